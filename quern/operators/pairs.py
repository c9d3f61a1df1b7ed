"""Loading of concept pairs: normalisation, first-wins deduplication, stable ids, group reports."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from quern.functions.text import casefold, normalize_space, relation_slug, stable_pair_id


def load_pairs(raw: DataFrame, position: str = "row_no", strict: bool = True) -> DataFrame:
    """(position, pair_id, base_relation, concept_1, concept_2): the first row of each folded triple.

    strict: a blank required value fails the job and names the row; otherwise such rows are left out.
    """
    tidy = raw.select(
        F.col(position), normalize_space(F.coalesce("pair_id", F.lit(""))).alias("given_id"),
        *(normalize_space(F.coalesce(c, F.lit(""))).alias(c) for c in ("base_relation", "concept_1", "concept_2")),
    )
    whole = (F.col("base_relation") != "") & (F.col("concept_1") != "") & (F.col("concept_2") != "")
    if strict:
        fail = F.raise_error(F.concat(F.lit("blank required value in row "), F.col(position).cast("string")))
        tidy = tidy.withColumn("base_relation", F.when(whole, F.col("base_relation")).otherwise(fail.cast("string")))
    else:
        tidy = tidy.where(whole)
    keyed = tidy.select("*", relation_slug(F.col("base_relation")).alias("slug"), casefold(F.col("concept_1")).alias("f1"), casefold(F.col("concept_2")).alias("f2"))
    first = keyed.withColumn("n", F.row_number().over(Window.partitionBy("slug", "f1", "f2").orderBy(position))).where("n = 1")
    pair_id = F.when(F.col("given_id") != "", F.col("given_id")).otherwise(stable_pair_id(F.col("base_relation"), F.col("concept_1"), F.col("concept_2")))
    return first.select(position, pair_id.alias("pair_id"), F.col("slug").alias("base_relation"), "concept_1", "concept_2")


def repeated_pair_ids(pairs: DataFrame) -> DataFrame:
    """(pair_id, n) of ids that different pairs share: loading must not go on with them."""
    return pairs.groupBy("pair_id").agg(F.count(F.lit(1)).alias("n")).where("n > 1")


def one_pair_per_id(pairs: DataFrame, position: str = "row_no") -> DataFrame:
    """The first pair of each id, where repeated ids are tolerated."""
    first = Window.partitionBy("pair_id").orderBy(position)
    return pairs.withColumn("n", F.row_number().over(first)).where("n = 1").drop("n")


def group_report(pairs: DataFrame) -> DataFrame:
    """(base_relation, pair_count, distinct_ids)."""
    return pairs.groupBy("base_relation").agg(F.count(F.lit(1)).alias("pair_count"), F.countDistinct("pair_id").alias("distinct_ids"))


def undersized_groups(pairs: DataFrame, target_count: int = 4) -> DataFrame:
    """(base_relation, pair_count) of groups too small for one stem and its targets."""
    return pairs.groupBy("base_relation").agg(F.count(F.lit(1)).alias("pair_count")).where(F.col("pair_count") < target_count + 1)


def unfinished(inputs: DataFrame, finished: DataFrame, key: str = "pair_id") -> DataFrame:
    """Resume: inputs without a stored record, whether it failed or not; placed before every costly step."""
    return inputs.join(finished.select(key), key, "left_anti")
