"""File sources and sinks: pairs, JSON lines, the review table, aliases, the report."""

from __future__ import annotations

import json
from pathlib import Path

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from quern import schemas

REQUIRED_PAIR_COLUMNS = ("base_relation", "concept_1", "concept_2")


def _csv(spark: SparkSession, path: str):
    return spark.read.option("header", True).option("multiLine", True).option("escape", '"').option("encoding", "UTF-8")


def read_pairs_csv(spark: SparkSession, path: str) -> DataFrame:
    """(row_no, pair_id, base_relation, concept_1, concept_2) as typed; a missing file or column is an error.

    The header decides where a column stands; extra columns are ignored. row_no orders rows of a file.
    """
    if not _exists(spark, path):
        raise FileNotFoundError(path)
    raw = _csv(spark, path).csv(path)  # with a header and no schema every column is text: nothing is inferred
    raw = raw.toDF(*[c.lstrip("﻿") for c in raw.columns])
    missing = sorted(set(REQUIRED_PAIR_COLUMNS) - set(raw.columns))
    if missing:
        raise ValueError(f"missing columns: {missing}")
    pair_id = F.col("pair_id") if "pair_id" in raw.columns else F.lit(None).cast("string")
    return raw.select(F.monotonically_increasing_id().alias("row_no"), pair_id.alias("pair_id"), *REQUIRED_PAIR_COLUMNS)


def _exists(spark: SparkSession, path: str) -> bool:
    jvm = spark._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target)


def read_jsonl(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """Records of JSON lines; a missing path has none, blank lines are skipped, a malformed line fails the job."""
    if not _exists(spark, path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("mode", "FAILFAST").json(path)


def write_jsonl(df: DataFrame, path: str) -> None:
    """Overwrite; null fields are written. The commit protocol makes the result appear whole."""
    df.write.mode("overwrite").option("ignoreNullFields", False).json(path)


def append_jsonl(df: DataFrame, path: str) -> None:
    df.write.mode("append").option("ignoreNullFields", False).json(path)


def finished_ids(records: DataFrame, id_field: str = "pair_id") -> DataFrame:
    """Distinct ids of stored records, failed ones included; only that column is read."""
    return records.select(id_field).where(F.col(id_field).isNotNull()).distinct()


def write_review_csv(rows: DataFrame, path: str) -> None:
    """The one editable file for reviewers, columns in fixed order, with a byte-order mark for spreadsheets."""
    header = rows.select([F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in schemas.REVIEW_COLUMNS])
    marked = header.withColumnRenamed(schemas.REVIEW_COLUMNS[0], "﻿" + schemas.REVIEW_COLUMNS[0])
    marked.coalesce(1).write.mode("overwrite").option("header", True).option("escape", '"').option("emptyValue", "").csv(path)


def read_review_csv(spark: SparkSession, path: str) -> DataFrame:
    """Review rows as text with their ordinal, empty cells as ''."""
    raw = _csv(spark, path).option("nullValue", "\0").option("emptyValue", "").csv(path)
    raw = raw.toDF(*[c.lstrip("﻿") for c in raw.columns])
    kept = [F.coalesce(F.col(c), F.lit("")).alias(c) if c in raw.columns else F.lit("").alias(c) for c in schemas.REVIEW_COLUMNS]
    return raw.select(F.monotonically_increasing_id().alias("row_no"), *kept)


def read_aliases(path: str | None) -> dict[str, list[str]]:
    """{canonical: variants} of a YAML file; none if it is missing."""
    if path is None or not Path(path).exists():
        return {}
    import yaml

    raw = yaml.safe_load(Path(path).read_text(encoding="utf-8")) or {}
    return {str(k): [str(x) for x in v] if isinstance(v, list) else [str(v)] for k, v in raw.items()}


def alias_table(spark: SparkSession, aliases: dict[str, list[str]]) -> DataFrame:
    """(variant, canonical) as slugs; later duplicates win."""
    from quern.functions.text import relation_slug

    rows = [(i, k, v) for i, (k, vs) in enumerate(aliases.items()) for v in [k, *vs]]
    typed = spark.createDataFrame([(n, *r) for n, r in enumerate(rows)], "n bigint, i bigint, k string, v string")
    slugs = typed.select("n", relation_slug(F.col("v")).alias("variant"), relation_slug(F.col("k")).alias("canonical"))
    return slugs.groupBy("variant").agg(F.max_by("canonical", "n").alias("canonical"))


def read_published(spark: SparkSession, folder: str) -> DataFrame:
    """Published questions: answers by value, the base relation in the file's name."""
    raw = spark.read.option("multiLine", True).schema(schemas.PUBLISHED_QUESTION).json(folder)
    return raw.select(F.regexp_replace(F.col("_metadata.file_name"), r"\.json$", "").alias("base_relation"), "*")


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A small text file, on whatever storage the path names."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    out = target.getFileSystem(spark._jsc.hadoopConfiguration()).create(target, True)
    try:
        out.write(bytearray(text.encode("utf-8")))
    finally:
        out.close()


def write_report(report: DataFrame, path: str) -> dict:
    """A one-row report as readable JSON."""
    row = json.loads(report.toJSON().first())
    write_text(report.sparkSession, path, json.dumps(row, indent=2, ensure_ascii=False))
    return row


def table_or_empty(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """Parquet where it exists, else no rows."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException:
        return spark.createDataFrame([], schema)
