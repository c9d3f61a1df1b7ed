"""Embedding cache as a table keyed by hash of model and text: lookups, missing texts, upserts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from quern.functions.text import cache_key


def corrupt(cache: DataFrame) -> DataFrame:
    """(cache_key, dimensions, stored) of entries whose vector is not of the stated length."""
    bad = cache.where(F.col("vector").isNull() | (F.size("vector") != F.col("dimensions")))
    return bad.select("cache_key", "dimensions", F.when(F.col("vector").isNotNull(), F.size("vector")).alias("stored"))


def lookup(texts: DataFrame, cache: DataFrame, model: str, text: str = "text", strict: bool = False) -> DataFrame:
    """Adds vector (null where none is stored); strict: a corrupt entry fails the job."""
    own = cache.where(F.col("model") == model).select("cache_key", "dimensions", "vector")
    joined = texts.withColumn("cache_key", cache_key(F.lit(model), F.col(text))).join(own, "cache_key", "left")
    if strict:
        wrong = F.col("vector").isNotNull() & (F.size("vector") != F.col("dimensions"))
        joined = joined.withColumn("vector", F.when(wrong, F.raise_error(F.lit("corrupt cached embedding")).cast("array<float>")).otherwise(F.col("vector")))
    return joined.drop("cache_key", "dimensions")


def missing_texts(texts: DataFrame, cache: DataFrame, model: str, text: str = "text") -> DataFrame:
    """Distinct non-null texts without an entry of the model: only these go to the embedding service."""
    distinct = texts.where(F.col(text).isNotNull()).select(text).distinct()
    keyed = distinct.withColumn("cache_key", cache_key(F.lit(model), F.col(text)))
    return keyed.join(cache.where(F.col("model") == model).select("cache_key"), "cache_key", "left_anti").select(text)


def upserted(cache: DataFrame, fresh: DataFrame, order: str) -> DataFrame:
    """The cache with fresh entries in place of stored ones of the same key; the last fresh one by order counts."""
    columns = ["cache_key", "model", "text_value", "dimensions", "vector"]
    kept = cache.select(*columns).join(fresh.select("cache_key"), "cache_key", "left_anti")
    return kept.unionByName(last_entries(fresh, order).select(*columns))


def last_entries(fresh: DataFrame, order: str) -> DataFrame:
    """The last entry of each key by order."""
    last = Window.partitionBy("cache_key").orderBy(F.col(order).desc())
    return fresh.withColumn("_n", F.row_number().over(last)).where("_n = 1").drop("_n", order)


def entries(texts_with_vectors: DataFrame, model: str, text: str = "text") -> DataFrame:
    """Cache rows from (text, vector)."""
    return texts_with_vectors.select(
        cache_key(F.lit(model), F.col(text)).alias("cache_key"), F.lit(model).alias("model"), F.col(text).alias("text_value"),
        F.size("vector").alias("dimensions"), F.col("vector").cast("array<float>").alias("vector"),
    )
