"""Stages as incremental streams: new input files are processed once, results appended, finished keys skipped."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from quern.operators.pairs import unfinished
from quern.sources.files import table_or_empty


def run_incrementally(spark: SparkSession, source: str, schema: StructType, stage: Callable[[DataFrame], DataFrame], output: str, output_schema: StructType, checkpoint: str, key: str = "pair_id") -> StreamingQuery:
    """Process the Parquet files of a folder that are new since the last call, and stop.

    Each batch first drops keys that the output already holds, so that a repeated file adds nothing. The checkpoint folder
    and the output must be on storage that all executors share.
    """

    def append(batch: DataFrame, _: int) -> None:
        stored = table_or_empty(spark, output, output_schema)
        fresh = unfinished(batch.dropDuplicates([key]), stored.select(key).distinct(), key)
        stage(fresh).write.mode("append").parquet(output)

    stream = spark.readStream.schema(schema).parquet(source)
    return stream.writeStream.foreachBatch(append).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def windowed_counts(events: DataFrame, time_col: str, key: str, lateness: str = "10 minutes", window: str = "5 minutes") -> DataFrame:
    """Counts by key and time window with late rows admitted up to the watermark; works on streams and on tables."""
    from pyspark.sql import functions as F

    return events.withWatermark(time_col, lateness).groupBy(F.window(time_col, window), key).agg(F.count(F.lit(1)).alias("n"))
