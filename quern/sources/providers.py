"""External services behind one interface: requests go in as rows, replies come out as rows.

A provider is any function from a batch of requests to replies; it runs in mapInPandas, so that the services are called
from the executors. Nothing here opens a connection: the default provider replays recorded replies, which makes every run
repeatable. A reply that failed carries its error and is stored like any other, so that a resumed run does not repeat it.
"""

from __future__ import annotations

import random
import time
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from quern import schemas


@dataclass
class Throttle:
    """At least delay seconds between two calls of one partition."""

    delay: float = 0.0
    last: float = 0.0

    def wait(self) -> None:
        now = time.monotonic()
        if now < self.last + self.delay:
            time.sleep(self.last + self.delay - now)
        self.last = time.monotonic()


def with_retries(call: Callable[[], object], attempts: int = 5, most_wait: float = 30.0, pause: Callable[[float], None] = time.sleep) -> object:
    """The result of call; on any exception it is tried again with exponential, jittered waits."""
    for attempt in range(attempts):
        try:
            return call()
        except Exception:
            if attempt + 1 == attempts:
                raise
            pause(random.uniform(0, min(most_wait, 2.0**attempt)))
    raise AssertionError("unreachable")


def called(requests: DataFrame, provider: Callable[[dict], dict], schema: StructType, parallel: int = 1, delay: float = 0.0, attempts: int = 5) -> DataFrame:
    """Replies of a provider to each request; parallel partitions call it, each so slowly that together they keep to delay.

    A request whose last attempt fails gives its key fields and the error as 'Type: message'.
    """
    fields = schema.fieldNames()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        throttle = Throttle(delay * parallel)

        def one(row: dict) -> dict:
            def call() -> dict:
                throttle.wait()
                return provider(row)

            try:
                return {**{k: row.get(k) for k in fields}, **with_retries(call, attempts)}
            except Exception as problem:  # noqa: BLE001
                return {**{k: row.get(k) for k in fields}, "error": f"{type(problem).__name__}: {problem}"}

        for batch in batches:
            yield pd.DataFrame([one(row) for row in batch.to_dict("records")], columns=fields)

    # a shuffle, so that what comes before is not squeezed into so few tasks
    return requests.repartition(parallel).mapInPandas(run, schema)


def replayed(requests: DataFrame, recorded: DataFrame, keys: list[str]) -> DataFrame:
    """Recorded replies to requests; a request without one has an error."""
    marked = recorded.withColumn("_known", F.lit(True))
    joined = requests.select(*keys).join(marked, keys, "left")
    error = F.when(F.col("_known").isNull(), F.lit("LookupError: no recorded reply"))
    has_error = "error" in recorded.columns
    return joined.withColumn("error", F.coalesce(error, F.col("error")) if has_error else error).drop("_known")


def embedded(texts: DataFrame, embed: Callable[[list[str]], Iterable[list[float]]], model: str, batch_size: int = 64, parallel: int = 1) -> DataFrame:
    """Cache rows of texts (one column, text) from an embedding service called in batches; a short reply is an error.

    A service that numbers its vectors, as (index, vector), may give them in any order.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            values = batch["text"].tolist()
            for at in range(0, len(values), batch_size):
                part = values[at : at + batch_size]
                replies = with_retries(lambda part=part: list(embed(part)))
                if replies and isinstance(replies[0], tuple):
                    replies = [vector for _, vector in sorted(replies)]
                vectors = [list(map(float, v)) for v in replies]
                if len(vectors) != len(part):
                    raise ValueError(f"{len(vectors)} vectors for {len(part)} texts")
                yield pd.DataFrame({"text": part, "vector": vectors})

    from quern.sources.embedding_cache import entries

    return entries(texts.select("text").repartition(parallel).mapInPandas(run, "text string, vector array<float>"), model)


def search_titles(queries: DataFrame, pages: DataFrame, limit: int = 8) -> DataFrame:
    """Offline title search over a page table: (query_id, title, place) of pages whose title is the query's text."""
    from pyspark.sql.window import Window

    from quern.functions.text import casefold, normalize_space

    titled = pages.select("title", casefold(normalize_space(F.col("title"))).alias("key")).distinct()
    met = queries.withColumn("key", casefold(normalize_space(F.col("query")))).join(titled, "key")
    place = F.row_number().over(Window.partitionBy("query_id").orderBy("title"))
    return met.withColumn("place", place).where(F.col("place") <= limit).select("query_id", "title", "place")


def extracts(titles: DataFrame, pages: DataFrame) -> DataFrame:
    """(title, text) of titles that the page table has with text."""
    return titles.select("title").distinct().join(pages.select("title", "text").where(F.length(F.trim("text")) > 0), "title")


PAGE_SCHEMA = schemas.PAGE
