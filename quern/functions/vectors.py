"""Vector kernels in double precision."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def dot(u: Column, v: Column) -> Column:
    products = F.zip_with(u, v, lambda x, y: x.cast("double") * y.cast("double"))
    return F.aggregate(products, F.lit(0.0), lambda acc, x: acc + x)


def norm(u: Column) -> Column:
    return F.sqrt(F.aggregate(u, F.lit(0.0), lambda acc, x: acc + x.cast("double") * x.cast("double")))


def cosine(u: Column, v: Column) -> Column:
    """Cosine; 0 where either norm is 0."""
    size = norm(u) * norm(v)
    return F.when(size == 0, 0.0).otherwise(dot(u, v) / F.when(size == 0, 1.0).otherwise(size))


def unit(u: Column) -> Column:
    """Unit vector of a non-zero vector, the zero vector as it is: a later cosine is one dot product."""
    size = norm(u)
    return F.transform(u, lambda x: x.cast("double") / F.when(size == 0, 1.0).otherwise(size))


def overlap(stem: Column, target: Column) -> Column:
    """Sum of products of the scores that two maps share."""
    shared = F.map_zip_with(stem, target, lambda _, s, t: F.coalesce(s * t, F.lit(0.0)))
    return F.coalesce(F.aggregate(F.map_values(shared), F.lit(0.0), lambda acc, x: acc + x), F.lit(0.0))


def _unit_sets(column: pa.Array) -> list[np.ndarray]:
    """Each row's vectors as one matrix of unit rows; null rows and null vectors are left out, zero vectors stay zero."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    sets = []
    for row in column:
        vectors = [v for v in (row.values or ()) if v.is_valid] if row.is_valid else []
        if not vectors:
            sets.append(np.zeros((0, 0)))
            continue
        m = np.stack([v.values.to_numpy(zero_copy_only=False).astype(np.float64) for v in vectors])
        size = np.sqrt((m * m).sum(1))
        sets.append(m / np.where(size == 0, 1.0, size)[:, None])
    return sets


def context_similarity(sides: DataFrame, keys: list[str], left: str, right: str, threshold: float = 0.5) -> DataFrame:
    """(keys, similarity): mean of the cosines above threshold over all pairs of two arrays of vectors, 0 without any.

    Both arrays of a row are small (the contexts of one pair); their cosines are one matrix product. Vectors of different
    length in a row fail the job.
    """
    fields = [sides.schema[k] for k in keys]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields) + ", similarity double"
    n = len(keys)

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for u, v in zip(_unit_sets(batch.column(n)), _unit_sets(batch.column(n + 1))):
                c = (u @ v.T).ravel() if len(u) and len(v) else np.zeros(0)
                kept = c[c > threshold]
                out.append(float(kept.mean()) if len(kept) else 0.0)
            yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in range(n)), pa.array(out, pa.float64())], names=[*keys, "similarity"])

    return sides.select(*keys, left, right).mapInArrow(compare, schema)


def ties(values: Column, tolerance: float = 1e-10) -> Column:
    """Indices of the values within tolerance of the largest; an empty array fails."""
    top = F.array_max(values)
    near = F.filter(F.transform(values, lambda x, i: F.when(F.abs(x - top) <= tolerance, i)), lambda i: i.isNotNull())
    return F.when(F.size(values) > 0, near).otherwise(F.raise_error(F.lit("no values")).cast("array<int>"))


def answer(values: Column, tolerance: float = 1e-10) -> Column:
    """First index within tolerance of the largest."""
    return F.element_at(ties(values, tolerance), 1)
