import numpy as np
import pytest

from quern.llm import neighbours as N

SCHEMA = "cache_key string, model string, text_value string, dimensions int, vector array<float>, neighbour string"


def clustered(n, dims, seed=3, spread=0.15):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(n // 8 + 1, dims))
    x = centres[rng.integers(0, len(centres), n)] + spread * rng.normal(size=(n, dims))
    return x * rng.uniform(0.2, 5.0, size=(n, 1))


def exact(x, top=5, least=0.82):
    u = x / np.linalg.norm(x, axis=1)[:, None]
    s = u @ u.T
    np.fill_diagonal(s, -1)
    return {(min(i, j), max(i, j)) for i in range(len(x)) for j in np.argsort(-s[i], kind="stable")[:top] if s[i, j] >= least}


def pairs(spark, rows, **options):
    return {tuple(r) for r in N.neighbour_pairs(spark.createDataFrame(rows, SCHEMA), **options).collect()}


@pytest.mark.parametrize("n,dims", [(3000, 32), (700, 7)])
def test_recall_against_brute_force(spark, n, dims):
    x = clustered(n, dims).astype(np.float32)
    rows = [(f"k{i:05d}", "m", None, dims, [float(v) for v in row], None) for i, row in enumerate(x)]
    got = pairs(spark, rows)
    want = {(f"k{a:05d}", f"k{b:05d}") for a, b in exact(x.astype(np.float64))}
    assert len(got & want) >= 0.97 * len(want) and len(got & want) >= 0.97 * len(got)


def test_vectors_that_take_no_part(spark):
    good = [("a", "m", "t", 2, [1.0, 0.0], None), ("b", "m", None, 2, [2.0, 0.01], None), ("c", "n", None, 2, [1.0, 0.0], None)]
    bad = [("d", "m", None, 2, None, None), ("e", "m", None, 2, [0.0, 0.0], None), ("f", "m", None, 2, [float("nan"), 1.0], None), ("g", "m", None, 2, [float("inf"), 1.0], None), ("h", "m", None, 3, [1.0, 0.0], None), ("i", "m", None, 2, [None, 1.0], None), (None, "m", None, 2, [1.0, 0.0], None), ("j", None, None, 2, [1.0, 0.0], None), ("k", "m", None, None, [1.0, 0.0], None)]
    assert pairs(spark, good + bad) == {("a", "b")}
    assert pairs(spark, []) == set() and pairs(spark, bad) == set()


def test_ties_repeats_and_one_dimension(spark):
    same = [(k, "m", None, 3, [1.0, 2.0, 2.0], None) for k in "abcdefgh"]
    got = pairs(spark, [*same, same[0]], top=2)
    assert got == {("a", k) for k in "bcdefgh"} | {("b", k) for k in "cdefgh"}
    assert pairs(spark, [("a", "m", None, 1, [2.0], None), ("b", "m", None, 1, [5.0], None), ("c", "m", None, 1, [-1.0], None)]) == {("a", "b")}


def rows_of(x):
    return [(f"k{i:05d}", "m", None, x.shape[1], [float(v) for v in row], None) for i, row in enumerate(x)]


def test_large_groups_are_split_without_more_copies(spark):
    x = clustered(4000, 16).astype(np.float32)
    want = {(f"k{a:05d}", f"k{b:05d}") for a, b in exact(x.astype(np.float64))}
    frame = spark.createDataFrame(rows_of(x), SCHEMA).selectExpr("cache_key AS key", "model", "dimensions", "vector")
    batch = frame.toArrow().combine_chunks().to_batches()[0]
    for size in (1 << 20, 16 * 4 * 250):  # whole groups, groups of about 250 vectors
        books = N.fit_codebooks(frame, group_bytes=size)
        assert N.route(batch, books).num_rows <= N.MAX_GROUPS * len(x)
        got = pairs(spark, rows_of(x), group_bytes=size)
        assert len(got & want) >= 0.97 * max(len(want), len(got))
    assert books[("m", 16)]["part_of"] is not None


def test_many_equal_vectors_are_not_compared(spark):
    x = clustered(300, 8).astype(np.float32)
    x[50:250] = x[7]
    rows = rows_of(x)
    want = {(f"k{a:05d}", f"k{b:05d}") for a, b in exact(x.astype(np.float64))}
    assert pairs(spark, rows + rows[:60]) == want
    single, surplus = N.without_surplus_copies(spark.createDataFrame(rows, SCHEMA).selectExpr("cache_key AS key", "model", "dimensions", "vector"), 5)
    assert single.count() == 105 and surplus.count() == 195 * 5


def test_near_equal_vectors_in_bounded_memory():
    import resource

    import pyarrow as pa

    n, dims = 20_000, 64
    rng = np.random.default_rng(4)
    x = (np.ones(dims) + 0.01 * rng.normal(size=(n, dims))).astype(np.float32)
    x /= np.linalg.norm(x, axis=1)[:, None]
    packed = np.round(x / np.abs(x).max(1)[:, None] * 32767).astype("<i2")
    before = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss
    table = pa.table({"key": [f"k{i:05d}" for i in range(n)], "is_entry": [True] * n, "c2": pa.array([0] * n, pa.int16()), "cells": pa.array([[0]] * n, pa.list_(pa.int16())), "packed": [row.tobytes() for row in packed]})
    got = N.answer(table, 5, 0.82)
    assert resource.getrusage(resource.RUSAGE_SELF).ru_maxrss - before < 1_000_000  # kilobytes
    y = packed[:40].astype(np.float64) / np.linalg.norm(packed[:40].astype(np.float64), axis=1)[:, None]
    z = packed.astype(np.float64) / np.linalg.norm(packed.astype(np.float64), axis=1)[:, None]
    near = {}
    for k, t in zip(got.column("key").to_pylist(), got.column("neighbour").to_pylist()):
        near.setdefault(k, []).append(int(t[1:]))
    for i, s in enumerate(y @ z.T):
        s[i] = -1
        assert np.allclose(np.sort(s[near[f"k{i:05d}"]]), np.sort(s)[-5:], atol=3e-6)


def test_traversal_is_in_order_of_the_sums():
    rng = np.random.default_rng(0)
    d1, d2 = rng.random(9), rng.random(11)
    found = [(i, j) for i, _, cells in N.traverse(d1, d2, probes=20, groups=9) for j in cells]
    order = sorted(((d1[i] + d2[j], i, j) for i in range(9) for j in range(11)))
    assert set(found) == {(i, j) for _, i, j in order[:20]}
