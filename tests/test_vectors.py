import pytest
from pyspark.sql import functions as F

from quern.functions import vectors as V


def test_overlap_uses_shared_relations_only(spark):
    df = spark.createDataFrame([({"capital": 2.0, "largest_city": 1.2}, {"capital": 1.5, "located_in": 0.9}), ({}, {"a": 1.0})], "s map<string,double>, t map<string,double>")
    assert [r[0] for r in df.select(V.overlap(F.col("s"), F.col("t"))).collect()] == [3.0, 0.0]


def test_context_similarity_is_the_mean_above_the_threshold(spark):
    schema = "k int, l array<array<float>>, r array<array<float>>"
    rows = [(1, [[1.0, 0.0]], [[1.0, 0.0], [0.0, 1.0]]), (2, [], [[1.0, 0.0]]), (3, None, None), (4, [[0.0, 0.0]], [[1.0, 0.0]]), (5, [[1.0, 0.0]], [[1.0, 1.7320508]])]
    got = {r["k"]: r["similarity"] for r in V.context_similarity(spark.createDataFrame(rows, schema), ["k"], "l", "r", 0.5).collect()}
    assert got[1] == 1.0 and got[2] == got[3] == got[4] == 0.0
    assert got[5] == 0.0 or got[5] == pytest.approx(0.5, abs=1e-6)  # the threshold is strict, float32 decides


def test_cosine_with_zero_vectors(spark):
    df = spark.createDataFrame([([3.0, 4.0], [3.0, 4.0]), ([0.0, 0.0], [1.0, 0.0])], "u array<float>, v array<float>")
    assert [r[0] for r in df.select(V.cosine(F.col("u"), F.col("v"))).collect()] == [pytest.approx(1.0), 0.0]


def test_ties(spark):
    df = spark.createDataFrame([([0.1, 0.5, 0.5],), ([0.5 - 5e-11, 0.5],)], "v array<double>")
    assert [tuple(r) for r in df.select(V.answer(F.col("v"), 1e-12), V.ties(F.col("v"), 1e-12)).collect()][0] == (1, [1, 2])
    assert [r[0] for r in df.select(V.answer(F.col("v"), 1e-10)).collect()][1] == 0  # the first within tolerance, not the largest
    with pytest.raises(Exception, match="no values"):
        spark.createDataFrame([([],)], "v array<double>").select(V.ties(F.col("v"))).collect()
