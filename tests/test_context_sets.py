"""The kernel of context similarity against brute force, on sets of any size and origin, without ranges of ids."""

import math
import random

from quern.functions import vectors as V


def _cosine(u, v):
    size = math.sqrt(sum(x * x for x in u)) * math.sqrt(sum(x * x for x in v))
    return sum(x * y for x, y in zip(u, v)) / size if size else 0.0


def test_context_similarity_by_brute_force(spark):
    rng = random.Random(3)
    vectors = [[0.0] * 5, *([rng.gauss(0, 1) for _ in range(5)] for _ in range(400))]
    sets = [(f"k{i}", rng.choices(vectors, k=rng.choice((0, 1, 7, 130))), rng.choices(vectors, k=rng.choice((0, 2, 90)))) for i in range(25)]
    sides = spark.createDataFrame(sets, "k string, l array<array<double>>, r array<array<double>>")
    for threshold in (-1.0, 0.2, 0.99):
        got = {r["k"]: r["similarity"] for r in V.context_similarity(sides, ["k"], "l", "r", threshold).collect()}
        assert len(got) == len(sets)
        for k, left, right in sets:
            kept = [c for u in left for v in right if (c := _cosine(u, v)) > threshold]
            assert abs(got[k] - (sum(kept) / len(kept) if kept else 0.0)) < 1e-9
