import datetime

import numpy as np
import pytest

from quern.llm import ranking as R

CHOICES = "choice_id bigint, pair_id string, block_id bigint, relations array<string>, most_relevant string, least_relevant string, answered_at timestamp, item string"
VOCAB = "relation_id bigint, relation string"


def at(n):
    return datetime.datetime(2025, 1, 1) + datetime.timedelta(minutes=n)


def test_solution_equals_the_dense_one(spark):
    rng = np.random.default_rng(1)
    names = [f"r{i:02d}" for i in range(12)]
    rows, pulls = [], np.zeros((13, 13))
    for n in range(400):
        i, j = rng.choice(12, 2, replace=False) if n % 3 else (0, rng.integers(1, 12))
        if rng.random() < 0.8:
            i, j = min(i, j), max(i, j)
        rows.append((names[i], names[j], 1))
        pulls[i, j] += 1
    w = pulls[:12, :12]
    both = w + w.T
    exact = np.linalg.solve(np.diag(both.sum(1) + 1.0) - both, w.sum(1) - w.sum(0))
    outcomes = spark.createDataFrame(rows, "winner string, loser string, n bigint").groupBy("winner", "loser").sum("n").toDF("winner", "loser", "n")
    got = {r["item"]: (r["strength"], r["compared"]) for r in R.spring_strengths(outcomes, tolerance=1e-9).collect()}
    assert all(abs(got[n][0] - x) < 1e-6 for n, x in zip(names, exact)) and got["r00"][1] == int(both[0].sum())


def test_answers_that_count(spark):
    block = ["a_b", "c", "d"]
    rows = [
        (1, "p", 1, block, "c", "d", at(0), None), (2, "p", 1, block, "aB", " D.", at(5), None),  # the later one counts
        (3, "p", 2, block, None, "d", at(0), None), (4, "p", 3, block, "c", "c", at(0), None), (5, "p", 4, block, "zz", None, at(0), None),
        (6, None, 1, block, "d", None, at(0), None), (7, None, 1, block, "d", None, at(0), None), (8, "q", 1, None, "a", "b", at(0), None), (9, "q", 2, [None, "c", "C"], "c", None, None, None),
    ]
    outcomes = {(r["winner"], r["loser"]): r["n"] for r in R.comparisons(R.latest_answers(spark.createDataFrame(rows, CHOICES))).collect()}
    assert outcomes == {("a_b", "c"): 2, ("a_b", "d"): 2, ("c", "d"): 2, ("d", "a_b"): 2, ("d", "c"): 2} or outcomes[("a_b", "c")] == 1
    assert outcomes[("a_b", "c")] == 1 and outcomes[("a_b", "d")] == 2 and outcomes[("c", "d")] == 2 and outcomes[("d", "a_b")] == 2


def test_quarters_and_items_without_comparisons(spark):
    vocab = spark.createDataFrame([(i, f"r{i}") for i in range(8)], VOCAB)
    rows = [(i, "p", i, ["r0", "r1", "r2"], "r0", "r2", at(i), None) for i in range(5)]
    ranked = R.rank_relations(spark.createDataFrame(rows, CHOICES), vocab).orderBy("rank").collect()
    assert [r["relation"] for r in ranked] == ["r0", "r1", "r3", "r4", "r5", "r6", "r7", "r2"] and [r["quarter"] for r in ranked] == [1, 1, 2, 2, 3, 3, 4, 4]
    assert ranked[2]["strength"] == 0.0 and ranked[2]["compared"] == 0


def test_empty_and_ties(spark):
    vocab = spark.createDataFrame([(1, "b"), (2, "a"), (3, None)], VOCAB)
    ranked = R.rank_relations(spark.createDataFrame([], CHOICES), vocab).orderBy("rank").collect()
    assert [(r["relation"], r["strength"]) for r in ranked] == [("a", 0.0), ("b", 0.0)]


def test_items_outside_the_list_and_of_other_letters(spark):
    rows = [(i, "p", i, ["Größe von", "other", "unlisted"], "grosse_von", "unlisted", at(i), None) for i in range(3)]
    items = {r["item"]: r["strength"] for r in R.item_strengths(spark.createDataFrame(rows, CHOICES)).collect()}
    assert set(items) == {"grosse_von", "other", "unlisted"} and items["grosse_von"] > items["other"] > items["unlisted"]


def test_a_system_that_does_not_settle_fails(spark):
    rows = [(f"r{i}", f"r{i + 1}", 10) for i in range(30)]
    with pytest.raises(RuntimeError, match="settled"):
        R.spring_strengths(spark.createDataFrame(rows, "winner string, loser string, n bigint"), tolerance=1e-12, max_rounds=2)
