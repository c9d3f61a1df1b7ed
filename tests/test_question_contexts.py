"""Contexts of the answers: every usable vector takes part, as compared text by text."""

from quern.plans.reference_queries import mentioned_vectors


def test_contexts_hold_every_mentioning_vector(spark):
    pairs = spark.createDataFrame([("p", "Lake Oro", "Ann"), ("q", "Oro", "none")], "pair_id string, concept_1 string, concept_2 string")
    texts = ["lake oro", "flows into: Lake Oro", "Lake Oro flows_into", "Ann Lake Oro", "Annex", "Oro", "Lake", None]
    # all keys begin alike: a cap for each prefix of the key would pass over most of these
    rows = [(f"ab{i}", "concept-embed-b", t, 2, [float(i), 1.0]) for i, t in enumerate(texts)]
    rows += [(f"ab{100 + i}", "concept-embed-b", "Ann", 2, [100.0 + i, 1.0]) for i in range(40)]
    rows += [("ab200", "concept-embed-b", "Ann", 2, [float("nan"), 1.0]), ("ab201", "concept-embed-b", "Ann", 3, [1.0, 1.0]), ("ab202", "concept-embed-a", "Ann", 2, [1.0, 1.0])]
    cache = spark.createDataFrame(rows, "cache_key string, model string, text_value string, dimensions int, vector array<float>")
    got = {r["pair_id"]: sorted(v[0] for v in r["vectors"]) for r in mentioned_vectors(pairs, cache).collect()}
    assert got == {"p": [0, 1, 2, 3, *range(100, 140)], "q": [0, 1, 2, 3, 5]}
