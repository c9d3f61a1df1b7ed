"""Pairs, evidence, relations, questions and quality on small fixtures, and the traps of their semantics."""

import pytest
from pyspark.sql import functions as F

from quern import schemas
from quern.config import Questions, RelationFilter
from quern.operators import evidence as ev
from quern.operators import pairs as pr
from quern.operators import quality as ql
from quern.operators import questions as qs
from quern.operators import relations as rl

RAW = "row_no bigint, pair_id string, base_relation string, concept_1 string, concept_2 string"


def test_dedupe_comes_before_the_id_check(spark):
    raw = spark.createDataFrame([(1, "p1", "Capital", "Paris", "France"), (2, "p1", "capital", "PARIS", "France"), (3, None, "capital", "Rome", "Italy")], RAW)
    pairs = pr.load_pairs(raw)
    assert [(r["row_no"], r["base_relation"], r["concept_1"]) for r in pairs.orderBy("row_no").collect()] == [(1, "capital", "Paris"), (3, "capital", "Rome")]
    assert pr.repeated_pair_ids(pairs).count() == 0


def test_clashing_ids_and_blanks(spark):
    raw = spark.createDataFrame([(1, "p", "r", "a", "b"), (2, "p", "r", "c", "d")], RAW)
    assert [tuple(r) for r in pr.repeated_pair_ids(pr.load_pairs(raw)).collect()] == [("p", 2)]
    blank = spark.createDataFrame([(7, None, "r", " ", "b")], RAW)
    with pytest.raises(Exception, match="row 7"):
        pr.load_pairs(blank).collect()
    assert pr.load_pairs(blank, strict=False).count() == 0


def test_groups(spark):
    pairs = spark.createDataFrame([("p%d" % i, "big" if i < 5 else "small") for i in range(6)], "pair_id string, base_relation string")
    assert [tuple(r) for r in pr.undersized_groups(pairs).collect()] == [("small", 1)]
    assert {tuple(r) for r in pr.group_report(pairs).collect()} == {("big", 5, 5), ("small", 1, 1)}


def test_failed_records_are_finished_too(spark):
    inputs = spark.createDataFrame([("a",), ("b",)], "pair_id string")
    stored = spark.createDataFrame([("a", "boom")], "pair_id string, error string")
    assert [r[0] for r in pr.unfinished(inputs, stored).collect()] == ["b"]


PAGES = "page_id bigint, title string, text string"


def test_retrieval(spark):
    pairs = spark.createDataFrame([("p", "r", "Iran", "The Lake (novel)"), ("q", "r", "Nowhere", "Nothing")], "pair_id string, base_relation string, concept_1 string, concept_2 string")
    pages = spark.createDataFrame([(1, "Iran", "An Iranian saw the lake in spring. The lake is far from everything else. IRAN and The Lake met again here."), (2, "The Lake (novel)", "An Iranian saw the LAKE in spring. And the lake of Iran is old indeed."), (3, "Iran", None)], PAGES)
    records = {r["pair_id"]: r for r in ev.retrieve(pairs, pages).collect()}
    got = [(s["sentence_id"], s["text"], s["page_title"]) for s in records["p"]["evidence_sentences"]]
    assert got == [(0, "An Iranian saw the lake in spring.", "Iran"), (1, "IRAN and The Lake met again here.", "Iran"), (2, "And the lake of Iran is old indeed.", "The Lake (novel)")]
    assert not records["p"]["passes_minimum"] and records["q"]["evidence_sentences"] == []


def test_budget_stops_at_the_first_overflow(spark):
    df = spark.createDataFrame([("p", 0, "x" * 10), ("p", 1, "y" * 50), ("p", 2, "z")], "pair_id string, sentence_id int, text string")
    assert [r["sentence_id"] for r in ev.prompt_context(df, "sentence_id", "text", limit=30).collect()] == [0]


def _evidence(spark, rows):
    return spark.createDataFrame(rows, schemas.WIKI_EVIDENCE)


def test_mining(spark):
    pairs = spark.createDataFrame([(p, "capital", "x", "y") for p in "abc"], schemas.CONCEPT_PAIR)
    sentence = [{"sentence_id": 0, "text": "t", "page_title": "p", "page_url": None}]
    evidence = _evidence(spark, [("a", "capital", "x", "y", [], [], sentence, True, None), ("b", "capital", "x", "y", [], [], sentence, False, None)])
    reply = [("a", [("isCapitalOf", [0, 0, 9], "q", "e"), ("!!", [0], None, None), ("Seat Of", None, None, None)], None)]
    replies = spark.createDataFrame(reply, schemas.EXTRACTION)
    aliases = spark.createDataFrame([("is_capital_of", "capital")], "variant string, canonical string")
    rows = {r["pair_id"]: r for r in rl.mine(pairs, evidence, replies, aliases).collect()}
    assert [(r["normalized_predicate"], r["evidence_sentence_ids"], r["source"]) for r in rows["a"]["relations"]] == [("capital", [0], "openai"), ("seat_of", [], "openai")]
    assert rows["b"]["error"].startswith("1 evidence sentences of") and rows["c"]["error"] == "the pair has no evidence record"


def test_base_relation_is_injected(spark):
    pairs = spark.createDataFrame([("a", "capital", "x", "y")], schemas.CONCEPT_PAIR)
    evidence = _evidence(spark, [("a", "capital", "x", "y", [], [], [], True, None)])
    replies = spark.createDataFrame([("a", [("seat of", [], None, None)], None)], schemas.EXTRACTION)
    aliases = spark.createDataFrame([], "variant string, canonical string")
    relations = rl.mine(pairs, evidence, replies, aliases).first()["relations"]
    assert [(r["normalized_predicate"], r["source"]) for r in relations] == [("seat_of", "openai"), ("capital", "input_base_relation")]


def _mined(spark, predicates):
    relations = [(p, p, ids, None, None, source) for p, ids, source in predicates]
    return spark.createDataFrame([("a", "r", "x", "y", relations, None)], schemas.MINED_RELATIONS)


def test_review_rules_in_order(spark):
    mined = _mined(spark, [("r", [], "input_base_relation"), ("x", [0], "o"), ("related_to", [0], "o"), ("related_to", [0], "o"), ("best_friend", [0], "o"), ("current_seat", [0], "o"), ("seat_of", [], "o"), ("seat_of", [0], "o"), ("home_of", [7], "o")])
    evidence = _evidence(spark, [("a", "r", "x", "y", [], [], [{"sentence_id": 0, "text": "T0", "page_title": None, "page_url": None}], True, None)])
    rows = rl.review_rows(mined, evidence).orderBy("pos").collect()
    assert [r["suggested_category"] for r in rows] == ["base_relation", "malformed", "ambiguous", "duplicate", "opinion_based", "transient", "unsupported", "duplicate", "valid"]
    assert rows[2]["evidence_text"] == "T0" and rows[8]["evidence_text"] == "[missing sentence 7]"
    strict = rl.review_rows(mined, evidence, rules=RelationFilter(auto_reject_unsupported=True)).orderBy("pos").collect()
    assert strict[6]["suggested_decision"] == "reject"


def _review(spark, rows):
    full = [{**dict.fromkeys(schemas.REVIEW_COLUMNS, ""), "pair_id": "a", **r} for r in rows]
    df = spark.createDataFrame(full, schemas.REVIEW)
    return df.withColumn("row_no", F.col("reviewer_notes").cast("int"))


def test_finalising(spark):
    review = _review(spark, [
        {"final_decision": " ACCEPT", "final_relation": "Seat Of", "evidence_sentence_ids": "1,x,2", "reviewer_notes": "1"},
        {"final_decision": "accept", "final_relation": "", "normalized_predicate": "seat_of", "evidence_sentence_ids": "9", "reviewer_notes": "2"},
        {"final_decision": "reject", "normalized_predicate": "other", "base_relation": "last", "reviewer_notes": "3"},
        {"pair_id": "b", "final_decision": "reject", "reviewer_notes": "4"},
        {"final_decision": "", "suggested_decision": "review", "reviewer_notes": "5"},
    ])
    rows = rl.finalize(review, ["row_no"], use_suggestions=True).collect()
    assert len(rows) == 1 and rows[0]["base_relation"] == "last"
    assert [(r["relation"], r["evidence_sentence_ids"], r["source"]) for r in rows[0]["relations"]] == [("seat_of", [1, 2], "reviewed")]
    assert rl.unresolved(review).count() == 1


def _eligible(spark, n=5, relations=("r1", "r2")):
    rows = [(f"p{i}", "g", f"c{i}", f"d{i}", {r: 1.0 + i for r in relations}) for i in range(n)]
    return spark.createDataFrame(rows, "pair_id string, base_relation string, concept_1 string, concept_2 string, scores map<string,double>")


def test_pools_and_sampling(spark):
    eligible = _eligible(spark, 6)
    pools = qs.target_pools(eligible)
    assert pools.count() == 30 and pools.where("stem_id = target_id").count() == 0
    settings = Questions(target_count=4, questions_per_stem=3)
    sampled = qs.sampled_targets(qs.stem_schedule(eligible, settings), pools, settings)
    sets = sampled.groupBy("stem_id", "occurrence").agg(F.array_sort(F.collect_set("target_id")).alias("s")).collect()
    assert len(sets) == 18 and all(len(r["s"]) == 4 and r["stem_id"] not in r["s"] for r in sets)
    assert len({(r["stem_id"], tuple(r["s"])) for r in sets}) == 18
    again = qs.sampled_targets(qs.stem_schedule(eligible.repartition(7), settings), pools.repartition(3), settings)
    assert sorted(map(tuple, sampled.collect())) == sorted(map(tuple, again.collect()))


def test_long_lists_are_met_in_parts(spark):
    eligible = _eligible(spark, 60)
    whole = {tuple(r) for r in qs.target_pools(eligible).collect()}
    assert len(whole) == 60 * 59
    parts = {tuple(r) for r in qs.target_pools(eligible, part=6, draws=2).collect()}
    assert parts < whole and {s for s, _ in parts} == {f"p{i}" for i in range(60)} and len(parts) < 60 * 45
    settings = Questions()
    assert qs.sampled_targets(qs.stem_schedule(eligible, settings), qs.target_pools(eligible, part=6), settings).groupBy("stem_id").count().where("count = 4").count() == 60


def test_long_lists_are_met_whole(spark):
    eligible = _eligible(spark, 200, ("r1",))
    pools = qs.target_pools(eligible)
    assert pools.count() == 200 * 199 and pools.distinct().count() == 200 * 199
    assert {tuple(r) for r in qs.target_pools(eligible, part=7).collect()} == {tuple(r) for r in pools.collect()}


def test_small_pools_are_skipped(spark):
    eligible = _eligible(spark, 4)
    settings = Questions()
    assert qs.sampled_targets(qs.stem_schedule(eligible, settings), qs.target_pools(eligible), settings).count() == 0


def test_each_slot_has_its_own_attempts(spark):
    made = lambda n, wanted, **more: qs.sampled_targets(qs.stem_schedule(e := _eligible(spark, n), s := Questions(questions_per_stem=wanted, **more)), qs.target_pools(e), s).groupBy("stem_id", "occurrence").agg(F.array_sort(F.collect_list("target_id")).alias("s")).groupBy("stem_id").agg(F.count_distinct("s").alias("n"), F.max("occurrence").alias("last")).collect()
    assert [(r["n"], r["last"]) for r in made(11, 150)] == [(150, 149)] * 11
    # the first question is the same however many are asked
    e, pools = _eligible(spark, 7), qs.target_pools(_eligible(spark, 7))
    first = lambda s: {tuple(r) for r in qs.sampled_targets(qs.stem_schedule(e, s), pools, s).where("occurrence = 0").collect()}
    assert first(Questions(questions_per_stem=3)) == first(Questions())
    # pools of 5 have 5 sets: slots beyond them stay empty
    assert [(r["n"], r["last"]) for r in made(6, 9)] == [(5, 4)] * 6
    # with one attempt for each slot, a slot whose set is known stays empty
    assert all(1 < r["n"] <= 5 for r in made(6, 9, max_sampling_attempts_per_question=1))


def test_total_questions(spark):
    eligible = _eligible(spark, 6)
    assert qs.stem_schedule(eligible, Questions(total_questions=4)).count() == 4
    assert qs.stem_schedule(eligible, Questions(total_questions=20)).count() == 20
    assert qs.shortfall_warning(3, Questions(total_questions=4)) and qs.shortfall_warning(4, Questions(total_questions=4)) is None


def test_eligibility_needs_context_and_group_size(spark):
    pairs = _eligible(spark, 6).drop("scores")
    ranked = [(f"p{i}", "g", "c", "d", [("r", 1, 1, 0, 1.0, 0.0, 2.1, 1)], [], "boom" if i == 5 else None) for i in range(6)]
    rankings = spark.createDataFrame(ranked, schemas.RELATION_RANKING)
    evidence = _evidence(spark, [(f"p{i}", "g", "c", "d", [], [], [], True, None) for i in range(6)])
    assert qs.eligible_pairs(pairs, rankings, evidence).count() == 5
    weak = evidence.withColumn("passes_minimum", F.col("pair_id") != "p0")
    assert qs.eligible_pairs(pairs, rankings, weak).count() == 0
    assert qs.eligible_pairs(pairs, rankings, weak, Questions(require_context_pass=False)).count() == 5


def test_quality_rules(spark):
    t = lambda *ids: [(i, "c", "d") for i in ids]
    rows = [
        ("q1", "g", ("p0", "c", "d"), t("p1", "p2", "p3", "p4"), {"m": [0.1, 0.2, 0.3, 0.4]}, {"m": 3}, {}, {}),
        ("q1", "g", ("p0", "c", "d"), t("p1", "p1", "p0", "zz"), {"m": [0.1], "k": None}, {"m": 4}, {}, {}),
        ("q2", "h", ("p0", "c", "d"), t("p1"), None, None, None, None),
    ]
    questions = spark.createDataFrame(rows, schemas.QUESTION)
    pairs = spark.createDataFrame([(f"p{i}", "g") for i in range(5)], "pair_id string, base_relation string")
    got = sorted((r["question_id"], r["rule"], r["detail"]) for r in ql.question_errors(questions, pairs).collect())
    assert got == sorted([
        ("q1", "duplicate_question_id", ""), ("q1", "duplicate_target", ""), ("q1", "stem_among_targets", ""), ("q1", "score_length", "m"), ("q1", "score_length", "k"),
        ("q1", "invalid_answer", "m"), ("q1", "invalid_answer", "k"), ("q1", "unknown_target", "zz"), ("q2", "target_count", ""), ("q2", "target_relation", "p1"),
    ])
    report = ql.report(pairs, _evidence(spark, []), spark.createDataFrame([], schemas.RELATION_RANKING), questions).first()
    assert report["status"] == "failed" and report["question_count"] == 3 and report["relation_statistics"]["mean"] == 0.0
    assert dict(report["semantic_measure_agreement"]) == {"all_three_agree": 2, "all_differ": 1}


def test_answers(spark):
    scored = spark.createDataFrame([("s", 0, i, f"t{i}", v) for i, v in enumerate((0.1, 0.5, 0.5))], "stem_id string, occurrence int, slot int, target_id string, m double")
    row = qs.answers(scored, ("m",)).first()
    assert (row["answer"], row["tied"], row["answer_pair_id"], row["values"]) == (1, [1, 2], "t1", [0.1, 0.5, 0.5])
