import json

from quern.operators import nested

RECORD = {"evidence_sentences": [{"sentence_id": 4, "text": "t"}, None, "odd"], "relations": [{"relation": "r", "score": 1.5, "rank": 1}], "blocks": [None, {"block_id": 9, "relations": ["a", None, "b"]}, {"relations": "c"}], "scores": {"m": [1, None, 2.5, "x"], "k": 3}}
WHOLE = {
    ("evidence_sentence", "", 0), ("evidence_sentence", "", 2), ("ranked_relation", "", 0), ("block", "", 1), ("block", "", 2),
    ("block_relation", "1", 0), ("block_relation", "1", 2), ("block_relation", "2", 0), ("score", "m", 0), ("score", "m", 2), ("score", "k", 0),
}


def index(spark, *payloads):
    df = spark.createDataFrame([(i, p, "clash") for i, p in enumerate(payloads)], "line_no bigint, payload string, pos string")
    rows = [tuple(r) for r in nested.child_index(df).collect()]
    assert len(rows) == len(set(rows))
    return {i: {r[1:] for r in rows if r[0] == i} for i in range(len(payloads))}


def test_wrapped_and_quoted(spark):
    record = json.dumps(RECORD)
    forms = [record, json.dumps(record), json.dumps({"meta": {"x": [1]}, "record": RECORD}), json.dumps({"batch": {"item": {"record": record}}}), json.dumps([[RECORD]]), json.dumps(json.dumps({"a": record})), "  " + record + "\n"]
    assert set(map(frozenset, index(spark, *forms).values())) == {frozenset(WHOLE)}


def test_broken_empty_and_odd_lines(spark):
    got = index(spark, None, "", "null", "[]", "{", '{"relations": [1', "17", '"text"', '{"relations": null}', '{"x": {"y": []}}', '{"relations": {"relation": "one"}}', '{"scores": [{"measure": "m", "values": [1, 2]}, {"measure": "k"}]}')
    assert [len(got[i]) for i in range(10)] == [0] * 10
    assert got[10] == {("ranked_relation", "", 0)} and got[11] == {("score", "m", 0), ("score", "m", 1)}


def test_empty_table_and_tables(spark):
    empty = spark.createDataFrame([], "line_no bigint, payload string")
    assert nested.child_index(empty).count() == 0
    df = spark.createDataFrame([(1, json.dumps(RECORD))], "line_no bigint, payload string")
    assert [(r["pos"], r["sentence_id"], r["text"]) for r in nested.evidence_sentences(df).collect()] == [(0, 4, "t"), (2, None, None)]
    assert nested.ranked_relations(df).first()["score"] == 1.5
    assert sorted(r["block_id"] or 0 for r in nested.ranking_blocks(df).collect()) == [0, 9]
    assert {(r["block_pos"], r["pos"], r["relation"]) for r in nested.block_relations(df).collect()} == {(1, 0, "a"), (1, 2, "b"), (2, 0, "c")}
    assert {(r["measure"], r["pos"], r["score"]) for r in nested.scores(df).collect()} == {("m", 0, 1.0), ("m", 2, 2.5), ("k", 0, 3.0)}


def test_repeated_lines_and_long_payloads(spark):
    long = json.dumps({"evidence_sentences": [{"text": "x" * 200} for _ in range(3000)]})
    df = spark.createDataFrame([(1, long), (2, long)], "line_no bigint, payload string")
    assert nested.child_index(df).count() == 6000


def test_many_wrappers(spark):
    deep = json.dumps(RECORD)
    for i in range(40):
        deep = json.dumps({"a": [json.loads(deep)]} if i != 20 else deep)
    quoted = json.dumps(RECORD)
    for _ in range(9):
        quoted = json.dumps({"x": quoted})
    got = index(spark, deep, quoted)
    assert got[0] == got[1] == WHOLE


def test_records_of_one_line_are_told_apart(spark):
    two = json.dumps({"a": {"evidence_sentences": [{"text": "one"}], "scores": {"m": [1, "n/a"]}}, "b": [{"evidence_sentences": [{"text": "one"}, {"text": "two"}], "blocks": {"relations": ["x"]}}]})
    df = spark.createDataFrame([(1, two)], "line_no bigint, payload string")
    assert [(r["record"], r["pos"], r["text"]) for r in nested.evidence_sentences(df).orderBy("record", "pos").collect()] == [(0, 0, "one"), (1, 0, "one"), (1, 1, "two")]
    assert [tuple(r)[1:] for r in nested.scores(df).collect()] == [(0, "m", 0, 1.0)]
    assert [tuple(r)[1:] for r in nested.block_relations(df).collect()] == [(1, 0, 0, "x")]
    assert len(index(spark, two)[0]) == 5
