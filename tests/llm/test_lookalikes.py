import pytest
from pyspark.sql import functions as F

from quern.llm import lookalikes as K


def test_token_scripts():
    assert K.resolved_scripts("Mount") == {"Latin"} and K.resolved_scripts("Моunt") == frozenset()
    assert K.resolved_scripts("漢かな") == {"Japanese"} and K.resolved_scripts("12") is None
    assert K.consistent("Моunt") == "Mount" and K.consistent("Моор") == "Moop" and K.consistent("Мельница") == "Мельница" and K.consistent("Mount") == "Mount"
    assert K.consistent("Моор", "Cyrillic") == "Моор" == K.consistent("Moop", "Cyrillic")


def test_confusables_of_many_scripts():
    assert len(K.shapes()) > 300
    for a, b in (("раураӏ", "paypal"), ("ɡood dıg", "good dig"), ("օne", "one"), ("Ꭺbc", "Abc"), ("ꓮꓐ", "AB"), ("уха и сор", "yxa и cop")):
        assert K.visible_form(a) == K.visible_form(b)


def test_the_text_chooses_the_script():
    for text in ("уха и сор", "Это сор", "Αθήνα ΤΟΠΟ", "Tокио".replace("T", "Т")):
        assert K.visible_form(text) == text
    assert K.visible_form("The оld mill, уха") == "The old mill, yxa"
    assert K.visible_form("сор") == "cop"


@pytest.mark.parametrize("a,b", [
    ("Mount Lake", "Моunt Lаkе"), ("Ｍｏｕｎｔ　Ｌａｋｅ", "Mount Lake"), ("Mou​nt", "Mount"), ("a b", "a b"), ("Cáfe", "Cáfe"), ("Kö­nig", "König"),
    ("ﬁeld", "field"), ("Kit", "Kit"), ("on‑the", "on-the"), ("а̂", "â"), ("ΒΕΤΑ", "BETA"),
])
def test_same(a, b):
    assert K.visible_form(a) == K.visible_form(b)


@pytest.mark.parametrize("a,b", [("Mount", "mount"), ("Cafe", "Café"), ("Моунт", "Mount"), ("ab", "a b"), ("a-b", "ab"), ("Il", "ll"), ("0", "O")])
def test_different(a, b):
    assert K.visible_form(a) != K.visible_form(b)


PAIRS = "row_no bigint, pair_id string, base_relation string, concept_1 string, concept_2 string, id_1 string"
EVIDENCE = "evidence_id bigint, evidence_sentences array<struct<sentence_id:bigint,text:string,page_title:string,page_url:string>>"


def test_pairs(spark):
    rows = [
        (1, "a", "flows_into", "Lake", "Sea", "x"), (2, "a", "Flows Into", "Lаke", "Sea", "x"), (3, None, "flowsInto", "Lake ", "Sea", None), (4, "a", "other", "Lаke", "Sea", None),
        (5, "a", "flows_into", "Lake", None, None), (6, "a", "flows_into", " ", " ", None), (7, "a", None, "Q", "R", None), (8, "a", None, "Ｑ", "R", None), (None, "a", "flows_into", "Lake", "Sea", None),
    ]
    got = sorted(map(tuple, K.same_looking_pairs(spark.createDataFrame(rows, PAIRS)).collect()))
    assert got == [(0, 1, 2), (0, 2, 3), (0, 7, 8)]


def test_classes_count_the_links_of_the_pairs(spark):
    rows = [(i, "a", "r", "Lake" if i % 3 else "Lаke", "Sea", None) for i in range(30)] + [(100, "a", "r", "Other", "Sea", None), (101, "a", "r", "Other", "Sea", None)]
    pairs, evidence = spark.createDataFrame(rows, PAIRS), spark.createDataFrame([], EVIDENCE)
    links: dict = {}
    for _, a, b in map(tuple, K.same_looking_pairs(pairs).collect()):
        links[a], links[b] = links.get(a, 0) + 1, links.get(b, 0) + 1
    found = K.looking_classes(pairs, evidence).collect()
    assert {r["id"]: r["links"] for r in found} == links and len({r["class"] for r in found}) == 1


def test_sentences_and_empty(spark):
    long = "x" * 100_000
    rows = [(1, [(0, "A mill.", None, None), (1, "А mill.", None, None), (2, "A mill. ", None, None), (3, None, None, None), (4, "a mill.", None, None)]), (2, [(0, "А mill.", None, None)]), (3, None), (4, [(0, long, None, None), (1, long + "​", None, None)])]
    evidence = spark.createDataFrame(rows, EVIDENCE)
    pairs = spark.createDataFrame([], PAIRS)
    assert sorted(map(tuple, K.same_looking(pairs, evidence).collect())) == [("wiki_evidence", 1, 0, 1), ("wiki_evidence", 1, 1, 2), ("wiki_evidence", 4, 0, 1)]
    assert K.same_looking(pairs, spark.createDataFrame([], EVIDENCE)).count() == 0


def test_column_form_equals_the_function(spark):
    values = ["Mount Lake", " a \t b ", "Моunt", "é́", "", "Ａ　", None]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    got = [r[0] for r in df.orderBy("i").select(K.looks_like(F.col("v"))).collect()]
    assert got == [None if v is None else K.visible_form(v) for v in values]
