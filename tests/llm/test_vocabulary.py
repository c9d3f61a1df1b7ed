import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from quern.llm.vocabulary import Trie, Vocabulary, allowed, mapped, typed_values

ENTRIES = [
    ("flows_into", ["flows into", "empties into", "mündet in"]), ("crossed_by_bridge", ["crossed by bridge", "has crossing"]), ("renamed_from", ["renamed from", "formerly called"]),
    ("excavated_at", ["excavated at", "dig site"]), ("heir_of_estate", ["heir of estate", "erbe des gutes"]), ("mythical_parent_of", ["legendary father or mother"]), ("character_in", ["appears as figure in"]),
]
V = Vocabulary(ENTRIES)


@pytest.mark.parametrize("typed,entry", [
    ("flows into", "flows_into"), ("FlowsInto", "flows_into"), ("FLOWS-INTO", "flows_into"), ("  flows  into ", "flows_into"), ("fl0ws into", "flows_into"), ("folws into", "flows_into"), ("fllrws into", "flows_into"),
    ("mundet in", "flows_into"), ("rel:flows-ito", "flows_into"), ("is the flows into (since 1800)", "flows_into"), ("flows into #2", "flows_into"), ("flows into / empties into", "flows_into"),
    ("flоwѕ intо", "flows_into"), ("ｆｌｏｗｓ into", "flows_into"), ("fl​ows into", "flows_into"), ("has crossing", "crossed_by_bridge"), ("bridge by crossed", "crossed_by_bridge"),
    ("formerly called", "renamed_from"), ("formerly: flows into", "flows_into"), ("excav. at", "excavated_at"), ("gutes des erbe", "heir_of_estate"), ("legendary father or mother", "mythical_parent_of"),
    ("legendary_father_r_motaeer", "mythical_parent_of"), ("flows", ""), ("flown over", ""), ("bridge toll amount", ""), ("character trait", ""), ("site smell", ""), ("n/a", ""), ("???", ""), ("at", ""), ("flows into / dig site", ""),
])
def test_values(typed, entry):
    assert V.entry_of(typed) == entry


def distance(a, b):
    """Letters exchanged, inserted, deleted or neighbours swapped."""
    d = [[i + j if i * j == 0 else 0 for j in range(len(b) + 1)] for i in range(len(a) + 1)]
    for i in range(1, len(a) + 1):
        for j in range(1, len(b) + 1):
            d[i][j] = min(d[i - 1][j] + 1, d[i][j - 1] + 1, d[i - 1][j - 1] + (a[i - 1] != b[j - 1]))
            if i > 1 and j > 1 and a[i - 1] == b[j - 2] and a[i - 2] == b[j - 1]:
                d[i][j] = min(d[i][j], d[i - 2][j - 2] + 1)
    return d[-1][-1]


@settings(max_examples=200, deadline=None)
@given(paths=st.lists(st.text("abc", min_size=1, max_size=6), min_size=1, max_size=6, unique=True), value=st.text("abc", max_size=7), limit=st.integers(0, 3))
def test_automaton_equals_brute_force(paths, value, limit):
    trie = Trie()
    for i, p in enumerate(paths):
        trie.add(p, i, 0)
    assert trie.within(value, limit) == {i: distance(p, value) for i, p in enumerate(paths) if distance(p, value) <= limit}


def test_distances_grow_with_length():
    assert [allowed(n) for n in (1, 3, 4, 6, 7, 14, 15, 100)] == [0, 0, 1, 1, 2, 2, 3, 3]


def test_ties_are_no_answer():
    assert Vocabulary([("cat_of", []), ("bat_of", [])]).entry_of("rat of") == ""


RAW = "mined_id bigint, relation string, relations array<struct<raw_predicate:string,normalized_predicate:string>>"
CANON = "canon_id bigint, relations array<struct<relation:string>>"
VOCAB = "relation_id bigint, relation string, label string, aliases array<string>"


def test_rows(spark):
    raw = spark.createDataFrame([(1, "clash", [("flows into", None), (None, "flows_into"), (" ", None), ("x" * 100_000, None)]), (2, None, None), (3, None, []), (1, None, [("flows into", None)])], RAW)
    canon = spark.createDataFrame([(9, [("Flows Into",), ("zodiac",)])], CANON)
    vocab = spark.createDataFrame([(1, "flows_into", "flows into", None), (2, None, None, None)], VOCAB)
    got = sorted(map(tuple, mapped(typed_values(raw, canon), vocab, "typed").collect()))
    assert got == [("canonical_relations", 9, 0, "flows_into"), ("canonical_relations", 9, 1, ""), ("raw_relations", 1, 0, "flows_into"), ("raw_relations", 1, 0, "flows_into"), ("raw_relations", 1, 3, "")]
    none = spark.createDataFrame([], VOCAB)
    assert {r["relation"] for r in mapped(typed_values(raw, canon), none, "typed").collect()} == {""}
    assert mapped(typed_values(spark.createDataFrame([], RAW), spark.createDataFrame([], CANON)), vocab, "typed").count() == 0


def test_all_entries_within_the_distance(spark):
    values = spark.createDataFrame([(1, "flows into"), (2, "excavatd at"), (3, "nothing like it"), (4, "flows in to")], "pos bigint, typed string")
    vocab = spark.createDataFrame([(i, name, None, others) for i, (name, others) in enumerate([*ENTRIES, ("flown_into", ["x"])])], "relation_id bigint, relation string, label string, aliases array<string>")
    from quern.llm.vocabulary import near_entries

    found = {(r["pos"], r["relation"]): r["distance"] for r in near_entries(values, vocab, "typed").collect()}
    assert found == {(1, "flows_into"): 0, (1, "flown_into"): 1, (2, "excavated_at"): 1, (4, "flows_into"): 1, (4, "flown_into"): 2}
