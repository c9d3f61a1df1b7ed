import random

from quern.llm import contamination as C

WORDS = [f"{a}{b}" for a in ("bar", "cel", "dor", "fim", "gul", "hap", "jov", "kem") for b in ("an", "et", "is", "ol", "up", "ax", "ey", "id")]
ITEMS = "item_id bigint, task string, text string, doc_id string"
DOCS = "doc_id bigint, text string, item_id string"


def passage(n, seed):
    rng = random.Random(seed)
    return [rng.choice(WORDS) + (f"q{seed}x{i}" if i % 6 == 0 else "") for i in range(n)]


def found(spark, docs, items):
    return {tuple(r) for r in C.contained_items(spark.createDataFrame(docs, DOCS), spark.createDataFrame(items, ITEMS)).collect()}


def test_disguises(spark):
    words = passage(60, 1)
    text = " ".join(words)
    part = words[10:40]
    changed = [w if i % 7 else "almost" for i, w in enumerate(part, 1)]
    docs = [
        (1, "Before. " + text + ". After.", None), (2, " ".join(part).upper().replace(" ", ",  "), None), (3, "​".join(" ".join(part)), None), (4, " ".join(changed), None),
        (5, " ".join(f"{w}[{i}]" for i, w in enumerate(part)), None), (6, " ".join(part).replace("a", "а").replace("e", "е"), None), (7, "".join(chr(ord(c) + 0xFEE0) if c != " " else "　" for c in " ".join(part)), None),
        (8, " ".join(words[:14]) + " something else entirely", None), (9, None, None), (10, "", None), (11, " ".join(reversed(words)), None), (12, "<p>" + "</p> <b>".join(part) + "</b>", None), (13, " ".join(w.replace("o", "ö") for w in part), None),
    ]
    assert {d for d, _ in found(spark, docs, [(5, "t", text, None)])} == {1, 2, 3, 4, 5, 6, 7, 12, 13}


def test_shared_openings_do_not_count(spark):
    opening = passage(24, 99)
    items = [(i, "t", " ".join(opening + passage(40, i)), None) for i in range(1, 8)]
    docs = [(1, " ".join(opening), None), (2, " ".join(opening + passage(40, 3)[:25]), None)]
    assert found(spark, docs, items) == {(2, 3)}


def test_common_phrases_with_changes_do_not_count(spark):
    frame = [random.Random(7).choice(WORDS) for _ in range(40)]
    item = lambda n: " ".join(w if i % 8 else f"name{n}n{i}" for i, w in enumerate(frame))
    items = [(n, "t", item(n), None) for n in range(6)]
    assert found(spark, [(1, item(3), None)], items) == {(1, 3)}


def test_brute_force(spark):
    """Plain passages: contained exactly if 20 successive words are."""
    rng = random.Random(11)
    items = [(i, "t", " ".join(passage(50, i)), None) for i in range(20)]
    docs = []
    for d in range(60):
        i, n = rng.randrange(20), rng.randrange(10, 35)
        at = rng.randrange(0, 50 - n)
        docs.append((d, " ".join(passage(15, 100 + d) + passage(50, i)[at : at + n] + passage(15, 200 + d)), None))
    want = set()
    for d, text, _ in docs:
        words = text.split()
        runs = {tuple(words[k : k + 20]) for k in range(len(words) - 19)}
        for i, _, t, _ in items:
            own = t.split()
            if any(tuple(own[k : k + 20]) in runs for k in range(len(own) - 19)):
                want.add((d, i))
    assert found(spark, docs, items) == want


def test_parts_of_items_empty_and_long(spark):
    opening = passage(70, 99)
    items = [(i, "t", " ".join((opening if i < 5 else []) + passage(30, i)), None) for i in range(8)] + [(9, "t", None, None), (None, "t", "x", None), (10, "t", "short", None), (6, "t", " ".join(passage(40, 77)), None)]
    docs = [(1, " ".join(passage(20_000, 50) + passage(30, 4)), None), (1, " ".join(passage(30, 2)), None), (2, " ".join(opening), None), (3, " ".join(passage(40, 77)[5:30]), None), (4, " ".join(passage(30, 6)), None)]
    whole = found(spark, docs, items)
    assert whole == {(1, 4), (1, 2), (3, 6), (4, 6)}
    d, i = spark.createDataFrame(docs, DOCS), spark.createDataFrame(items, ITEMS)
    for size in (1, 2_000):  # every item, or a few items, in a broadcast of their own
        assert whole == {tuple(r) for r in C.contained_items(d, i, shard_bytes=size).collect()}
    assert found(spark, [], items) == set() and found(spark, docs, []) == set()


def test_openings_are_those_of_enough_texts():
    texts = [list("abcdefghij") + [str(i)] for i in range(5)] + [list("abcdefghij0") + ["x", "y"], list("zzzzzzzzzz")]
    assert C.openings(texts) == [10, 10, 10, 10, 10, 10, 0]
    assert C.openings(texts[:4]) == [0] * 4 and C.openings([]) == []


def test_scripts_without_spaces(spark):
    item = "那座旧灯塔的看守人在第七个冬天把铜钟埋进了葡萄园后面的沙丘里，直到镇上的女教师带着三个学生沿着干涸的河床走了两天，才在一块刻着船锚的石头下面找到了它，并把它送回了教堂。"
    docs = [(1, "前言。" + item + "结束。", None), (2, item[:44].replace("，", " "), None), (3, item[:16], None), (4, "另一段没有关系的文字，说的是别的地方的事情，与任何题目都没有联系。", None)]
    assert found(spark, docs, [(5, "t", item, None), (6, "t", " ".join(passage(40, 3)), None)]) == {(1, 5), (2, 5)}
