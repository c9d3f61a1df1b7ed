import random
from pathlib import Path

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from quern.llm import tokenizer as T

FILE = Path(T.TOKENIZER_DIR, "byte_bpe_50k.tiktoken")
pytestmark = pytest.mark.skipif(not FILE.exists(), reason="no vocabulary here")


@pytest.fixture(scope="module")
def reference():
    import tiktoken

    payload = FILE.read_bytes()
    encoding = tiktoken.Encoding("own", pat_str=T.WORD_PATTERN, mergeable_ranks=T.parse_ranks(payload), special_tokens={})
    return payload, lambda text: encoding.encode_ordinary(text or "")


def test_odd_texts(reference):
    payload, encode = reference
    rng = random.Random(5)
    texts = ["", None, " ", "=" * 4000, "a" * 3000, " " * 999 + "x", "\n \t\r\n", "<|endoftext|>", "don't we've I'LL", "é" * 99, "สะพาน" * 200, "漢字" * 500, "👩‍👧", "\x00\x7f\x80"]
    texts += ["".join(rng.choice("abcdehinorst  ") for _ in range(300)) for _ in range(50)]
    assert T.encode_texts(texts, payload) == [encode(t) for t in texts]


@settings(max_examples=150, deadline=None)
@given(st.text(max_size=60))
def test_any_text(reference, text):
    payload, encode = reference
    assert T.encode_texts([text], payload) == [encode(text)]


def test_memory_is_emptied_without_harm(reference, monkeypatch):
    payload, encode = reference
    monkeypatch.setattr(T, "WORD_MEMORY", 5)
    texts = [f"word{i} and other words {i * 7}" for i in range(50)]
    assert [T.encode_texts([t], payload)[0] for t in texts] == [encode(t) for t in texts]


def test_rows(spark, reference):
    payload, encode = reference
    df = spark.createDataFrame([(1, "A mill.", "x"), (2, None, None), (3, "", None), (1, "A mill.", None), (None, "é", None)], "doc_id bigint, text string, ids string")
    got = sorted(((r["doc_id"], r["ids"]) for r in T.encode_corpus(df).collect()), key=str)
    assert got == sorted([(1, encode("A mill.")), (2, []), (3, []), (1, encode("A mill.")), (None, encode("é"))], key=str)
    assert T.encode_corpus(spark.createDataFrame([], "doc_id bigint, text string")).count() == 0
