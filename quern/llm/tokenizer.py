"""Problem 7: the whole corpus as token ids of a public byte-level BPE vocabulary.

A byte-level BPE encoding is fixed by a last-token state for each prefix: a token sequence is the encoding of its
bytes exactly when every two neighbours are the encoding of theirs, so the last token of a prefix is the one suffix
token that is valid after the last token of the prefix before it. The distinct words of a batch form a trie; walking it
depth first (sorted order, where the path shared with the word before is kept) computes each shared prefix once.

The plan is one narrow pass: no shuffle, the vocabulary (under 1 MB, checked) is broadcast.

Defined results: null text and empty text give the empty list; every row gives one row, repeated and null ids included;
columns other than the id and the text are ignored; strings of special tokens are ordinary text.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quern.runtime import broadcast_bytes

TOKENIZER_DIR = "/opt/tokenizers"
#: Fixed value: how the vocabulary's text is cut into words before merging.
WORD_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Words kept between batches; beyond it the memory is emptied and words are computed anew.
WORD_MEMORY = 200_000


def parse_ranks(payload: bytes) -> dict[bytes, int]:
    """Token bytes -> id from a rank file (base64 token, space, id)."""
    return {base64.b64decode(a): int(b) for a, b in (line.split() for line in payload.splitlines() if line)}


class TrieEncoder:
    """Encodes sets of words by last-token states over their prefix trie."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.bytes_of = {i: t for t, i in ranks.items()}
        self.fits: dict[int, bool] = {}
        self.whole: dict[bytes, bool] = {}
        lengths: dict[bytes, set[int]] = {}
        for token in ranks:
            lengths.setdefault(token[-2:], set()).add(len(token))
        #: For the last two bytes of a prefix: lengths of tokens that may end there, longest first.
        self.lengths = {tail: tuple(sorted(found, reverse=True)) for tail, found in lengths.items()}
        self.words: dict[str, tuple[int, ...]] = {}

    def merge(self, data: bytes) -> list[int]:
        """Encoding by repeated merging of the neighbours of lowest rank; for short strings."""
        ranks, parts = self.ranks, [data[i : i + 1] for i in range(len(data))]
        while len(parts) > 1:
            best, at = None, -1
            for i in range(len(parts) - 1):
                rank = ranks.get(parts[i] + parts[i + 1])
                if rank is not None and (best is None or rank < best):
                    best, at = rank, i
            if best is None:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return [ranks[p] for p in parts]

    def reachable(self, token: bytes) -> bool:
        known = self.whole.get(token)
        if known is None:
            known = self.whole[token] = self.merge(token) == [self.ranks[token]]
        return known

    def neighbours(self, left: int, right: int) -> bool:
        """Whether right may follow left in an encoding."""
        key = left * 1_000_003 + right
        known = self.fits.get(key)
        if known is None:
            known = self.fits[key] = self.merge(self.bytes_of[left] + self.bytes_of[right]) == [left, right]
        return known

    def extend(self, data: bytes, last: list[int], begin: list[int]) -> None:
        """Propagate the states from the prefix of length len(last) - 1 to the whole of data."""
        ranks, lengths = self.ranks, self.lengths
        for end in range(len(last), len(data) + 1):
            one = data[end - 1 : end]
            options = lengths.get(data[end - 2 : end], ()) if end > 1 else ()
            found = False
            for n in options:
                start = end - n
                if start < 0 or n == 1:
                    continue
                token = data[start:end]
                rank = ranks.get(token)
                if rank is None or not self.reachable(token):
                    continue
                if start == 0 or self.neighbours(last[start], rank):
                    last.append(rank)
                    begin.append(start)
                    found = True
                    break
            if not found:
                last.append(ranks[one])
                begin.append(end - 1)

    def learn(self, words: set[str]) -> None:
        """Encode new words, depth first over their trie."""
        if len(self.words) + len(words) > WORD_MEMORY:
            self.words.clear()
        if len(self.fits) > 4 * WORD_MEMORY:
            self.fits.clear()
        last, begin, before = [-1], [0], b""
        for data, word in sorted((w.encode("utf-8"), w) for w in words):
            shared = 0
            for x, y in zip(before, data):
                if x != y:
                    break
                shared += 1
            del last[shared + 1 :], begin[shared + 1 :]
            self.extend(data, last, begin)
            ids, at = [], len(data)
            while at:
                ids.append(last[at])
                at = begin[at]
            self.words[word] = tuple(reversed(ids))
            before = data


def encoder_of(payload: bytes) -> tuple[TrieEncoder, object]:
    import regex

    return TrieEncoder(parse_ranks(payload)), regex.compile(WORD_PATTERN)


_ENCODERS: dict[int, tuple[TrieEncoder, object]] = {}


def encode_texts(texts: list[str | None], payload: bytes) -> list[list[int]]:
    """Ids of each text; one encoder per worker process."""
    key = hash(payload)
    if key not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[key] = encoder_of(payload)
    encoder, pattern = _ENCODERS[key]
    cut = [pattern.findall(t) if t else [] for t in texts]
    new = {w for words in cut for w in words}
    if len(encoder.words) + len(new) > WORD_MEMORY:
        encoder.words.clear()
    new -= encoder.words.keys()
    if new:
        encoder.learn(new)
    known = encoder.words
    out = []
    for words in cut:
        ids: list[int] = []
        for w in words:
            ids += known[w]
        out.append(ids)
    return out


def encode_corpus(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", name: str = "byte_bpe_50k", tokenizer_dir: str = TOKENIZER_DIR) -> DataFrame:
    """(id, ids array<int>) for each row of docs."""
    ranks = broadcast_bytes(docs.sparkSession, Path(tokenizer_dir, f"{name}.tiktoken").read_bytes())
    id_type = docs.schema[id_col].dataType
    schema = T.StructType([T.StructField(id_col, id_type), T.StructField("ids", T.ArrayType(T.IntegerType()))])

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = encode_texts(batch.column(1).to_pylist(), ranks.value)
            ids = pa.array(found, pa.list_(pa.field("element", pa.int32())))
            yield pa.RecordBatch.from_arrays([batch.column(0), ids], names=[id_col, "ids"])

    return docs.select(F.col(id_col), F.col(text_col).cast("string")).mapInArrow(encode, schema)
