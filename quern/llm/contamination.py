"""Problem 8: corpus documents that contain passages of held-out items, and the items.

Wu-Manber multi-pattern search over words: the patterns are all windows of WINDOW words of the items. A shift table over
blocks of two words skips positions where no pattern can end, a hash of the window selects the patterns that may, and a
direct comparison confirms them. Each confirmed occurrence is extended in both directions over changed, inserted and
dropped words; a document contains an item if one alignment spans at least LEAST_WORDS successive words of it.

Words are compared in consistent script form, folded, without accents, marks and mark-up; in scripts without spaces each
character stands for CHARACTER_WORDS of a word. The opening words that many items share do not count. Texts of one kind share
phrases, so an alignment with changed words must also hold a word that is distinctive of the item; both are judged over
all items. Words are numbers of the items' vocabulary (0: none of theirs): the shift table and the hashes are read for all
positions of a batch at once, and only documents with a distinctive word of an item, or with as many windows in a row as an
unchanged passage has, are aligned.

The items are a stated query set that the driver reads (4 bytes a word). They are broadcast, in several parts only beyond
SHARD_BYTES (the size is checked), against every document in one narrow pass over whole texts; nothing is shuffled. Defined
results: null, empty and blank texts contain nothing; an item without LEAST_WORDS words of its own is in no document; an
item_id with several texts is contained where one of them is; repeated documents are reported each; other columns are ignored.
"""

from __future__ import annotations

import pickle
import re
import unicodedata
from collections import Counter
from collections.abc import Iterator
from functools import reduce
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quern.llm.lookalikes import ACCENTS, INVISIBLE, visible_form
from quern.runtime import BROADCAST_BYTES, broadcast_bytes

LEAST_WORDS = 20
WINDOW, BLOCK = 4, 2
#: What a character of a script without spaces counts, in words.
CHARACTER_WORDS = 0.625
#: An opening of at least OPENING_WORDS words that OPENING_ITEMS items share is an instruction.
OPENING_WORDS, OPENING_ITEMS = 8, 5
#: A word of at most so many items is distinctive.
DISTINCTIVE_ITEMS = 2
#: Changed words in a row, and the share of words that must be unchanged.
CHANGED_RUN, UNCHANGED = 2, 0.7
#: Bytes of the items in one broadcast, bits of the hashed shift table, documents searched at once, tokens a task remembers.
SHARD_BYTES, TABLE_BITS, SEARCHED, MEMORY_TOKENS = BROADCAST_BYTES // 2, 20, 1024, 200_000

MARKS = re.compile(r"\[\s*\w{1,4}\s*\]|<[^<>]{0,80}>|[*†‡§¶^~`²³¹⁰-₉]")
UNSPACED = "\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u3040-\u30ff\u3400-\u9fff"
WORD = re.compile(f"[{UNSPACED}]|[^\\W_{UNSPACED}]+")
CHARACTER = re.compile(f"[{UNSPACED}]")


def compared_words(text: str) -> list[str]:
    """Words as they are compared."""
    return [w for token in MARKS.sub("", text).split() for w in token_words(token)]


def token_words(token: str) -> list[str]:
    """Words of a token without white space and mark-up."""
    if not token.isascii():
        token = visible_form(INVISIBLE.sub("", token), spaces=False)
        token = ACCENTS.sub("", unicodedata.normalize("NFKD", token))
    return WORD.findall(token.casefold())


def openings(texts: list[list[str]]) -> list[int]:
    """For each text the length of its longest opening, of OPENING_WORDS or more, that OPENING_ITEMS texts share."""

    def common(a: list[str], b: list[str]) -> int:
        n = 0
        for x, y in zip(a, b):
            if x != y:
                break
            n += 1
        return n

    order = sorted(range(len(texts)), key=texts.__getitem__)
    found = [0] * len(texts)
    for first in range(len(order) - OPENING_ITEMS + 1):
        # in order, texts between two that share an opening share it too
        group = order[first : first + OPENING_ITEMS]
        n = common(texts[group[0]], texts[group[-1]])
        if n >= OPENING_WORDS:
            for i in group:
                found[i] = max(found[i], n)
    return found


class TokenMemory(dict):
    """Token -> numbers of its words."""

    def __init__(self, vocabulary: dict[str, int]):
        self.vocabulary = vocabulary

    def __missing__(self, token: str) -> tuple[int, ...]:
        self[token] = found = tuple(self.vocabulary.get(w, 0) for w in token_words(token))
        return found


class WuManber:
    """Shift table, window hashes and windows of items; items: (item_id, word numbers from 1 on)."""

    def __init__(self, items: list[tuple[int, np.ndarray]], vocabulary: dict[str, int], distinctive: np.ndarray, weights: np.ndarray):
        self.memory = TokenMemory(vocabulary)
        self.distinctive = distinctive
        self.known = set(np.flatnonzero(distinctive).tolist())
        self.ids: list[int] = []
        self.words: list[list[int]] = []
        self.places: list[np.ndarray] = []
        self.windows: dict[tuple[int, ...], dict[int, list[int]]] = {}
        self.owners: dict[int, set[int]] = {}
        shift = np.full(1 << TABLE_BITS, WINDOW - BLOCK + 1, np.int8)
        hashes = []
        for item_id, words in items:
            places = np.concatenate([[0.0], np.cumsum(weights[words])])
            if places[-1] < LEAST_WORDS:
                continue
            item, own = len(self.ids), words.tolist()
            self.ids.append(item_id)
            self.words.append(own)
            self.places.append(places)
            for end in range(WINDOW - 1, BLOCK - 2, -1):
                # the block that ends so many words before the end of a window
                blocks = self._blocks(words)[end - 1 : len(words) - (WINDOW - 1 - end) - 1]
                np.minimum.at(shift, blocks, np.int8(WINDOW - 1 - end))
            hashes.append(self._hashes(words))
            for at in range(len(own) - WINDOW + 1):
                self.windows.setdefault(tuple(own[at : at + WINDOW]), {}).setdefault(item, []).append(at)
            for word in set(own):
                if word in self.known:
                    self.owners.setdefault(word, set()).add(item)
        self.shift = shift
        self.hashes = np.unique(np.concatenate(hashes)) if hashes else np.zeros(1, np.uint64)

    @staticmethod
    def _blocks(words: np.ndarray) -> np.ndarray:
        """Place in the shift table of the block that begins at each word but the last."""
        mixed = words[:-1].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + words[1:].astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F)
        return (mixed >> np.uint64(64 - TABLE_BITS)).astype(np.int64)

    @staticmethod
    def _hashes(words: np.ndarray) -> np.ndarray:
        """Hash of the window that begins at each word."""
        n = len(words) - WINDOW + 1
        out = np.zeros(max(n, 0), np.uint64)
        for i in range(WINDOW):
            out = out * np.uint64(0x100000001B3) + words[i : i + len(out)].astype(np.uint64)
        return out

    def hits(self, words: np.ndarray) -> np.ndarray:
        """Places where a window of an item begins (up to equal hashes)."""
        if len(words) < WINDOW:
            return np.zeros(0, np.int64)
        at = np.flatnonzero(self.shift[self._blocks(words)[WINDOW - BLOCK :]] == 0)
        found = self._hashes(words)[at]
        return at[self.hashes[np.minimum(np.searchsorted(self.hashes, found), len(self.hashes) - 1)] == found]

    def search(self, texts: list[str]) -> list[set[int]]:
        """Item ids of which each text contains a passage."""
        memory, out = self.memory, [set() for _ in texts]
        if len(memory) > MEMORY_TOKENS:
            memory.clear()
        lists = [list(chain.from_iterable(map(memory.__getitem__, MARKS.sub("", t).split()))) for t in texts]
        starts = np.cumsum([0, *(len(x) + 1 for x in lists)])
        whole = np.zeros(starts[-1], np.int64)  # an unknown word parts the texts
        for start, x in zip(starts, lists):
            whole[start : start + len(x)] = x
        hits = self.hits(whole)
        if not len(hits):
            return out
        run = LEAST_WORDS - WINDOW
        in_row = np.zeros(len(hits), bool)
        in_row[run:] = hits[run:] - hits[:-run] == run
        bounds = np.searchsorted(hits, starts)
        marked = np.flatnonzero(self.distinctive[whole])
        mark_bounds = np.searchsorted(marked, starts)
        for row, words in enumerate(lists):
            a, b = bounds[row], bounds[row + 1]
            if a == b:
                continue
            candidates: set[int] = set()
            for word in set(whole[marked[mark_bounds[row] : mark_bounds[row + 1]]].tolist()):
                candidates |= self.owners.get(word, set())
            for j in (a + np.flatnonzero(in_row[a:b])).tolist():
                first, last = (self.windows.get(tuple(whole[hits[k] : hits[k] + WINDOW].tolist()), {}) for k in (j - run, j))
                candidates |= first.keys() & last.keys()
            if candidates:
                out[row] = {self.ids[i] for i in self.contained(words, (hits[a:b] - starts[row]).tolist(), candidates)}
        return out

    def contained(self, words: list[int], hits: list[int], candidates: set[int]) -> set[int]:
        """Candidates of which the words contain a passage; hits: where windows begin."""
        found: set[int] = set()
        covered: dict[tuple[int, int], int] = {}  # (item, diagonal) -> last place that an alignment covers
        for at in hits:
            window = self.windows.get(tuple(words[at : at + WINDOW]))
            if window is None:
                continue
            for item in candidates & window.keys():
                if item in found:
                    continue
                for place in window[item]:
                    if covered.get((item, at - place), -1) >= place:
                        continue
                    own, places = self.words[item], self.places[item]
                    end, end_at, changed_after, known_after = self._extend(own, words, place, at, 1)
                    begin, _, changed_before, known_before = self._extend(own, words, place, at, -1)
                    covered[(item, at - place)] = end
                    covered[(item, end_at - end)] = max(end, covered.get((item, end_at - end), -1))
                    span, changed = end - begin + 1, changed_after + changed_before
                    if places[end + 1] - places[begin] >= LEAST_WORDS and span - changed >= UNCHANGED * span and (changed == 0 or known_after or known_before):
                        found.add(item)
                        break
        return found

    def _extend(self, own: list[int], words: list[int], place: int, at: int, way: int) -> tuple[int, int, int, bool]:
        """From equal words on: (last equal place, its place in words, changed words between, a distinctive word among the equal)."""
        i, j, changed, pending = place, at, 0, 0
        last, last_at, known = place, at, own[place] in self.known
        n, m = len(own), len(words)
        distinctive = self.known
        while True:
            i += way
            j += way
            if i < 0 or j < 0 or i >= n or j >= m:
                break
            word = own[i]
            if word == words[j]:
                last, last_at = i, j
                if pending:
                    changed, pending = changed + pending, 0
                known = known or word in distinctive
                continue
            moved = False
            if pending == 0:
                # two equal words on a neighbouring diagonal: a word was inserted or dropped
                for di, dj in ((1, 1), (2, 2), (0, 1), (0, 2), (1, 0), (3, 3)):
                    a, b = i + way * di, j + way * dj
                    if 0 <= a < n and 0 <= b < m and own[a] == words[b] and 0 <= a + way < n and 0 <= b + way < m and own[a + way] == words[b + way]:
                        if di != dj:
                            i, j, pending, moved = a - way, b - way, 1, True
                        break
            if moved:
                continue
            pending += 1
            if pending > CHANGED_RUN:
                break
        return last, last_at, changed, known


def item_shards(rows: Iterator, shard_bytes: int) -> Iterator[bytes]:
    """Payloads of WuManber of at most shard_bytes, or of one item; openings and distinctive words are those of all rows."""
    texts = list(dict.fromkeys((r["item_id"], r["text"]) for r in rows if r["text"]))
    words = [compared_words(text) for _, text in texts]
    cut = [w[n:] for w, n in zip(words, openings(words))]
    several = Counter(w for own in {tuple(w) for w in cut} for w in set(own))
    shard: list = []
    size = 0

    def payload(shard: list) -> bytes:
        vocabulary = {w: i for i, w in enumerate(sorted({w for _, own in shard for w in own}), 1)}
        distinctive, weights = np.zeros(len(vocabulary) + 1, bool), np.ones(len(vocabulary) + 1)
        for w, i in vocabulary.items():
            distinctive[i] = several[w] <= DISTINCTIVE_ITEMS
            weights[i] = CHARACTER_WORDS if CHARACTER.match(w) else 1.0
        return pickle.dumps(([(item, np.array([vocabulary[w] for w in own], np.int32)) for item, own in shard], vocabulary, distinctive, weights))

    for (item, text), own in zip(texts, cut):
        n = 2 * len(text.encode("utf-8")) + 4 * len(own)
        if shard and size + n > shard_bytes:
            yield payload(shard)
            shard, size = [], 0
        shard.append((item, own))
        size += n
    if shard:
        yield payload(shard)


_SEARCHES: dict[int, WuManber] = {}


def search_of(payload: bytes) -> WuManber:
    key = hash(payload)
    if key not in _SEARCHES:
        _SEARCHES.clear()
        _SEARCHES[key] = WuManber(*pickle.loads(payload))
    return _SEARCHES[key]


def contained_items(docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", text: str = "text", shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """(doc_id, item_id) of documents that contain a passage of an item."""
    slim = docs.select(doc_id, text).where(F.col(text).isNotNull())
    kind = docs.schema[doc_id].dataType
    schema = T.StructType([T.StructField(doc_id, kind), T.StructField("item_id", T.LongType())])
    found = []
    stated = items.where("item_id IS NOT NULL").select("item_id", "text").orderBy("item_id", "text").toLocalIterator()
    for payload in item_shards(stated, shard_bytes):
        payload = broadcast_bytes(docs.sparkSession, payload)

        def search(batches: Iterator[pa.RecordBatch], payload=payload) -> Iterator[pa.RecordBatch]:
            tables = search_of(payload.value)
            for batch in batches:
                for at in range(0, batch.num_rows, SEARCHED):
                    part = batch.slice(at, SEARCHED)
                    pairs = [(row, item) for row, own in enumerate(tables.search(part.column(1).to_pylist())) for item in sorted(own)]
                    rows, ids = pa.array([r for r, _ in pairs], pa.int64()), pa.array([i for _, i in pairs], pa.int64())
                    yield pa.RecordBatch.from_arrays([part.column(0).take(rows), ids], names=[doc_id, "item_id"])

        found.append(slim.mapInArrow(search, schema))
    if not found:
        return docs.sparkSession.createDataFrame([], schema)
    whole = reduce(DataFrame.unionAll, found)
    return whole if len(found) == 1 else whole.distinct()
