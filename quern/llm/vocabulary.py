"""Problem 3: freely typed values mapped to the entries of a reference list, the rest reported as having none.

A trie holds every entry by name, label and aliases; further paths hold the word orders of an entry and its words cut
short, as people write them. A typed value walks the trie as a Levenshtein automaton (insertion, deletion, exchange and
transposition of letters; the automaton's state is a band of distances) and all entries within a distance that depends on
the length come back; for an answer the nearest counts, and a tie between entries is no answer; near_entries gives them all,
with their distances.

Before the walk a value is brought to its consistent script form, split at camel case, folded, and freed of remarks around
the value proper; "a / b", "a = b" and "a or b" are read as alternatives.

The reference list is a fixed table (its size is checked before it is broadcast), the typed values are mapped in one narrow
pass: no shuffle, nothing depends on how often a value occurs. Defined results: null and blank values give no row; a value
that no entry is near to has the empty string; places are those of the list, null elements keep theirs; repeated rows
give repeated answers; other columns are ignored; an empty reference list answers the empty string for all.
"""

from __future__ import annotations

import pickle
import re
import unicodedata
from collections.abc import Iterator
from itertools import permutations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quern.llm.lookalikes import visible_form
from quern.runtime import blank, broadcast_bytes

#: Remarks before and after the value proper.
REMARKS_BEFORE = ("is the", "in part", "formerly", "probably", "rel", "was", "has", "is", "see", "the")
REMARKS_AFTER = ("they say", "directly", "check", "sic", "rel")
ALTERNATIVES = re.compile(r"\s*(?:/|=|\||;|\bor\b|→)\s*")
#: (longest length, distance): a value of at most that many letters may differ so much from an entry.
DISTANCES = ((3, 0), (6, 1), (14, 2), (1 << 30, 3))
#: Letters that a word cut short keeps at least, and words of an entry whose orders are listed.
CUT_LETTERS, ORDER_WORDS = 4, 5
MEMORY = 100_000


def allowed(length: int) -> int:
    return next(k for longest, k in DISTANCES if length <= longest)


def plain_value(text: str) -> str:
    """Folded words of a typed value, separators kept as they part alternatives."""
    text = visible_form(text, spaces=False)
    text = re.sub(r"(?<=[a-zäöüß0-9])(?=[A-Z])", " ", text)
    text = "".join(c for c in unicodedata.normalize("NFKD", text.casefold()) if not unicodedata.combining(c))
    return text


def words_of(text: str) -> list[str]:
    return re.findall(r"[^\W_]+", text)


def without_remarks(words: list[str], text: str) -> list[list[str]]:
    """The words, and the words freed of remarks step by step."""
    out = [words]
    text = re.sub(r"\(since\s*\d+\)|[(\[][^)\]]*[)\]]|#\s*\d+", " ", re.sub(r"[_-]+", " ", text))
    words = words_of(text)
    if words != out[-1] and words:
        out.append(words)
    changed = True
    while changed and words:
        changed = False
        for remark in REMARKS_AFTER:
            r = remark.split()
            if len(words) > len(r) and words[-len(r) :] == r:
                words, changed = words[: -len(r)], True
                out.append(words)
        for remark in REMARKS_BEFORE:
            r = remark.split()
            if len(words) > len(r) and words[: len(r)] == r:
                words, changed = words[len(r) :], True
                out.append(words)
                break
    return out


class Trie:
    """Paths of letters to entries, walked with a Levenshtein automaton."""

    def __init__(self) -> None:
        self.root: dict = {}

    def add(self, path: str, entry: int, cost: int) -> None:
        node = self.root
        for char in path:
            node = node.setdefault(char, {})
        known = node.setdefault("", {})
        known[entry] = min(cost, known.get(entry, cost))

    def within(self, value: str, limit: int) -> dict[int, int]:
        """Entry -> distance (with the path's own cost) of all entries within limit."""
        found: dict[int, int] = {}
        n = len(value)
        big = limit + 1

        def walk(node: dict, depth: int, row: list[int], before: list[int] | None, char_before: str) -> None:
            # row[j]: distance between the path and the first j letters of value, exact within the band
            ends = node.get("")
            if ends is not None and row[n] <= limit:
                for entry, cost in ends.items():
                    d = row[n] + cost
                    if d <= limit and d < found.get(entry, big):
                        found[entry] = d
            if depth + 1 - limit > n:
                return
            low, high = max(1, depth + 1 - limit), min(n, depth + 1 + limit)
            for char, child in node.items():
                if char == "":
                    continue
                new = [big] * (n + 1)
                if depth + 1 <= limit:
                    new[0] = depth + 1
                least = new[0]
                for j in range(low, high + 1):
                    d = row[j - 1] if value[j - 1] == char else 1 + min(row[j - 1], row[j], new[j - 1])
                    if before is not None and j > 1 and value[j - 1] == char_before and value[j - 2] == char and char != char_before:
                        d = min(d, before[j - 2] + 1)
                    if d < big:
                        new[j] = d
                        if d < least:
                            least = d
                if least <= limit:
                    walk(child, depth + 1, new, row, char)

        walk(self.root, 0, [j if j <= limit else big for j in range(n + 1)], None, "")
        return found


class Vocabulary:
    """The reference list: (name, labels and aliases) in order."""

    def __init__(self, entries: list[tuple[str, list[str]]]):
        self.names = [name for name, _ in entries]
        self.straight, self.altered = Trie(), Trie()
        for entry, (name, others) in enumerate(entries):
            for value in dict.fromkeys([name, *others]):
                words = words_of(plain_value(value))
                if not words:
                    continue
                self.straight.add(" ".join(words), entry, 0)
                for path in self._altered(words):
                    self.altered.add(path, entry, 0)
        self.memory: dict[str, str] = {}

    @staticmethod
    def _altered(words: list[str]) -> set[str]:
        """Other word orders, words run together, and one long word cut short."""
        paths = {" ".join(p) for p in permutations(words)} if 1 < len(words) <= ORDER_WORDS else set()
        paths.add("".join(words))
        for i, word in enumerate(words):
            for n in range(CUT_LETTERS, len(word) - 1):
                paths.add(" ".join([*words[:i], word[:n], *words[i + 1 :]]))
        paths.discard(" ".join(words))
        return paths

    def nearest(self, words: list[str]) -> tuple[int, set[int]] | None:
        """(distance, entries) of the nearest entries within the distance for the length."""
        best = self.within(" ".join(words))
        if not best:
            return None
        least = min(best.values())
        return least, {e for e, d in best.items() if d == least}

    def within(self, value: str, whole: bool = False) -> dict[int, int]:
        """Entry -> distance of the entries within the distance for the length; only those at no distance where there are
        some, unless the whole is asked for."""
        best = {} if whole else self.straight.within(value, 0)
        if not best:
            limit = allowed(len(value))
            best = self.straight.within(value, limit)
        if min(best.values(), default=1) > 0 or whole:
            limit = allowed(len(value))
            # an altered path may differ less: the whole value must still be spelled almost right
            for entry, d in self.altered.within(value, min(limit, 2 if len(value) > 10 else 1)).items():
                if d < best.get(entry, limit + 1):
                    best[entry] = d
        return best

    def near(self, typed: str) -> list[tuple[str, int]]:
        """(name, distance) of all entries within the distance, of the value or of what is left without remarks."""
        best: dict[int, int] = {}
        text = plain_value(typed)
        for words in without_remarks(words_of(text), text):
            for entry, d in (self.within(" ".join(words), whole=True) if words else {}).items():
                best[entry] = min(d, best.get(entry, d))
        return sorted(((self.names[e], d) for e, d in best.items()), key=lambda x: (x[1], x[0]))

    def entry_of(self, typed: str) -> str:
        """Name of the entry that a typed value means, or the empty string."""
        known = self.memory.get(typed)
        if known is None:
            if len(self.memory) > MEMORY:
                self.memory.clear()
            known = self.memory[typed] = self._entry_of(typed)
        return known

    def _entry_of(self, typed: str) -> str:
        text = plain_value(typed)
        found = self._one(text)
        if found is None:
            parts = [p for p in ALTERNATIVES.split(re.sub(r"[_-]+", " ", re.sub(r"[(\[][^)\]]*[)\]]", " ", text))) if words_of(p)]
            if len(parts) > 1:
                answers = [a for a in map(self._one, parts) if a is not None]
                names = set.intersection(*answers) if answers else set()
                if len(names) == 1 and (len(answers) == len(parts) or len(parts) == 2):
                    found = names
        return self.names[next(iter(found))] if found and len(found) == 1 else ""

    def _one(self, text: str) -> set[int] | None:
        """Entries meant by one alternative."""
        best: tuple[int, set[int]] | None = None
        for words in without_remarks(words_of(text), text):
            near = self.nearest(words) if words else None
            if near is not None and (best is None or near[0] < best[0]):
                best = near
                if near[0] == 0:
                    break
        if best is None:
            # letters lost next to a space leave the space behind: it counts as a letter here
            spaced = re.sub(r"[\s_-]", " ", text)
            near_by: dict[int, int] = {}
            for value in dict.fromkeys((spaced, spaced.strip().replace("  ", " "))):
                for entry, d in self.straight.within(value, allowed(len(value))).items():
                    near_by[entry] = min(d, near_by.get(entry, d))
            if near_by:
                least = min(near_by.values())
                best = least, {e for e, d in near_by.items() if d == least}
        return best[1] if best else None


_VOCABULARIES: dict[int, Vocabulary] = {}


def vocabulary_of(payload: bytes) -> Vocabulary:
    key = hash(payload)
    if key not in _VOCABULARIES:
        _VOCABULARIES.clear()
        _VOCABULARIES[key] = Vocabulary(pickle.loads(payload))
    return _VOCABULARIES[key]


def reference_payload(vocab: DataFrame) -> bytes:
    """The fixed reference list, (name, labels and aliases) in order of relation_id."""
    rows = vocab.where("relation IS NOT NULL").orderBy("relation_id").select("relation", "label", "aliases").toLocalIterator()
    return pickle.dumps([(r["relation"], [v for v in [r["label"], *(r["aliases"] or [])] if v]) for r in rows])


def mapped(values: DataFrame, vocab: DataFrame, value: str) -> DataFrame:
    """The columns of values but for the typed one, and relation."""
    payload = broadcast_bytes(values.sparkSession, reference_payload(vocab))
    keys = [c for c in values.columns if c != value]
    schema = ", ".join(f"`{k}` {values.schema[k].dataType.simpleString()}" for k in keys) + ", relation string"

    def look_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = vocabulary_of(payload.value)
        for batch in batches:
            names = pa.array([known.entry_of(v) for v in batch.column(len(keys)).to_pylist()], pa.string())
            yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in range(len(keys))), names], names=[*keys, "relation"])

    return values.select(*keys, value).mapInArrow(look_up, schema)


def near_entries(values: DataFrame, vocab: DataFrame, value: str) -> DataFrame:
    """The columns of values but for the typed one, with relation and distance: one row for each entry within the distance."""
    payload = broadcast_bytes(values.sparkSession, reference_payload(vocab))
    keys = [c for c in values.columns if c != value]
    schema = ", ".join(f"`{k}` {values.schema[k].dataType.simpleString()}" for k in keys) + ", relation string, distance int"

    def look_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, memory = vocabulary_of(payload.value), {}
        for batch in batches:
            if len(memory) > MEMORY:
                memory.clear()
            rows, names, distances = [], [], []
            for row, typed in enumerate(batch.column(len(keys)).to_pylist()):
                if typed not in memory:
                    memory[typed] = known.near(typed)
                for name, d in memory[typed]:
                    rows.append(row)
                    names.append(name)
                    distances.append(d)
            take = pa.array(rows, pa.int64())
            yield pa.RecordBatch.from_arrays([*(batch.column(i).take(take) for i in range(len(keys))), pa.array(names, pa.string()), pa.array(distances, pa.int32())], names=[*keys, "relation", "distance"])

    return values.select(*keys, value).mapInArrow(look_up, schema)


def typed_values(mined: DataFrame, canonical: DataFrame) -> DataFrame:
    """(src, rec_id, pos, typed) of both tables' relation lists; nulls and blanks are left out."""
    a = mined.select(F.lit("raw_relations").alias("src"), F.col("mined_id").alias("rec_id"), F.posexplode(F.transform("relations", lambda r: r["raw_predicate"])).alias("pos", "typed"))
    b = canonical.select(F.lit("canonical_relations").alias("src"), F.col("canon_id").alias("rec_id"), F.posexplode(F.transform("relations", lambda r: r["relation"])).alias("pos", "typed"))
    both = a.unionAll(b)
    return both.where(~blank(F.col("typed"))).select("src", "rec_id", F.col("pos").cast("bigint").alias("pos"), "typed")
