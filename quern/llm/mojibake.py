"""Problem 9: documents with text decoded in the wrong encoding, found and restored by noisy-channel decoding.

Channel: the stored characters of a token are put back into the bytes of the code page in which they were read; a byte that
was lost (U+FFFD) is a wildcard. The bytes form a lattice whose edges are UTF-8 sequences or the characters of a national
encoding; reading twice is undone twice. A sequence with a wildcard is an edge set: the known bytes stay and the letter is
open within them. Source: document frequencies of words over the whole corpus (pairs of characters for scripts without
spaces), in bits. A Viterbi search over the tokens of a document chooses for each token the stored text or one reading;
changing the reading costs bits, so does beginning one at all. A word with open letters is priced by the corpus words that
equal it in every known letter, fit the known bytes and keep the script; the letters with most of their documents fill it.
Where no word fits, or no letters hold FILL_SHARE of the documents, the letter stays open (U+FFFD).

Plan: one narrow pass over the texts counts words and proposes readings, in blocks of BLOCK_DOCS documents; its short result
is written once to the checkpoint folder. Words asked by a block meet the counts in an equi-join (a hot word has one row for
each block, not for each occurrence), the prices of a block come together again, and the search runs within each document.
No table of the corpus reaches the driver or is broadcast; open words are broadcast only below a checked number.

Defined results: null, empty and ASCII texts are no case; a text with U+FFFD is one, whether or not it can be restored;
repeated documents are restored each and found once; a null doc_id is not reported; other columns are ignored.
"""

from __future__ import annotations

import math
import pickle
import re
import unicodedata
from bisect import bisect
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quern.runtime import cut

#: Code pages in which UTF-8 is misread, and encodings that are misread as Western European.
READ_AS = ("cp1252", "cp1250", "cp1251", "mac_roman", "cp437", "cp850", "cp1253", "cp1254", "cp1256", "iso8859_2", "koi8_r", "cp866")
NATIONAL = ("cp1251", "koi8_r", "gb18030", "euc_jp", "shift_jis", "euc_kr", "big5", "cp1253", "iso8859_7", "cp1256", "cp874", "cp1255", "iso8859_5", "cp866", "cp1250")
NATIONAL_READ_AS = {"cp1252": NATIONAL, "cp1251": ("koi8_r", "cp866"), "koi8_r": ("cp1251", "cp866")}
#: Marks beyond ASCII that a national reading may hold beside letters.
MARKS = frozenset("«»“”„‘’—–…¿¡、。「」『』！？，：；（）・ー·؟،؛।") | {"\u3000"}
DOUBLE_BYTE = {"gb18030", "euc_jp", "shift_jis", "euc_kr", "big5"}
READINGS = 3
#: Bits: an unknown word beyond the rarest known one, a sign within a word, a control character, a change of script, a valid sequence, a change of
#: reading, the least gain of a document, and a letter of an unknown word beyond its second (alphabets; Han and Hangul).
LETTER, WIDE_LETTER = 4.0, 16.0
WIDE = "[\u3040-\u30ff\u3400-\u9fff\uac00-\ud7a3]"
UNKNOWN, SIGN, CONTROL, MIXED, SEQUENCE, CHANGE, LEAST_GAIN = 2.0, 3.0, 6.0, 4.0, 3.0, 4.0, 6.0
#: Bits of a lost byte that stays: more than a search needs to read its token as open.
LOST_BITS = 24.0
#: Bits of a sequence of which bytes are lost: it is no evidence by itself.
OPEN_SEQUENCE = 8.0
#: Share of the documents of all fitting words that the chosen letters need.
FILL_SHARE = 0.5
#: Documents of a block, tokens (and their characters) kept by a task, and distinct open words up to which they are broadcast.
BLOCK_DOCS, MEMORY_TOKENS, MEMORY_CHARS, OPEN_WORDS = 512, 100_000, 4_000_000, 50_000

LOST = "\ufffd"
#: An open letter of which some bytes are known is one private character that numbers those bytes.
OPEN_FROM, OPEN_TO = "\U000f0000", "\U0010fffd"
OPEN = f"{LOST}{OPEN_FROM}-{OPEN_TO}"
PRIVATE = re.compile(f"[{OPEN_FROM}-{OPEN_TO}]")
ANY_OPEN = re.compile(f"[{OPEN}]")
SPLIT = re.compile(r"[^ \t\n\r]+")
LETTERS = re.compile("[^\\W\\d_](?:[^\\W\\d_]|[̀-ͯ'’ऀ-ॿـً-ْ])*")
UNSPACED_LETTERS = "฀-໿က-႟ក-៿぀-ヿ㐀-鿿"
UNSPACED = re.compile(f"[{UNSPACED_LETTERS}]+")
#: A run of letters and open letters: of scripts without spaces, or of others.
OPEN_RUN = re.compile(f"[{OPEN}{UNSPACED_LETTERS}]*[{UNSPACED_LETTERS}][{OPEN}{UNSPACED_LETTERS}]*|(?:[^\\W\\d_]|[{OPEN}])(?:[^\\W\\d_]|[{OPEN}̀-ͯ'’])*")


@lru_cache(maxsize=None)
def byte_table(page: str) -> dict[str, int]:
    """Character -> byte of a code page; bytes without a character are the control characters of that number."""
    table = {chr(b): b for b in range(128, 160)}
    for b in range(128, 256):
        try:
            table[bytes([b]).decode(page)] = b
        except UnicodeDecodeError:
            pass
        table.setdefault(chr(b), b) if page == "cp1252" else None
    return table


@lru_cache(maxsize=None)
def undefined_bytes(page: str) -> frozenset[int]:
    """Bytes of the upper half without a character in a code page; decoding loses them."""
    return frozenset(b for b in range(128, 256) if "\ufffd" in bytes([b]).decode(page, "replace"))


@lru_cache(maxsize=None)
def sequence_marks(page: str) -> tuple[str, str]:
    """Characters that show the first and the further bytes of UTF-8 sequences in a code page, for a regex class."""
    table = byte_table(page).items()
    return tuple(re.escape("".join(c for c, b in table if low <= b <= high)) for low, high in ((0xC2, 0xF4), (0x80, 0xBF)))


@lru_cache(maxsize=None)
def sequence_start(page: str | None) -> re.Pattern:
    """What every UTF-8 sequence shown in a code page (None: in any of them) begins with: most tokens have none."""
    marks = [sequence_marks(p) for p in (READ_AS if page is None else (page,))]
    lead, more = ("".join(m[i] for m in marks) for i in (0, 1))
    return re.compile(f"[{lead}][{more}{LOST}]" + (f"|{LOST}[{more}]" if page is None or loses_first(page) else ""))


@lru_cache(maxsize=None)
def loses_first(page: str) -> bool:
    """Whether a code page lacks a character for a first byte of UTF-8 sequences."""
    return not set(range(0xC2, 0xF5)) <= set(byte_table(page).values())


@lru_cache(maxsize=None)
def high_characters(page: str) -> re.Pattern:
    """The characters of the upper half of a code page."""
    return re.compile("[" + re.escape("".join(byte_table(page))) + "]")


@lru_cache(maxsize=None)
def high_pair(page: str) -> re.Pattern:
    return re.compile(high_characters(page).pattern + "{2}")


def tokens_of(text: str) -> list[str]:
    """Tokens of a text that are not ASCII."""
    return [t for t in SPLIT.findall(text) if not t.isascii()]


#: Numbers of open letters: two bytes, three bytes, three bytes of which Windows-1252 has lost one.
TWO_BYTES, THREE_BYTES = 31 * 65, 31 * 65 + 17 * 65 * 65


def open_letter(data: list[int | None], page: str = "") -> str:
    """The letter of a UTF-8 sequence of which some bytes are lost: an open one, unless only one usual letter has its byte
    among those that the code page does not have."""
    if len(data) > 3 or not any(data):
        return LOST
    lost = data.index(None)
    if data.count(None) == 1 and lost and page and undefined_bytes(page):
        fits = [letter for b in undefined_bytes(page) if (letter := usual_letter(bytes([*data[:lost], b, *data[lost + 1 :]])))]
        if len(fits) == 1:
            return fits[0]
        if page == "cp1252" and len(data) == 3:
            return chr(ord(OPEN_FROM) + THREE_BYTES + (lost - 1) * 1024 + (data[0] - 0xE0) * 64 + data[3 - lost] - 0x80)
    code = 0 if data[0] is None else data[0] - (0xC1 if len(data) == 2 else 0xDF)
    for b in data[1:]:
        code = code * 65 + (0 if b is None else b - 0x7F)
    return chr(ord(OPEN_FROM) + code + (TWO_BYTES if len(data) == 3 else 0))


def usual_letter(data: bytes) -> str | None:
    """The letter or usual mark of a sequence; the rare Han letters of U+3400 to U+4DBF are left out."""
    try:
        letter = data.decode("utf-8")
    except UnicodeDecodeError:
        return None
    return letter if letter in MARKS or letter.isalpha() and not "㐀" <= letter <= "䶿" else None


def may_be(letter: str, open_char: str) -> bool:
    """Whether an open letter can be a letter, by the bytes that are known."""
    data = letter.encode("utf-8")
    if open_char == LOST:
        return len(data) > 1
    code, known = ord(open_char) - ord(OPEN_FROM), []
    if code >= THREE_BYTES:
        lost, code = divmod(code - THREE_BYTES, 1024)
        lead, other = divmod(code, 64)
        return len(data) == 3 and data[0] == lead + 0xE0 and data[2 - lost] == other + 0x80 and data[1 + lost] in undefined_bytes("cp1252")
    size = 2 if code < TWO_BYTES else 3
    code -= 0 if size == 2 else TWO_BYTES
    for _ in range(size - 1):
        code, b = divmod(code, 65)
        known.append(b + 0x7F if b else None)
    known.append(code + (0xC1 if size == 2 else 0xDF) if code else None)
    return len(data) == size and all(k is None or k == b for k, b in zip(reversed(known), data))


def context_of(run: str, i: int) -> str:
    """The open letter at a place of a run without spaces, with its known neighbours."""
    before = run[i - 1 : i] if i else ""
    return ("" if ANY_OPEN.match(before) else before) + run[i] + ("" if ANY_OPEN.match(run[i + 1 : i + 2]) else run[i + 1 : i + 2])


def words_of(text: str) -> list[str]:
    """Words of a text that are not ASCII; pairs of characters where a script has no spaces. A word with open letters holds
    them as they are, an open letter of a script without spaces stands between its neighbours."""
    out, rest = [], text
    if ANY_OPEN.search(text):
        for run in OPEN_RUN.findall(text):
            opens = [i for i, c in enumerate(run) if ANY_OPEN.match(c)]
            if opens and UNSPACED.search(run):
                out += [w for w in (context_of(run, i) for i in opens) if len(w) > 1]
                out += [w for w in (run[i : i + 2] for i in range(len(run) - 1)) if not ANY_OPEN.search(w)]
            elif opens and len(opens) < len(run):
                out.append(run.rstrip("'’"))
            elif not opens:
                out += words_of(run)
        rest = OPEN_RUN.sub(" ", text)
    else:
        if UNSPACED.search(text):
            for run in UNSPACED.findall(text):
                out += [run[i : i + 2] for i in range(len(run) - 1)] or [run]
            rest = UNSPACED.sub(" ", text)
        out += [w.rstrip("'’") for w in LETTERS.findall(rest) if not w.isascii()]
        rest = LETTERS.sub(" ", rest)
    if not rest.isascii():
        out += sorted({c for c in rest if c > "\x7f" and not ANY_OPEN.match(c) and c not in MARKS})
    return out


def word_bits(word: str, n: int | None, documents: int) -> float:
    """Bits of a word in n of so many documents; a word that the corpus does not have pays for its letters."""
    if n:
        return math.log2((documents + 1) / (n + 0.5))
    return math.log2(documents + 1) + UNKNOWN + (WIDE_LETTER if re.search(WIDE, word) else LETTER) * max(0, len(word) - 2)


def as_utf8(token: str, page: str) -> tuple[str, int] | None:
    """(text, whole sequences) if the token's bytes hold UTF-8 sequences; a sequence with lost bytes is an open letter."""
    if sequence_start(page).search(token) is None:
        return None
    table = byte_table(page)
    out, sequences, read, i, n = [], 0, False, 0, len(token)
    while i < n:
        char = token[i]
        lead = table.get(char, 0) if char > "\x7f" else 0
        size = 2 if 0xC2 <= lead <= 0xDF else 3 if 0xE0 <= lead <= 0xEF else 4 if 0xF0 <= lead <= 0xF4 else 0
        if char == LOST and loses_first(page):  # the further bytes tell how long the sequence is
            size = 1
            while size < 3 and i + size < n and 0x80 <= table.get(token[i + size], 0) <= 0xBF:
                size += 1
            size = 0 if size == 1 else size
        if size and i + size <= n:
            data: list[int | None] = [lead or None]
            for c in token[i + 1 : i + size]:
                b = None if c == LOST else table.get(c, 0) if c > "\x7f" else 0
                if b is not None and not 0x80 <= b <= 0xBF:
                    break
                data.append(b)
            else:
                try:
                    out.append(open_letter(data, page) if None in data else bytes(data).decode("utf-8"))
                    sequences += None not in data
                    read = True
                    i += size
                    continue
                except UnicodeDecodeError:
                    pass
        out.append(char)
        i += 1
    return ("".join(out), sequences) if read else None


@lru_cache(maxsize=None)
def byte_characters(page: str) -> dict[int, str]:
    """str.translate table from the characters of a code page to those of the same bytes in Latin-1."""
    return {ord(c): chr(b) for c, b in byte_table(page).items()}


def as_national(token: str, page: str, encoding: str) -> str | None:
    """The token's bytes in a national encoding; characters that the code page does not have stay as they are."""
    shown = token.translate(byte_characters(page))
    try:
        if max(shown) <= "\xff" and (page == "cp1252" or all(c <= "\x7f" or c in byte_table(page) for c in token)):
            return shown.encode("latin-1").decode(encoding)
    except UnicodeDecodeError:
        return None
    table, out, data = byte_table(page), [], bytearray()
    for char in token + "\0":
        b = ord(char) if "\0" < char <= "\x7f" else table.get(char)
        if b is not None:
            data.append(b)
            continue
        try:
            out.append(bytes(data).decode(encoding))
        except UnicodeDecodeError:
            return None
        out.append(char)
        data = bytearray()
    return "".join(out)[:-1]


def readings(token: str) -> dict[str, tuple[str, int]]:
    """Name of a reading -> (text, valid sequences) of all readings of a token."""
    out: dict[str, tuple[str, int]] = {}
    if PRIVATE.search(token):
        return out
    if LOST in token:
        out["lost"] = (token, 0)
    for page in READ_AS if sequence_start(None).search(token) else ():
        text, total = token, 0
        for depth in range(1, READINGS + 1):
            step = as_utf8(text, page)
            if step is None:
                break
            text, total = step[0], total + step[1]
            if all(text != known for known, _ in out.values()):
                out[f"utf8:{page}:{depth}"] = (text, total)
    if LOST in token:
        return out
    if MIXED_CYRILLIC.search(token):
        # Western text read as Cyrillic: words of both scripts become Latin ones
        text = as_national(token, "cp1251", "cp1252")
        if text is not None and all(c <= "\x7f" or c in MARKS or script_of(c) == "LATIN" for c in text):
            out["cp1252:cp1251:1"] = (text, 0)
    letters = 0
    for page, encodings in NATIONAL_READ_AS.items():
        shown = high_characters(page).findall(token)
        high = len(shown)
        if high < 2 or (page != "cp1252" and not any(map(str.isalpha, shown))):
            continue
        letters = letters or sum(map(str.isalpha, token))
        paired = high_pair(page).search(token)
        for encoding in encodings:
            if encoding in DOUBLE_BYTE and not paired or encoding not in DOUBLE_BYTE and high < 0.6 * letters:
                continue
            text = as_national(token, page, encoding)
            if text is not None and text != token and plausible(text, encoding not in DOUBLE_BYTE and encoding != "cp874"):
                out[f"{encoding}:{page}:1"] = (text, 0)
    return out


MIXED_CYRILLIC = re.compile(r"[A-Za-z][Ѐ-ӿ]|[Ѐ-ӿ][A-Za-z]")
LETTER_RUN = re.compile(r"[^\x00-\x7f]+")
LATIN_NEIGHBOUR = re.compile(r"[A-Za-z][^\x00-\x7f]|[^\x00-\x7f][A-Za-z]")


def plausible(text: str, spaced: bool) -> bool:
    """Whether everything beyond ASCII is a letter, a mark behind a letter or a usual sign, in runs of two letters at
    least; spaced: a script with spaces, whose words hold no Latin letters."""
    long = 0
    for run in LETTER_RUN.findall(text):
        run = run.strip("".join(MARKS))
        if run and unicodedata.category(run[0])[0] != "L":
            return False
        long = max(long, len(run))
        if any(unicodedata.category(c)[0] not in "LM" and c not in MARKS for c in run):
            return False
    return long >= 2 and not (spaced and LATIN_NEIGHBOUR.search("".join(c for c in text if c not in MARKS)))


@lru_cache(maxsize=65536)
def script_of(char: str) -> str:
    return unicodedata.name(char, "?").split(" ")[0]


def shape_bits(text: str) -> float:
    """Bits for signs within words, control characters and scripts that change within a word."""
    bits = 0.0
    for i, char in enumerate(text):
        if char <= "\x7f":
            continue
        kind = unicodedata.category(char)
        if kind in ("Cc", "Cn", "Co", "Cs"):
            bits += CONTROL
        elif kind[0] in "SNZ" or (kind[0] == "P" and 0 < i < len(text) - 1 and text[i - 1].isalnum() and text[i + 1].isalnum() and char not in "’‐‑·"):
            bits += SIGN
        elif kind[0] == "M" and (i == 0 or not (text[i - 1].isalpha() or unicodedata.category(text[i - 1])[0] == "M")):
            bits += SIGN
    for word in LETTERS.findall(text):
        scripts = [script_of(c) for c in word if c.isalpha()]
        changes = sum(a != b and not ({a, b} <= {"CJK", "HIRAGANA", "KATAKANA", "LATIN", "THAI"} or {a, b} <= {"HANGUL", "LATIN"}) for a, b in zip(scripts, scripts[1:]))
        bits += MIXED * min(changes, 6)
        bits += MIXED * sum(a.islower() and b.isupper() for a, b in zip(word, word[1:]))
    return bits


def token_proposals(token: str) -> tuple[tuple[str, list[str], float], ...]:
    """(reading, words, bits without the words) of a token that has a reading, the stored text first."""
    found = readings(token)
    if not found:
        return ()
    stored = ("", words_of(token), shape_bits(token) + (LOST_BITS if LOST in token else 0.0))
    return stored, *((name, words_of(text), shape_bits(text) - SEQUENCE * sequences + OPEN_SEQUENCE * len(PRIVATE.findall(text))) for name, (text, sequences) in found.items())


class TokenMemory(dict):
    """Token -> (its words without open letters, its proposals); tokens occur again and again."""

    chars = 0

    def __missing__(self, token: str) -> tuple[tuple[str, ...], tuple]:
        words = tuple(w for w in words_of(token) if not ANY_OPEN.search(w))
        self.chars += len(token)
        self[token] = words, token_proposals(token)
        return self[token]

    def bounded(self) -> None:
        if len(self) > MEMORY_TOKENS or self.chars > MEMORY_CHARS:
            self.clear()
            self.chars = 0


def text_proposals(text: str, memory: TokenMemory, seen: Counter | None = None) -> list[tuple[int, tuple]]:
    """(token number, its proposals) for each token that has a reading; the words of the text are counted once into seen."""
    found = [memory[t] for t in tokens_of(text)]
    if seen is not None:
        seen.update(set().union(*(words for words, _ in found)))
    return [(number, p) for number, (_, p) in enumerate(found) if p]


def best_path(rows: list[tuple[int, str, float]]) -> tuple[float, dict[int, str]]:
    """Gain in bits and {token number: reading} of the best path over (token number, reading, bits)."""
    tokens: dict[int, dict[str, float]] = {}
    for number, name, bits in rows:
        tokens.setdefault(number, {})[name] = bits
    kind = lambda name: name.rpartition(":")[0]
    cost: dict[str, float] = {"": 0.0}
    back: list[tuple[int, dict[str, str]]] = []
    stored = 0.0
    for number in sorted(tokens):
        own = tokens[number]
        base = own.get("", 0.0)
        stored += base
        cheapest = min(cost, key=lambda k: (cost[k], k))
        new, origin = {}, {}
        for name, bits in own.items():
            before = {k for k in cost if k in (name, cheapest, "") or (name and kind(k) == kind(name))}
            # going on with a reading, or back to the stored text, is free
            least, origin[name] = min((cost[k] + (0 if name == "" or kind(k) == kind(name) else CHANGE), k) for k in before)
            new[name] = least + bits
        for k in cost:  # a reading in use stays at hand over tokens that do not have it
            if k not in new:
                new[k], origin[k] = cost[k] + base, k
        cost = new
        back.append((number, origin))
    if not back:
        return 0.0, {}
    name = min(cost, key=lambda k: (cost[k], k))
    gain = stored - cost[name]
    chosen: dict[int, str] = {}
    for number, origin in reversed(back):
        if name and name in tokens[number]:
            chosen[number] = name
        name = origin[name]
    if gain >= LEAST_GAIN:
        # what one UTF-8 reading has damaged, it also restores in words that the corpus does not have
        used = Counter(n for n in chosen.values() if n.startswith("utf8:"))
        for number, own in tokens.items():
            fits = [n for n in own if used[n]]
            if chosen.get(number, "lost") == "lost" and fits:
                chosen[number] = max(fits, key=lambda n: (used[n], n))
    return gain, chosen


BLOCKS = "block bigint, words array<string>, counts array<int>, asked array<string>, opened array<string>, proposals binary"


def blocks_of(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """One row for each block of documents: its words with their documents, the words its proposals ask for, those with open
    letters, and the proposals as (doc_id, hash of the text, [(token number, proposals)])."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memory, number = TokenMemory(), TaskContext.get().partitionId() << 32
        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK_DOCS):
                ids, texts, hashes = (c.to_pylist() for c in batch.slice(at, BLOCK_DOCS).columns)
                memory.bounded()
                seen: Counter = Counter()
                rows = []
                for doc, value, code in zip(ids, texts, hashes):
                    found = text_proposals(value, memory, seen)
                    if found and doc is not None:
                        rows.append((doc, code, found))
                asked = {w for _, _, tokens in rows for _, p in tokens for _, words, _ in p for w in words}
                opened = {w for w in asked if ANY_OPEN.search(w)}
                cols = ([number], [list(seen)], [list(seen.values())], [list(asked)], [list(opened)], [pickle.dumps(rows, 5)])
                strings = pa.list_(pa.field("element", pa.string()))
                kinds = (pa.int64(), strings, pa.list_(pa.field("element", pa.int32())), strings, strings, pa.binary())
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], names=[f.split()[0] for f in BLOCKS.split(", ")])
                number += 1

    beyond = docs.where(F.col(text).rlike(r"[^\x00-\x7F]")).select(doc_id, text, F.xxhash64(text).alias("_hash"))
    return beyond.mapInArrow(read, BLOCKS)


def open_keys(word: str) -> list[str]:
    """What a fitting corpus word must share, as keys of word_keys; none if the known letters are too far apart."""
    low, n = word.lower(), len(word)
    if UNSPACED.search(word):
        i = next(i for i, c in enumerate(word) if ANY_OPEN.match(c))
        return [f"<{c}" for c in word[:i]] + [f">{c}" for c in word[i + 1 :]]
    for kind, parts in (("h", 2), ("q", 4)):
        for part in range(parts):
            piece = low[part * n // parts : (part + 1) * n // parts]
            if piece and not ANY_OPEN.search(piece):
                return [f"{kind}{part}|{n}|{piece}"]
    return [f"m|{ANY_OPEN.sub(LOST, low)}"] if ANY_OPEN.sub("", low).isascii() else []


def word_keys(kinds: set[str]) -> Column:
    """SQL of the keys of a corpus word, of the kinds that open words ask for."""
    spaced, found = [], []
    for kind, parts in (("h", 2), ("q", 4)):
        for part in range(parts):
            if f"{kind}{part}" in kinds:
                begin, end = f"CAST({part} * length(word) / {parts} AS INT)", f"CAST({part + 1} * length(word) / {parts} AS INT)"
                spaced.append(f"concat('{kind}{part}|', length(word), '|', lower(substring(word, {begin} + 1, {end} - {begin})))")
    if "m" in kinds:
        spaced.append(f"concat('m|', regexp_replace(lower(word), '[^\\\\x00-\\\\x7F]', '{LOST}'))")
    found += ["concat('<', left(word, 1))"] if "<" in kinds else []
    found += ["concat('>', right(word, 1))"] if ">" in kinds else []
    unspaced = f"word RLIKE '[{UNSPACED_LETTERS}]'"
    one, other = f"array({', '.join(found)})", f"array({', '.join(spaced)})"
    return F.expr(f"CASE WHEN {unspaced} AND length(word) = 2 THEN CAST({one} AS array<string>) WHEN {unspaced} THEN CAST(array() AS array<string>) ELSE CAST({other} AS array<string>) END")


def fitting_letters(asked: str, word: str) -> tuple[int, str] | None:
    """(side, letters) that a corpus word gives to the open letters of a word; side: 1 before, 2 behind an open letter of a
    script without spaces, whose pairs of characters are the words."""
    if UNSPACED.search(asked):
        i = next(i for i, c in enumerate(asked) if ANY_OPEN.match(c))
        side = 1 if i and word[0] == asked[i - 1] and may_be(word[1], asked[i]) else 0
        return (side, word[1]) if side else (2, word[0]) if asked[i + 1 :] == word[1] and may_be(word[0], asked[i]) else None
    if len(word) != len(asked):
        return None
    letters, known = [], [c for c in asked if not ANY_OPEN.match(c)]
    for i, (a, w) in enumerate(zip(asked, word)):
        if ANY_OPEN.match(a) is None:
            if a.lower() != w.lower():
                return None
            continue
        capital = len(known) > 1 and all(c.isupper() for c in known if c.isalpha())
        letters.append(w.upper() if capital else w.lower() if i else w)
        if len(letters[-1]) != 1 or not may_be(letters[-1], a):
            return None
    return 0, "".join(letters)


def filled_words(opened: DataFrame, counts: DataFrame) -> DataFrame:
    """(word, n, fill) of the words with open letters that corpus words fit; opened: (word), each once."""

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [(w, key, len(found)) for w in batch.column(0).to_pylist() if (found := open_keys(w)) for key in found]
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate((pa.string(), pa.string(), pa.int32()))], names=["asked", "key", "sides"])

    def fitted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for asked, sides, word, n in zip(*(c.to_pylist() for c in batch.columns)):
                found = fitting_letters(asked, word)
                # a pair of characters can give the letter on either side
                both = [found] if found is None or found[0] != 1 or len(asked) < 3 else [found, *([(2, word[0])] if word[1] == asked[-1] and may_be(word[0], asked[1]) else [])]
                rows += [(asked, sides, side, letters, n) for side, letters in filter(None, both)]
            kinds = (pa.string(), pa.int32(), pa.int32(), pa.string(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], names=["asked", "sides", "side", "letters", "n"])

    asks = cut(opened.mapInArrow(keyed, "asked string, key string, sides int"))
    kinds = {r[0] for r in asks.select(F.regexp_extract("key", r"^([hq]\d|m|[<>])", 1)).distinct().collect()}
    none = F.lit(None)
    if not kinds:
        return counts.limit(0).select("word", "n", none.cast("string").alias("fill"))
    words = counts.select("word", "n", F.explode(word_keys(kinds)).alias("key"))
    asks = F.broadcast(asks) if asks.count() <= OPEN_WORDS else asks
    met = words.join(asks, "key").select("asked", "sides", "word", "n").distinct()
    fits = met.mapInArrow(fitted, "asked string, sides int, side int, letters string, n bigint").groupBy("asked", "sides", "letters")
    side = lambda i: F.sum(F.when(F.col("side") == i, F.col("n")))
    sums = fits.agg(side(0).alias("whole"), side(1).alias("before"), side(2).alias("behind"))
    n = F.when(F.col("whole").isNotNull(), F.col("whole")).when(F.col("sides") == 2, F.when(F.col("before").isNotNull() & F.col("behind").isNotNull(), F.least("before", "behind"))).otherwise(F.coalesce("before", "behind"))
    best = sums.select("asked", "letters", n.alias("n")).where("n IS NOT NULL").groupBy("asked").agg(F.max(F.struct("n", "letters")).alias("m"), F.sum("n").alias("all"))
    return best.select(F.col("asked").alias("word"), F.col("m.n").alias("n"), F.when(F.col("m.n") >= FILL_SHARE * F.col("all"), F.col("m.letters")).alias("fill"))


def decoded(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, hash of the text, chosen map<token, reading>, fills map<word, letters>) of the documents that gain LEAST_GAIN
    bits or more. The pass over the texts is run and written when this is called."""
    blocks = cut(blocks_of(docs, doc_id, text))
    counts = blocks.select(F.explode(F.arrays_zip("words", "counts")).alias("w")).groupBy(F.col("w.words").alias("word")).agg(F.sum("w.counts").alias("n"))
    opened = blocks.select(F.explode("opened").alias("word")).distinct()
    known = counts.select("word", "n", F.lit(None).cast("string").alias("fill")).unionByName(filled_words(opened, counts))
    priced = blocks.select("block", F.explode("asked").alias("word")).join(known, "word")
    prices = priced.groupBy("block").agg(F.collect_list(F.struct("word", "n", "fill")).alias("prices"))
    documents = docs.count()

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, found in zip(*(c.to_pylist() for c in batch.columns)):
                prices = {p["word"]: p for p in found or ()}
                bits = {w: word_bits(w, p["n"], documents) for w, p in prices.items()}
                cols: list[list] = [[], [], [], []]
                for doc, code, tokens in pickle.loads(rows):
                    costs = [(number, name, own + sum(bits[w] if w in bits else word_bits(w, None, documents) for w in words)) for number, p in tokens for name, words, own in p]
                    gain, chosen = best_path(costs)
                    if gain >= LEAST_GAIN and chosen:
                        words = {w for number, p in tokens for name, words, _ in p if chosen.get(number) == name for w in words}
                        fills = {w: prices[w]["fill"] for w in words if w in prices and prices[w]["fill"]}
                        for col, v in zip(cols, (doc, code, sorted(chosen.items()), sorted(fills.items()))):
                            col.append(v)
                kinds = (id_type, pa.int64(), pa.map_(pa.int32(), pa.string()), pa.map_(pa.string(), pa.string()))
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], names=[doc_id, "_hash", "chosen", "fills"])

    kind = docs.schema[doc_id].dataType.simpleString()
    id_type = docs.select(doc_id).limit(0).toArrow().schema.field(0).type
    joined = blocks.select("block", "proposals").join(prices, "block", "left").select("proposals", "prices")
    return joined.mapInArrow(search, f"`{doc_id}` {kind}, _hash bigint, chosen map<int,string>, fills map<string,string>")


def garbled_documents(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id) of documents of which a part was decoded with the wrong encoding."""
    return decoded(docs, doc_id, text).select(doc_id).distinct()


def fill_open(text: str, fills: dict[str, str]) -> str:
    """The text with its open letters filled, U+FFFD where nothing fits."""

    def filled(m: re.Match) -> str:
        run = m.group()
        if ANY_OPEN.search(run) is None:
            return run
        if UNSPACED.search(run):
            return "".join(fills.get(context_of(run, i), LOST) if ANY_OPEN.match(c) else c for i, c in enumerate(run))
        letters = iter(fills.get(run.rstrip("'’"), ""))
        return "".join(next(letters, LOST) if ANY_OPEN.match(c) else c for c in run)

    return PRIVATE.sub(LOST, OPEN_RUN.sub(filled, text))


def token_between(token: str, before: str | None, behind: str | None) -> str | None:
    """A token without a reading of its own (too short for one) between two readings of the same national encoding."""
    if before is None or before != behind or before.startswith("utf8:") or before == "lost":
        return None
    encoding, page, _ = before.split(":")
    text = as_national(token, page, encoding)
    return text if text and all(c <= "\x7f" or c.isalpha() or c in MARKS for c in text) else None


def put_back(text: str, chosen: dict[int, str], fills: dict[str, str]) -> str:
    """The text with its chosen readings and the letters that fill open ones; all other characters stay as stored."""
    out, end, number = [], 0, -1
    numbers, names = sorted(chosen), [chosen[n] for n in sorted(chosen)]
    for m in SPLIT.finditer(text):
        token = m.group()
        if token.isascii():
            continue
        number += 1
        if number in chosen:
            new = fill_open(readings(token)[chosen[number]][0], fills)
        else:
            at = bisect(numbers, number)
            new = token_between(token, names[at - 1] if at else None, names[at] if at < len(names) else None)
        if new is not None:
            out += [text[end : m.start()], new]
            end = m.end()
    return "".join([*out, text[end:]])


def restored_documents(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, restored): the garbled documents with their text as far as it can be restored."""
    found = decoded(docs, doc_id, text).dropDuplicates([doc_id, "_hash"])
    garbled = docs.select(doc_id, text, F.xxhash64(text).alias("_hash")).join(found, [doc_id, "_hash"]).select(doc_id, text, "chosen", "fills")
    kind = docs.schema[doc_id].dataType.simpleString()

    def restore(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, chosen, fills = (batch.column(i).to_pylist() for i in (1, 2, 3))
            done = [put_back(t, dict(c), dict(f)) for t, c, f in zip(texts, chosen, fills)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(done, pa.string())], names=[doc_id, "restored"])

    return garbled.mapInArrow(restore, f"`{doc_id}` {kind}, restored string")
