"""Problem 1: ordered sentences of texts in many languages and scripts, with their offsets.

A pushdown automaton reads the marks of a text from left to right. Its stack holds list levels at the bottom and quotations
and brackets above them: opening marks are pushed and their ends popped, list markers push a level, go on with one or fall
back to an outer one, and a terminator ends a sentence only where no quotation or bracket is open. A mark that is never
closed, or whose end comes behind that of an outer one, is an ordinary character; a blank line empties the stack.
Abbreviations are looked up in a trie; ordinals, decimals, initials, file names and addresses are told from terminators by
what stands around a full stop; white space decides nothing, except in Thai, which has no terminators.

Before it is read a text is folded mark by mark (width, look-alike letters, accents, invisible characters), so that
abbreviations are known in any spelling; offsets always refer to the text as stored. The time is linear in the length.

Defined results: null, empty and blank texts have no sentences; a text without marks is one sentence; a list marker belongs to
its item, and an item that begins a line and goes on with the list begins a sentence; an inch or foot sign, an apostrophe and
a smiley are no quotations or brackets; repeated elements give their rows once for each element; other fields and columns are
ignored. The plan is one narrow pass: explode, then Arrow batches.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quern.llm.lookalikes import INVISIBLE, fold_table

# Abbreviations, by how they behave before a new sentence.
TITLES = "dr mr mrs ms mx prof st sgt capt gov gen col lt maj cmdr adm rev hon pres sen rep fr mme mlle sr sra srta dna herr hr don vs cf e.g i.e viz env incl bzw sog vgl z.b d.h u.a ggf mt ft डॉ श्री κ.κ им ул см проф".split()
BEFORE_NUMBERS = "no nos nr num vol vols pp pg pags pag p s ch cap fig figs art sec est approx ca circa abb bd kap стр гл рис род".split()
MAY_END = "etc al ltd inc co corp bros jr b.c a.d c.e b.c.e a.m p.m u.s u.k u.n ss usw ff тыс млн др пр jan feb mar apr jun jul aug sep sept oct nov dec".split()
PARTICLES = {"von", "van", "de", "da", "di", "del", "della", "der", "den", "zu", "zur", "ter", "ibn", "bin", "al", "el", "la", "le", "du", "dos", "af", "av"}
ORDINAL_BEFORE = {"am", "im", "vom", "zum", "beim", "der", "den", "dem", "des", "die", "das", "ab", "bis", "seit", "zur", "jeder", "jedem"}

QUOTES = {"“": "”", "„": "“”", "‟": "”", "«": "»", "‹": "›", "「": "」", "『": "』", "〈": "〉", "《": "》", "｢": "｣", "‘": "’", "‚": "‘’"}
CLOSING_QUOTES = set("”»›」』〉》｣’")
BRACKETS = {"(": ")", "[": "]", "{": "}", "【": "】", "〔": "〕"}
CLOSING_BRACKETS = set(BRACKETS.values())
#: Terminators that end a sentence whatever follows.
STRONG = set("。｡।॥։።፧፨។៕။؟۔⁇⁈⁉‼")
_PAIRED = "\"'" + "".join(QUOTES) + "".join(CLOSING_QUOTES) + "".join(BRACKETS) + "".join(CLOSING_BRACKETS)
MARKS = re.compile("[.!?…;\n" + re.escape("".join(STRONG) + _PAIRED) + "]")
PAIRED = re.compile("[" + re.escape(_PAIRED) + "]|\n[^\\S\n]*\n")
THAI = re.compile("[\u0e00-\u0e7f]")
GREEK_LETTER = re.compile("[\u0370-\u03ff\u1f00-\u1fff]")
LATIN_LETTER = re.compile("[A-Za-z\u00c0-\u024f]")
#: A list marker and its kinds; a number or letter stands for its place in the list.
LIST_MARK = re.compile(r"(?:(\()?(?:(\d{1,3})|([ivx]{1,5})|([A-Za-z]))([.)])|([•‣◦▪●*–-]))(?=\s)")
ROMAN = {"i": 1, "ii": 2, "iii": 3, "iv": 4, "v": 5, "vi": 6, "vii": 7, "viii": 8, "ix": 9, "x": 10}
WORD_BEFORE = re.compile(r"[^\s\d_.,;:!?\"'(){}\[\]«»“”„…/\\|<>=+*&%$#@~^–—-]+(?:\.[^\s\d_.,;:!?\"'(){}\[\]«»“”„…/\\|<>=+*&%$#@~^–—-]+)*\Z")
SPACE = re.compile(r"\s+")


def _trie(words: list[str], kind: str, into: dict) -> None:
    for word in words:
        node = into
        for char in word:
            node = node.setdefault(char, {})
        node[""] = kind


ABBREVIATIONS: dict = {}
_trie(TITLES, "title", ABBREVIATIONS)
_trie(BEFORE_NUMBERS, "number", ABBREVIATIONS)
_trie(MAY_END, "may end", ABBREVIATIONS)


def abbreviation(word: str) -> str | None:
    """Kind of an abbreviation without its last full stop, by the trie."""
    node = ABBREVIATIONS
    for char in word if word.isascii() else unicodedata.normalize("NFKC", word):
        node = node.get(char)
        if node is None:
            return None
    return node.get("")


#: Typography that keeps its meaning: width becomes ASCII, except for marks that only exist in wide form.
_FOLD = fold_table(keep="".join(STRONG) + "".join(QUOTES) + "".join(CLOSING_QUOTES) + "…")


#: Characters that the automaton does not see: invisible ones and combining accents.
UNSEEN = re.compile(INVISIBLE.pattern[:-1] + "\u0300-\u036f]")


def folded(text: str) -> tuple[str, list[int] | None]:
    """The text for the automaton, and the stored position of each of its characters (None: the same)."""
    if UNSEEN.search(text) is None:
        return text.translate(_FOLD), None
    keep = [i for i, c in enumerate(text) if UNSEEN.match(c) is None]
    return "".join(text[i] for i in keep).translate(_FOLD), keep


def _starts_sentence(s: str, at: int) -> bool:
    """Whether what stands at a position may open a sentence: no lower-case word, unless it is a name's particle."""
    if at >= len(s):
        return True
    char = s[at]
    if char.islower():
        return _particle(s, at)
    return char not in ",;:-–—…/%&+=)]}"


def _particle(s: str, at: int) -> bool:
    end = at
    while end < len(s) and s[end].isalpha():
        end += 1
    return s[at:end] in PARTICLES and end + 1 < len(s) and s[end].isspace() and s[end + 1].isupper()


def _full_stop_ends(s: str, begin: int, at: int, after: int) -> bool:
    """Whether the full stop at a position ends its sentence; after: the position behind the run of marks."""
    following = s[after] if after < len(s) else ""
    if not following:
        return True
    before = s[at - 1] if at > begin else ""
    if not before or before.isspace():
        return False
    space = following.isspace()
    nxt = after
    while nxt < len(s) and s[nxt].isspace():
        nxt += 1
    if nxt >= len(s):
        return True
    if "ሀ" <= before <= "፿":
        return False
    if before.isdigit():
        if following.isdigit():
            return False
        number = at
        while number > begin and s[number - 1].isdigit():
            number -= 1
        if at - number <= 3 and space and s[nxt].isalpha():
            word = re.search(r"(\w+)\s+\Z", s[max(begin, number - 24) : number])
            if word and word.group(1).lower() in ORDINAL_BEFORE:
                return False
    if following.isalpha() and s[after + 1 : after + 2] == "." and before.isalpha() and not s[at - 2 : at - 1].isalpha():
        return False  # within an abbreviation of single letters
    if not space and (following.islower() or following in "_/\\@#=&-"):
        return following.islower() and _particle(s, after)
    if not space and following.isdigit():
        number = after
        while number < len(s) and s[number].isdigit():
            number += 1
        if number < len(s) and not s[number].isspace():
            return False
    word = WORD_BEFORE.search(s, max(begin, at - 24), at)
    if word is not None:
        name = word.group().lower()
        kind = abbreviation(name)
        if kind == "title":
            return False
        if kind == "number":
            return not (s[nxt].isdigit() or s[nxt].islower() or s[nxt] in "IVXLC" and abbreviation(name) == "number" and s[nxt : nxt + 2].isupper())
        if len(name) == 1 and not (word.group().islower() and _unit(s, begin, word.start())):
            # an initial; east Asian and other letters without case are words
            if word.group().isupper() or word.group().islower() or "֐" <= name <= "ࣿ":
                return False
        if kind == "may end" or len(name) == 1 or "." in name:
            return _starts_sentence(s, nxt)
    if s[nxt] in ",;:":
        return False
    return True


def _unit(s: str, begin: int, at: int) -> bool:
    """Whether a letter stands behind a number, as a unit does."""
    while at > begin and s[at - 1].isspace():
        at -= 1
    return at > begin and s[at - 1].isdigit()


def _speech_ends(s: str, end: int, said: bool) -> bool:
    """Whether a sentence ends with a quotation that closed behind a terminator; said: a colon introduces it."""
    if said or end >= len(s):
        return True
    if not s[end].isspace():
        return s[end].isupper()
    nxt = end
    while nxt < len(s) and s[nxt].isspace():
        nxt += 1
    return nxt >= len(s) or (not s[nxt].islower() and s[nxt] not in ",;:-–—.!?")


def _thai_space(s: str, m: re.Match) -> bool:
    """Whether a space of a Thai text ends a sentence."""
    if m.start() == 0 or m.end() == len(s):
        return False
    a, b = s[m.start() - 1], s[m.end()]
    if a.isnumeric() or b.isnumeric():
        return False
    thai = lambda c: "฀" <= c <= "๿"
    return thai(a) or thai(b)


def spans(text: str | None) -> list[tuple[int, int]]:
    """Offsets (begin, end) of the sentences of a text as stored."""
    if not text:
        return []
    s, at = folded(text)
    ends = _ends(s, _greek_counts(text, at) if ";" in s and GREEK_LETTER.search(text) else None)
    out, begin = [], 0
    for end in [*ends, len(s)]:
        a, b = begin, end
        while a < b and s[a].isspace():
            a += 1
        while b > a and s[b - 1].isspace():
            b -= 1
        begin = end
        if a < b:
            out.append((a, b) if at is None else (at[a], at[b - 1] + 1))
    if at is not None:
        out = [(a if i else _first(text, a), _last(text, b, out[i + 1][0] if i + 1 < len(out) else len(text))) for i, (a, b) in enumerate(out)]
    return out


def _first(text: str, a: int) -> int:
    """Invisible characters before the first sentence belong to it."""
    while a and not text[a - 1].isspace():
        a -= 1
    return a


def _last(text: str, b: int, limit: int) -> int:
    """Marks and invisible characters directly behind a sentence belong to it."""
    while b < limit and UNSEEN.match(text[b]):
        b += 1
    return b


def _greek_counts(text: str, at: list[int] | None) -> list[int]:
    """For each place of the folded text: twice the Greek letters less the Latin ones before it in the stored text (names are
    often Latin)."""
    counts = [0]
    for char in text if at is None else map(text.__getitem__, at):
        counts.append(counts[-1] + (2 if GREEK_LETTER.match(char) else -1 if LATIN_LETTER.match(char) else 0))
    return counts


def _opens(s: str, i: int, char: str) -> bool:
    """Whether a mark may open a quotation or bracket."""
    before, behind = s[i - 1 : i], s[i + 1 : i + 2]
    if char == '"':
        return not before.isdigit()  # an inch sign
    if char in "'‘‚":
        return not before.isalnum() and behind != "" and not behind.isspace()
    return char in QUOTES or char in BRACKETS and not (before in (":", ";") and char == "(")


def _closes(s: str, i: int, char: str) -> bool:
    """Whether a mark may close a quotation or bracket."""
    before, behind = s[i - 1 : i], s[i + 1 : i + 2]
    if char == ")":
        return not (before in (":", ";") or before == "-" and s[i - 2 : i - 1] in (":", ";"))  # a smiley
    if char == "'":
        return before in ("." , "!", "?", ",", "…") and not behind.isalnum()
    if char == "’":
        return not behind.isalpha()
    return True


def _pairs(s: str) -> dict[int, int]:
    """Place of each opening mark that is closed -> place of its end; pairs do not cross and end before a blank line."""
    pairs: dict[int, int] = {}
    stack: list[tuple[str, int]] = []
    waited: dict[str, int] = {}

    def pop() -> int:
        closing, opened = stack.pop()
        for c in closing:
            waited[c] -= 1
        return opened

    for m in PAIRED.finditer(s):
        i, char = m.start(), m.group()
        if char[0] == "\n":
            stack.clear()
            waited.clear()
        elif waited.get(char) and _closes(s, i, char):
            while char not in stack[-1][0]:
                pop()
            pairs[pop()] = i
        elif _opens(s, i, char):
            closing = QUOTES.get(char) or BRACKETS.get(char) or char
            stack.append((closing, i))
            for c in closing:
                waited[c] = waited.get(c, 0) + 1
    return pairs


def _list_mark(s: str, at: int) -> tuple[str, list[int], int] | None:
    """(kind, places in the list that it may stand for, end) of a list marker at a position."""
    m = LIST_MARK.match(s, at)
    if m is None:
        return None
    bracket, number, roman, letter, close, bullet = m.groups()
    if bullet:
        return bullet, [], m.end()
    if bracket and close == ".":
        return None
    kind = (bracket or "") + close
    if number:
        return "1" + kind, [int(number)], m.end()
    values = [ROMAN[roman]] if roman in ROMAN else []
    if letter or len(roman or "") == 1:
        values.append(ord((letter or roman).lower()) - 96)
    return ("a" if (letter or roman).islower() else "A") + kind, values, m.end()


def _go_on(levels: list[tuple[str, list[int]]], mark: tuple[str, list[int], int], first: bool) -> bool:
    """Go on with the level that the marker follows, without the levels within it, or push a level that it begins; of each
    kind of marker the stack holds one level, a list that begins anew takes its place."""
    kind, values, _ = mark
    for depth in range(len(levels) - 1, -1, -1):
        known, places = levels[depth]
        if known == kind and (not values or any(v - 1 in places for v in values)):
            del levels[depth + 1 :]
            levels[depth] = kind, [v for v in values if v - 1 in places]
            return True
        if known == kind and first and 1 in values:
            del levels[depth:]
    if first and (not values or 1 in values):
        levels.append((kind, values))
    return False


def _ends(s: str, greek: list[int] | None) -> list[int]:
    """Positions behind the sentences of a folded text; greek: see _greek_counts."""
    ends: list[int] = []
    pairs = _pairs(s)
    levels: list[tuple[str, list[int]]] = []  # list levels, the bottom of the stack
    stack: list[tuple[int, int, bool]] = []  # quotations and brackets: (end, begin, introduced by a colon)
    begin = skip = 0
    start: int | None = None  # where the first character of the sentence stands, once it is asked for
    thai = THAI.search(s) is not None
    spaces = iter([m for m in SPACE.finditer(s) if _thai_space(s, m)]) if thai else iter(())
    space = next(spaces, None)

    def end_at(position: int) -> None:
        nonlocal begin, start
        ends.append(position)
        begin, start = position, None

    def first() -> int:
        nonlocal start
        if start is None:
            m = SPACE.match(s, begin)
            start = m.end() if m else begin
        return start

    marked = -1
    for m in MARKS.finditer(s):
        i, char = m.start(), m.group()
        while space is not None and space.start() < i:
            if not stack:
                end_at(space.start())
            space = next(spaces, None)
        if i < skip:
            continue
        if not stack and marked != first():
            marked = first()
            mark = _list_mark(s, marked)
            if mark is not None:
                _go_on(levels, mark, True)
                skip = mark[2]
                if i < skip:
                    continue
        if stack and i == stack[-1][0]:
            _, opened, said = stack.pop()
            if stack:
                continue
            last = i - 1
            while last > opened and s[last].isspace():
                last -= 1
            closed = last > opened and (s[last] in ".!?…" or s[last] in STRONG)
            if not closed or s.endswith("...", opened + 1, last + 1) and not said:
                continue
            if char in CLOSING_BRACKETS:
                if first() == opened:
                    end_at(i + 1)
            elif _speech_ends(s, i + 1, said):
                end_at(i + 1)
            continue
        if i in pairs:
            before = i - 1
            while before >= 0 and s[before].isspace():
                before -= 1
            stack.append((pairs[i], i, before >= 0 and s[before] in ":："))
            continue
        if char == "\n":
            if stack:
                continue
            line = SPACE.match(s, i).end()
            if s.count("\n", i, line) > 1:
                levels.clear()
            mark = _list_mark(s, line) if levels else None
            if mark is not None and first() < i:
                if _go_on(levels, mark, True):
                    end_at(i)
                    marked = line
                skip = mark[2]
            continue
        if stack or char in _PAIRED:
            continue
        if char == ";":
            if greek is not None and greek[i] > greek[begin]:
                end_at(i + 1)
            continue
        after = i + 1
        while after < len(s) and (s[after] in ".!?…" or s[after] in STRONG):
            after += 1
        skip = after
        run = s[i:after]
        if "…" in run or run.startswith(".."):
            attached = i > begin and not s[i - 1].isspace()
            nxt = after
            while nxt < len(s) and s[nxt].isspace():
                nxt += 1
            if run[-1] in "!?" or (attached and nxt < len(s) and nxt > after and s[nxt].isupper()):
                end_at(after)
            continue
        if run == ".":
            ended = _full_stop_ends(s, begin, i, after) and not _numbers_item(s, i, levels)
        elif run[0] in "!?":
            nxt = s[after] if after < len(s) else ""
            ended = not (nxt.islower() and nxt.isascii() and not _particle(s, after)) and nxt not in set("=&/,")
        else:
            ended = True
        if ended:
            while after < len(s) and after not in pairs and (s[after] in CLOSING_QUOTES or s[after] in CLOSING_BRACKETS):
                after += 1
            skip = after
            end_at(after)
    while space is not None:
        if not stack:
            end_at(space.start())
        space = next(spaces, None)
    return ends


def _numbers_item(s: str, at: int, levels: list[tuple[str, list[int]]]) -> bool:
    """Whether a full stop within a line belongs to the number of the next item of the innermost list level."""
    if not levels or not s[at - 1].isdigit():
        return False
    number = at
    while number > 0 and at - number < 4 and s[number - 1].isdigit():
        number -= 1
    mark = _list_mark(s, number) if number == 0 or s[number - 1].isspace() else None
    return mark is not None and mark[2] == at + 1 and _go_on(levels, mark, False)


UNITS = "unit_no bigint, start_pos bigint, end_pos bigint"


def sentence_units(texts: DataFrame, keys: list[str], text: str = "text") -> DataFrame:
    """(keys..., unit_no, start_pos, end_pos) for each sentence of each non-null text."""
    slim = texts.select(*keys, F.col(text).alias("_text")).where("_text IS NOT NULL")
    fields = [slim.schema[k] for k in keys]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields) + ", " + UNITS

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, number, begins, ends = [], [], [], []
            for row, value in enumerate(batch.column(len(keys)).to_pylist()):
                for unit, (a, b) in enumerate(spans(value)):
                    rows.append(row)
                    number.append(unit)
                    begins.append(a)
                    ends.append(b)
            take = pa.array(rows, pa.int64())
            cols = [batch.column(k).take(take) for k in range(len(keys))]
            yield pa.RecordBatch.from_arrays([*cols, pa.array(number, pa.int64()), pa.array(begins, pa.int64()), pa.array(ends, pa.int64())], names=[*keys, "unit_no", "start_pos", "end_pos"])

    return slim.mapInArrow(cut, schema)


def evidence_texts(evidence: DataFrame) -> DataFrame:
    """(evidence_id, sentence_id, text) of each evidence element."""
    return evidence.select("evidence_id", F.explode("evidence_sentences").alias("s")).select("evidence_id", F.col("s.sentence_id").alias("sentence_id"), F.col("s.text").alias("text"))
