"""Text kernels as Column expressions; all stay in the JVM."""

from __future__ import annotations

import html
import json
import sys
import unicodedata
from collections.abc import Callable, Iterable
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F


@lru_cache(maxsize=1)
def _decompositions() -> tuple[str, str, tuple[tuple[str, str], ...]]:
    """From the Unicode database: characters whose compatibility form without combining marks is one other character, and
    those whose form is several characters of which some are ASCII letters or digits (signs, fractions, numerals, units)."""
    single, to, several = [], [], []
    for code in range(0x80, sys.maxunicode + 1):
        char = chr(code)
        if unicodedata.combining(char) or not unicodedata.decomposition(char):
            continue
        plain = "".join(c for c in unicodedata.normalize("NFKD", char) if not unicodedata.combining(c))
        if len(plain) == 1 and plain != char:
            single.append(char)
            to.append(plain)
        elif not plain or len(plain) > 1 and any(c.isascii() and c.isalnum() for c in plain):
            several.append((char, plain))
    return "".join(single), "".join(to), tuple(several)


@lru_cache(maxsize=1)
def _folds() -> tuple[tuple[str, str], ...]:
    """From the Unicode database: lower-case characters, but for the usual ones, and their case-folded forms where those differ."""
    usual = {before for before, _ in _USUAL_FOLDS}
    return tuple((c, c.casefold()) for c in map(chr, range(0x80, sys.maxunicode + 1)) if c.casefold() != c and c.lower() == c and c not in usual)


def _class_of(chars: Iterable[str]) -> str:
    """A regex class of characters, as ranges of code points."""
    ranges: list[list[int]] = []
    for code in sorted(map(ord, chars)):
        if ranges and ranges[-1][1] == code - 1:
            ranges[-1][1] = code
        else:
            ranges.append([code, code])
    return "[" + "".join(f"\\x{{{a:X}}}-\\x{{{b:X}}}" for a, b in ranges) + "]"


@lru_cache(maxsize=1)
def _classes() -> tuple[str, str, str]:
    """Regex classes: characters of several, of the folds but for the usual ones, and combining marks."""
    marks = (c for c in map(chr, range(0x80, sys.maxunicode + 1)) if unicodedata.combining(c))
    return _class_of(c for c, _ in _decompositions()[2]), _class_of(c for c, _ in _folds()), _class_of(marks)


def _once(c: Column, f: Callable[[Column], Column]) -> Column:
    """f(c), with c computed once however often f names it."""
    return F.element_at(F.transform(F.array(c), f), 1)


def _replaced(c: Column, pairs: tuple[tuple[str, str], ...], present: str) -> Column:
    """c with the pairs replaced; only texts that hold one of them are looked at closely."""
    listed = F.from_json(F.lit(json.dumps([{"a": a, "b": b} for a, b in pairs])), "array<struct<a:string,b:string>>")
    return _once(c, lambda v: F.when(v.rlike(present), F.aggregate(listed, v, lambda acc, x: F.replace(acc, x["a"], x["b"]))).otherwise(v))


def normalize_space(c: Column) -> Column:
    """Runs of white space (no-break spaces and separators included) as one space, none at the ends."""
    return F.trim(F.regexp_replace(c, r"(?U)[\s\x1C-\x1F]+", " "))


BEYOND_ASCII = r"[^\x00-\x7F]"
#: The folds that texts hold often; the others are looked up only where one of them occurs.
_USUAL_FOLDS = (("ß", "ss"), ("ς", "σ"), ("ſ", "s"))


def casefold(c: Column) -> Column:
    """Full Unicode case folding."""
    usual = F.lower(c)
    for before, after in _USUAL_FOLDS:
        usual = F.replace(usual, F.lit(before), F.lit(after))
    return F.when(c.rlike(BEYOND_ASCII), _replaced(usual, _folds(), _classes()[1])).otherwise(F.lower(c))


def plain_letters(c: Column) -> Column:
    """Compatibility decomposition without combining marks, as far as ASCII letters and digits come of it."""
    single, to, several = _decompositions()
    some, _, marks = _classes()
    whole = F.regexp_replace(_replaced(F.translate(c, single, to), several, some), marks, "")
    return F.when(c.rlike(BEYOND_ASCII), whole).otherwise(c)


def ascii_slug(c: Column) -> Column:
    """relation_slug for text known to be ASCII: a short chain of built-in functions."""
    s = F.regexp_replace(normalize_space(c), r"([a-z0-9])(?=[A-Z])", "$1_")
    return F.trim(F.regexp_replace(F.lower(s), r"[^a-z0-9]+", "_"), F.lit("_"))


def relation_slug(c: Column) -> Column:
    """A relation label as snake case: camel case split, accents dropped, folded, other runs as one underscore."""
    split = F.regexp_replace(normalize_space(c), r"([a-z0-9])(?=[A-Z])", "$1_")
    folded = _once(_once(split, plain_letters), casefold)
    return F.when(c.rlike(BEYOND_ASCII), F.trim(F.regexp_replace(folded, r"[^a-z0-9]+", "_"), F.lit("_"))).otherwise(ascii_slug(c))


def stable_pair_id(base_relation: Column, concept_1: Column, concept_2: Column) -> Column:
    """pair_ and 12 hex digits of a SHA-1 over the slug and the folded concepts."""
    key = F.concat_ws("\0", relation_slug(base_relation), casefold(F.trim(concept_1)), casefold(F.trim(concept_2)))
    return F.concat(F.lit("pair_"), F.substring(F.sha1(key), 1, 12))


def stable_question_id(stem_id: Column, target_ids: Column, occurrence: Column) -> Column:
    """q_ and 14 hex digits of a SHA-1 over the stem, the targets as displayed and the occurrence."""
    key = F.concat_ws("\0", stem_id, F.array_join(target_ids, "\0"), occurrence.cast("string"))
    return F.concat(F.lit("q_"), F.substring(F.sha1(key), 1, 14))


def cache_key(model: Column, text: Column) -> Column:
    """SHA-256 over model and text."""
    return F.sha2(F.concat_ws("\0", model, text), 256)


def _unescaped(texts: pd.Series) -> pd.Series:
    return texts.map(html.unescape, na_action="ignore")


def unescape_entities(c: Column) -> Column:
    """HTML entities decoded; only texts with an ampersand leave the JVM."""
    return F.coalesce(F.pandas_udf(_unescaped, "string")(F.when(F.contains(c, F.lit("&")), c)), c)


def clean_wiki_text(c: Column, unescape: bool = True) -> Column:
    """Page text without [n] markers, entities decoded, white space collapsed."""
    return normalize_space(F.regexp_replace(unescape_entities(c) if unescape else c, r"\[[0-9]+\]", ""))


#: Fixed value: white space after a closing mark and before an ASCII capital, digit, quote or bracket.
SENTENCE_BOUNDARY = "(?<=[.!?])\\s+(?=[A-Z0-9\"'“‘(])"


def split_sentences(c: Column, min_chars: int = 25, max_chars: int = 900) -> Column:
    """Array of the sentences of min_chars to max_chars code points."""
    parts = F.transform(F.split(c, SENTENCE_BOUNDARY), normalize_space)
    return F.filter(parts, lambda s: F.length(s).between(min_chars, max_chars))


def alias_variants(label: Column) -> Column:
    """Folded spellings of a concept: underscores as spaces, without parentheses, without a leading The."""
    tidy = normalize_space(label)
    forms = F.array(
        casefold(tidy),
        casefold(F.replace(tidy, F.lit("_"), F.lit(" "))),
        casefold(F.trim(F.regexp_replace(tidy, r"\s*\([^)]*\)\s*", ""))),
        F.when(tidy.startswith("The "), casefold(F.substring(tidy, 5, 1 << 30))),
    )
    return F.filter(F.array_distinct(forms), lambda x: x.isNotNull() & (x != ""))


def contains_any(folded: Column, aliases: Column) -> Column:
    """Whether any alias is a substring of a folded sentence."""
    return F.exists(aliases, lambda a: F.contains(folded, a))


def page_url(title: Column, language: str = "en") -> Column:
    """Article address of a title, percent-encoded with the slash kept."""
    encoded = F.url_encode(F.replace(title, F.lit(" "), F.lit("_")))
    for before, after in (("+", "%20"), ("%2F", "/"), ("%7E", "~"), ("*", "%2A")):
        encoded = F.replace(encoded, F.lit(before), F.lit(after))
    return F.concat(F.lit(f"https://{language}.wikipedia.org/wiki/"), encoded)


def parse_id_list(c: Column) -> Column:
    """Comma-separated ids as array<bigint>; other items are left out."""
    items = F.filter(F.split(c, ","), lambda x: F.trim(x).rlike("^[0-9]+$"))
    return F.transform(items, lambda x: F.trim(x).cast("bigint"))


def hex_suffix_seed(pair_id: Column, seed: int = 42) -> Column:
    """seed plus the last four characters of an id where all are hex digits, else seed."""
    tail = F.lower(F.right(pair_id, F.lit(4)))
    return F.lit(seed) + F.when(tail.rlike("^[0-9a-f]+$"), F.conv(tail, 16, 10).cast("int")).otherwise(F.lit(0))
