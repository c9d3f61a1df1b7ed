"""Problem 2: one consistent form for texts that look the same and differ in their characters.

For each token the script sets of its letters are intersected. An empty intersection shows a mixed-script token, a token of
another script that can be spelled wholly in the look-alikes of one script a whole-script confusable. The script of a text
is the one that most of its letters without a look-alike are of; all confusable tokens are re-spelled in that script where
it has their letters, else in the first script that has; a token that none can spell keeps its letters, those with a
look-alike in Latin form. The remaining forms are normalised: width, ligatures, compatibility characters, composition of
accents, invisible characters, dashes, kinds and runs of spaces. Case and accents stay, since they are visible.

The look-alikes are those of the public confusables data for all scripts, as Spark's ICU library carries it, which is read
from its jar where Spark is installed; only letters that look like one ASCII letter are used.

Rows that share the consistent form meet in one equi-join (no pairs of other rows are ever formed); rows of a hot group
are split by adaptive skew handling. look_classes gives one row for each unit with its class and the number of its links,
without forming pairs. Defined results: null or blank values are in no pair; values equal but for white space at their
ends are no pair; repeated rows pair with every row of another spelling; other columns are ignored.
"""

from __future__ import annotations

import glob
import os
import re
import struct
import sys
import unicodedata
import zipfile
from collections import Counter
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quern.functions.text import relation_slug
from quern.runtime import blank

CONFUSABLES = "com/ibm/icu/impl/data/icudata/confusables.cfu"

#: Characters without a shape of their own.
INVISIBLE = re.compile("[­͏؜ᅟᅠ឴឵᠋-᠎​-‏‪-‮⁠-⁯︀-️﻿]")
DASHES = {"‐": "-", "‑": "-", "‒": "-", "­": "", "−": "-", "﹣": "-", "－": "-"}
#: Tokens with a letter beyond ASCII; the others are consistent as they are.
TOKEN = re.compile(r"(?<![^\W\d_])[A-Za-z]*+(?:[^\W\d_A-Za-z]|[̀-ͯ])(?:[^\W\d_]|[̀-ͯ])*")
ANY_TOKEN = re.compile(r"[^\W\d_](?:[^\W\d_]|[̀-ͯ])*")
DASH = re.compile("[" + "".join(DASHES) + "]")
#: Accents that combine with letters of any alphabet.
ACCENTS = re.compile("[̀-ͯ҃-҉᪰-᫿᷀-᷿⃐-⃰︠-︯]")
SPACES = re.compile(r"[^\S\r\n\x0b\x0c\x1c-\x1e\x85  ]+")


def _library() -> str:
    """The ICU library of this Spark installation."""
    import pyspark

    for home in (os.environ.get("SPARK_HOME"), os.path.dirname(pyspark.__file__)):
        for folder in (os.path.join(home, "jars"), os.path.join(home, "..", "__spark_libs__")) if home else ():
            found = sorted(glob.glob(os.path.join(folder, "icu4j-*.jar")))
            if found:
                return found[-1]
    raise FileNotFoundError("no icu4j library in the jars of this Spark installation")


def prototypes() -> dict[str, str]:
    """Character -> what it looks like, from the confusables data: a header, keys (character and length of its form, in
    order), and for each key the form itself or its place in a table of texts."""
    with zipfile.ZipFile(_library()) as jar:
        data = jar.read(CONFUSABLES)
    data = data[struct.unpack_from(">H", data)[0] :]
    keys_at, keys, index_at, _, table_at, table = struct.unpack_from(">6i", data, 12)
    text = data[table_at : table_at + 2 * table].decode("utf-16-be", "surrogatepass")
    out = {}
    for i in range(keys):
        (key,) = struct.unpack_from(">I", data, keys_at + 4 * i)
        (value,) = struct.unpack_from(">H", data, index_at + 2 * i)
        n = (key >> 24) + 1
        out[chr(key & 0x1FFFFF)] = chr(value) if n == 1 else text[value : value + n]
    return out


@lru_cache(maxsize=1)
def shapes() -> dict[str, dict[str, str]]:
    """Letter -> {script: its look-alike there}: letters that look like one ASCII letter, of the same case where there is one."""
    forms = prototypes() | {"ӏ": "l"}  # drawn as l, though the data sets it beside i
    ascii_letters: dict[str, list[str]] = {}
    for letter in map(chr, [*range(65, 91), *range(97, 123)]):
        ascii_letters.setdefault(forms.get(letter, letter), []).append(letter)
    found: dict[str, dict[str, str]] = {}
    members: dict[str, list[str]] = {}
    for letter in sorted(forms):
        kind = unicodedata.category(letter)
        if letter.isascii() or kind not in ("Lu", "Ll", "Lo") or unicodedata.normalize("NFKD", letter) != letter:
            continue
        like = ascii_letters.get(forms[letter], ())
        same = [x for x in like if x.isupper() == (kind != "Ll")] or list(like)
        if same:
            members.setdefault(same[0], []).append(letter)
    for latin, letters in members.items():
        shape = {"Latin": latin}
        for letter in letters:
            for script in script_set(letter) or ():
                # the letter that stands for the shape in its script, before rarer ones
                shape.setdefault(script, letter)
        for letter in (latin, *letters):
            found[letter] = shape
    return found


@lru_cache(maxsize=4096)
def script_set(char: str) -> frozenset[str] | None:
    """Scripts in which a letter is used; None: any (marks, digits, signs)."""
    if not unicodedata.category(char).startswith("L"):
        return None
    name = unicodedata.name(char, "").split(" ")[0]
    if name in ("CJK", "KANGXI", "IDEOGRAPHIC"):
        return frozenset(("Han", "Japanese", "Korean"))
    if name in ("HIRAGANA", "KATAKANA", "KATAKANA-HIRAGANA"):
        return frozenset(("Japanese",))
    if name == "HANGUL":
        return frozenset(("Korean",))
    if name == "MODIFIER":
        return None
    return frozenset((name.capitalize(),))


def resolved_scripts(token: str) -> frozenset[str] | None:
    """Intersection of the script sets of the letters; empty for a mixed-script token, None if any script fits."""
    scripts: frozenset[str] | None = None
    for char in token:
        own = script_set(char)
        if own is not None:
            scripts = own if scripts is None else scripts & own
    return scripts


def spelled(token: str, script: str) -> str | None:
    """The token in letters of one script, or None."""
    out = []
    for char in token:
        own = script_set(char)
        if own is None or script in own:
            out.append(char)
        elif script in shapes().get(char, ()):
            out.append(shapes()[char][script])
        else:
            return None
    return "".join(out)


@lru_cache(maxsize=65536)
def consistent(token: str, script: str = "Latin") -> str:
    """The token (decomposed, without invisible characters) in its consistent spelling within a text of a script."""
    scripts = resolved_scripts(token)
    known = shapes()
    if scripts is None or script in scripts:
        # letters of the script itself that only look like its usual ones
        return "".join(known[c][script] if c in known and not c.isascii() and script in known[c] else c for c in token)
    for other in (script, "Latin", *sorted(set().union(*(known.get(c, ()) for c in token)))) if not scripts else (script,):
        found = spelled(token, other)
        if found is not None:
            return found
    # letters of several scripts that none has, or a token of its own script
    return token if scripts else "".join(known[c]["Latin"] if c in known else c for c in token)


@lru_cache(maxsize=1)
def shaped_letter() -> re.Pattern:
    """Letters beyond ASCII of the scripts that have a look-alike of an ASCII letter, and Latin ones that are one; all beyond
    the first plane, where a class of single letters would be slow."""
    scripts = {script for shape in shapes().values() for script in shape} - {"Latin"}
    codes = [c for c in range(0x80, 0x10000) if unicodedata.category(chr(c))[0] == "L" and (chr(c) in shapes() or not scripts.isdisjoint(script_set(chr(c)) or ()))]
    ranges: list[list[int]] = []
    for code in codes:
        if ranges and ranges[-1][1] == code - 1:
            ranges[-1][1] = code
        else:
            ranges.append([code, code])
    return re.compile("[" + "".join(f"{chr(a)}-{chr(b)}" for a, b in ranges) + "\U00010000-\U0001ffff]")


def text_script(text: str) -> str:
    """The script of most letters of a decomposed text that have no look-alike elsewhere; Latin where there are none."""
    letters, known = Counter(text), shapes()
    counts: dict[str, int] = {}
    for letter, n in letters.items():
        if letter > "\x7f" and letter not in known:
            for script in script_set(letter) or ():
                counts[script] = counts.get(script, 0) + n
    if not counts:
        return "Latin"
    script = max(counts, key=lambda k: (counts[k], k))
    latin = sum(n for letter, n in letters.items() if letter <= "\x7f" and letter.isalpha() and script not in known.get(letter, ()))
    return script if counts[script] > latin else "Latin"


def visible_form(text: str, spaces: bool = True) -> str:
    """The consistent form of a text; texts that look the same have the same. spaces: runs of them are one, none at the ends."""
    if not text.isascii():
        text = unicodedata.normalize("NFKD", INVISIBLE.sub("", text))
        text = DASH.sub(lambda m: DASHES[m.group()], text)
        if shaped_letter().search(text):  # all other tokens are consistent as they are
            script = text_script(text)
            text = (TOKEN if script == "Latin" else ANY_TOKEN).sub(lambda m: consistent(m.group(), script), text)
        text = unicodedata.normalize("NFC", text)
    return SPACES.sub(" ", text).strip() if spaces else text


@lru_cache(maxsize=8)
def fold_table(keep: str = "") -> dict[int, str]:
    """str.translate table, one character for one: width, look-alikes and accents folded, spaces as a space."""
    table: dict[int, str] = {}
    for code in range(0x80, min(sys.maxunicode, 0xFFFF) + 1):
        char = chr(code)
        if char in keep or 0xAC00 <= code < 0xD7A4 or 0xD800 <= code < 0xE000:
            continue
        if char.isspace():
            table[code] = " "
            continue
        plain = "".join(c for c in unicodedata.normalize("NFKD", char) if not unicodedata.combining(c))
        plain = shapes()[plain]["Latin"] if plain in shapes() and unicodedata.category(plain) != "Lo" else plain
        if len(plain) == 1 and plain != char:
            table[code] = plain
    return table


def _forms(texts: pd.Series) -> pd.Series:
    return texts.map(visible_form, na_action="ignore")


def looks_like(c: Column) -> Column:
    """The consistent form of a text column; only texts beyond ASCII leave the JVM."""
    forms = F.pandas_udf(_forms, "string")
    beyond = c.rlike(r"[^\x00-\x7F]")
    plain = F.regexp_replace(F.regexp_replace(c, r"[ \t\x1F]+", " "), r"^[\s\x1C-\x1F]+|[\s\x1C-\x1F]+$", "")
    return F.coalesce(forms(F.when(beyond, c)), plain)


def stripped(c: Column) -> Column:
    """Without white space of any kind at the ends."""
    return F.regexp_replace(c, r"(?U)^[\s\x1C-\x1F\x85]+|[\s\x1C-\x1F\x85]+$", "")


def look_classes(units: DataFrame, groups: list[str], unit_id: str, look: Column, spelling: Column) -> DataFrame:
    """(groups..., id, class, links): each unit that another one of its group looks like in another spelling, its class, and
    how many those are. Spellings are counted before they meet their classes: no pairs are formed."""
    keyed = units.select(*groups, F.col(unit_id).alias("id"), F.sha2(look, 256).alias("class"), F.sha2(spelling, 256).alias("_spelling"))
    counts = keyed.groupBy(*groups, "class", "_spelling").agg(F.count(F.lit(1)).alias("own"))
    sizes = counts.groupBy(*groups, "class").agg(F.sum("own").alias("all"), F.count(F.lit(1)).alias("spellings")).where(F.col("spellings") > 1)
    several = counts.join(sizes, [*groups, "class"]).select(*groups, "class", "_spelling", (F.col("all") - F.col("own")).alias("links"))
    return keyed.join(several, [*groups, "class", "_spelling"]).select(*groups, "id", "class", "links")


def same_looks(units: DataFrame, groups: list[str], unit_id: str, look: Column, spelling: Column) -> DataFrame:
    """(groups..., id_1, id_2): units of one group with the same look and another spelling, id_1 < id_2."""
    keyed = units.select(*groups, F.col(unit_id).alias("_id"), look.alias("_look"), spelling.alias("_spelling"))
    a = keyed.select(*groups, "_look", F.col("_id").alias("id_1"), F.col("_spelling").alias("s_1"))
    b = keyed.select(*groups, "_look", F.col("_id").alias("id_2"), F.col("_spelling").alias("s_2"))
    met = a.join(b, [*groups, "_look"]).where("id_1 < id_2 AND s_1 <> s_2")
    return met.select(*groups, "id_1", "id_2")


def _pair_units(pairs: DataFrame) -> tuple[DataFrame, list[str], str, Column, Column]:
    usable = pairs.where(~blank(F.col("concept_1")) & ~blank(F.col("concept_2")) & F.col("row_no").isNotNull())
    usable = usable.select(F.lit(0).cast("bigint").alias("rec_id"), "row_no", F.coalesce(relation_slug(F.col("base_relation")), F.lit("")).alias("_base"), "concept_1", "concept_2")
    look = F.concat_ws("\0", "_base", looks_like(F.col("concept_1")), looks_like(F.col("concept_2")))
    return usable, ["rec_id"], "row_no", look, F.concat_ws("\0", stripped(F.col("concept_1")), stripped(F.col("concept_2")))


def _sentence_units(evidence: DataFrame) -> tuple[DataFrame, list[str], str, Column, Column]:
    units = evidence.select(F.col("evidence_id").alias("rec_id"), F.explode("evidence_sentences").alias("s"))
    units = units.select("rec_id", F.col("s.sentence_id").alias("sentence_id"), F.col("s.text").alias("text")).where(~blank(F.col("text")))
    return units, ["rec_id"], "sentence_id", looks_like(F.col("text")), stripped(F.col("text"))


def same_looking_pairs(pairs: DataFrame) -> DataFrame:
    """(rec_id = 0, id_1, id_2) of rows of one base relation whose concepts look the same, not all spelled the same."""
    return same_looks(*_pair_units(pairs))


def same_looking_sentences(evidence: DataFrame) -> DataFrame:
    """(rec_id, id_1, id_2) of sentences of one record that look the same and are not spelled the same."""
    return same_looks(*_sentence_units(evidence)).distinct()


def same_looking(pairs: DataFrame, evidence: DataFrame) -> DataFrame:
    """(src, rec_id, id_1, id_2) over both tables."""
    a = same_looking_pairs(pairs).select(F.lit("concept_pairs").alias("src"), "rec_id", "id_1", "id_2")
    b = same_looking_sentences(evidence).select(F.lit("wiki_evidence").alias("src"), "rec_id", "id_1", "id_2")
    return a.unionAll(b)


def looking_classes(pairs: DataFrame, evidence: DataFrame) -> DataFrame:
    """(src, rec_id, id, class, links) over both tables."""
    a = look_classes(*_pair_units(pairs)).select(F.lit("concept_pairs").alias("src"), "rec_id", "id", "class", "links")
    b = look_classes(*_sentence_units(evidence)).select(F.lit("wiki_evidence").alias("src"), "rec_id", "id", "class", "links")
    return a.unionAll(b)
