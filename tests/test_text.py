import hashlib
import unicodedata

import pytest
from pyspark.sql import functions as F

from quern.functions import text as X


def run(spark, values, f):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    return [r[0] for r in df.orderBy("i").select(f(F.col("v"))).collect()]


def test_slug_camel_case_and_spaces(spark):
    assert run(spark, ["Located In", "isLocatedIn", "  a--B c ", "Größe Café", "漢字", "", None], X.relation_slug) == ["located_in", "is_located_in", "a_b_c", "grosse_cafe", "", "", None]


def test_slug_equals_a_plain_python_form(spark):
    def plain(v):
        import re

        v = re.sub(r"(?<=[a-z0-9])(?=[A-Z])", "_", " ".join(v.split()))
        v = "".join(c for c in unicodedata.normalize("NFKD", v) if not unicodedata.combining(c)).casefold()
        return re.sub(r"_+", "_", re.sub(r"[^a-z0-9]+", "_", v)).strip("_")

    import sys

    signs = [f"a{chr(c)}b" for c in range(0x80, sys.maxunicode + 1) if unicodedata.decomposition(chr(c)) and not 0xAC00 <= c < 0xD7A4 and not 0xF900 <= c < 0xFAE0 and not 0x2F800 <= c < 0x2FA20]
    values = ["Brand™ of", "½ owner", "Ⅷ rank", "№ of", "km㎏", "aाb", "ﷺ x", "𝐁old 𝟗", "Ǆep", *signs, "ﬁrst Lake", "Ｗｉｄｅ", "mündet in", "naïveCase", "ŽelezoRudný", "x²", "K elvin"]
    assert run(spark, values, X.relation_slug) == [plain(v) for v in values]


def test_casefold(spark):
    assert run(spark, ["STRASSE ß", "ΣΊΣΥΦΟΣ", "ſharp"], X.casefold) == ["strasse ss", "σίσυφοσ", "sharp"]


def test_normalize_space(spark):
    assert run(spark, [" a   b\n\tc\x1f"], X.normalize_space) == ["a b c"]


def test_pair_id(spark):
    df = spark.createDataFrame([("Located In", " Paris", "France ")], "b string, x string, y string")
    got = df.select(X.stable_pair_id(F.col("b"), F.col("x"), F.col("y"))).first()[0]
    assert got == "pair_" + hashlib.sha1(b"located_in\0paris\0france").hexdigest()[:12]


def test_question_id_depends_on_order(spark):
    df = spark.createDataFrame([(["a", "b"],), (["b", "a"],)], "t array<string>")
    one, two = (r[0] for r in df.select(X.stable_question_id(F.lit("s"), F.col("t"), F.lit(0))).collect())
    assert one != two and one == "q_" + hashlib.sha1(b"s\0a\0b\x000").hexdigest()[:14]


def test_clean_and_split(spark):
    text = "A &amp; B &eacute; lived[12]  here for years. &quot;It&quot; was quite a long story. short. Élan never starts one here."
    assert run(spark, [text], X.clean_wiki_text)[0].startswith('A & B é lived here for years. "It" was')
    got = run(spark, [X_clean(spark, text)], X.split_sentences)[0]
    assert got == ["A & B é lived here for years.", '"It" was quite a long story. short. Élan never starts one here.']


def X_clean(spark, text):
    return run(spark, [text], X.clean_wiki_text)[0]


def test_alias_variants(spark):
    got = run(spark, ["The Old_Mill (novel)", "Paris"], X.alias_variants)
    assert set(got[0]) == {"the old_mill (novel)", "the old mill (novel)", "the old_mill", "old_mill (novel)"}
    assert got[1] == ["paris"]


def test_contains_any_is_a_substring_test(spark):
    df = spark.createDataFrame([("an iranian lake", ["iran"]), ("a lake", ["iran"])], "s string, a array<string>")
    assert [r[0] for r in df.select(X.contains_any(F.col("s"), F.col("a"))).collect()] == [True, False]


def test_page_url_ids_and_seed(spark):
    assert run(spark, ["A b/c (d)*~+é"], X.page_url) == ["https://en.wikipedia.org/wiki/A_b/c_%28d%29%2A~%2B%C3%A9"]
    assert run(spark, ["3, x, 07 ,-1", ""], X.parse_id_list) == [[3, 7], []]
    assert run(spark, ["pair_00ff", "pair_xyz"], X.hex_suffix_seed) == [42 + 255, 42]


@pytest.mark.parametrize("model,text", [("m", "t"), ("m", "é\n")])
def test_cache_key(spark, model, text):
    df = spark.createDataFrame([(model, text)], "m string, t string")
    assert df.select(X.cache_key(F.col("m"), F.col("t"))).first()[0] == hashlib.sha256(f"{model}\0{text}".encode()).hexdigest()


def test_casefold_is_that_of_unicode(spark):
    import sys

    letters = [chr(c) for c in range(0x80, sys.maxunicode + 1) if not 0xD800 <= c < 0xE000 and (chr(c).casefold() != chr(c) or chr(c).lower() != chr(c)) and unicodedata.name(chr(c), "")]
    values = ["Straße ΣΑΣ ſ", "ŉ ǰ ΐ ﬃ ՙև", "ᏸ Ꭰ ꭰ", "İI", "Ὀδυσσεύς ᾳ ᾈ", *letters]
    got = run(spark, values, X.casefold)
    assert [(v, g) for v, g in zip(values, got) if g != v.casefold()] == []
