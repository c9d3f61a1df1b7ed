"""Queries of the language-model operators, each over its whole tables with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from quern.runtime import table

Query = Callable[[SparkSession, str], DataFrame]


def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    from quern.llm.sentences import evidence_texts, sentence_units

    return sentence_units(evidence_texts(table(spark, sf_dir, "wiki_evidence")), ["evidence_id", "sentence_id"])


def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    from quern.llm.lookalikes import same_looking

    return same_looking(table(spark, sf_dir, "concept_pairs"), table(spark, sf_dir, "wiki_evidence"))


def p2_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    from quern.llm.lookalikes import looking_classes

    return looking_classes(table(spark, sf_dir, "concept_pairs"), table(spark, sf_dir, "wiki_evidence")).drop("class")


def p2_normalized(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pyspark.sql import functions as F

    from quern.llm.lookalikes import looks_like

    pairs = table(spark, sf_dir, "concept_pairs")
    return pairs.select("row_no", looks_like(F.col("concept_1")).alias("concept_1"), looks_like(F.col("concept_2")).alias("concept_2"))


def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    from quern.llm.vocabulary import mapped, typed_values

    typed = typed_values(table(spark, sf_dir, "raw_relations"), table(spark, sf_dir, "canonical_relations"))
    return mapped(typed, table(spark, sf_dir, "relation_vocab"), "typed")


def p3_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    from quern.llm.vocabulary import near_entries, typed_values

    typed = typed_values(table(spark, sf_dir, "raw_relations"), table(spark, sf_dir, "canonical_relations"))
    return near_entries(typed, table(spark, sf_dir, "relation_vocab"), "typed")


def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    from quern.llm.ranking import rank_relations

    ranked = rank_relations(table(spark, sf_dir, "maxdiff_choices"), table(spark, sf_dir, "relation_vocab"))
    return ranked.select("relation", "quarter")


def p4_strengths(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pyspark.sql import functions as F

    from quern.llm.ranking import rank_relations

    ranked = rank_relations(table(spark, sf_dir, "maxdiff_choices"), table(spark, sf_dir, "relation_vocab"))
    return ranked.select("relation", F.round("strength", 6).alias("score"), "compared", "rank")


def p4_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pyspark.sql import functions as F

    from quern.llm.ranking import item_strengths

    return item_strengths(table(spark, sf_dir, "maxdiff_choices")).select("item", F.round("strength", 6).alias("score"), "compared")


def p6_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    from quern.llm.neighbours import neighbour_pairs

    return neighbour_pairs(table(spark, sf_dir, "embedding_cache"))


def p7_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    from quern.llm.tokenizer import encode_corpus

    return encode_corpus(table(spark, sf_dir, "documents"))


def p8_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    from quern.llm.contamination import contained_items

    return contained_items(table(spark, sf_dir, "documents"), table(spark, sf_dir, "eval_items"))


def p9_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    from quern.llm.mojibake import garbled_documents

    return garbled_documents(table(spark, sf_dir, "documents"))


def p9_restored(spark: SparkSession, sf_dir: str) -> DataFrame:
    from quern.llm.mojibake import restored_documents

    return restored_documents(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Query] = {f.__name__: f for f in (p1_found, p2_found, p2_classes, p2_normalized, p3_found, p3_candidates, p4_found, p4_strengths, p4_items, p6_found, p7_ids, p8_found, p9_found, p9_restored)}



def _q(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


# The look-alikes and invisible characters that the SQL knows; one place in each row is one shape.
S_LATIN = "ABCEHIJKMNOPSTXYZaceijhopsxyduvqw"
S_CYRILLIC = "АВСЕНІЈКМ ОРЅТХУ асеіјһорѕхуԁ  ԛԝ"
S_GREEK = "ΑΒ ΕΗΙ ΚΜΝΟΡ ΤΧΥΖα  ι  ορ    υν  "
S_UNSEEN = "\u00ad\u034f\u061c\u200b\u200c\u200d\u200e\u200f\u202a\u202b\u202c\u202d\u202e\u2060\u2061\u2062\u2063\u2064\ufe00\ufe0e\ufe0f\ufeff"


def _look_sql(x: str) -> str:
    """Skeleton of a text by one translation: width and look-alikes by tables, accents kept and composed."""
    import unicodedata

    latin = {c: a for row in (S_CYRILLIC, S_GREEK) for a, c in zip(S_LATIN, row) if c != " "}
    frm, to = ["\u2010", "\u2011", *latin], ["-", "-", *latin.values()]
    for code in range(0x80, 0xFFFF):
        char = chr(code)
        single = unicodedata.normalize("NFKC", char)
        if char not in frm and (unicodedata.decomposition(char).startswith("<") or char == "\u212a") and len(single) == 1 and single != char:
            frm, to = [*frm, char], [*to, latin.get(single, single)]
    out = f"translate({x}, {_q(S_UNSEEN)}, '')"
    for code in range(0x370, 0x530):  # Greek and Cyrillic letters with an accent, as letter and accent
        parts = unicodedata.normalize("NFD", chr(code))
        if len(parts) == 2 and parts[0] in latin:
            out = f"replace({out}, {_q(chr(code))}, {_q(parts)})"
    for ligature, plain in (("ﬀ", "ff"), ("ﬁ", "fi"), ("ﬂ", "fl")):
        out = f"replace({out}, '{ligature}', '{plain}')"
    return f"trim(regexp_replace(nfc_normalize(translate({out}, {_q(''.join(frm))}, {_q(''.join(to))})), '[ \t]+', ' ', 'g'), ' ' || chr(10) || chr(13))"


def _p2_sql() -> str:
    slug = "trim(regexp_replace(lower(regexp_replace(base_relation, '([a-z0-9])([A-Z])', '\\1_\\2', 'g')), '[^a-z0-9]+', '_', 'g'), '_')"
    ends = "' ' || chr(9) || chr(10) || chr(13) || chr(160) || chr(5760) || chr(8192) || chr(8193) || chr(8194) || chr(8195) || chr(8196) || chr(8197) || chr(8198) || chr(8199) || chr(8200) || chr(8201) || chr(8202) || chr(8239) || chr(8287) || chr(12288)"
    filled = lambda c: f"coalesce(trim({c}, {ends}), '') <> ''"
    return f"""WITH p AS (SELECT row_no, coalesce({slug}, '') AS base, {_look_sql('concept_1')} AS l1, {_look_sql('concept_2')} AS l2, trim(concept_1, {ends}) AS c1, trim(concept_2, {ends}) AS c2
             FROM concept_pairs WHERE {filled('concept_1')} AND {filled('concept_2')}),
        e AS (SELECT evidence_id, s.sentence_id AS id, {_look_sql('s.text')} AS look, trim(s.text, {ends}) AS t FROM (SELECT evidence_id, unnest(evidence_sentences) AS s FROM wiki_evidence) WHERE {filled('s.text')})
    SELECT 'concept_pairs' AS src, CAST(0 AS BIGINT) AS rec_id, a.row_no AS id_1, b.row_no AS id_2 FROM p a JOIN p b USING (base, l1, l2) WHERE a.row_no < b.row_no AND (a.c1 <> b.c1 OR a.c2 <> b.c2)
    UNION ALL SELECT DISTINCT 'wiki_evidence', a.evidence_id, a.id, b.id FROM e a JOIN e b USING (evidence_id, look) WHERE a.id < b.id AND a.t <> b.t"""


_P6_SQL = """WITH v AS (SELECT cache_key, model, list_transform(vector, lambda x: CAST(x AS DOUBLE)) AS v FROM embedding_cache
        WHERE cache_key IS NOT NULL AND model IS NOT NULL AND len(vector) = dimensions AND len(list_filter(vector, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0 AND len(list_filter(vector, lambda x: x <> 0)) > 0),
    near AS (SELECT a.cache_key AS a, b.cache_key AS b, list_cosine_similarity(a.v, b.v) AS c FROM v a JOIN v b ON a.model = b.model AND a.cache_key <> b.cache_key AND len(a.v) = len(b.v)),
    best AS (SELECT a, b FROM (SELECT a, b, row_number() OVER (PARTITION BY a ORDER BY round(c, 6) DESC, b) AS n FROM near WHERE c >= 0.82) WHERE n <= 5)
    SELECT DISTINCT least(a, b) AS key_1, greatest(a, b) AS key_2 FROM best"""

#: Queries whose result DuckDB can state; the others are tested against brute force, round trips or fixtures.
#: p6_found is approximate: the SQL compares all vectors, which small tables allow.
_P2 = _p2_sql()
_P2_CLASSES = f"SELECT src, rec_id, id, count(*) AS links FROM (SELECT src, rec_id, id_1 AS id FROM ({_P2}) UNION ALL SELECT src, rec_id, id_2 FROM ({_P2})) GROUP BY 1, 2, 3"
ORACLE_SQL: dict[str, str] = {"p2_found": _P2, "p2_classes": _P2_CLASSES, "p6_found": _P6_SQL}
