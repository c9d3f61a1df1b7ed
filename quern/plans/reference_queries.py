"""Queries of the relational operators over the domain tables, each with the SQL that states its result.

Tables hold repeated and dirty rows; where a record must be one for each pair, the last stored one counts, and where a
query needs fields that a table lacks (review decisions, page sources) they are derived from columns by a stated rule.
"""

from __future__ import annotations

import unicodedata
import uuid
from collections.abc import Callable
from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quern.config import MaxDiff, Questions
from quern.functions import text as X
from quern.functions import vectors as V
from quern.operators import evidence as ev
from quern.operators import maxdiff as md
from quern.operators import pairs as pr
from quern.operators import quality as ql
from quern.operators import questions as qs
from quern.operators import relations as rl
from quern.runtime import cut, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}

# --- SQL fragments, the DuckDB forms of quern.functions.text -----------------------------------------------------------
_WS = r"[\s\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}\x1C-\x1F]+"


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def s_norm(x: str) -> str:
    return f"trim(regexp_replace({x}, {_quoted(_WS)}, ' ', 'g'))"


def s_fold(x: str) -> str:
    out = f"lower({x})"
    for char in "ßςſﬀﬁﬂﬃﬄﬅﬆŉǰ":
        out = f"replace({out}, '{char}', '{char.casefold()}')"
    return out


def _plain(char: str) -> str:
    return "".join(c for c in unicodedata.normalize("NFKD", char) if not unicodedata.combining(c))


@lru_cache(maxsize=1)
def _plain_sql() -> tuple[str, str, str]:
    """Straight from the Unicode database: characters with a plain form of one character, those forms, and a map of the
    characters whose plain forms hold several characters with ASCII letters or digits."""
    forms = {chr(c): _plain(chr(c)) for c in range(0x80, 0x20000) if unicodedata.decomposition(chr(c)) and not unicodedata.combining(chr(c))}
    one = {c: p for c, p in forms.items() if len(p) == 1 and p != c}
    more = {c: p for c, p in forms.items() if len(p) > 1 and any("0" <= x <= "9" or "a" <= x.lower() <= "z" for x in p)}
    entries = ", ".join(f"{_quoted(c)}: {_quoted(p)}" for c, p in more.items())
    return _quoted("".join(one)), _quoted("".join(one.values())), f"MAP {{{entries}}}"


def s_slug(x: str, beyond_ascii: bool = False) -> str:
    split = f"regexp_replace({s_norm(x)}, '([a-z0-9])([A-Z])', '\\1_\\2', 'g')"
    if beyond_ascii:
        chars, plain, several = _plain_sql()
        wide = f"translate(array_to_string(list_transform(string_split({split}, ''), lambda ch: coalesce({several}[ch], ch)), ''), {chars}, {plain})"
        split = f"CASE WHEN regexp_matches({x}, '[^\\x00-\\x7F]') THEN regexp_replace({wide}, '\\p{{Mn}}+', '', 'g') ELSE {split} END"
    return f"trim(regexp_replace({s_fold(split)}, '[^a-z0-9]+', '_', 'g'), '_')"


def s_draw(seed: int, *parts: str) -> str:
    return f"sha1(concat_ws(chr(0), '{seed}', {', '.join(f'CAST({p} AS VARCHAR)' for p in parts)}))"


S_PAIRS = f"""pairs AS (
    SELECT row_no, CASE WHEN given <> '' THEN given ELSE 'pair_' || substr(sha1(concat_ws(chr(0), slug, {s_fold('c1')}, {s_fold('c2')})), 1, 12) END AS pair_id,
           slug AS base_relation, c1 AS concept_1, c2 AS concept_2
    FROM (SELECT *, row_number() OVER (PARTITION BY slug, {s_fold('c1')}, {s_fold('c2')} ORDER BY row_no) AS n
          FROM (SELECT row_no, coalesce({s_norm('pair_id')}, '') AS given, {s_slug('base_relation')} AS slug, {s_norm('concept_1')} AS c1, {s_norm('concept_2')} AS c2
                FROM concept_pairs
                WHERE coalesce({s_norm('base_relation')}, '') <> '' AND coalesce({s_norm('concept_1')}, '') <> '' AND coalesce({s_norm('concept_2')}, '') <> ''))
    WHERE n = 1)"""
S_ONE_PAIR = "one_pair AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY pair_id ORDER BY row_no) AS n FROM pairs) WHERE n = 1)"


def s_last(name: str, source: str, key: str) -> str:
    return f"{name} AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY pair_id ORDER BY {key} DESC) AS n FROM {source}) WHERE n = 1)"


def query(sql: str | None = None):
    """Register a query under its function's name."""

    def register(f: Callable[[SparkSession, str], DataFrame]):
        QUERIES[f.__name__] = f
        if sql is not None:
            ORACLE_SQL[f.__name__] = sql
        return f

    return register


def _pairs(spark: SparkSession, d: str) -> DataFrame:
    return pr.load_pairs(table(spark, d, "concept_pairs"), strict=False)


def _one_pair(spark: SparkSession, d: str) -> DataFrame:
    return pr.one_pair_per_id(_pairs(spark, d)).drop("row_no")


def _last(spark: SparkSession, d: str, name: str, key: str) -> DataFrame:
    return rl.latest_record(table(spark, d, name), key)


# --- pairs: loading, groups, resume ------------------------------------------------------------------------------------
@query(f"WITH {S_PAIRS} SELECT row_no, pair_id, base_relation, concept_1, concept_2 FROM pairs")
def pairs_load_dedupe(spark, d):
    return _pairs(spark, d)


@query(f"WITH {S_PAIRS} SELECT pair_id, count(*) AS n FROM pairs GROUP BY 1 HAVING count(*) > 1")
def repeated_pair_ids(spark, d):
    return pr.repeated_pair_ids(_pairs(spark, d))


@query(f"SELECT row_no, {s_slug('base_relation')} AS slug FROM concept_pairs")
def relation_slug(spark, d):
    return table(spark, d, "concept_pairs").select("row_no", X.relation_slug(F.col("base_relation")).alias("slug"))


@query(f"SELECT mined_id, CAST(pos AS INTEGER) AS pos, {s_slug('r.raw_predicate', True)} AS slug FROM (SELECT mined_id, unnest(relations) AS r, unnest(range(len(relations))) AS pos FROM raw_relations)")
def predicate_slug(spark, d):
    flat = table(spark, d, "raw_relations").select("mined_id", F.posexplode("relations").alias("pos", "r"))
    return flat.select("mined_id", "pos", X.relation_slug(F.col("r.raw_predicate")).alias("slug"))


@query(f"WITH {S_PAIRS} SELECT base_relation, count(*) AS pair_count, count(DISTINCT pair_id) AS distinct_ids FROM pairs GROUP BY 1")
def input_group_report(spark, d):
    return pr.group_report(_pairs(spark, d))


@query(f"WITH {S_PAIRS} SELECT base_relation, count(*) AS pair_count FROM pairs GROUP BY 1 HAVING count(*) < 21")
def undersized_groups(spark, d):
    return pr.undersized_groups(_pairs(spark, d), target_count=20)


@query(f"WITH {S_PAIRS} SELECT row_no, pair_id FROM pairs p WHERE NOT EXISTS (SELECT 1 FROM wiki_evidence e WHERE e.pair_id = p.pair_id)")
def resume_anti_join(spark, d):
    return pr.unfinished(_pairs(spark, d), table(spark, d, "wiki_evidence")).select("row_no", "pair_id")


@query("SELECT DISTINCT pair_id FROM relation_rankings WHERE pair_id IS NOT NULL")
def finished_ids(spark, d):
    from quern.sources.files import finished_ids as ids

    return ids(table(spark, d, "relation_rankings"))


@query(f"WITH {S_PAIRS} SELECT row_no, array_to_string(list_sort(list_distinct(list_filter([{s_fold('concept_1')}, {s_fold(chr(114)+'eplace(concept_1, ' + chr(39) + '_' + chr(39) + ', ' + chr(39) + ' ' + chr(39) + ')')}, {s_fold('trim(regexp_replace(concept_1, ' + _quoted(r'[ ]*[(][^)]*[)][ ]*') + ', ' + chr(39)*2 + ', ' + chr(39) + 'g' + chr(39) + '))')}, CASE WHEN concept_1 LIKE 'The %' THEN {s_fold('substr(concept_1, 5)')} END], lambda x: x IS NOT NULL AND x <> ''))), '|') AS aliases FROM pairs")
def alias_variants(spark, d):
    return _pairs(spark, d).select("row_no", F.array_join(F.array_sort(X.alias_variants(F.col("concept_1"))), "|").alias("aliases"))


# --- pages, sentences, evidence ----------------------------------------------------------------------------------------
_UNESCAPED = "replace(replace(replace(replace(replace(replace(text, '&nbsp;', chr(160)), '&quot;', '\"'), '&#39;', ''''), '&lt;', '<'), '&gt;', '>'), '&amp;', '&')"
S_CLEAN = s_norm(f"regexp_replace({_UNESCAPED}, '\\[[0-9]+\\]', '', 'g')")
S_SENTENCES = f"""sentences AS (
    SELECT doc_id AS page_id, page_title, CAST(pos - 1 AS INTEGER) AS sentence_pos, sentence FROM (
        SELECT doc_id, page_title, unnest(parts) AS sentence, unnest(range(1, len(parts) + 1)) AS pos FROM (
            SELECT doc_id, page_title, list_filter(list_transform(string_split(regexp_replace({S_CLEAN}, '([.!?])\\s+([A-Z0-9"''“‘(])', '\\1' || chr(1) || '\\2', 'g'), chr(1)), lambda s: {s_norm('s')}), lambda s: length(s) BETWEEN 25 AND 900) AS parts
            FROM documents WHERE text IS NOT NULL)))"""


@query(f"SELECT doc_id, md5({S_CLEAN}) AS cleaned, length({S_CLEAN}) AS n FROM documents WHERE text IS NOT NULL")
def page_clean(spark, d):
    cleaned = table(spark, d, "documents").where("text IS NOT NULL").select("doc_id", X.clean_wiki_text(F.col("text")).alias("c"))
    return cleaned.select("doc_id", F.md5(F.encode("c", "utf-8")).alias("cleaned"), F.length("c").cast("bigint").alias("n"))


@query(f"WITH {S_SENTENCES} SELECT page_id, sentence_pos, sentence FROM sentences")
def sentence_split(spark, d):
    return ev.page_sentences(table(spark, d, "documents"), "doc_id", "page_title", "text").select("page_id", "sentence_pos", "sentence")


@query(f"SELECT DISTINCT page_title, 'https://en.wikipedia.org/wiki/' || replace(url_encode(replace(page_title, ' ', '_')), '%2F', '/') AS url FROM documents  WHERE page_title IS NOT NULL")
def page_urls(spark, d):
    titles = table(spark, d, "documents").where("page_title IS NOT NULL").select("page_title").distinct()
    return titles.select("page_title", X.page_url(F.col("page_title")).alias("url"))


S_CANDIDATES = f"""titled AS (SELECT doc_id AS page_id, {s_fold(s_norm('page_title'))} AS folded FROM documents WHERE coalesce({s_norm('page_title')}, '') <> ''),
    candidates AS (SELECT pair_id, page_id, page_pos FROM (
        SELECT pair_id, page_id, row_number() OVER (PARTITION BY pair_id ORDER BY side, page_id) - 1 AS page_pos FROM (
            SELECT pair_id, page_id, min(side) AS side FROM (
                SELECT pair_id, 0 AS side, {s_fold('concept_1')} AS folded FROM one_pair UNION ALL SELECT pair_id, 1, {s_fold('concept_2')} FROM one_pair) JOIN titled USING (folded)
            GROUP BY 1, 2)) WHERE page_pos < 10)"""


def s_aliases(c: str) -> str:
    bare = f"trim(regexp_replace({c}, '[ ]*[(][^)]*[)][ ]*', '', 'g'))"
    return f"list_filter([{s_fold(c)}, {s_fold(f'replace({c}, chr(95), chr(32))')}, {s_fold(bare)}, CASE WHEN {c} LIKE 'The %' THEN {s_fold(f'substr({c}, 5)')} END], lambda x: x IS NOT NULL AND x <> '')"


S_FOUND = f"""found AS (
    SELECT pair_id, page_pos, page_title, sentence_pos, sentence FROM candidates JOIN sentences USING (page_id)
    JOIN (SELECT pair_id, {s_aliases('concept_1')} AS a1, {s_aliases('concept_2')} AS a2 FROM one_pair) USING (pair_id)
    WHERE len(list_filter(a1, lambda x: contains({s_fold('sentence')}, x))) > 0 AND len(list_filter(a2, lambda x: contains({s_fold('sentence')}, x))) > 0)"""
S_EVIDENCE = f"""evidence AS (SELECT pair_id, row_number() OVER (PARTITION BY pair_id ORDER BY page_pos, sentence_pos) - 1 AS sentence_id, sentence AS text, page_title FROM (
    SELECT *, row_number() OVER (PARTITION BY pair_id, {s_fold('sentence')} ORDER BY page_pos, sentence_pos) AS n FROM found) WHERE n = 1)"""
S_WIKI = f"WITH {S_PAIRS}, {S_ONE_PAIR}, {S_SENTENCES}, {S_CANDIDATES}, {S_FOUND}, {S_EVIDENCE}"


def _pages(spark, d):
    return table(spark, d, "documents")


def _found(spark, d):
    pairs = _one_pair(spark, d)
    candidates = cut(ev.candidate_pages(pairs, _pages(spark, d), "doc_id", "page_title"))
    sentences = ev.page_sentences(ev.asked_pages(_pages(spark, d), candidates, "doc_id"), "doc_id", "page_title", "text")
    return pairs, ev.cooccurrences(pairs, candidates, sentences)


@query(f"WITH {S_PAIRS}, {S_ONE_PAIR}, {S_CANDIDATES} SELECT pair_id, page_id, page_pos FROM candidates")
def evidence_page_cap(spark, d):
    return ev.candidate_pages(_one_pair(spark, d), _pages(spark, d), "doc_id", "page_title").withColumn("page_pos", F.col("page_pos").cast("bigint"))


@query(f"{S_WIKI} SELECT pair_id, page_pos, sentence_pos, sentence FROM found")
def evidence_cooccurrence(spark, d):
    return _found(spark, d)[1].select("pair_id", F.col("page_pos").cast("bigint").alias("page_pos"), "sentence_pos", "sentence")


@query(f"{S_WIKI} SELECT pair_id, sentence_id, text, page_title FROM evidence")
def evidence_sentence_ids(spark, d):
    return ev.numbered_evidence(_found(spark, d)[1]).drop("page_url")


@query(f"{S_WIKI} SELECT p.pair_id, count(e.sentence_id) AS n, count(e.sentence_id) >= 5 AS passes_minimum FROM one_pair p LEFT JOIN evidence e USING (pair_id) GROUP BY 1")
def evidence_pass_minimum(spark, d):
    records = ev.retrieve(_one_pair(spark, d), _pages(spark, d), page_id="doc_id", title="page_title")
    return records.select("pair_id", F.size("evidence_sentences").cast("bigint").alias("n"), "passes_minimum")


@query("""SELECT evidence_id, sentence_id, line FROM (
    SELECT evidence_id, s.sentence_id AS sentence_id, '[' || CAST(s.sentence_id AS VARCHAR) || '] ' || s.text AS line,
           sum(length('[' || CAST(s.sentence_id AS VARCHAR) || '] ' || s.text)) OVER (PARTITION BY evidence_id ORDER BY s.sentence_id ROWS UNBOUNDED PRECEDING) AS total
    FROM (SELECT evidence_id, unnest(evidence_sentences) AS s FROM wiki_evidence) WHERE s.text IS NOT NULL) WHERE total <= 400""")
def prompt_budget(spark, d):
    flat = table(spark, d, "wiki_evidence").select("evidence_id", F.explode("evidence_sentences").alias("s")).select("evidence_id", "s.sentence_id", "s.text").where("text IS NOT NULL")
    return ev.prompt_context(flat, "sentence_id", "text", limit=400, key="evidence_id")


@query("""SELECT evidence_id, count(*) AS lines, sum(length(line)) AS chars FROM (
    SELECT evidence_id, line, sum(length(line)) OVER (PARTITION BY evidence_id ORDER BY sentence_id ROWS UNBOUNDED PRECEDING) AS total FROM (
        SELECT evidence_id, s.sentence_id AS sentence_id, '[' || CAST(s.sentence_id AS VARCHAR) || '] ' || s.text AS line FROM (SELECT evidence_id, unnest(evidence_sentences) AS s FROM wiki_evidence) WHERE s.text IS NOT NULL))
    WHERE total <= 24000 GROUP BY 1""")
def prompt_budget_default(spark, d):
    flat = table(spark, d, "wiki_evidence").select("evidence_id", F.explode("evidence_sentences").alias("s")).select("evidence_id", "s.sentence_id", "s.text").where("text IS NOT NULL")
    lines = ev.prompt_context(flat, "sentence_id", "text", key="evidence_id")
    return lines.groupBy("evidence_id").agg(F.count(F.lit(1)).alias("lines"), F.sum(F.length("line")).cast("decimal(38,0)").alias("chars"))


@query("SELECT evidence_id FROM wiki_evidence WHERE coalesce(passes_minimum, false)")
def evidence_gate(spark, d):
    return ev.usable(table(spark, d, "wiki_evidence")).select("evidence_id")


# --- relations: aliases, mining, review, finalising --------------------------------------------------------------------
S_ALIASES = f"""aliases AS (SELECT variant, max_by(canonical, relation_id) AS canonical FROM (
    SELECT relation_id, {s_slug('v', True)} AS variant, relation AS canonical FROM (SELECT relation_id, relation, unnest(list_concat([relation, label], aliases)) AS v FROM relation_vocab)) GROUP BY 1)"""


def _aliases(spark, d):
    flat = table(spark, d, "relation_vocab").select("relation_id", "relation", F.explode(F.concat(F.array("relation", "label"), "aliases")).alias("v"))
    return flat.select("relation_id", X.relation_slug(F.col("v")).alias("variant"), F.col("relation").alias("canonical")).groupBy("variant").agg(F.max_by("canonical", "relation_id").alias("canonical"))


S_TYPED = "typed AS (SELECT mined_id, pair_id, CAST(pos AS INTEGER) AS pos, r.raw_predicate AS raw_predicate, r.evidence_sentence_ids AS ids FROM (SELECT mined_id, pair_id, unnest(relations) AS r, unnest(range(len(relations))) AS pos FROM raw_relations))"


@query(f"WITH {S_ALIASES}, {S_TYPED} SELECT mined_id, pos, coalesce(canonical, slug) AS normalized FROM (SELECT mined_id, pos, {s_slug('raw_predicate', True)} AS slug FROM typed WHERE raw_predicate IS NOT NULL) LEFT JOIN aliases ON variant = slug")
def alias_normalize(spark, d):
    flat = table(spark, d, "raw_relations").select("mined_id", F.posexplode("relations").alias("pos", "r")).select("mined_id", "pos", F.col("r.raw_predicate").alias("raw")).where("raw IS NOT NULL")
    return rl.normalized(flat, "raw", _aliases(spark, d)).select("mined_id", "pos", "normalized")


S_LAST_EVIDENCE = s_last("last_evidence", "wiki_evidence", "evidence_id")


@query(f"""WITH {S_LAST_EVIDENCE}, {S_TYPED} SELECT mined_id, pos, array_to_string(list_sort(list_distinct(list_filter(coalesce(ids, []), lambda x: list_contains(coalesce(known, []), x)))), ',') AS ids
    FROM typed LEFT JOIN (SELECT pair_id, list_transform(evidence_sentences, lambda s: s.sentence_id) AS known FROM last_evidence) USING (pair_id)""")
def evidence_id_validate(spark, d):
    known = _last(spark, d, "wiki_evidence", "evidence_id").select("pair_id", F.transform("evidence_sentences", lambda s: s["sentence_id"]).alias("known"))
    flat = table(spark, d, "raw_relations").select("mined_id", "pair_id", F.posexplode("relations").alias("pos", "r")).join(known, "pair_id", "left")
    ids = rl.valid_ids(F.col("r.evidence_sentence_ids"), F.col("known"))
    return flat.select("mined_id", "pos", F.array_join(F.transform(ids, lambda i: i.cast("string")), ",").alias("ids"))


def _mined(spark, d):
    replies = _last(spark, d, "raw_relations", "mined_id").select("pair_id", F.transform("relations", lambda r: F.struct(r["raw_predicate"].alias("predicate"), r["evidence_sentence_ids"].alias("evidence_sentence_ids"), r["evidence_quote"].alias("evidence_quote"), r["explanation"].alias("explanation"))).alias("relations"), "error")
    return rl.mine(_one_pair(spark, d), _last(spark, d, "wiki_evidence", "evidence_id"), replies, _aliases(spark, d))


S_MINED = f"""WITH {S_PAIRS}, {S_ONE_PAIR}, {S_ALIASES}, {S_LAST_EVIDENCE}, {s_last('last_reply', 'raw_relations', 'mined_id')},
    gated AS (SELECT p.pair_id, p.base_relation, e.pair_id AS has, coalesce(e.passes_minimum, false) AS passes, coalesce(len(e.evidence_sentences), 0) AS n, r.relations AS reply, r.error AS reply_error
              FROM one_pair p LEFT JOIN last_evidence e USING (pair_id) LEFT JOIN last_reply r ON r.pair_id = p.pair_id),
    judged AS (SELECT *, CASE WHEN has IS NULL THEN 'the pair has no evidence record' WHEN NOT passes THEN CAST(n AS VARCHAR) || ' evidence sentences of 5 required' ELSE reply_error END AS error FROM gated),
    extracted AS (SELECT pair_id, coalesce(canonical, slug) AS normalized FROM (SELECT pair_id, {s_slug('r.raw_predicate', True)} AS slug FROM (SELECT pair_id, unnest(reply) AS r FROM judged WHERE error IS NULL)) LEFT JOIN aliases ON variant = slug WHERE coalesce(canonical, slug) <> ''),
    injected AS (SELECT pair_id, coalesce(canonical, base_relation) AS normalized FROM judged LEFT JOIN aliases ON variant = base_relation WHERE error IS NULL)"""


@query(f"""{S_MINED} SELECT j.pair_id, j.error, (SELECT count(*) FROM extracted x WHERE x.pair_id = j.pair_id) AS n_extracted,
    (SELECT count(*) FROM injected i WHERE i.pair_id = j.pair_id AND NOT EXISTS (SELECT 1 FROM extracted x WHERE x.pair_id = i.pair_id AND x.normalized = i.normalized)) AS n_injected FROM judged j""")
def mine_relations(spark, d):
    stated = lambda r: r["source"] == "input_base_relation"
    return _mined(spark, d).select("pair_id", "error", F.size(F.filter("relations", lambda r: ~stated(r))).cast("bigint").alias("n_extracted"), F.size(F.filter("relations", stated)).cast("bigint").alias("n_injected"))


@query(f"{S_MINED} SELECT pair_id, normalized FROM injected i WHERE NOT EXISTS (SELECT 1 FROM extracted x WHERE x.pair_id = i.pair_id AND x.normalized = i.normalized)")
def base_relation_inject(spark, d):
    flat = _mined(spark, d).select("pair_id", F.explode("relations").alias("r")).where("r.source = 'input_base_relation'")
    return flat.select("pair_id", F.col("r.normalized_predicate").alias("normalized"))


# The word lists of the review rules, stated once more for the SQL.
S_AMBIGUOUS = "['related_to', 'associated_with', 'connected_to', 'linked_to', 'represents', 'influences', 'leads', 'has_connection_with']"
S_OPINION = "['best', 'better', 'beautiful', 'important', 'greatest', 'favourite', 'favorite', 'prestigious', 'superior', 'inferior']"
S_TRANSIENT = "['current', 'currently', 'recent', 'recently', 'now', 'incumbent', 'ongoing', 'temporary', 'latest']"
S_REVIEW = f"""WITH {S_LAST_EVIDENCE},
    flat AS (SELECT mined_id, pair_id, CAST(pos AS INTEGER) AS pos, r.raw_predicate AS raw_predicate, r.normalized_predicate AS p, coalesce(r.evidence_sentence_ids, []) AS ids, r.source AS source
             FROM (SELECT mined_id, pair_id, unnest(relations) AS r, unnest(range(len(relations))) AS pos FROM raw_relations)),
    seen AS (SELECT *, row_number() OVER (PARTITION BY mined_id, p ORDER BY pos) > 1 AS dup FROM flat),
    judged AS (SELECT *, CASE WHEN source = 'input_base_relation' THEN 'accept|base_relation' WHEN coalesce(length(p), 0) < 2 THEN 'reject|malformed' WHEN dup THEN 'reject|duplicate'
        WHEN list_contains({S_AMBIGUOUS}, p) THEN 'review|ambiguous' WHEN list_has_any(string_split(p, '_'), {S_OPINION}) THEN 'reject|opinion_based'
        WHEN list_has_any(string_split(p, '_'), {S_TRANSIENT}) THEN 'reject|transient' WHEN len(ids) = 0 THEN 'review|unsupported' ELSE 'accept|valid' END AS verdict FROM seen)"""


def _review(spark, d):
    evidence = _last(spark, d, "wiki_evidence", "evidence_id")
    return rl.review_rows(table(spark, d, "raw_relations"), evidence, record="mined_id")


@query(f"{S_REVIEW} SELECT mined_id, pos, split_part(verdict, '|', 1) AS suggested_decision, split_part(verdict, '|', 2) AS suggested_category FROM judged")
def review_suggest(spark, d):
    return _review(spark, d).select("mined_id", "pos", "suggested_decision", "suggested_category")


@query(f"{S_REVIEW} SELECT mined_id, pos, p AS normalized_predicate FROM judged WHERE verdict = 'reject|duplicate'")
def review_duplicates(spark, d):
    return _review(spark, d).where("suggested_category = 'duplicate'").select("mined_id", "pos", "normalized_predicate")


@query(f"""{S_REVIEW}, texts AS (SELECT pair_id, s.sentence_id AS id, s.text AS text FROM (SELECT pair_id, unnest(evidence_sentences) AS s FROM last_evidence)),
    each AS (SELECT mined_id, pos, pair_id, unnest(ids) AS id, unnest(range(len(ids))) AS k FROM flat),
    shown AS (SELECT mined_id, pos, string_agg(coalesce(text, '[missing sentence ' || CAST(each.id AS VARCHAR) || ']'), ' || ' ORDER BY k) AS evidence_text FROM each LEFT JOIN texts ON texts.pair_id = each.pair_id AND texts.id = each.id GROUP BY 1, 2)
    SELECT f.mined_id, f.pos, array_to_string(ids, ',') AS evidence_sentence_ids, coalesce(evidence_text, '') AS evidence_text FROM flat f LEFT JOIN shown s ON s.mined_id = f.mined_id AND s.pos = f.pos""")
def review_evidence_text(spark, d):
    return _review(spark, d).select("mined_id", "pos", "evidence_sentence_ids", "evidence_text")


# a reviewer's decision is derived: every third row is left to the suggestion, the rest is accepted unless the id list is empty
S_DECIDED = f"""{S_REVIEW}, decided AS (SELECT mined_id, pair_id, pos, p, ids, source, split_part(verdict, '|', 1) AS suggested,
        CASE WHEN (mined_id + pos) % 3 = 0 THEN '' WHEN len(ids) = 0 THEN 'Reject ' ELSE ' ACCEPT' END AS typed FROM judged),
    resolved AS (SELECT *, CASE WHEN trim(lower(typed)) = '' THEN suggested ELSE trim(lower(typed)) END AS decision FROM decided)"""


def _decided(spark, d):
    typed = F.when((F.col("mined_id") + F.col("pos")) % 3 == 0, "").when(F.col("evidence_sentence_ids") == "", "Reject ").otherwise(" ACCEPT")
    return _review(spark, d).withColumn("final_decision", typed)


@query(f"{S_DECIDED} SELECT mined_id, pos FROM resolved WHERE decision NOT IN ('accept', 'reject')")
def review_unresolved(spark, d):
    return rl.unresolved(_decided(spark, d), use_suggestions=True).select("mined_id", "pos")


@query(f"""{S_DECIDED} SELECT pair_id, relation, array_to_string(ids, ',') AS ids, source FROM (
    SELECT *, row_number() OVER (PARTITION BY pair_id, relation ORDER BY mined_id, pos) AS n FROM (
        SELECT pair_id, mined_id, pos, ids, coalesce(nullif(source, ''), 'reviewed') AS source, {s_slug('p', True)} AS relation FROM resolved WHERE decision = 'accept' AND pair_id IS NOT NULL)) WHERE n = 1""")
def finalize_canonical(spark, d):
    final = rl.finalize(_decided(spark, d), ["mined_id", "pos"], use_suggestions=True)
    flat = final.where("pair_id IS NOT NULL").select("pair_id", F.explode("relations").alias("r"))
    return flat.select("pair_id", "r.relation", F.array_join(F.transform("r.evidence_sentence_ids", lambda i: i.cast("string")), ",").alias("ids"), "r.source")


@query("SELECT event_id, coalesce(array_to_string(list_transform(list_filter(string_split(props, ':'), lambda x: regexp_matches(trim(x, ' }'), '^[0-9]+$')), lambda x: trim(x, ' }')), ','), '') AS ids FROM events")
def parse_id_list(spark, d):
    listed = F.replace(F.replace("props", F.lit(":"), F.lit(",")), F.lit("}"), F.lit(" "))
    return table(spark, d, "events").select("event_id", F.array_join(F.transform(X.parse_id_list(listed), lambda i: i.cast("string")), ",").alias("ids"))


@query("SELECT canon_id, CAST(pos AS INTEGER) AS pos, coalesce(nullif(r.source, ''), 'reviewed') AS source, nullif(r.notes, '') AS notes FROM (SELECT canon_id, unnest(relations) AS r, unnest(range(len(relations))) AS pos FROM canonical_relations)")
def blank_coalesce(spark, d):
    flat = table(spark, d, "canonical_relations").select("canon_id", F.posexplode("relations").alias("pos", "r"))
    return flat.select("canon_id", "pos", F.coalesce(F.nullif(F.col("r.source"), F.lit("")), F.lit("reviewed")).alias("source"), F.nullif(F.col("r.notes"), F.lit("")).alias("notes"))


def s_search(limit: int) -> str:
    return f"WITH {S_PAIRS}, titled AS (SELECT DISTINCT page_title AS title, {s_fold(s_norm('page_title'))} AS folded FROM documents WHERE page_title IS NOT NULL) SELECT row_no, title, place FROM (SELECT row_no, title, CAST(row_number() OVER (PARTITION BY row_no ORDER BY title) AS INTEGER) AS place FROM pairs JOIN titled ON folded = {s_fold('concept_1')}) WHERE place <= {limit}"


def _searched(spark, d, limit: int):
    from quern.sources.providers import search_titles as search

    pages = _pages(spark, d).where("page_title IS NOT NULL").select(F.col("page_title").alias("title"))
    asked = _pairs(spark, d).select(F.col("row_no").alias("query_id"), F.col("concept_1").alias("query"))
    return search(asked, pages, limit=limit).withColumnRenamed("query_id", "row_no")


@query(s_search(2))
def search_titles(spark, d):
    return _searched(spark, d, 2)


@query(s_search(8))
def search_titles_default(spark, d):
    return _searched(spark, d, 8)


@query("SELECT ranking_id, r.relation AS relation, round(CASE WHEN r.appearances > 0 THEN coalesce(r.most_count, 0) / r.appearances ELSE 0 END - CASE WHEN r.appearances > 0 THEN coalesce(r.least_count, 0) / r.appearances ELSE 0 END, 9) AS rate FROM (SELECT ranking_id, unnest(relations) AS r FROM relation_rankings) WHERE r IS NOT NULL")
def ranking_rates(spark, d):
    flat = table(spark, d, "relation_rankings").select("ranking_id", F.explode("relations").alias("r")).where("r IS NOT NULL").select("ranking_id", "r.*")
    rate = lambda c: F.when(F.col("appearances") > 0, F.coalesce(c, F.lit(0)) / F.col("appearances")).otherwise(0.0)
    return flat.select("ranking_id", "relation", F.round(rate("most_count") - rate("least_count"), 9).alias("rate"))


@query("SELECT canon_id FROM canonical_relations WHERE len(relations) <> len(list_distinct(list_transform(relations, lambda r: coalesce(r.relation, ''))))")
def repeated_labels(spark, d):
    labels = F.transform("relations", lambda r: F.coalesce(r["relation"], F.lit("")))
    return table(spark, d, "canonical_relations").where(F.size(labels) != F.size(F.array_distinct(labels))).select("canon_id")


@query(f"""WITH {S_PAIRS}, {S_ONE_PAIR}, texts AS (SELECT 'context' AS family, s.text AS text FROM (SELECT unnest(evidence_sentences) AS s FROM wiki_evidence WHERE coalesce(passes_minimum, false)) WHERE s.text IS NOT NULL
    UNION SELECT 'stem', concept_1 || ' : ' || concept_2 || ' | base relation: ' || base_relation FROM one_pair UNION SELECT 'pair', concept_1 || ' : ' || concept_2 FROM one_pair) SELECT family, count(*) AS n FROM texts GROUP BY 1""")
def embedding_texts(spark, d):
    pairs = _one_pair(spark, d)
    context = ev.usable(table(spark, d, "wiki_evidence")).select(F.explode("evidence_sentences").alias("s")).select(F.lit("context").alias("family"), F.col("s.text").alias("text")).where("text IS NOT NULL")
    stems = pairs.select(F.lit("stem").alias("family"), qs.stem_text(F.col("concept_1"), F.col("concept_2"), F.col("base_relation")).alias("text"))
    targets = pairs.select(F.lit("pair").alias("family"), qs.pair_text(F.col("concept_1"), F.col("concept_2")).alias("text"))
    return context.unionByName(stems).unionByName(targets).distinct().groupBy("family").agg(F.count(F.lit(1)).alias("n"))


# --- Max-Diff ----------------------------------------------------------------------------------------------------------
S_CHOICES = f"""last_choice AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY pair_id, block_id ORDER BY answered_at DESC, choice_id DESC) AS n FROM maxdiff_choices) WHERE n = 1),
    resolved AS (SELECT pair_id, block_id, relations,
        CASE WHEN list_contains(relations, most_relevant) THEN most_relevant ELSE list_filter(relations, lambda r: {s_slug('r')} = {s_slug('most_relevant')})[-1] END AS most,
        CASE WHEN list_contains(relations, least_relevant) THEN least_relevant ELSE list_filter(relations, lambda r: {s_slug('r')} = {s_slug('least_relevant')})[-1] END AS least FROM last_choice)"""
S_TALLY = """tally AS (SELECT pair_id, relation, CAST(count(*) AS INTEGER) AS appearances, CAST(sum(CASE WHEN most = relation THEN 1 ELSE 0 END) AS INTEGER) AS most_count, CAST(sum(CASE WHEN least = relation THEN 1 ELSE 0 END) AS INTEGER) AS least_count
    FROM (SELECT pair_id, most, least, unnest(relations) AS relation FROM resolved WHERE most IS NOT NULL AND least IS NOT NULL AND most <> least) GROUP BY 1, 2)"""


def _resolved(spark, d):
    from pyspark.sql.window import Window

    last = Window.partitionBy("pair_id", "block_id").orderBy(F.col("answered_at").desc(), F.col("choice_id").desc())
    latest = table(spark, d, "maxdiff_choices").withColumn("n", F.row_number().over(last)).where("n = 1")
    return latest.select("pair_id", "block_id", "relations", md.resolved_choice(F.col("most_relevant"), F.col("relations")).alias("most"), md.resolved_choice(F.col("least_relevant"), F.col("relations")).alias("least"))


@query(f"WITH {S_CHOICES} SELECT pair_id, block_id, most, least FROM resolved")
def resolve_choice(spark, d):
    return _resolved(spark, d).select("pair_id", "block_id", "most", "least")


def _tally(spark, d):
    return md.tallies(_resolved(spark, d).where("most IS NOT NULL AND least IS NOT NULL AND most <> least"), ["pair_id"])


@query(f"WITH {S_CHOICES}, {S_TALLY} SELECT pair_id, relation, appearances, most_count, least_count, round(most_count / appearances - least_count / appearances + 1.1, 9) AS score FROM tally")
def maxdiff_tally(spark, d):
    return _tally(spark, d).select("pair_id", "relation", "appearances", "most_count", "least_count", F.round("score", 9).alias("score"))


@query(f"WITH {S_CHOICES}, {S_TALLY} SELECT pair_id, relation, CAST(row_number() OVER (PARTITION BY pair_id ORDER BY round(most_count / appearances - least_count / appearances + 1.1, 9) DESC, relation) AS INTEGER) AS rank FROM tally")
def maxdiff_rank(spark, d):
    return md.ranked(_tally(spark, d), ["pair_id"]).select("pair_id", "relation", "rank")


@query(f"""WITH {S_CHOICES}, judged AS (SELECT pair_id, relations, CASE WHEN len(relations) = 1 THEN relations[1] ELSE most END AS most, CASE WHEN len(relations) = 1 THEN NULL ELSE least END AS least,
        len(relations) = 1 OR (most IS NOT NULL AND least IS NOT NULL AND most <> least) AS good FROM resolved WHERE pair_id IS NOT NULL AND block_id IS NOT NULL),
    whole AS (SELECT pair_id, bool_and(coalesce(good, false)) AS good FROM judged GROUP BY 1),
    counted AS (SELECT pair_id, relation, count(*) AS n, count(*) FILTER (WHERE most = relation) AS m, count(*) FILTER (WHERE least = relation) AS l FROM (SELECT pair_id, most, least, unnest(relations) AS relation FROM judged) GROUP BY 1, 2)
    SELECT w.pair_id, c.relation, CAST(row_number() OVER (PARTITION BY w.pair_id ORDER BY round(m / n - l / n + 1.1, 9) DESC, c.relation NULLS FIRST) AS INTEGER) AS rank, round(m / n - l / n + 1.1, 9) AS score, CAST(NULL AS VARCHAR) AS error FROM whole w JOIN counted c USING (pair_id) WHERE good
    UNION ALL SELECT pair_id, NULL, NULL, NULL, 'ValueError: a choice is missing, outside its block, or both choices are the same' FROM whole WHERE NOT good""")
def maxdiff_rank_pairs(spark, d):
    """Ranking records from the stored blocks and answers: one bad answer and the pair has an error in place of a ranking."""
    from pyspark.sql.window import Window

    last = Window.partitionBy("pair_id", "block_id").orderBy(F.col("answered_at").desc(), F.col("choice_id").desc())
    latest = table(spark, d, "maxdiff_choices").where("pair_id IS NOT NULL AND block_id IS NOT NULL").withColumn("n", F.row_number().over(last)).where("n = 1")
    labels = latest.groupBy("pair_id").agg(F.array_distinct(F.flatten(F.collect_list("relations"))).alias("relations"))
    canonical = labels.select("pair_id", *(F.lit(None).cast("string").alias(c) for c in ("base_relation", "concept_1", "concept_2")), "relations")
    out = md.rank_pairs(canonical, latest.select("pair_id", "block_id", "relations"), latest, MaxDiff())
    flat = out.select("pair_id", "error", F.explode_outer("relations").alias("r"))
    return flat.select("pair_id", "r.relation", "r.rank", F.round("r.score", 9).alias("score"), "error")


@query("""SELECT a AS relation_1, b AS relation_2, count(*) AS n FROM (
    SELECT choice_id, a, unnest(items) AS b FROM (SELECT choice_id, items, unnest(items) AS a FROM (SELECT choice_id, list_distinct(list_filter(relations, lambda r: r IS NOT NULL)) AS items FROM maxdiff_choices))) WHERE a < b GROUP BY 1, 2""")
def maxdiff_cooccurrence(spark, d):
    return md.block_cooccurrence(table(spark, d, "maxdiff_choices"), ["choice_id"])


@query("SELECT canon_id, relations[1].relation AS relation, 1.0 + 1.1 AS score FROM canonical_relations WHERE len(relations) = 1")
def single_relation_rank(spark, d):
    canonical = table(spark, d, "canonical_relations").where("size(relations) = 1").withColumn("pair_id", F.col("canon_id").cast("string"))
    blocks = canonical.select("pair_id", F.lit(0).cast("bigint").alias("block_id"), F.transform("relations", lambda r: r["relation"]).alias("relations"))
    choices = blocks.select("pair_id", "block_id", *(F.lit(None).cast("string").alias(c) for c in ("most_relevant", "least_relevant", "rationale")))
    out = md.rank_pairs(canonical, blocks, choices, MaxDiff())
    one = F.element_at("relations", 1)
    return out.select(F.col("pair_id").cast("bigint").alias("canon_id"), one["relation"].alias("relation"), one["score"].cast("decimal(3,1)").alias("score"))


@query()
def balanced_blocks(spark, d):
    canonical = _last(spark, d, "canonical_relations", "canon_id").where("pair_id IS NOT NULL")
    return md.design(canonical)


# --- vectors -----------------------------------------------------------------------------------------------------------
S_VEC = "vec AS (SELECT vec_id, label, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS v FROM embeddings)"
s_cos = lambda a, b: f"CASE WHEN sqrt(list_dot_product({a}, {a})) * sqrt(list_dot_product({b}, {b})) = 0 THEN 0.0 ELSE list_dot_product({a}, {b}) / (sqrt(list_dot_product({a}, {a})) * sqrt(list_dot_product({b}, {b}))) END"


@query(f"WITH {S_VEC} SELECT a.vec_id AS vec_id, round({s_cos('a.v', 'b.v')}, 9) AS similarity FROM vec a JOIN vec b ON b.vec_id = a.vec_id + 1")
def vector_cosine(spark, d):
    e = table(spark, d, "embeddings").select("vec_id", F.col("embedding").alias("v"))
    following = e.select((F.col("vec_id") - 1).alias("vec_id"), F.col("v").alias("w"))
    return e.join(following, "vec_id").select("vec_id", F.round(V.cosine(F.col("v"), F.col("w")), 9).alias("similarity"))


@query(f"""WITH z AS (SELECT cache_key, list_transform(vector, lambda x: CAST(x AS DOUBLE)) AS v FROM embedding_cache WHERE len(vector) = dimensions AND len(list_filter(vector, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0)
    SELECT cache_key, round({s_cos('v', 'v')}, 9) AS self_similarity FROM z""")
def vector_zero_guard(spark, d):
    finite = "size(vector) = dimensions AND NOT exists(vector, x -> x IS NULL OR isnan(x) OR x = float('Infinity') OR x = float('-Infinity'))"
    return table(spark, d, "embedding_cache").where(finite).select("cache_key", F.round(V.cosine(F.col("vector"), F.col("vector")), 9).alias("self_similarity"))


@query(f"""WITH {S_PAIRS}, {S_ONE_PAIR}, asked AS (SELECT pair_id, concept_1 || ' : ' || concept_2 AS pair_text, concept_1 || ' : ' || concept_2 || ' | base relation: ' || base_relation AS stem_text FROM one_pair)
    SELECT pair_id, md5(pair_text) AS pair_text, md5(stem_text) AS stem_text FROM asked""")
def prototype_texts(spark, d):
    p = _one_pair(spark, d)
    both = p.select("pair_id", qs.pair_text(F.col("concept_1"), F.col("concept_2")).alias("a"), qs.stem_text(F.col("concept_1"), F.col("concept_2"), F.col("base_relation")).alias("b"))
    return both.select("pair_id", F.md5(F.encode("a", "utf-8")).alias("pair_text"), F.md5(F.encode("b", "utf-8")).alias("stem_text"))


@query(f"""WITH {S_VEC}, q AS (SELECT label, min(vec_id) AS stem FROM vec GROUP BY 1)
    SELECT t.label AS label, t.vec_id AS vec_id, round({s_cos('s.v', 't.v')}, 9) AS prototypicality FROM q JOIN vec s ON s.vec_id = q.stem JOIN vec t ON t.label = q.label AND t.vec_id <> q.stem""")
def prototypicality(spark, d):
    e = table(spark, d, "embeddings").select("label", "vec_id", F.col("embedding").alias("v"))
    stems = e.groupBy("label").agg(F.min_by("v", "vec_id").alias("s"), F.min("vec_id").alias("stem"))
    met = e.join(stems, "label").where("vec_id <> stem")
    return met.select("label", "vec_id", F.round(V.cosine(F.col("s"), F.col("v")), 9).alias("prototypicality"))


# --- questions ---------------------------------------------------------------------------------------------------------
S_LAST_RANKING = "last_ranking AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY pair_id ORDER BY ranking_id DESC) AS n FROM relation_rankings WHERE len(relations) > 0 AND coalesce(error, '') = '') WHERE n = 1)"
S_SCORES = "scores AS (SELECT pair_id, relation, max_by(score, pos) AS score FROM (SELECT pair_id, r.relation AS relation, r.score AS score, pos FROM (SELECT pair_id, unnest(relations) AS r, unnest(range(len(relations))) AS pos FROM last_ranking)) WHERE relation IS NOT NULL GROUP BY 1, 2)"
S_ELIGIBLE = f"""WITH {S_PAIRS}, {S_ONE_PAIR}, {S_LAST_EVIDENCE}, {S_LAST_RANKING}, {S_SCORES},
    kept AS (SELECT p.* FROM one_pair p JOIN last_ranking USING (pair_id) JOIN last_evidence e USING (pair_id) WHERE coalesce(e.passes_minimum, false)),
    eligible AS (SELECT pair_id, base_relation, concept_1, concept_2 FROM (SELECT *, count(*) OVER (PARTITION BY base_relation) AS size FROM kept) WHERE size >= 3)"""
S_POOL = """pool AS (SELECT DISTINCT a.pair_id AS stem_id, b.pair_id AS target_id FROM eligible a JOIN scores s ON s.pair_id = a.pair_id JOIN scores t ON t.relation = s.relation JOIN eligible b ON b.pair_id = t.pair_id AND b.base_relation = a.base_relation WHERE a.pair_id <> b.pair_id)"""
#: The tables hold few pairs of a group with usable rankings: two targets are asked for.
ASKED = Questions(target_count=2)


def _rankings(spark, d):
    return rl.latest_record(qs.usable_rankings(table(spark, d, "relation_rankings")), "ranking_id")


def _eligible(spark, d, settings=ASKED):
    return qs.eligible_pairs(_one_pair(spark, d), _rankings(spark, d), _last(spark, d, "wiki_evidence", "evidence_id"), settings)


@query(f"{S_ELIGIBLE} SELECT pair_id, base_relation FROM eligible")
def eligible_pairs(spark, d):
    return _eligible(spark, d).select("pair_id", "base_relation")


@query(f"{S_ELIGIBLE} SELECT base_relation, count(*) AS n FROM kept GROUP BY 1 HAVING count(*) >= 3")
def eligible_groups(spark, d):
    return _eligible(spark, d).groupBy("base_relation").agg(F.count(F.lit(1)).alias("n"))


@query(f"{S_ELIGIBLE.replace('size >= 3', 'size >= 5')} SELECT pair_id, base_relation FROM eligible")
def eligible_pairs_default(spark, d):
    return _eligible(spark, d, Questions()).select("pair_id", "base_relation")


@query(f"{S_ELIGIBLE}, {S_POOL} SELECT stem_id, target_id FROM pool")
def target_pool(spark, d):
    return qs.target_pools(_eligible(spark, d))


@query(f"{S_ELIGIBLE}, {S_POOL} SELECT stem_id, target_id, coalesce(round(sum(s.score * t.score), 9), 0.0) AS overlap FROM pool JOIN scores s ON s.pair_id = stem_id LEFT JOIN scores t ON t.pair_id = target_id AND t.relation = s.relation GROUP BY 1, 2")
def relational_overlap(spark, d):
    eligible = _eligible(spark, d)
    scored = qs.relation_overlaps(qs.target_pools(eligible), eligible)
    return scored.select("stem_id", "target_id", F.round(qs.MEASURES[0], 9).alias("overlap"))


@query(f"{S_ELIGIBLE} SELECT stem_id, copy, {s_draw(42, 'stem_id', 'copy')} AS place FROM (SELECT pair_id AS stem_id, CAST(unnest(range(2)) AS INTEGER) AS copy FROM eligible)")
def stem_schedule(spark, d):
    return qs.stem_schedule(_eligible(spark, d), Questions(target_count=2, questions_per_stem=2))


@query(f"{S_ELIGIBLE} SELECT stem_id, copy, place FROM (SELECT pair_id AS stem_id, 0 AS copy, {s_draw(42, 'pair_id', '0')} AS place FROM eligible) ORDER BY place, stem_id LIMIT 3")
def schedule_truncated(spark, d):
    return qs.stem_schedule(_eligible(spark, d), Questions(target_count=2, total_questions=3))


@query()
def schedule_extended(spark, d):
    """Three questions for each two stems: the rest are drawn with replacement."""
    eligible = _eligible(spark, d)
    return qs.stem_schedule(eligible, Questions(target_count=2, total_questions=eligible.count() * 3 // 2))


@query(f"{S_ELIGIBLE}, {S_POOL} SELECT pair_id FROM eligible e WHERE EXISTS (SELECT 1 FROM pool p WHERE p.stem_id = e.pair_id)")
def stems_with_overlap(spark, d):
    eligible = _eligible(spark, d)
    return eligible.join(qs.target_pools(eligible).withColumnRenamed("stem_id", "pair_id"), "pair_id", "left_semi").select("pair_id")


S_SAMPLE = f"""sampled AS (SELECT stem_id, slot, target_id FROM (
    SELECT stem_id, target_id, row_number() OVER (PARTITION BY stem_id ORDER BY {s_draw(42, 'stem_id', '0', 'target_id')}, target_id) - 1 AS slot, count(*) OVER (PARTITION BY stem_id) AS n FROM pool) WHERE slot < 2 AND n >= 2)"""
S_QUESTIONS = f"{S_ELIGIBLE}, {S_POOL}, {S_SAMPLE}"


def _sampled(spark, d, eligible):
    return qs.sampled_targets(qs.stem_schedule(eligible, ASKED), qs.target_pools(eligible), ASKED)


@query(f"{S_QUESTIONS} SELECT stem_id, slot, target_id FROM sampled")
def question_sample(spark, d):
    return _sampled(spark, d, _eligible(spark, d)).select("stem_id", F.col("slot").cast("bigint").alias("slot"), "target_id")


@query(f"{S_QUESTIONS} SELECT stem_id, 'q_' || substr(sha1(concat_ws(chr(0), stem_id, string_agg(target_id, chr(0) ORDER BY slot), '0')), 1, 14) AS question_id, string_agg(target_id, ',' ORDER BY slot) AS targets FROM sampled GROUP BY stem_id")
def question_build(spark, d):
    ids = qs.question_ids(_sampled(spark, d, _eligible(spark, d)))
    return ids.select("stem_id", "question_id", F.array_join("target_ids", ",").alias("targets"))


def s_words(x: str) -> str:
    return f"trim(regexp_replace({s_fold(x)}, '[ :_]+', ' ', 'g'))"


def _words(c):
    return F.trim(F.regexp_replace(X.casefold(c), "[ :_]+", " "))


def mentioned_vectors(pairs: DataFrame, cache: DataFrame, model: str = "concept-embed-b") -> DataFrame:
    """(pair_id, vectors): every usable cached vector of a model whose text names a concept of the pair in whole words.

    The caches of the tables hold concepts with relations, no evidence sentences. Texts meet concepts in an equi-join of the
    runs of their words, so that all vectors take part, however many there are.
    """
    usable = cache.where(F.col("model") == model).where("text_value IS NOT NULL AND size(vector) = dimensions AND NOT exists(vector, x -> x IS NULL OR isnan(x) OR x = float('Infinity') OR x = float('-Infinity'))")
    words = usable.select("cache_key", "vector", F.split(_words(F.col("text_value")), " ").alias("w"))
    runs = F.flatten(F.transform(F.sequence(F.lit(1), F.size("w")), lambda i: F.transform(F.sequence(F.lit(1), F.size("w") - i + 1), lambda n: F.array_join(F.slice(F.col("w"), i, n), " "))))
    named = pairs.select("pair_id", F.explode(F.array("concept_1", "concept_2")).alias("c")).select("pair_id", _words(F.col("c")).alias("run")).where("run <> ''")
    met = named.join(words.select("cache_key", F.explode(F.array_distinct(runs)).alias("run")), "run").select("pair_id", "cache_key").distinct()
    return met.join(usable.select("cache_key", "vector"), "cache_key").groupBy("pair_id").agg(F.collect_list("vector").alias("vectors"))


def _digest_vectors(texts: DataFrame) -> DataFrame:
    """(text_value, vector): a stand-in embedder of 32 numbers, the hex digits of a text's digest about their middle."""
    digits = F.expr("transform(sequence(1, 32), i -> instr('0123456789abcdef', substring(md5(encode(text_value, 'utf-8')), i, 1)) - 8.5D)")
    return texts.distinct().withColumn("vector", digits)


S_WHOLE = f"""{S_QUESTIONS},
    named AS (SELECT pair_id, {s_words('c')} AS run FROM (SELECT pair_id, unnest([concept_1, concept_2]) AS c FROM eligible)),
    cached AS (SELECT cache_key, ' ' || {s_words('text_value')} || ' ' AS words, list_transform(vector, lambda x: CAST(x AS DOUBLE)) AS v FROM embedding_cache WHERE model = 'concept-embed-b' AND text_value IS NOT NULL AND len(vector) = dimensions AND len(list_filter(vector, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0),
    ctx AS (SELECT pair_id, cache_key, any_value(v) AS v FROM named JOIN cached ON run <> '' AND contains(words, ' ' || run || ' ') GROUP BY 1, 2),
    texts AS (SELECT pair_id, md5(concept_1 || ' : ' || concept_2) AS p, md5(concept_1 || ' : ' || concept_2 || ' | base relation: ' || base_relation) AS s FROM eligible),
    digits AS (SELECT pair_id, list_transform(range(1, 33), lambda i: CAST(instr('0123456789abcdef', substr(p, i, 1)) - 8.5 AS DOUBLE)) AS p, list_transform(range(1, 33), lambda i: CAST(instr('0123456789abcdef', substr(s, i, 1)) - 8.5 AS DOUBLE)) AS s FROM texts),
    long AS (SELECT stem_id, slot, target_id, 'ranked_relational_overlap' AS measure, round(coalesce(sum(s.score * t.score), 0.0), 6) AS value FROM sampled JOIN scores s ON s.pair_id = stem_id LEFT JOIN scores t ON t.pair_id = target_id AND t.relation = s.relation GROUP BY 1, 2, 3
        UNION ALL SELECT stem_id, slot, target_id, 'context_embedding_similarity', round(coalesce(avg(c) FILTER (WHERE c > 0.05), 0.0), 6) FROM (SELECT stem_id, slot, target_id, CASE WHEN a.v IS NOT NULL AND b.v IS NOT NULL THEN {s_cos('a.v', 'b.v')} END AS c FROM sampled LEFT JOIN ctx a ON a.pair_id = stem_id LEFT JOIN ctx b ON b.pair_id = target_id) GROUP BY 1, 2, 3
        UNION ALL SELECT stem_id, slot, target_id, 'prototypicality', round({s_cos('a.s', 'b.p')}, 6) FROM sampled JOIN digits a ON a.pair_id = stem_id JOIN digits b ON b.pair_id = target_id),
    top AS (SELECT *, max(value) OVER (PARTITION BY stem_id, measure) AS best FROM long)"""


@query(f"{S_WHOLE} SELECT stem_id, slot, target_id, value AS similarity FROM long WHERE measure = 'context_embedding_similarity'")
def context_similarity(spark, d):
    """Mean cosine above the threshold between the context vectors of a stem and of each of its targets."""
    eligible = _eligible(spark, d)
    scored = qs.context_scores(_sampled(spark, d, eligible), mentioned_vectors(eligible, table(spark, d, "embedding_cache")), threshold=0.05)
    return scored.select("stem_id", F.col("slot").cast("bigint").alias("slot"), "target_id", F.round(qs.MEASURES[1], 6).alias("similarity"))


@query(f"{S_WHOLE} SELECT stem_id, measure, min(slot) AS answer, string_agg(CAST(slot AS VARCHAR), ',' ORDER BY slot) AS ties, min_by(target_id, slot) AS answer_pair_id, max(best) AS best FROM top WHERE abs(value - best) <= 1e-10 GROUP BY 1, 2")
def question_answers(spark, d):
    """All three measures; contexts from every usable vector that names a concept of the pair."""
    eligible = _eligible(spark, d)
    texts = lambda c: eligible.select(c.alias("text_value"))
    vectors = _digest_vectors(texts(qs.stem_text(F.col("concept_1"), F.col("concept_2"), F.col("base_relation"))).unionByName(texts(qs.pair_text(F.col("concept_1"), F.col("concept_2")))))
    scored = qs.relation_overlaps(_sampled(spark, d, eligible), eligible)
    scored = qs.context_scores(scored, mentioned_vectors(eligible, table(spark, d, "embedding_cache")), threshold=0.05)
    scored = qs.prototype_scores(scored, eligible, vectors)
    out = qs.answers(scored.withColumns({m: F.round(m, 6) for m in qs.MEASURES}))
    return out.select("stem_id", "measure", F.col("answer").cast("bigint").alias("answer"), F.array_join(F.transform("tied", lambda i: i.cast("string")), ",").alias("ties"), "answer_pair_id", F.array_max("values").alias("best"))


@query("""SELECT question_id, measure, CAST(min(i) AS INTEGER) AS answer, string_agg(CAST(i AS VARCHAR), ',' ORDER BY i) AS ties FROM (
    SELECT *, max(v) OVER (PARTITION BY question_id, measure) AS best FROM (
        SELECT question_id, measure, i, v FROM (SELECT question_id, measure, unnest(vals) AS v, unnest(range(len(vals))) AS i FROM (
            SELECT question_id, e.key AS measure, list_transform(e.value, lambda x: round(x, 1)) AS vals FROM (SELECT question_id, unnest(map_entries(scores)) AS e FROM analogy_questions))) WHERE v IS NOT NULL))
    WHERE abs(v - best) <= 1e-10 GROUP BY 1, 2""")
def argmax_ties(spark, d):
    flat = table(spark, d, "analogy_questions").select("question_id", F.explode("scores").alias("measure", "vals")).select("question_id", "measure", F.transform("vals", lambda x: F.round(x, 1)).alias("vals")).where("exists(vals, x -> x IS NOT NULL)")
    tied = flat.withColumn("tied", V.ties(F.col("vals")))
    return tied.select("question_id", "measure", F.element_at("tied", 1).alias("answer"), F.array_join(F.transform("tied", lambda i: i.cast("string")), ",").alias("ties"))


# --- embedding cache ---------------------------------------------------------------------------------------------------
@query("SELECT cache_key, sha256(concat_ws(chr(0), model, text_value)) AS key FROM embedding_cache WHERE text_value IS NOT NULL")
def embedding_cache_key(spark, d):
    return table(spark, d, "embedding_cache").where("text_value IS NOT NULL").select("cache_key", X.cache_key(F.col("model"), F.col("text_value")).alias("key"))


@query("""SELECT DISTINCT s.text AS text FROM (SELECT unnest(evidence_sentences) AS s FROM wiki_evidence WHERE coalesce(passes_minimum, false))
    WHERE s.text IS NOT NULL AND NOT EXISTS (SELECT 1 FROM embedding_cache c WHERE c.model = 'concept-embed-b' AND c.text_value = s.text)""")
def embedding_missing(spark, d):
    from quern.sources.embedding_cache import missing_texts

    texts = ev.usable(table(spark, d, "wiki_evidence")).select(F.explode("evidence_sentences").alias("s")).select(F.col("s.text").alias("text"))
    return missing_texts(texts, table(spark, d, "embedding_cache").withColumn("cache_key", X.cache_key(F.col("model"), F.col("text_value"))), "concept-embed-b")


@query("SELECT cache_key, dimensions, CAST(len(vector) AS INTEGER) AS stored FROM embedding_cache WHERE vector IS NULL OR len(vector) <> dimensions")
def embedding_corrupt(spark, d):
    from quern.sources.embedding_cache import corrupt

    return corrupt(table(spark, d, "embedding_cache"))


# --- quality and reports -----------------------------------------------------------------------------------------------
S_FAULTS = f"""WITH {S_PAIRS}, {S_ONE_PAIR},
    q AS (SELECT question_id, base_relation, stem.pair_id AS stem_id, list_transform(coalesce(targets, []), lambda t: t.pair_id) AS ids, scores, answers FROM analogy_questions),
    m AS (SELECT question_id, ids, answers, e.key AS measure, e.value AS vals FROM (SELECT question_id, ids, answers, unnest(map_entries(scores)) AS e FROM q)),
    t AS (SELECT question_id, base_relation, unnest(ids) AS target_id FROM q)"""


@query(f"""{S_FAULTS} SELECT question_id, 'target_count' AS rule, '' AS detail FROM q WHERE len(ids) <> 4
    UNION ALL SELECT question_id, 'duplicate_target', '' FROM q WHERE len(ids) <> len(list_distinct(ids))
    UNION ALL SELECT question_id, 'stem_among_targets', '' FROM q WHERE list_contains(ids, stem_id)
    UNION ALL SELECT question_id, 'score_length', measure FROM m WHERE coalesce(len(vals), -1) <> len(ids)
    UNION ALL SELECT question_id, 'invalid_answer', measure FROM m WHERE NOT coalesce(answers[measure] BETWEEN 0 AND len(ids) - 1, false)
    UNION ALL SELECT question_id, 'unknown_target', target_id FROM t LEFT JOIN one_pair p ON p.pair_id = t.target_id WHERE p.pair_id IS NULL
    UNION ALL SELECT question_id, 'target_relation', target_id FROM t JOIN one_pair p ON p.pair_id = t.target_id WHERE p.base_relation <> t.base_relation""")
def question_quality_errors(spark, d):
    return ql.question_errors(table(spark, d, "analogy_questions"), _one_pair(spark, d))


@query("SELECT avg(n) AS mean, median(n) AS median, min(n) AS minimum, max(n) AS maximum FROM (SELECT len(relations) AS n FROM relation_rankings WHERE len(relations) > 0 AND coalesce(error, '') = '')")
def stats_counts(spark, d):
    return ql.size_statistics(qs.usable_rankings(table(spark, d, "relation_rankings")).select(F.size("relations").alias("n")), "n")


@query("SELECT CASE n WHEN 1 THEN 'all_three_agree' WHEN 2 THEN 'two_agree' ELSE 'all_differ' END AS agreement, count(*) AS n FROM (SELECT len(list_distinct(map_values(answers))) AS n FROM analogy_questions) GROUP BY 1")
def agreement_histogram(spark, d):
    return ql.agreement(table(spark, d, "analogy_questions"))


@query("SELECT count(*) AS question_count, count(DISTINCT question_id) AS distinct_ids FROM analogy_questions")
def distinct_ids(spark, d):
    return table(spark, d, "analogy_questions").agg(F.count(F.lit(1)).alias("question_count"), F.countDistinct("question_id").alias("distinct_ids"))


@query("SELECT (SELECT count(*) FROM wiki_evidence WHERE NOT coalesce(passes_minimum, false)) AS failed_evidence, (SELECT count(*) FROM relation_rankings WHERE coalesce(len(relations), 0) = 0 OR coalesce(error, '') <> '') AS failed_rankings")
def failure_counts(spark, d):
    return ql.failure_counts(table(spark, d, "wiki_evidence"), table(spark, d, "relation_rankings"))


@query(f"""{S_FAULTS} SELECT DISTINCT question_id, 'duplicate_question_id' AS rule FROM q""")
def question_duplicate_ids(spark, d):
    """Every question stored twice: the second of each breaks the rule."""
    questions = table(spark, d, "analogy_questions")
    found = ql.question_errors(questions.unionAll(questions), _one_pair(spark, d))
    return found.where("rule = 'duplicate_question_id'").select("question_id", "rule")


S_SIZES = lambda xs: f"(SELECT struct_pack(mean := coalesce(avg(n), 0), median := coalesce(median(n), 0), low := coalesce(min(n), 0), high := coalesce(max(n), 0)) FROM ({xs}))"


@query(f"""{S_FAULTS}, faults AS (SELECT 'target_count' AS rule FROM q WHERE len(ids) <> 4
        UNION ALL SELECT 'duplicate_target' FROM q WHERE len(ids) <> len(list_distinct(ids))
        UNION ALL SELECT 'stem_among_targets' FROM q WHERE list_contains(ids, stem_id)
        UNION ALL SELECT 'score_length' FROM m WHERE coalesce(len(vals), -1) <> len(ids)
        UNION ALL SELECT 'invalid_answer' FROM m WHERE NOT coalesce(answers[measure] BETWEEN 0 AND len(ids) - 1, false)
        UNION ALL SELECT 'unknown_target' FROM t LEFT JOIN one_pair p ON p.pair_id = t.target_id WHERE p.pair_id IS NULL
        UNION ALL SELECT 'target_relation' FROM t JOIN one_pair p ON p.pair_id = t.target_id WHERE p.base_relation <> t.base_relation),
    sizes AS (SELECT {S_SIZES("SELECT len(relations) AS n FROM relation_rankings WHERE len(relations) > 0 AND coalesce(error, '') = ''")} AS r, {S_SIZES("SELECT coalesce(len(evidence_sentences), 0) AS n FROM wiki_evidence")} AS c)
    SELECT (SELECT count(*) FROM one_pair) AS pair_count, (SELECT count(*) FROM wiki_evidence) AS evidence_record_count, (SELECT count(*) FROM relation_rankings) AS ranking_record_count,
        (SELECT count(*) FROM analogy_questions) AS question_count, (SELECT count(DISTINCT question_id) FROM analogy_questions) AS distinct_question_ids,
        coalesce((SELECT string_agg(rule || '=' || CAST(n AS VARCHAR), ',' ORDER BY rule) FROM (SELECT rule, count(*) AS n FROM faults GROUP BY 1)), '') AS errors,
        round(r.mean, 6) AS relations_mean, r.median AS relations_median, CAST(r.low AS BIGINT) AS relations_minimum, CAST(r.high AS BIGINT) AS relations_maximum,
        round(c.mean, 6) AS sentences_mean, c.median AS sentences_median, CAST(c.low AS BIGINT) AS sentences_minimum, CAST(c.high AS BIGINT) AS sentences_maximum,
        (SELECT string_agg(k || '=' || CAST(n AS VARCHAR), ',' ORDER BY k) FROM (SELECT CASE n WHEN 1 THEN 'all_three_agree' WHEN 2 THEN 'two_agree' ELSE 'all_differ' END AS k, count(*) AS n FROM (SELECT len(list_distinct(map_values(answers))) AS n FROM analogy_questions) GROUP BY 1)) AS agreement,
        (SELECT count(*) FROM wiki_evidence WHERE NOT coalesce(passes_minimum, false)) AS failed_evidence, (SELECT count(*) FROM relation_rankings WHERE coalesce(len(relations), 0) = 0 OR coalesce(error, '') <> '') AS failed_rankings,
        CASE WHEN (SELECT count(*) FROM faults) = 0 THEN 'ok' ELSE 'failed' END AS status FROM sizes""")
def validation_report(spark, d):
    """The report with its maps as text, so that every number can be compared."""
    made = ql.report(_one_pair(spark, d), table(spark, d, "wiki_evidence"), table(spark, d, "relation_rankings"), table(spark, d, "analogy_questions"))
    listed = lambda c: F.array_join(F.transform(F.array_sort(F.map_entries(c)), lambda e: F.concat(e["key"], F.lit("="), e["value"].cast("string"))), ",")
    counts = ("pair_count", "evidence_record_count", "ranking_record_count", "question_count", "distinct_question_ids")
    sizes = [F.round(F.col(f"{c}.{f}"), 6).alias(f"{n}_{f}") if f == "mean" else F.col(f"{c}.{f}").alias(f"{n}_{f}") for c, n in (("relation_statistics", "relations"), ("context_sentence_statistics", "sentences")) for f in ("mean", "median", "minimum", "maximum")]
    return made.select(*counts, listed(F.col("errors")).alias("errors"), *sizes, listed(F.col("semantic_measure_agreement")).alias("agreement"), "failed_evidence", "failed_rankings", "status")


@query("SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events")
def jsonl_scan(spark, d):
    """The events as JSON lines in a folder beside the checkpoints, read back by the source."""
    from pyspark.sql import types as T

    from quern.runtime import ensure_checkpoint_dir
    from quern.sources.files import read_jsonl, write_jsonl

    folder = f"{ensure_checkpoint_dir(spark)}/jsonl_scan-{uuid.uuid4().hex}"
    write_jsonl(table(spark, d, "events").select("event_id", F.from_json("props", "k BIGINT").alias("props")), folder)
    schema = T.StructType.fromDDL("event_id BIGINT, props STRUCT<k: BIGINT>")
    return read_jsonl(spark, folder, schema).select("event_id", "props.k")


FLAGSHIP = evidence_sentence_ids
