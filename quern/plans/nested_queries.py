"""Queries of the nested-record operator (problem 5)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from quern.operators import nested
from quern.runtime import table


def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nested.child_index(table(spark, sf_dir, "record_lines"))


def p5_evidence_sentences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nested.evidence_sentences(table(spark, sf_dir, "record_lines"))


def p5_ranked_relations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nested.ranked_relations(table(spark, sf_dir, "record_lines"))


def p5_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nested.ranking_blocks(table(spark, sf_dir, "record_lines"))


def p5_block_relations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nested.block_relations(table(spark, sf_dir, "record_lines"))


def p5_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nested.scores(table(spark, sf_dir, "record_lines"))


QUERIES = {f.__name__: f for f in (p5_found, p5_evidence_sentences, p5_ranked_relations, p5_blocks, p5_block_relations, p5_scores)}

_LIST = "CASE WHEN {v} IS NULL OR json_type({v}) = 'NULL' THEN [] WHEN json_type({v}) = 'ARRAY' THEN json_extract({v}, '$[*]') ELSE [{v}] END"
_OPEN = "CASE WHEN json_type(j) = 'VARCHAR' AND json_valid(j ->> '$') THEN json(j ->> '$') ELSE j END AS j"
_ITEMS = f"""WITH u0 AS (SELECT line_no, json(payload) AS j FROM record_lines WHERE json_valid(payload)),
    u1 AS (SELECT line_no, {_OPEN} FROM u0), u2 AS (SELECT line_no, {_OPEN} FROM u1), u3 AS (SELECT line_no, {_OPEN} FROM u2),
    top AS (SELECT line_no, dense_rank() OVER (PARTITION BY line_no ORDER BY length(t.path), t.path) - 1 AS record, t.key AS k, t.value AS v FROM u3, json_tree(u3.j) t
            WHERE t.key IN ('evidence_sentences', 'relations', 'blocks', 'scores') AND NOT regexp_matches(t.path, 'evidence_sentences|relations|blocks|scores')),
    lists AS (SELECT line_no, record, k, {_LIST.format(v='v')} AS xs FROM top),
    items AS (SELECT line_no, record, k, unnest(xs) AS x, unnest(range(len(xs))) AS pos FROM lists),
    labels AS (SELECT line_no, record, pos AS block, {_LIST.format(v="json_extract(x, '$.relations')")} AS xs FROM items WHERE k = 'blocks' AND json_type(x) = 'OBJECT'),
    block_labels AS (SELECT line_no, record, block, unnest(xs) AS x, unnest(range(len(xs))) AS pos FROM labels),
    named AS (SELECT line_no, record, e.key AS measure, e.value AS v FROM top, json_each(top.v) e WHERE k = 'scores' AND json_type(top.v) = 'OBJECT'
              UNION ALL SELECT line_no, record, x ->> '$.measure', json_extract(x, '$.values') FROM items WHERE k = 'scores' AND json_type(x) = 'OBJECT' AND json_exists(x, '$.measure')),
    measured AS (SELECT line_no, record, measure, {_LIST.format(v='v')} AS xs FROM named),
    numbers AS (SELECT line_no, record, measure, x, pos FROM (SELECT line_no, record, measure, unnest(xs) AS x, unnest(range(len(xs))) AS pos FROM measured) WHERE json_type(x) IN ('BIGINT', 'UBIGINT', 'DOUBLE'))"""


def _flat_sql(list_name: str, fields: str) -> str:
    cols = ", ".join(f"TRY_CAST(x ->> '$.{f.split()[0]}' AS {f.split()[1]}) AS {f.split()[0]}" for f in fields.split(", "))
    return f"{_ITEMS} SELECT line_no, record, pos, {cols} FROM items WHERE k = '{list_name}' AND json_type(x) <> 'NULL'"


ORACLE_SQL: dict[str, str] = {
    "p5_found": f"""{_ITEMS}
    SELECT DISTINCT line_no, CASE k WHEN 'evidence_sentences' THEN 'evidence_sentence' WHEN 'relations' THEN 'ranked_relation' ELSE 'block' END AS child, '' AS parent_key, pos FROM items WHERE k <> 'scores' AND json_type(x) <> 'NULL'
    UNION ALL SELECT DISTINCT line_no, 'block_relation', CAST(block AS VARCHAR), pos FROM block_labels WHERE json_type(x) <> 'NULL'
    UNION ALL SELECT DISTINCT line_no, 'score', measure, pos FROM numbers""",
    "p5_evidence_sentences": _flat_sql("evidence_sentences", "sentence_id BIGINT, text VARCHAR, page_title VARCHAR, page_url VARCHAR"),
    "p5_ranked_relations": _flat_sql("relations", "relation VARCHAR, appearances INTEGER, most_count INTEGER, least_count INTEGER, p_most DOUBLE, p_least DOUBLE, score DOUBLE, rank INTEGER"),
    "p5_blocks": _flat_sql("blocks", "block_id BIGINT, most_relevant VARCHAR, least_relevant VARCHAR, rationale VARCHAR"),
    "p5_block_relations": f"{_ITEMS} SELECT line_no, record, block AS block_pos, pos, x ->> '$' AS relation FROM block_labels WHERE json_type(x) <> 'NULL'",
    "p5_scores": f"{_ITEMS} SELECT line_no, record, measure, pos, CAST(x AS DOUBLE) AS score FROM numbers",
}
