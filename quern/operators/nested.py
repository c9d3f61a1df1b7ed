"""Problem 5: deeply nested records turned into flat child tables that keep their parent and their place.

A higher-order SQL projection over VARIANT values: ``aggregate`` opens one layer of wrappers after the other until none is
left and takes the lists of each record once; nested ``transform`` calls attach the record's number, the ancestor keys and
the indices; ``flatten`` combines the arrays and one ``inline`` for each target table emits the rows. Everything is a
narrow projection: no shuffle, no Python.

Defined results: a payload that is null, empty or not valid JSON gives no row; a record is found inside objects, lists and
quoted JSON, however many of them are around it; a payload may hold several records, which the flat tables number (record)
by the number of their wrappers, then by their place; null children give no row but keep their place; anything else in
place of a list (an object, a text, a number) is a list of one; scores may be an object of lists or a list of {measure,
values}; only numbers are scores; child_index names no record, so that equal children of several records are one row
there; lines are never merged; columns other than the key and the payload are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: The lists that make an object a record, and the types that are numbers.
RECORD_LISTS = ("evidence_sentences", "relations", "blocks", "scores")
#: Layers that are opened before the loop is given as many rounds as the payload has characters.
FEW_LAYERS = 6
NUMBER_TYPES = "('TINYINT','SMALLINT','INT','BIGINT','FLOAT','DOUBLE')"

_LISTS = ", ".join(f"'{k}', try_variant_get(v, '$.{k}', 'variant')" for k in RECORD_LISTS)
_RECORDS = "array<struct<v:variant," + ",".join(f"{k}:variant" for k in RECORD_LISTS) + ">>"
_IS_RECORD = "(" + " OR ".join(f"l.{k} IS NOT NULL" for k in RECORD_LISTS) + ")"
#: The values directly inside a wrapper: items of a list, values of an object, quoted JSON.
_INSIDE = """coalesce(try_variant_get(l.v, '$', 'array<variant>'), map_values(try_variant_get(l.v, '$', 'map<string,variant>')),
    CASE WHEN schema_of_variant(l.v) = 'STRING' THEN array(try_parse_json(try_variant_get(l.v, '$', 'string'))) ELSE CAST(array() AS array<variant>) END)"""
#: One layer of wrappers: values that are records are kept, the others are opened.
_LAYER = f"""element_at(transform(array(transform(filter(acc.open, v -> v IS NOT NULL), v -> named_struct('v', v, {_LISTS}))), ls -> named_struct(
    'records', concat(acc.records, filter(ls, l -> {_IS_RECORD})),
    'open', flatten(transform(filter(ls, l -> NOT {_IS_RECORD}), l -> {_INSIDE})))), 1)"""


def _listed(v: str) -> str:
    """SQL of a variant as a list: null is empty, anything but a list is a list of one."""
    return f"""CASE WHEN {v} IS NULL OR is_variant_null({v}) THEN CAST(array() AS array<variant>)
        ELSE coalesce(try_variant_get({v}, '$', 'array<variant>'), array({v})) END"""


def _present(v: str) -> str:
    return f"({v} IS NOT NULL AND NOT is_variant_null({v}))"


def unwrap(lines: DataFrame, key: str = "line_no", payload: str = "payload") -> DataFrame:
    """(key, records array<struct>): the records inside each payload with their four lists."""
    text = f"CAST(`{payload}` AS string)"
    start = f"named_struct('records', CAST(array() AS {_RECORDS}), 'open', array(try_parse_json({text})))"
    once = lambda o: f"transform(array({o}), acc -> {_LAYER})"
    loop = lambda o, layers: f"aggregate(sequence(1, {layers}), {o}, (acc, i) -> CASE WHEN size(acc.open) = 0 THEN acc ELSE {_LAYER} END)"
    # most records have few wrappers; no payload has more layers than characters, and a layer that opens nothing is passed over
    deep = f"CASE WHEN size(p.open) = 0 THEN p.records ELSE {loop('p', f'length({text})')}.records END"
    wrapped = f"element_at(transform(array({loop('o', FEW_LAYERS)}), p -> {deep}), 1)"
    found = f"element_at(transform({once(start)}, o -> CASE WHEN size(o.open) = 0 THEN o.records ELSE {wrapped} END), 1)"
    return lines.select(F.col(key), F.expr(found).alias("records"))


def _children(list_name: str) -> str:
    """SQL of the non-null items of one list of all records, with their record and place."""
    places = f"transform({_listed(f'r.{list_name}')}, (x, i) -> named_struct('record', CAST(n AS bigint), 'pos', CAST(i AS bigint), 'item', x))"
    return f"flatten(transform(records, (r, n) -> filter({places}, c -> {_present('c.item')})))"


#: Labels of the blocks of all records; blocks is a column of _children.
_BLOCK_RELATIONS = f"""flatten(transform(blocks, b -> filter(transform({_listed("try_variant_get(b.item, '$.relations', 'variant')")},
    (x, i) -> named_struct('record', b.record, 'block_pos', b.pos, 'pos', CAST(i AS bigint), 'item', x)), c -> {_present('c.item')})))"""
#: An object of lists, or a list of {measure, values} brought to that form.
_OF_OBJECT = "transform(map_entries(try_variant_get(r.scores, '$', 'map<string,variant>')), e -> named_struct('measure', e.key, 'vals', e.value))"
_OF_LIST = f"transform(filter({_listed('r.scores')}, m -> m IS NOT NULL), m -> named_struct('measure', try_variant_get(m, '$.measure', 'string'), 'vals', try_variant_get(m, '$.values', 'variant')))"
_NAMED = "(try_variant_get(r.scores, '$.measure', 'string') IS NOT NULL AND try_variant_get(r.scores, '$.values', 'variant') IS NOT NULL)"
_MEASURES = f"CASE WHEN {_NAMED} THEN {_OF_LIST} ELSE coalesce({_OF_OBJECT}, {_OF_LIST}) END"
_IS_NUMBER = f"({_present('c.item')} AND (schema_of_variant(c.item) IN {NUMBER_TYPES} OR schema_of_variant(c.item) LIKE 'DECIMAL%'))"
_SCORES = f"""flatten(flatten(transform(records, (r, n) -> transform(CASE WHEN {_present('r.scores')} THEN {_MEASURES} ELSE array() END, p -> filter(transform({_listed('p.vals')},
    (x, i) -> named_struct('record', CAST(n AS bigint), 'measure', coalesce(p.measure, ''), 'pos', CAST(i AS bigint), 'item', x)), c -> {_IS_NUMBER})))))"""


def child_index(lines: DataFrame, key: str = "line_no", payload: str = "payload") -> DataFrame:
    """(key, child, parent_key, pos): the place of each child of every kind, in one pass."""
    records = unwrap(lines, key, payload)
    lists = records.select(F.col(key), "records", F.expr(_children("blocks")).alias("blocks"))

    def keyed(items: str, child: str, parent: str) -> str:
        return f"transform({items}, c -> named_struct('child', '{child}', 'parent_key', {parent}, 'pos', c.pos))"

    parts = [
        keyed(_children("evidence_sentences"), "evidence_sentence", "''"), keyed(_children("relations"), "ranked_relation", "''"), keyed("blocks", "block", "''"),
        keyed(_BLOCK_RELATIONS, "block_relation", "CAST(c.block_pos AS string)"), f"array_distinct({keyed(_SCORES, 'score', 'c.measure')})",
    ]
    rows = lists.select(F.col(key), F.size("records").alias("n"), F.expr(f"concat({', '.join(parts)})").alias("rows"))
    return rows.select(F.col(key), F.expr("inline(CASE WHEN n > 1 THEN array_distinct(rows) ELSE rows END)"))


def evidence_sentences(lines: DataFrame, key: str = "line_no", payload: str = "payload") -> DataFrame:
    """(key, record, pos, sentence_id, text, page_title, page_url)."""
    return _flat(lines, key, payload, "evidence_sentences", ("sentence_id bigint", "text string", "page_title string", "page_url string"))


def ranked_relations(lines: DataFrame, key: str = "line_no", payload: str = "payload") -> DataFrame:
    """(key, record, pos, relation, appearances, most_count, least_count, p_most, p_least, score, rank)."""
    fields = ("relation string", "appearances int", "most_count int", "least_count int", "p_most double", "p_least double", "score double", "rank int")
    return _flat(lines, key, payload, "relations", fields)


def ranking_blocks(lines: DataFrame, key: str = "line_no", payload: str = "payload") -> DataFrame:
    """(key, record, pos, block_id, most_relevant, least_relevant, rationale)."""
    return _flat(lines, key, payload, "blocks", ("block_id bigint", "most_relevant string", "least_relevant string", "rationale string"))


def block_relations(lines: DataFrame, key: str = "line_no", payload: str = "payload") -> DataFrame:
    """(key, record, block_pos, pos, relation)."""
    blocks = unwrap(lines, key, payload).select(F.col(key), F.expr(_children("blocks")).alias("blocks"))
    rows = f"transform({_BLOCK_RELATIONS}, c -> named_struct('record', c.record, 'block_pos', c.block_pos, 'pos', c.pos, 'relation', try_variant_get(c.item, '$', 'string')))"
    return blocks.select(F.col(key), F.expr(f"inline({rows})"))


def scores(lines: DataFrame, key: str = "line_no", payload: str = "payload") -> DataFrame:
    """(key, record, measure, pos, score); a measure that a record names twice gives its rows twice."""
    rows = f"transform({_SCORES}, c -> named_struct('record', c.record, 'measure', c.measure, 'pos', c.pos, 'score', try_variant_get(c.item, '$', 'double')))"
    return unwrap(lines, key, payload).select(F.col(key), F.expr(f"inline({rows})"))


def _flat(lines: DataFrame, key: str, payload: str, list_name: str, fields: tuple[str, ...]) -> DataFrame:
    cols = ", ".join(f"'{f.split()[0]}', try_variant_get(c.item, '$.{f.split()[0]}', '{f.split()[1]}')" for f in fields)
    rows = f"transform({_children(list_name)}, c -> named_struct('record', c.record, 'pos', c.pos, {cols}))"
    return unwrap(lines, key, payload).select(F.col(key), F.expr(f"inline({rows})"))
