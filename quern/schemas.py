"""Record schemas, always passed to readers: nothing is inferred."""

from __future__ import annotations

from pyspark.sql.types import ArrayType, BooleanType, DataType, DoubleType, FloatType, IntegerType, LongType, MapType, StringType, StructField, StructType

_SIMPLE = {"STRING": StringType, "BIGINT": LongType, "INT": IntegerType, "DOUBLE": DoubleType, "FLOAT": FloatType, "BOOLEAN": BooleanType}


def _parts(text: str) -> list[str]:
    """Split at the commas outside of angle brackets."""
    out, depth, begin = [], 0, 0
    for i, char in enumerate(text):
        depth += (char == "<") - (char == ">")
        if char == "," and depth == 0:
            out.append(text[begin:i].strip())
            begin = i + 1
    return [*out, text[begin:].strip()]


def _type(text: str) -> DataType:
    if text in _SIMPLE:
        return _SIMPLE[text]()
    kind, inner = text[: text.index("<")], text[text.index("<") + 1 : -1]
    if kind == "ARRAY":
        return ArrayType(_type(inner))
    if kind == "MAP":
        return MapType(*map(_type, _parts(inner)))
    return StructType([StructField(name.strip(), _type(rest.strip())) for name, _, rest in (p.partition(":") for p in _parts(inner))])


def struct(text: str) -> StructType:
    """A schema from 'name TYPE, ...'; unlike Spark's own reader of such text it needs no session."""
    return StructType([StructField(name.strip("`"), _type(rest.strip())) for name, _, rest in (p.partition(" ") for p in _parts(text))])

_PAIR = "pair_id STRING, base_relation STRING, concept_1 STRING, concept_2 STRING"
_SENTENCE = "STRUCT<sentence_id: BIGINT, text: STRING, page_title: STRING, page_url: STRING>"
_EXTRACTED = "STRUCT<predicate: STRING, evidence_sentence_ids: ARRAY<BIGINT>, evidence_quote: STRING, explanation: STRING>"
_MINED = "STRUCT<raw_predicate: STRING, normalized_predicate: STRING, evidence_sentence_ids: ARRAY<BIGINT>, evidence_quote: STRING, explanation: STRING, source: STRING>"
_CANONICAL = "STRUCT<relation: STRING, evidence_sentence_ids: ARRAY<BIGINT>, source: STRING, notes: STRING>"
_RANKED = "STRUCT<relation: STRING, appearances: INT, most_count: INT, least_count: INT, p_most: DOUBLE, p_least: DOUBLE, score: DOUBLE, rank: INT>"
_BLOCK = "STRUCT<block_id: BIGINT, relations: ARRAY<STRING>, most_relevant: STRING, least_relevant: STRING, rationale: STRING>"
_TARGET = "STRUCT<pair_id: STRING, concept_1: STRING, concept_2: STRING>"

CONCEPT_PAIR = struct(_PAIR)
WIKI_EVIDENCE = struct(f"{_PAIR}, resolved_titles ARRAY<STRING>, pages_considered ARRAY<STRING>, evidence_sentences ARRAY<{_SENTENCE}>, passes_minimum BOOLEAN, error STRING")
EXTRACTION = struct(f"pair_id STRING, relations ARRAY<{_EXTRACTED}>, error STRING")
MINED_RELATIONS = struct(f"{_PAIR}, relations ARRAY<{_MINED}>, error STRING")
CANONICAL_RELATIONS = struct(f"{_PAIR}, relations ARRAY<{_CANONICAL}>")
CHOICE = struct("pair_id STRING, block_id BIGINT, most_relevant STRING, least_relevant STRING, rationale STRING, error STRING")
RELATION_RANKING = struct(f"{_PAIR}, relations ARRAY<{_RANKED}>, blocks ARRAY<{_BLOCK}>, error STRING")
QUESTION = struct(f"question_id STRING, base_relation STRING, stem {_TARGET}, targets ARRAY<{_TARGET}>, scores MAP<STRING, ARRAY<DOUBLE>>, answers MAP<STRING, INT>, answer_pair_ids MAP<STRING, STRING>, ties MAP<STRING, ARRAY<INT>>")
PUBLISHED_QUESTION = struct("stem ARRAY<STRING>, `option` ARRAY<ARRAY<STRING>>, prototypical ARRAY<STRING>, relational_overalap ARRAY<STRING>, embedding ARRAY<STRING>")
EMBEDDING = struct("cache_key STRING, model STRING, text_value STRING, dimensions INT, vector ARRAY<FLOAT>")
PAGE = struct("title STRING, text STRING")

#: The columns of the review table, in order.
REVIEW_COLUMNS = ("pair_id", "base_relation", "concept_1", "concept_2", "raw_predicate", "normalized_predicate", "evidence_sentence_ids", "evidence_text", "source", "suggested_decision", "suggested_category", "suggested_reason", "final_decision", "final_relation", "reviewer_notes")
REVIEW = struct(", ".join(f"{c} STRING" for c in REVIEW_COLUMNS))
