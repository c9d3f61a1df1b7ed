"""Evidence: sentences of candidate pages that mention both concepts of a pair."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from quern.config import Wikipedia
from quern.functions.text import alias_variants, casefold, clean_wiki_text, contains_any, normalize_space, page_url, split_sentences
from quern.runtime import cut


def page_sentences(pages: DataFrame, page_id: str, title: str, text: str, settings: Wikipedia | None = None) -> DataFrame:
    """(page_id, page_title, sentence_pos, sentence, folded) of each page; a sentence is folded once, whatever asks for it."""
    settings = settings or Wikipedia()
    cut = split_sentences(clean_wiki_text(F.col(text)), settings.min_sentence_chars, settings.max_sentence_chars)
    found = pages.where(F.col(text).isNotNull()).select(F.col(page_id).alias("page_id"), F.col(title).alias("page_title"), F.posexplode(cut).alias("sentence_pos", "sentence"))
    return found.withColumn("folded", casefold(F.col("sentence")))


def candidate_pages(pairs: DataFrame, pages: DataFrame, page_id: str, title: str, max_pages: int = 10) -> DataFrame:
    """(pair_id, page_id, page_pos): pages whose title is a concept of the pair, first concept first, at most max_pages."""
    titled = pages.select(F.col(page_id).alias("page_id"), casefold(normalize_space(F.col(title))).alias("folded")).where("folded <> ''")
    # a pair needs the first pages of a title only: a title of a tenth of all pages meets its pairs with max_pages rows
    first = F.row_number().over(Window.partitionBy("folded").orderBy("page_id"))
    titled = titled.withColumn("n", first).where(F.col("n") <= max_pages).drop("n")
    asked = pairs.select("pair_id", F.posexplode(F.array(casefold(normalize_space(F.col("concept_1"))), casefold(normalize_space(F.col("concept_2"))))).alias("side", "folded"))
    found = asked.join(titled, "folded").groupBy("pair_id", "page_id").agg(F.min("side").alias("side"))
    order = Window.partitionBy("pair_id").orderBy("side", "page_id")
    return found.withColumn("page_pos", F.row_number().over(order) - 1).where(F.col("page_pos") < max_pages).select("pair_id", "page_id", "page_pos")


def asked_pages(pages: DataFrame, candidates: DataFrame, page_id: str) -> DataFrame:
    """The pages that any pair asks for; only these are split."""
    return pages.join(candidates.select(F.col("page_id").alias(page_id)).distinct(), page_id, "left_semi")


def cooccurrences(pairs: DataFrame, candidates: DataFrame, sentences: DataFrame) -> DataFrame:
    """(pair_id, page_pos, page_title, sentence_pos, sentence, folded) with an alias of each concept.

    An equi-join on the candidate page comes first; the containment test is a filter on its rows.
    """
    aliases = pairs.select("pair_id", alias_variants(F.col("concept_1")).alias("aliases_1"), alias_variants(F.col("concept_2")).alias("aliases_2"))
    met = candidates.join(aliases, "pair_id").join(sentences, "page_id")
    both = contains_any(F.col("folded"), F.col("aliases_1")) & contains_any(F.col("folded"), F.col("aliases_2"))
    return met.where(both).select("pair_id", "page_pos", "page_title", "sentence_pos", "sentence", "folded")


def numbered_evidence(found: DataFrame, language: str = "en") -> DataFrame:
    """(pair_id, sentence_id, text, page_title, page_url): first of equal folded sentences, dense ids from 0."""
    first = Window.partitionBy("pair_id", "folded").orderBy("page_pos", "sentence_pos")
    kept = found.withColumn("n", F.row_number().over(first)).where("n = 1")
    number = F.row_number().over(Window.partitionBy("pair_id").orderBy("page_pos", "sentence_pos")) - 1
    return kept.select("pair_id", number.cast("bigint").alias("sentence_id"), F.col("sentence").alias("text"), "page_title", page_url(F.col("page_title"), language).alias("page_url"))


def evidence_records(pairs: DataFrame, evidence: DataFrame, candidates: DataFrame | None = None, pages: DataFrame | None = None, min_sentences: int = 5) -> DataFrame:
    """One record for each pair, with or without evidence, and whether it passes the minimum."""
    sentence = F.struct("sentence_id", "text", "page_title", "page_url")
    grouped = evidence.groupBy("pair_id").agg(F.array_sort(F.collect_list(sentence)).alias("evidence_sentences"))
    out = pairs.select("pair_id", "base_relation", "concept_1", "concept_2").join(grouped, "pair_id", "left")
    if candidates is not None and pages is not None:
        titles = candidates.join(pages, "page_id").groupBy("pair_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("page_pos", "page_title"))), lambda p: p["page_title"]).alias("pages_considered"))
        out = out.join(titles, "pair_id", "left")
    else:
        out = out.withColumn("pages_considered", F.lit(None).cast("array<string>"))
    none = F.array().cast("array<struct<sentence_id:bigint,text:string,page_title:string,page_url:string>>")
    sentences = F.coalesce("evidence_sentences", none)
    return out.select(
        "pair_id", "base_relation", "concept_1", "concept_2", F.array_distinct(F.coalesce("pages_considered", F.array().cast("array<string>"))).alias("resolved_titles"),
        F.coalesce("pages_considered", F.array().cast("array<string>")).alias("pages_considered"), sentences.alias("evidence_sentences"),
        (F.size(sentences) >= min_sentences).alias("passes_minimum"), F.lit(None).cast("string").alias("error"),
    )


def retrieve(pairs: DataFrame, pages: DataFrame, settings: Wikipedia | None = None, page_id: str = "page_id", title: str = "title", text: str = "text") -> DataFrame:
    """Evidence records of pairs over a table of pages (the offline page source)."""
    settings = settings or Wikipedia()
    candidates = cut(candidate_pages(pairs, pages, page_id, title, settings.max_pages))  # short rows, read three times
    sentences = page_sentences(asked_pages(pages, candidates, page_id), page_id, title, text, settings)
    evidence = numbered_evidence(cooccurrences(pairs, candidates, sentences), settings.language)
    titles = pages.select(F.col(page_id).alias("page_id"), F.col(title).alias("page_title"))
    return evidence_records(pairs, evidence, candidates, titles, settings.min_sentences)


def usable(records: DataFrame, allow_below_minimum: bool = False) -> DataFrame:
    """Evidence gate: records that pass the minimum, or all where that is allowed."""
    return records if allow_below_minimum else records.where(F.coalesce("passes_minimum", F.lit(False)))


def prompt_context(sentences: DataFrame, order: str, text: str, limit: int = 24_000, key: str = "pair_id") -> DataFrame:
    """(key, order, line): context lines '[id] text' of each key until the first that would pass the limit."""
    line = F.concat(F.lit("["), F.col(order).cast("string"), F.lit("] "), F.col(text))
    running = F.sum(F.length("line")).over(Window.partitionBy(key).orderBy(order).rowsBetween(Window.unboundedPreceding, 0))
    lines = sentences.select(key, order, line.alias("line"))
    return lines.withColumn("total", running).where(F.col("total") <= limit).drop("total")


def prompts(context: DataFrame, pairs: DataFrame, order: str) -> DataFrame:
    """(pair_id, system, user) requests to a relation extractor."""
    joined = context.groupBy("pair_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(order, "line"))), lambda x: x["line"]), "\n").alias("context"))
    user = F.format_string(
        "Concepts: %s and %s. Stated relation: %s.\nList each relation from the first to the second that the numbered sentences support, in snake case, with the sentence numbers and a short quote.\n\n%s",
        "concept_1", "concept_2", "base_relation", "context",
    )
    system = F.lit("Report only lasting, factual relations that the given sentences support. No opinions, no vague links, nothing tied to the present day.")
    return pairs.join(joined, "pair_id").select("pair_id", system.alias("system"), user.alias("user"))
