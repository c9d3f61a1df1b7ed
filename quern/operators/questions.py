"""Question building: eligible pairs, target pools, seeded schedules and samples, scores, answers with ties."""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha1
from heapq import nsmallest
from math import comb

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from quern.config import Questions
from quern.functions.text import stable_question_id
from quern.functions.vectors import context_similarity, cosine, overlap, ties
from quern.runtime import cut

MEASURES = ("ranked_relational_overlap", "context_embedding_similarity", "prototypicality")


def draw(seed: int, *parts: Column) -> Column:
    """A seeded order that depends on the parts only, the same in every partitioning and in SQL."""
    return F.sha1(F.concat_ws("\0", F.lit(str(seed)), *(p.cast("string") for p in parts)))


def pair_text(c1: Column, c2: Column) -> Column:
    return F.concat(c1, F.lit(" : "), c2)


def stem_text(c1: Column, c2: Column, base_relation: Column) -> Column:
    return F.concat(c1, F.lit(" : "), c2, F.lit(" | base relation: "), base_relation)


def ranking_scores(relations: Column) -> Column:
    """map<relation, score> of a ranking; the last of equal labels counts."""
    entries = F.filter(relations, lambda r: r.isNotNull() & r["relation"].isNotNull())
    names = F.array_distinct(F.transform(entries, lambda r: r["relation"]))
    last = F.transform(names, lambda n: F.struct(n, F.element_at(F.filter(entries, lambda r: r["relation"] == n), -1)["score"]))
    return F.map_from_entries(last)


def usable_rankings(rankings: DataFrame) -> DataFrame:
    """Rankings with relations and without an error."""
    return rankings.where((F.size(F.coalesce("relations", F.array())) > 0) & (F.coalesce("error", F.lit("")) == ""))


def eligible_pairs(pairs: DataFrame, rankings: DataFrame, evidence: DataFrame, settings: Questions | None = None, allow_below_minimum: bool = False) -> DataFrame:
    """(pair columns, scores) of pairs with a usable ranking and, where required, with context, in groups large enough."""
    settings = settings or Questions()
    scored = usable_rankings(rankings).select("pair_id", ranking_scores(F.col("relations")).alias("scores"))
    context = evidence.select("pair_id", (F.coalesce("passes_minimum", F.lit(False)) | F.lit(allow_below_minimum)).alias("has_context"))
    joined = pairs.join(scored, "pair_id").join(context, "pair_id", "left")
    kept = joined.where(F.lit(not settings.require_context_pass) | F.coalesce("has_context", F.lit(False))).drop("has_context")
    # read many times from here on (pools, scores, texts): written once to the shared checkpoint folder
    kept = cut(kept)
    # group sizes are counted before they move: a base relation with a tenth of all pairs never stands in one task
    large = kept.groupBy("base_relation").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= settings.target_count + 1)
    return kept.join(large.select("base_relation"), "base_relation", "left_semi")


#: Members of a relation's list that meet a stem in one task; a longer list is met in several parts.
POOL_PART = 64


def target_pools(eligible: DataFrame, seed: int = 42, part: int = POOL_PART, draws: int | None = None) -> DataFrame:
    """(stem_id, target_id): other pairs of the stem's base relation that share a ranked relation.

    The pool is whole at every size: a list of a (base relation, relation) longer than part is split by hash, and each of its
    stems meets every part, so that a hot relation is spread over its parts. Only where draws is given does a stem meet no
    more than so many drawn parts of a longer list; no query and no stage asks for that.
    """
    keys = eligible.select("base_relation", "pair_id", F.explode(F.map_keys("scores")).alias("relation"))
    parts = keys.groupBy("base_relation", "relation").agg(F.ceil(F.count(F.lit(1)) / part).cast("int").alias("parts"))
    split = keys.join(parts, ["base_relation", "relation"])
    targets = split.select("base_relation", "relation", F.pmod(F.xxhash64("pair_id"), F.col("parts")).cast("int").alias("part"), F.col("pair_id").alias("target_id"))
    every = F.sequence(F.lit(0), F.col("parts") - 1)
    if draws is not None:
        drawn = F.transform(F.sequence(F.lit(0), F.lit(draws - 1)), lambda i: F.pmod(F.xxhash64(F.lit(seed), "pair_id", "relation", i), F.col("parts")).cast("int"))
        every = F.when(F.col("parts") <= draws, every).otherwise(F.array_distinct(drawn))
    stems = split.select("base_relation", "relation", F.explode(every).alias("part"), F.col("pair_id").alias("stem_id"))
    met = stems.join(targets, ["base_relation", "relation", "part"]).where("stem_id <> target_id")
    return met.select("stem_id", "target_id").distinct()


def stem_schedule(stems: DataFrame, settings: Questions | None = None) -> DataFrame:
    """(stem_id, copy, place): each stem questions_per_stem times, cut or extended to the total, in seeded order.

    Only a stated total needs a global place, and then a top-n; the extension draws stems by hash of the slot.
    """
    settings = settings or Questions()
    copies = stems.select(F.col("pair_id").alias("stem_id"), F.explode(F.sequence(F.lit(0), F.lit(settings.questions_per_stem - 1))).alias("copy"))
    order = draw(settings.seed, F.col("stem_id"), F.col("copy"))
    base = copies.withColumn("place", order)
    if settings.total_questions is None:
        return base
    n = base.count()
    if settings.total_questions <= n:
        return base.orderBy("place", "stem_id").limit(settings.total_questions)
    # with replacement: a slot draws a part of the stems, then a place in it; no stem is numbered across the whole table
    distinct = stems.select(F.col("pair_id").alias("stem_id"))
    parts = max(1, distinct.count() // POOL_PART)
    placed = distinct.withColumn("part", F.pmod(F.xxhash64("stem_id"), F.lit(parts)))
    placed = placed.withColumn("at", F.row_number().over(Window.partitionBy("part").orderBy("stem_id")) - 1).withColumn("size", F.count(F.lit(1)).over(Window.partitionBy("part")))
    slots = stems.sparkSession.range(settings.total_questions - n).select(F.col("id").alias("extra"), F.xxhash64(F.lit(settings.seed), "id").alias("h")).withColumn("part", F.pmod("h", F.lit(parts)))
    drawn = slots.join(placed, "part").where(F.pmod(F.shiftrightunsigned("h", 20), F.col("size")) == F.col("at"))
    extra = drawn.select("stem_id", (F.col("extra") + settings.questions_per_stem).cast("int").alias("copy"))
    return base.unionByName(extra.withColumn("place", draw(settings.seed, F.col("stem_id"), F.col("copy"))))


def _attempted_sets(pool: list[str], wanted: int, settings: Questions, stem_id: str) -> Iterator[list[str]]:
    """Fresh sets of a stem's slots in order: a slot draws until its set is new, or it has used all its attempts."""
    k, seen, attempt = settings.target_count, set(), 0
    start = f"{settings.seed}\0{stem_id}\0"
    for _ in range(wanted):
        for _ in range(settings.max_sampling_attempts_per_question):
            prefix = sha1(f"{start}{attempt}\0".encode())
            attempt += 1

            def place(target: str, prefix=prefix) -> tuple[str, str]:
                h = prefix.copy()
                h.update(target.encode())
                return h.hexdigest(), target

            chosen = nsmallest(k, pool, key=place)
            if (key := frozenset(chosen)) not in seen:
                seen.add(key)
                yield chosen
                break
        if len(seen) == comb(len(pool), k):  # no later draw can be new
            return


def sampled_targets(schedule: DataFrame, pools: DataFrame, settings: Questions | None = None) -> DataFrame:
    """(stem_id, occurrence, slot, target_id): for each slot of the schedule, target_count targets in display order.

    Attempt a of a stem takes the first targets in the order of hash(seed, stem, a, target); sets already used for the stem
    are passed over, so each set occurs once for a stem. Each slot has max_sampling_attempts_per_question attempts of its own,
    which follow those of the slot before. Slots without a new set, and stems whose pool is too small, have none.
    """
    settings = settings or Questions()
    k = settings.target_count
    sized = pools.withColumn("n", F.count(F.lit(1)).over(Window.partitionBy("stem_id"))).where(F.col("n") >= k).drop("n")
    asked = schedule.groupBy("stem_id").agg(F.count(F.lit(1)).cast("int").alias("wanted"))
    # the first attempt of a stem is always new: stems asked once take it without leaving the plan
    once = asked.where("wanted = 1").join(sized, "stem_id").withColumn("h", draw(settings.seed, F.col("stem_id"), F.lit(0), F.col("target_id")))
    order = Window.partitionBy("stem_id").orderBy("h", "target_id")
    first = once.withColumn("slot", F.row_number().over(order) - 1).where(F.col("slot") < k).select("stem_id", F.lit(0).alias("occurrence"), "slot", "target_id")
    if settings.questions_per_stem == 1 and settings.total_questions is None:
        return first

    def attempts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for stem_id, wanted, pool in zip(*batch.columns):
                sets = _attempted_sets(pool.as_py(), wanted.as_py(), settings, stem_id.as_py())
                rows = [(stem_id.as_py(), i, j, t) for i, chosen in enumerate(sets) for j, t in enumerate(chosen)]
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, kind) for c, kind in zip(zip(*rows), (pa.string(), pa.int32(), pa.int32(), pa.string()))], names=["stem_id", "occurrence", "slot", "target_id"])

    several = sized.groupBy("stem_id").agg(F.collect_list("target_id").alias("pool")).join(asked.where("wanted > 1"), "stem_id").select("stem_id", "wanted", "pool")
    return first.unionByName(several.mapInArrow(attempts, "stem_id string, occurrence int, slot int, target_id string"))


def question_ids(sampled: DataFrame) -> DataFrame:
    """(stem_id, occurrence, question_id, target_ids): ids depend on the display order."""
    lists = sampled.groupBy("stem_id", "occurrence").agg(F.transform(F.array_sort(F.collect_list(F.struct("slot", "target_id"))), lambda t: t["target_id"]).alias("target_ids"))
    return lists.withColumn("question_id", stable_question_id(F.col("stem_id"), F.col("target_ids"), F.col("occurrence")))


def relation_overlaps(sampled: DataFrame, eligible: DataFrame) -> DataFrame:
    """Adds ranked_relational_overlap of stem and target."""
    scores = eligible.select("pair_id", "scores")
    stems, targets = scores.toDF("stem_id", "s"), scores.toDF("target_id", "t")
    return sampled.join(stems, "stem_id").join(targets, "target_id").withColumn(MEASURES[0], overlap(F.col("s"), F.col("t"))).drop("s", "t")


def context_scores(sampled: DataFrame, contexts: DataFrame, threshold: float = 0.5) -> DataFrame:
    """Adds context_embedding_similarity; contexts: (pair_id, vectors array<array<float>>), none for a missing pair."""
    empty = F.array().cast("array<array<float>>")
    sides = sampled.select("stem_id", "target_id").distinct()
    joined = sides.join(contexts.toDF("stem_id", "l"), "stem_id", "left").join(contexts.toDF("target_id", "r"), "target_id", "left")
    joined = joined.select("stem_id", "target_id", F.coalesce("l", empty).alias("l"), F.coalesce("r", empty).alias("r"))
    similar = context_similarity(joined, ["stem_id", "target_id"], "l", "r", threshold).withColumnRenamed("similarity", MEASURES[1])
    return sampled.join(similar, ["stem_id", "target_id"])


def prototype_scores(sampled: DataFrame, pairs: DataFrame, vectors: DataFrame) -> DataFrame:
    """Adds prototypicality: cosine of the stem's text with relation and the target's text; vectors: (text_value, vector).

    A missing vector fails the job.
    """
    stems = pairs.select(F.col("pair_id").alias("stem_id"), stem_text(F.col("concept_1"), F.col("concept_2"), F.col("base_relation")).alias("text_value")).join(vectors, "text_value", "left").select("stem_id", F.col("vector").alias("u"))
    targets = pairs.select(F.col("pair_id").alias("target_id"), pair_text(F.col("concept_1"), F.col("concept_2")).alias("text_value")).join(vectors, "text_value", "left").select("target_id", F.col("vector").alias("v"))
    joined = sampled.join(stems, "stem_id").join(targets, "target_id")
    missing = F.raise_error(F.lit("missing cached embedding")).cast("double")
    return joined.withColumn(MEASURES[2], F.when(F.col("u").isNull() | F.col("v").isNull(), missing).otherwise(cosine(F.col("u"), F.col("v")))).drop("u", "v")


def answers(scored: DataFrame, measures: tuple[str, ...] = MEASURES, tolerance: float = 1e-10) -> DataFrame:
    """(stem_id, occurrence, measure, values, answer, tied, answer_pair_id) from scores of the slots."""
    long = scored.select("stem_id", "occurrence", "slot", "target_id", F.explode(F.create_map(*(x for m in measures for x in (F.lit(m), F.col(m))))).alias("measure", "value"))
    lists = long.groupBy("stem_id", "occurrence", "measure").agg(F.array_sort(F.collect_list(F.struct("slot", "target_id", "value"))).alias("slots"))
    values = lists.withColumn("values", F.transform("slots", lambda s: s["value"]))
    tied = values.withColumn("tied", ties(F.col("values"), tolerance)).withColumn("answer", F.element_at("tied", 1))
    return tied.select("stem_id", "occurrence", "measure", "values", "answer", "tied", F.element_at("slots", F.col("answer") + 1)["target_id"].alias("answer_pair_id"))


def question_records(pairs: DataFrame, sampled: DataFrame, answered: DataFrame) -> DataFrame:
    """Question records."""
    target = pairs.select(F.col("pair_id").alias("target_id"), F.struct("pair_id", "concept_1", "concept_2").alias("target"))
    stems = pairs.select(F.col("pair_id").alias("stem_id"), "base_relation", F.struct("pair_id", "concept_1", "concept_2").alias("stem"))
    lists = sampled.join(target, "target_id").groupBy("stem_id", "occurrence").agg(F.transform(F.array_sort(F.collect_list(F.struct("slot", "target"))), lambda t: t["target"]).alias("targets"))
    entry = lambda c: F.map_from_entries(F.collect_list(F.struct("measure", c)))
    maps = answered.groupBy("stem_id", "occurrence").agg(entry("values").alias("scores"), entry("answer").alias("answers"), entry("answer_pair_id").alias("answer_pair_ids"), entry("tied").alias("ties"))
    ids = question_ids(sampled).select("stem_id", "occurrence", "question_id")
    joined = lists.join(ids, ["stem_id", "occurrence"]).join(maps, ["stem_id", "occurrence"]).join(stems, "stem_id")
    return joined.select("question_id", "base_relation", "stem", "targets", "scores", "answers", "answer_pair_ids", "ties")


def shortfall_warning(made: int, settings: Questions) -> str | None:
    """The note beside an output that has fewer questions than were requested."""
    if settings.total_questions is None or made >= settings.total_questions:
        return None
    return f"Requested {settings.total_questions} questions, made {made}: some groups or stems lack enough unique target sets that share relations.\n"
