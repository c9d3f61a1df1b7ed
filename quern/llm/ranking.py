"""Problem 4: one global ranking of all items from best-worst answers, by spring energies.

Every comparison is a spring that wants its winner one unit above its loser; with a weak spring to zero for each item the
energy's minimum is the solution of one sparse symmetric system

    (degree_i + ridge) s_i - sum_j n_ij s_j = wins_i - losses_i

which conjugate gradients with the Jacobi (diagonal) preconditioner solve over DataFrames: the edge table is aggregated
once (at most one row for each ordered pair of items that met), each round joins it with the direction vector, and only
four sums reach the driver. Lineage is cut by a checkpoint every round.

Defined results: a block (pair, block number) counts once, by its answer of latest time (ties: larger choice id); rows
without a pair or block number are blocks of their own; labels match their block by slug; a null label, one outside its
block or two equal labels say nothing; null items are ignored; an item without comparisons has strength 0; ties rank by
name; empty input gives strength 0 for all; a system that has not settled after MAX_ROUNDS fails; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from quern.functions.text import relation_slug
from quern.runtime import cut

#: Weight of the spring that holds each item at zero, in comparisons.
RIDGE = 1.0
TOLERANCE = 1e-6
MAX_ROUNDS = 200


def latest_answers(choices: DataFrame) -> DataFrame:
    """(items array<string>, most, least) of the answer that counts for each block, as slugs.

    Labels become short before the one shuffle, which is on (pair_id, block_id); its keys are many and small.
    """
    items = F.array_distinct(F.filter(F.transform("relations", relation_slug), lambda r: r.isNotNull() & (r != "")))
    own = F.when(F.col("pair_id").isNull() | F.col("block_id").isNull(), F.col("choice_id"))
    slim = choices.select("pair_id", "block_id", own.alias("own"), "answered_at", "choice_id", items.alias("items"), relation_slug(F.col("most_relevant")).alias("most"), relation_slug(F.col("least_relevant")).alias("least"))
    slim = slim.select("pair_id", "block_id", "own", "answered_at", "choice_id", "items", F.array_position("items", F.col("most")).cast("int").alias("most_at"), F.array_position("items", F.col("least")).cast("int").alias("least_at"))
    order = Window.partitionBy("pair_id", "block_id", "own").orderBy(F.col("answered_at").desc_nulls_last(), F.col("choice_id").desc_nulls_last())
    last = slim.withColumn("n", F.row_number().over(order)).where("n = 1")
    at = lambda c: F.when(F.col(c) > 0, F.try_element_at("items", F.col(c)))
    return last.select("items", at("most_at").alias("most"), at("least_at").alias("least"))


def comparisons(answers: DataFrame) -> DataFrame:
    """(winner, loser, n): pre-aggregated outcomes; the most relevant beats the rest, the rest beats the least relevant."""
    said = answers.where("most IS NOT NULL OR least IS NOT NULL").where("NOT (most <=> least)")
    won = F.expr("CASE WHEN most IS NULL THEN CAST(array() AS array<struct<winner:string,loser:string>>) ELSE transform(filter(items, i -> i <> most), i -> struct(most AS winner, i AS loser)) END")
    lost = F.expr("CASE WHEN least IS NULL THEN CAST(array() AS array<struct<winner:string,loser:string>>) ELSE transform(filter(items, i -> i <> least AND NOT (i <=> most)), i -> struct(i AS winner, least AS loser)) END")
    return said.select(F.inline(F.concat(won, lost))).groupBy("winner", "loser").agg(F.count(F.lit(1)).alias("n"))


def spring_strengths(outcomes: DataFrame, ridge: float = RIDGE, tolerance: float = TOLERANCE, max_rounds: int = MAX_ROUNDS) -> DataFrame:
    """(item, strength, compared) from (winner, loser, n)."""
    both = outcomes.select(F.col("winner").alias("i"), F.col("loser").alias("j"), "n", F.col("n").alias("net")).unionAll(
        outcomes.select(F.col("loser").alias("i"), F.col("winner").alias("j"), "n", (-F.col("n")).alias("net"))
    )
    edges = cut(both.groupBy("i", "j").agg(F.sum("n").cast("double").alias("n"), F.sum("net").cast("double").alias("net")))
    start = edges.groupBy("i").agg((F.sum("n") + ridge).alias("d"), F.sum("net").alias("r"), F.sum("n").cast("bigint").alias("compared"))
    state = start.select("i", "d", "compared", F.lit(0.0).alias("x"), "r", (F.col("r") / F.col("d")).alias("p"))
    first = None
    for _ in range(max_rounds):
        pulled = edges.join(state.select(F.col("i").alias("j"), "p"), "j").groupBy("i").agg(F.sum(F.col("n") * F.col("p")).alias("q"))
        moved = cut(state.join(pulled, "i", "left").select("i", "d", "compared", "x", "r", "p", (F.col("d") * F.col("p") - F.coalesce("q", F.lit(0.0))).alias("ap")))
        sums = moved.agg(
            F.sum(F.col("p") * F.col("ap")).alias("pap"), F.sum(F.col("r") * F.col("r") / F.col("d")).alias("rz"),
            F.sum(F.col("r") * F.col("ap") / F.col("d")).alias("ra"), F.sum(F.col("ap") * F.col("ap") / F.col("d")).alias("aa"),
        ).first()
        if not sums.pap or not sums.rz:
            state = moved.select("i", "d", "compared", "x", "r", "p")
            break
        first = first or sums.rz
        alpha = sums.rz / sums.pap
        left = max(0.0, sums.rz - 2 * alpha * sums.ra + alpha * alpha * sums.aa)
        r = F.col("r") - alpha * F.col("ap")
        state = moved.select("i", "d", "compared", (F.col("x") + alpha * F.col("p")).alias("x"), r.alias("r"), (r / F.col("d") + (left / sums.rz) * F.col("p")).alias("p"))
        if left <= tolerance * tolerance * first:
            break
    else:
        raise RuntimeError(f"the strengths have not settled within {max_rounds} rounds")
    return state.select(F.col("i").alias("item"), F.col("x").alias("strength"), "compared")


def item_strengths(choices: DataFrame) -> DataFrame:
    """(item, strength, compared) of every label, as a slug, that was compared, whether or not a list holds it."""
    return spring_strengths(comparisons(latest_answers(choices)))


def rank_relations(choices: DataFrame, vocab: DataFrame) -> DataFrame:
    """(relation, strength, compared, rank, quarter) for each relation of the vocabulary.

    The final window is over the vocabulary, a fixed table, not over the answers.
    """
    strengths = item_strengths(choices)
    names = vocab.where("relation IS NOT NULL").select("relation").distinct().withColumn("item", relation_slug(F.col("relation")))
    order = Window.orderBy(F.col("strength").desc(), F.col("relation"))
    joined = names.join(strengths, "item", "left").select("relation", F.coalesce("strength", F.lit(0.0)).alias("strength"), F.coalesce("compared", F.lit(0)).alias("compared"))
    return joined.select("relation", "strength", "compared", F.row_number().over(order).cast("bigint").alias("rank"), F.ntile(4).over(order).cast("bigint").alias("quarter"))
