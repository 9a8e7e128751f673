"""Summed log-probabilities of many token sequences under an n-gram model."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from corpusforge.functions import codec
from corpusforge.operators.ngram import NgramModel
from corpusforge.session import cut_lineage

# A probability table of at most this many rows (some 20 MB with three models) is broadcast.
BROADCAST_ROWS = 400_000


def used(targets: DataFrame) -> DataFrame:
    """(key, uses): how many targets hold each n-gram."""
    return targets.where("key is not null").groupBy("key").agg(F.count(F.lit(1)).alias("uses"))


def join_in_two(targets: DataFrame, probs: DataFrame, uses: DataFrame, limit: int) -> DataFrame:
    """``targets`` with their probabilities: frequent n-grams by broadcast, the others by shuffle.

    Fewer than ``limit`` n-grams can each hold more than one in ``limit`` of all targets. Both
    parts keep every target; those without an n-gram stay with the broadcast part.
    """
    total = uses.agg(F.sum("uses")).first()[0] or 0
    often = uses.where(F.col("uses") * max(limit, 1) > total).select("key")
    head = cut_lineage(probs.join(often, "key", "left_semi"), "frequent-ngrams")
    marked = targets.join(F.broadcast(head.withColumn("_head", F.lit(True))), "key", "left")
    frequent = F.col("_head").isNotNull() | F.col("key").isNull()
    tail = marked.where(~frequent).select(*targets.columns).join(probs, "key", "left")
    return marked.where(frequent).drop("_head").unionByName(tail)


def score_units(
    rows: DataFrame,
    units: list[str],
    model: NgramModel,
    first: Column | None = None,
    needed: DataFrame | None = None,
    broadcast_rows: int = BROADCAST_ROWS,
) -> DataFrame:
    """(units.., n_targets, sum_logp_<model>..) over targets of ``tokens`` from ``max(first, 1)``.

    The probabilities of the distinct n-grams are written once and counted. A small table is
    broadcast: then every target meets its probability where it is, and sums start in the task.
    A larger one is joined by shuffle, behind a count of each unit's distinct n-grams: rows are
    placed by unit while they are still packed, so that count moves nothing more. N-grams that
    more than one in ``broadcast_rows`` of all targets hold are fewer than ``broadcast_rows``,
    whatever the corpus; they meet their probability by broadcast. So the shuffle joins only
    n-grams too rare to fill a task.

    ``needed`` may name a table of n-grams known to hold all targets, such as the model's own
    counts for its training text.
    """
    positions = codec.target_positions(F.col("tokens"), F.lit(1) if first is None else first)

    def exploded(df: DataFrame) -> DataFrame:
        return df.select(*units, "tokens", F.explode_outer(positions).alias("_p")).select(
            *units,
            F.when(F.col("_p").isNotNull(), codec.ngrams(F.col("tokens"), F.col("_p"))).alias("key"),
        )

    if needed is None:
        needed = uses = cut_lineage(used(exploded(rows)), "used-ngrams")
    else:
        uses = None
    probs = cut_lineage(model.log_probs(needed), "log-probs")
    if probs.count() <= broadcast_rows:
        targets = exploded(rows).withColumn("_times", F.when(F.col("key").isNotNull(), 1).otherwise(0))
        scored = targets.join(F.broadcast(probs), "key", "left")
    else:
        if uses is None:
            uses = cut_lineage(used(exploded(rows)), "used-ngrams")
        placed = exploded(rows.repartition(*[F.col(u) for u in units]))
        targets = placed.groupBy(*units, "key").agg(F.count("key").alias("_times"))
        scored = join_in_two(targets, probs, uses, broadcast_rows)
    return (
        scored
        .groupBy(*units)
        .agg(
            F.sum("_times").alias("n_targets"),
            *[
                F.sum(F.col("_times") * F.col(f"logp_{m}")).alias(f"sum_logp_{m}")
                for m in model.models
            ],
        )
    )
