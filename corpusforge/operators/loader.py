"""Which reader gets which tokens at which step, as tables instead of a moving cursor."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import LongType

from corpusforge.functions import codec
from corpusforge.functions.codec import idiv
from corpusforge.operators.prefix import exclusive_prefix
from corpusforge.session import cut_lineage, tasks_for

# Shard numbers below 2**40; a rank's shards are summed in groups of at most 2**20 rows.
SHARD_BITS = 40

# Up to this many readings are broadcast; a moved row takes this many bytes beside its tokens.
BROADCAST_READINGS = 400_000
ROW_BYTES = 64

VAL_STEPS = 20
VAL_EVERY = 250
LOG_EVERY = 10


def windows(pieces: DataFrame, batch_size: int, seq_len: int) -> DataFrame:
    """(split, shard_idx, w, tokens): the T+1 ids of every whole window of every shard.

    Window ``w`` of a shard holds ids ``wT .. wT+T``: inputs are all but the last, targets all
    but the first. Windows cross document borders, never shard borders, and a shard holds whole
    batches of them. A window inside one document is cut in place; only windows that straddle
    documents are regrouped, so the shuffle carries the border windows alone.
    """
    T = seq_len
    lo, hi, w = F.col("lo"), F.col("hi"), F.col("w")
    n_windows = idiv(F.col("shard_len") - 1, batch_size * T) * batch_size
    first = idiv(F.greatest(lo - 1, F.lit(0)), T)
    last = F.least(n_windows - 1, idiv(hi - 1, T))
    parts = (
        pieces.withColumn("_first", first)
        .withColumn("_last", last)
        .where("_last >= _first")
        .withColumn("w", F.explode(F.sequence("_first", "_last")))
        .withColumn("_a", F.greatest(lo, w * T))
        .withColumn("_n", F.least(hi, w * T + (T + 1)) - F.col("_a"))
        .select(
            "split",
            "shard_idx",
            "w",
            "_a",
            "_n",
            codec.cut(F.col("tokens"), F.col("_a") - lo, F.col("_n")).alias("tokens"),
        )
    )
    inside = parts.where(F.col("_n") == T + 1).select("split", "shard_idx", "w", "tokens")
    across = (
        parts.where(F.col("_n") < T + 1)
        .groupBy("split", "shard_idx", "w")
        .agg(F.expr("listagg(tokens) within group (order by _a)").alias("tokens"))
    )
    return inside.unionByName(across)


def inputs_and_targets(window_rows: DataFrame) -> DataFrame:
    """Add ``x`` and ``y``: the window's ids without the last, and without the first."""
    n = codec.n_ids(F.col("tokens"))
    head = codec.cut(F.col("tokens"), F.lit(0), n - 1)
    tail = codec.cut(F.col("tokens"), F.lit(1), n - 1)
    return window_rows.withColumn("x", codec.ids(head)).withColumn("y", codec.ids(tail))


def place_of_window(w: Column, batch_size: int, n_ranks: int) -> dict[str, Column]:
    """Batch number in the shard, owning rank, the rank's own batch count, row in the batch."""
    batch = idiv(w, batch_size)
    return {
        "batch": batch,
        "rank": batch % n_ranks,
        "k": idiv(batch, n_ranks),
        "row_in_batch": w % batch_size,
    }


def loader_plan(shards: DataFrame, batch_size: int, seq_len: int, n_ranks: int) -> DataFrame:
    """(split, rank, shard_idx, n_tokens, n_batches, unused_tokens) from (split, shard_idx, n_tokens).

    A rank reads a shard until its own next stride would run past the end, so ranks may leave a
    shard after different numbers of batches. A shard too short for a rank's first batch counts
    zero. ``unused_tokens`` is what no rank reads as input.
    """
    tokens_per_batch = batch_size * seq_len
    whole = idiv(F.col("n_tokens") - 1, tokens_per_batch)

    def batches(rank: Column) -> Column:
        more = F.greatest(F.lit(1).cast("long"), idiv(whole - rank, n_ranks))
        return F.when(whole >= rank + 1, more).otherwise(F.lit(0).cast("long"))

    ranks = F.sequence(F.lit(0).cast("long"), F.lit(n_ranks - 1).cast("long"))
    read = F.aggregate(
        F.transform(ranks, batches), F.lit(0).cast("long"), lambda acc, x: acc + x
    )
    return (
        shards.withColumn("rank", F.explode(ranks))
        .withColumn("n_batches", batches(F.col("rank")))
        .withColumn("unused_tokens", F.col("n_tokens") - read * tokens_per_batch)
        .select("split", "rank", "shard_idx", "n_tokens", "n_batches", "unused_tokens")
    )


def _turns(plan: DataFrame, horizon: Column | None, epochs: int | None) -> DataFrame:
    """Each (rank, epoch, shard) visit with the rank's micro-step it starts at.

    The visits of an endless cycle over the shards are cut after ``epochs`` passes or at
    ``horizon`` micro-steps.
    """
    counted = exclusive_prefix(
        plan, "shard_idx", "n_batches", "before", by=["rank"], total="per_epoch", id_bits=SHARD_BITS
    ).where("n_batches > 0")
    if horizon is None:
        passes = F.lit(epochs).cast("long")
    else:
        counted = counted.withColumn("horizon", horizon.cast("long")).where("horizon > 0")
        passes = idiv(F.col("horizon") + F.col("per_epoch") - 1, F.col("per_epoch"))
    visits = (
        counted.withColumn("_passes", passes)
        .withColumn("epoch", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_passes") - 1)))
        .withColumn("m0", F.col("epoch") * F.col("per_epoch") + F.col("before"))
        .withColumn("m1", F.col("m0") + F.col("n_batches"))
        .drop("_passes")
    )
    if horizon is None:
        return visits
    return visits.where("m0 < horizon").withColumn("m1", F.least("m1", "horizon"))


def loader_schedule(
    plan: DataFrame,
    batch_size: int,
    seq_len: int,
    n_ranks: int,
    micro_steps: int | Column | None = None,
    epochs: int | None = None,
) -> DataFrame:
    """(rank, micro_step, epoch, shard_idx, pos): every batch each rank reads, in its own order."""
    if (micro_steps is None) == (epochs is None):
        raise ValueError("give either micro_steps or epochs")
    horizon = F.lit(micro_steps) if isinstance(micro_steps, int) else micro_steps
    m = F.col("micro_step")
    pos = (F.col("rank") + (m - F.col("m0")) * n_ranks) * (batch_size * seq_len)
    return (
        _turns(plan, horizon, epochs)
        .withColumn("micro_step", F.explode(F.sequence("m0", F.col("m1") - 1)))
        .select("rank", "micro_step", "epoch", "shard_idx", pos.alias("pos"))
    )


def val_batches(
    val_plan: DataFrame, batch_size: int, seq_len: int, n_ranks: int, val_steps: int = VAL_STEPS
) -> DataFrame:
    """The same leading batches of the validation split that every validation reads."""
    return loader_schedule(
        val_plan, batch_size, seq_len, n_ranks, micro_steps=val_steps
    ).select("rank", "micro_step", "shard_idx", "pos")


def scheduled_windows(
    window_rows: DataFrame, schedule: DataFrame, batch_size: int, seq_len: int
) -> DataFrame:
    """The windows that the schedule reads, each once; others go before anything is made of them."""
    batch = idiv(F.col("pos"), F.lit(batch_size * seq_len).cast("long")).alias("_batch")
    read = schedule.select("shard_idx", batch).distinct()
    place = place_of_window(F.col("w"), batch_size, 1)
    rows = window_rows.withColumn("_batch", place["batch"])
    return rows.join(read, ["shard_idx", "_batch"], "left_semi").drop("_batch")


def training_batches(
    window_rows: DataFrame,
    schedule: DataFrame,
    batch_size: int,
    seq_len: int,
    grad_accum: int,
    start_step: int = 0,
) -> DataFrame:
    """(rank, step, micro_step, row_in_batch, tokens): the rows of every batch a rank reads.

    ``inputs_and_targets`` makes x and y of the tokens. ``start_step`` resumes: earlier steps are
    dropped from the schedule before any window is moved. A window meets each of its readings by
    (shard, batch), so a second epoch costs one more row, not another scan. The readings are written
    once; a few are broadcast, many meet their windows in as many tasks as their bytes need.
    """
    batch = idiv(F.col("pos"), F.lit(batch_size * seq_len).cast("long"))
    step = idiv(F.col("micro_step"), F.lit(grad_accum).cast("long"))
    readings = (
        schedule.withColumn("step", step)
        .where(F.col("step") >= start_step)
        .select("rank", "step", "micro_step", "shard_idx", batch.alias("batch"))
    )
    place = place_of_window(F.col("w"), batch_size, 1)
    rows = window_rows.select(
        "shard_idx", place["batch"].alias("batch"), place["row_in_batch"].alias("row_in_batch"), "tokens"
    )
    # Written and counted, since Spark takes a schedule for as small as the visits it is unfolded from.
    readings = cut_lineage(readings, "readings")
    n = readings.count()
    if n <= BROADCAST_READINGS:
        met = rows.join(F.broadcast(readings), ["shard_idx", "batch"])
    else:
        tasks = tasks_for(rows.sparkSession, n * batch_size * (2 * (seq_len + 1) + ROW_BYTES))
        rows, readings = (side.repartition(tasks, "shard_idx", "batch") for side in (rows, readings))
        met = rows.join(readings.hint("merge"), ["shard_idx", "batch"])
    return met.select("rank", "step", "micro_step", "row_in_batch", "tokens")


def micro_steps_per_step(batch_tokens: int, batch_size: int, seq_len: int, n_ranks: int) -> int:
    per_micro = batch_size * seq_len * n_ranks
    if batch_tokens <= 0 or batch_tokens % per_micro:
        raise ValueError(f"batch_tokens {batch_tokens} is not a multiple of {per_micro}")
    return batch_tokens // per_micro


def with_split_tokens(plan: DataFrame) -> DataFrame:
    """Add ``split_tokens``: all tokens of the plan's shards, for horizons of one corpus pass."""
    sums = exclusive_prefix(
        plan, "shard_idx", "n_tokens", "_before", by=["rank"], total="split_tokens",
        id_bits=SHARD_BITS,
    )
    return sums.drop("_before")


def step_layout(
    plan: DataFrame,
    batch_size: int,
    seq_len: int,
    n_ranks: int,
    batch_tokens: int,
    total_tokens: int | None = None,
    start_step: int = 0,
    val_every: int = VAL_EVERY,
    log_every: int = LOG_EVERY,
) -> DataFrame:
    """(rank, step, n_micro, n_tokens, first_shard, last_shard, is_val, is_log).

    Each visit of a rank to a shard is a run of micro-steps, so its steps follow by arithmetic
    on the run's ends and no row per micro-step is made. ``total_tokens`` defaults to one pass
    over the plan's shards; ``start_step`` resumes without replaying earlier data.
    """
    grad_accum = micro_steps_per_step(batch_tokens, batch_size, seq_len, n_ranks)
    if total_tokens is None:
        plan, tokens = with_split_tokens(plan), F.col("split_tokens")
    else:
        tokens = F.lit(total_tokens).cast("long")
    horizon = idiv(tokens, batch_tokens) * grad_accum
    step = F.col("step")
    n_micro = F.least("m1", (step + 1) * grad_accum) - F.greatest("m0", step * grad_accum)
    return (
        _turns(plan, horizon, None)
        .withColumn(
            "step",
            F.explode(F.sequence(idiv(F.col("m0"), grad_accum), idiv(F.col("m1") - 1, grad_accum))),
        )
        .where(step >= start_step)
        .groupBy("rank", "step")
        .agg(
            F.sum(n_micro).alias("n_micro"),
            F.min_by("shard_idx", "m0").alias("first_shard"),
            F.max_by("shard_idx", "m0").alias("last_shard"),
        )
        .select(
            "rank",
            "step",
            "n_micro",
            (F.col("n_micro") * (batch_size * seq_len)).alias("n_tokens"),
            "first_shard",
            "last_shard",
            (step % val_every == 0).alias("is_val"),
            (step % log_every == 0).alias("is_log"),
        )
    )


@F.arrow_udf(LongType())
def id_sum(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    """The sum of each token binary's ids, without a list of them."""
    for batch in batches:
        tokens = batch.cast(pa.large_binary())
        _, where, data = tokens.buffers()
        ends = np.frombuffer(where, np.int64)[tokens.offset : tokens.offset + len(tokens) + 1]
        raw = np.zeros(0, np.uint8) if data is None else np.frombuffer(data, np.uint8)[ends[0] : ends[-1]]
        running = np.append(0, np.cumsum(raw.view(">u2"), dtype=np.int64))
        at = (ends - ends[0]) // 2
        yield pa.array(running[at[1:]] - running[at[:-1]], pa.int64())


def window_summary(window_rows: DataFrame, names: tuple[str, ...] = ("shard_idx", "w")) -> DataFrame:
    """(names.., sum_x, sum_y, first_id, last_id)."""
    tokens = F.col("tokens")
    first = F.nullif(F.substring(tokens, 1, 2), F.lit(b""))
    last = F.nullif(codec.last_ids(tokens, 1), F.lit(b""))
    total = id_sum(tokens)
    return (
        window_rows.select(*names, total.alias("_total"), codec.id_of(first).alias("first_id"), codec.id_of(last).alias("last_id"))
        .select(
            *names,
            (F.col("_total") - F.col("last_id")).alias("sum_x"),
            (F.col("_total") - F.col("first_id")).alias("sum_y"),
            "first_id",
            "last_id",
        )
    )
