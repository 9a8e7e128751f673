"""Losses, perplexity and throughput as tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from corpusforge.functions.codec import idiv
from corpusforge.operators.loader import place_of_window
from corpusforge.operators.ngram import NgramModel
from corpusforge.operators.prefix import previous_value
from corpusforge.operators.scoring import score_units


def token_logprob(window_rows: DataFrame, model: NgramModel) -> DataFrame:
    """(shard_idx, w, n_targets, sum_logp_<model>..) of every window."""
    return score_units(window_rows.select("shard_idx", "w", "tokens"), ["shard_idx", "w"], model)


def batch_losses(
    window_rows: DataFrame, batch_size: int, model: NgramModel, needed: DataFrame | None = None
) -> DataFrame:
    """(shard_idx, batch, loss_<model>..): mean loss per token of each batch of windows."""
    rows = window_rows.select(
        "shard_idx",
        place_of_window(F.col("w"), batch_size, 1)["batch"].alias("batch"),
        "tokens",
    )
    sums = score_units(rows, ["shard_idx", "batch"], model, needed=needed)
    return sums.select(
        "shard_idx",
        "batch",
        *[(-F.col(f"sum_logp_{m}") / F.col("n_targets")).alias(f"loss_{m}") for m in model.models],
    )


def loss_and_perplexity(logprobs: DataFrame, models: tuple[str, ...]) -> DataFrame:
    """(model, loss, ppl): mean loss per token over all given windows, and its exponential."""
    means = logprobs.agg(
        *[(-F.sum(f"sum_logp_{m}") / F.sum("n_targets")).alias(m) for m in models]
    )
    long = means.unpivot([], list(models), "model", "loss")
    return long.withColumn("ppl", F.exp("loss"))


def scheduled_losses(
    losses: DataFrame, schedule: DataFrame, batch_size: int, seq_len: int
) -> DataFrame:
    """The schedule's rows with the losses of the batches they read.

    Both sides hold about a row per batch of the corpus, and Spark takes a schedule for as small as
    the visits it is unfolded from, so neither is left to its choice of a broadcast.
    """
    at = schedule.withColumn(
        "batch", idiv(F.col("pos"), F.lit(batch_size * seq_len).cast("long"))
    )
    return at.join(losses.hint("merge"), ["shard_idx", "batch"])


def step_loss(scheduled: DataFrame, grad_accum: int, model: str) -> DataFrame:
    """(step, loss): mean over a rank's micro-batches, then over ranks."""
    per_rank = (
        scheduled.withColumn("step", idiv(F.col("micro_step"), F.lit(grad_accum).cast("long")))
        .groupBy("step", "rank")
        .agg(F.avg(f"loss_{model}").alias("loss"))
    )
    return per_rank.groupBy("step").agg(F.avg("loss").alias("loss"))


def stepped_val_loss(scheduled: DataFrame, models: tuple[str, ...]) -> DataFrame:
    """(model, loss, ppl) of the scheduled validation batches: per rank, then over ranks."""
    per_rank = scheduled.groupBy("rank").agg(*[F.avg(f"loss_{m}").alias(m) for m in models])
    means = per_rank.agg(*[F.avg(m).alias(m) for m in models])
    return means.unpivot([], list(models), "model", "loss").withColumn("ppl", F.exp("loss"))


def masked_loss(examples: DataFrame, batched: DataFrame, model: NgramModel, name: str) -> DataFrame:
    """(epoch, batch, loss): summed loss over answer tokens by their number, per whole batch.

    An example's sums do not depend on its batch, so they are made once and joined to every epoch.
    """
    sequences = examples.select("item_id", "tokens", "answer_start")
    sums = score_units(sequences, ["item_id"], model, first=F.col("answer_start"))
    return (
        batched.select("epoch", "batch", "item_id")
        .join(sums, "item_id")
        .groupBy("epoch", "batch")
        .agg((-F.sum(f"sum_logp_{name}") / F.sum("n_targets")).alias("loss"))
    )


def run_throughput(log: DataFrame, batch_tokens: int, log_every: int = 10) -> DataFrame:
    """(run_id, step, tokens_per_sec, ms_per_step) per log window, null on a run's first row.

    ``log`` has (run_id, step, ts). The time of a window is that between neighbouring log rows.
    """
    logged = log.where(F.col("step") % log_every == 0)
    with_before = previous_value(logged, ["run_id"], "step", F.unix_micros("ts"), "_before")
    seconds = (F.unix_micros("ts") - F.col("_before")) / 1e6
    return with_before.select(
        "run_id",
        "step",
        (F.lit(float(batch_tokens * log_every)) / seconds).alias("tokens_per_sec"),
        (seconds / float(log_every) * 1000.0).alias("ms_per_step"),
    )
