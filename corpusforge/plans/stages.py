"""The four stages end to end: prepare shards, lay out training, tune counts, evaluate."""

from __future__ import annotations

import contextlib
import functools
from collections.abc import Callable

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F

from corpusforge.operators import loader, mcq, metrics, ngram, pack, sft
from corpusforge.operators.tokenize import BYTES, Tokenizer, check_ids, tokenize
from corpusforge.session import cut_lineage, scratch
from corpusforge.sources import batches as batch_io, shards as shard_io
from corpusforge.sources.corpus import read_documents
from corpusforge.sources.results import append_results, read_metrics, write_metrics


def computed(report: DataFrame) -> DataFrame:
    """A report of a few rows per model and data set, computed now and free of its sources."""
    return report.sparkSession.createDataFrame(report.collect(), report.schema)


def prepare_shards(
    spark: SparkSession,
    documents_path: str,
    shards_path: str,
    shard_size: int = pack.DEFAULT_SHARD_SIZE,
    tokenizer: Tokenizer = BYTES,
    id_bits: int = pack.ID_BITS,
) -> DataFrame:
    """Documents to train and validation shards on disk; returns their manifest.

    A tokenizer that cannot count from the text alone is run once and its output written, since
    offsets read the lengths before the tokens.
    """
    with scratch(spark):
        tokenized = tokenize(read_documents(spark, documents_path), tokenizer)
        if tokenizer.count is None:
            tokenized = cut_lineage(tokenized, "tokens")
        offsets = check_ids(pack.doc_offsets(tokenized, id_bits), tokenizer.vocab_size)
        pieces = pack.shard_pieces(offsets, shard_size)
        shard_io.write_shards(pieces, shards_path)
    written = spark.read.schema(shard_io.SHARD_SCHEMA).parquet(shards_path)
    return pack.with_sizes_in_mib(pack.shard_manifest(written, shard_size))


def training_layout(
    spark: SparkSession,
    shards_path: str,
    batch_size: int,
    seq_len: int,
    n_ranks: int,
    batch_tokens: int,
    total_tokens: int | None = None,
    start_step: int = 0,
) -> tuple[DataFrame, DataFrame]:
    """(windows, steps) of the train split: what every rank reads, and at which step."""
    pieces = shard_io.read_shards(spark, shards_path, "train")
    shards = pieces.groupBy("split", "shard_idx").agg(F.max("shard_len").alias("n_tokens"))
    plan = loader.loader_plan(shards, batch_size, seq_len, n_ranks)
    steps = loader.step_layout(
        plan, batch_size, seq_len, n_ranks, batch_tokens, total_tokens, start_step
    )
    return loader.windows(pieces, batch_size, seq_len), steps


def training_batches(
    spark: SparkSession,
    shards_path: str,
    batches_path: str,
    batch_size: int,
    seq_len: int,
    n_ranks: int,
    batch_tokens: int,
    epochs: int | None = None,
    micro_steps: int | None = None,
    start_step: int = 0,
) -> None:
    """Write the batches of every rank, in files that ``sources.batches.read_batches`` reads in order.

    Whole passes over the train split, or ``micro_steps`` of an endless cycle over it; a resumed run
    names its ``start_step`` and earlier rows are not moved.
    """
    pieces = shard_io.read_shards(spark, shards_path, "train")
    shards = pieces.groupBy("split", "shard_idx").agg(F.max("shard_len").alias("n_tokens"))
    plan = loader.loader_plan(shards, batch_size, seq_len, n_ranks)
    schedule = loader.loader_schedule(plan, batch_size, seq_len, n_ranks, micro_steps, epochs)
    grad_accum = loader.micro_steps_per_step(batch_tokens, batch_size, seq_len, n_ranks)
    windows = loader.windows(pieces, batch_size, seq_len)
    with scratch(spark):
        rows = loader.training_batches(windows, schedule, batch_size, seq_len, grad_accum, start_step)
        batch_io.write_batches(rows, batches_path)


def record_runs(log: DataFrame, metrics_path: str) -> None:
    """Store a training log of (run_id, step, ts, loss) as metrics; a repeated call changes nothing."""
    write_metrics(log.withColumnRenamed("loss", "value"), metrics_path, "train_loss")


def throughput_of(spark: SparkSession, metrics_path: str, batch_tokens: int, log_every: int = 10) -> DataFrame:
    """(run_id, step, tokens_per_sec, ms_per_step) of the stored runs, from the times of their losses."""
    return metrics.run_throughput(read_metrics(spark, metrics_path, "train_loss"), batch_tokens, log_every)


def fit_models(
    windows: DataFrame,
    sciq_train: DataFrame,
    weight: int,
    tokenizer: Tokenizer = BYTES,
    counts_path: str | None = None,
) -> ngram.NgramModel:
    """The base, fine-tuned and tuning-only models over one table of counts, stored at ``counts_path``."""
    examples = sft.sft_examples(sciq_train, tokenizer=tokenizer)
    tuned = ngram.count_keys(ngram.targets(examples, first=F.col("answer_start")))
    counts = ngram.mix_counts(ngram.count_keys(ngram.targets(windows)), tuned, weight)
    with scratch(windows.sparkSession) if counts_path is not None else contextlib.nullcontext():
        return ngram.fit(counts, ("base", "finetuned", "sft_only"), tokenizer.vocab_size, counts_path)


def validation_loss(
    spark: SparkSession, shards_path: str, batch_size: int, seq_len: int, model: ngram.NgramModel
) -> DataFrame:
    """(model, loss, ppl) over the whole validation split."""
    pieces = shard_io.read_shards(spark, shards_path, "val")
    rows = loader.windows(pieces, batch_size, seq_len)
    with scratch(spark):
        return computed(metrics.loss_and_perplexity(metrics.token_logprob(rows, model), model.models))


def evaluate(
    sciq: DataFrame,
    arc: DataFrame,
    model: ngram.NgramModel | None = None,
    results_path: str | None = None,
    tokenizer: Tokenizer = BYTES,
    scorers: dict[str, Callable[[pd.DataFrame], pd.Series]] | None = None,
) -> DataFrame:
    """All models, data sets, items and choices on one board; results are stored when asked.

    ``scorers`` names the user's own models by their scoring functions, see ``mcq.user_scores``.
    """
    if model is None and not scorers:
        raise ValueError("give a model or scorers")
    with scratch(sciq.sparkSession):
        items = mcq.from_sciq(sciq).unionByName(mcq.from_arc(arc))
        scores = [mcq.choice_scores(items, model, tokenizer)] if model is not None else []
        for name, scorer in (scorers or {}).items():
            scores.append(mcq.user_scores(items, scorer, name, tokenizer=tokenizer))
        predicted = mcq.predictions(functools.reduce(DataFrame.unionByName, scores))
        board = computed(mcq.leaderboard(mcq.accuracy(predicted)))
    if results_path is not None:
        append_results(board, results_path)
    return board
