"""Every registered query as a function of (spark, folder)."""

from __future__ import annotations

import functools
import uuid
from collections.abc import Callable

import numpy as np
import pandas as pd
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from corpusforge.functions import codec
from corpusforge.operators import bpe, loader, mcq, metrics, ngram, pack, sft
from corpusforge.operators.tokenize import BYTES, pretoken_dictionary, token_unigrams, tokenize, tokenize_parts
from corpusforge.plans import stages
from corpusforge.session import cut_lineage, dealt, shared_dir, spread
from corpusforge.sources import batches, fixtures, results, shards
from corpusforge.sources.corpus import read_documents, read_ranks
from corpusforge.streaming import packer

# Parameters of the catalogue. The SQL twins use the same numbers.
SHARD = 100_000
B, T, RANKS = 4, 64, 2
BATCH_TOKENS = 2_048
EPOCHS = 2
SFT_EPOCHS = 2
SFT_WEIGHT = 5
TOP_K, TEMPERATURE = 5, 1.0
SEED = 0
MERGES = 64
MANY_MERGES = 5_000
RANK_FILE, GPT2_EOT = "byte_bpe_50k.tiktoken", 50_256
RESUME_STEP = 100
USER_CONTEXT = 128
MODELS = ("base", "finetuned", "sft_only")


def documents(spark: SparkSession, sf: str) -> DataFrame:
    return read_documents(spark, f"{sf}/documents.parquet")


def fresh_folder(spark, name):
    return f"{shared_dir(spark).rstrip('/')}/corpusforge/{name}-{uuid.uuid4().hex}"


def tokenized(spark, sf):
    return tokenize(documents(spark, sf))


def offsets(spark, sf):
    return pack.doc_offsets(tokenized(spark, sf))


def pieces(spark, sf):
    return pack.shard_pieces(offsets(spark, sf), SHARD)


def manifest(spark, sf):
    return pack.shard_manifest(pieces(spark, sf).drop("tokens"), SHARD)


def windows(spark, sf, split=None):
    if split == "val":  # shard 0 only: later documents are counted, not moved
        rows = pack.shard_pieces(pack.doc_offsets(tokenized(spark, sf), below=SHARD), SHARD)
    else:
        rows = pieces(spark, sf)
    return loader.windows(rows if split is None else rows.where(F.col("split") == split), B, T)


def plan(spark, sf, split=None):
    rows = manifest(spark, sf)
    if split is not None:
        rows = rows.where(F.col("split") == split)
    return loader.loader_plan(rows, B, T, RANKS)


def sciq_rows(spark, sf):
    turns = spark.read.schema(fixtures.CONVERSATIONS).parquet(f"{sf}/conversations.parquet")
    return fixtures.sciq_shaped(turns)


def arc_rows(spark, sf):
    texts = spark.read.schema(fixtures.BENCHMARK).parquet(f"{sf}/benchmark.parquet")
    return fixtures.arc_shaped(texts)


def written_sciq(spark, sf):
    """The derived question rows as a table, for queries that both tune and score on them."""
    return cut_lineage(dealt(sciq_rows(spark, sf)), "sciq")


def items(spark, sf, sciq=None):
    sciq = sciq_rows(spark, sf) if sciq is None else sciq
    return mcq.from_sciq(sciq).unionByName(mcq.from_arc(arc_rows(spark, sf)))


def train_examples(spark, sf, sciq=None):
    sciq = sciq_rows(spark, sf) if sciq is None else sciq
    return sft.sft_examples(sciq.where("split = 'train'"))


def base_counts(spark, sf):
    return ngram.count_keys(ngram.targets(windows(spark, sf, "train")))


def sft_counts(spark, sf, sciq=None):
    examples = train_examples(spark, sf, sciq)
    return ngram.count_keys(ngram.targets(examples, first=F.col("answer_start")))


def mixed_counts(spark, sf, sciq=None):
    return ngram.mix_counts(base_counts(spark, sf), sft_counts(spark, sf, sciq), SFT_WEIGHT)


def base_model(spark, sf):
    counts = base_counts(spark, sf).withColumnRenamed("n", "base")
    return ngram.fit(counts, ("base",), BYTES.vocab_size)


def all_models(spark, sf, sciq=None):
    return ngram.fit(mixed_counts(spark, sf, sciq), MODELS, BYTES.vocab_size)


# --- corpus ------------------------------------------------------------------------------


def doc_token_counts(spark, sf):
    return tokenized(spark, sf).select("doc_id", "n_tokens")


def corpus_totals(spark, sf):
    return pack.corpus_totals(tokenize_parts(spread(documents(spark, sf))), SHARD, BYTES.vocab_size)


def doc_offsets(spark, sf):
    return offsets(spark, sf).select("doc_id", "start", "n_tokens")


def shard_pieces(spark, sf):
    return pieces(spark, sf).select("doc_id", "shard_idx", "lo", "hi")


def spilled_docs(spark, sf):
    return pack.spilled_docs(pieces(spark, sf))


def words(spark, sf):
    return pretoken_dictionary(spread(documents(spark, sf)))


def unigrams(spark, sf):
    return token_unigrams(tokenize_parts(spread(documents(spark, sf))))


def bpe_merges(spark, sf):
    return bpe.merges_table(spark, bpe.learn_merges(documents(spark, sf), MERGES))


def doc_token_counts_bpe(spark, sf):
    docs = spread(documents(spark, sf))
    tokenizer = bpe.bpe_tokenizer(bpe.learn_merges(docs, MERGES))
    return tokenize(docs, tokenizer).select("doc_id", "n_tokens")


def bpe_merges_5k(spark, sf):
    """A vocabulary of usual size learned from every given text."""
    return bpe.merges_table(spark, bpe.learn_merges(documents(spark, sf), MANY_MERGES))


def _coded(docs, tokenizer):
    return tokenize(docs, tokenizer).select("doc_id", "n_tokens", F.sha2("tokens", 256).alias("tokens_sha256"))


def doc_tokens_bpe_5k(spark, sf):
    """Every document encoded with the learned vocabulary of usual size."""
    docs = documents(spark, sf)
    return _coded(spread(docs), bpe.bpe_tokenizer(bpe.learn_merges(docs, MANY_MERGES)))


def gpt2_tokenizer(spark):
    """The public vocabulary of 50,257 ids: bytes in its own order, the document mark last."""
    ranks = read_ranks(spark, "file://" + public_tokenizers.path(RANK_FILE))
    return bpe.vocabulary_tokenizer(bpe.load_ranks(ranks), GPT2_EOT)


def doc_tokens_gpt2(spark, sf):
    """Every document with the ids of the public vocabulary."""
    return _coded(spread(documents(spark, sf)), gpt2_tokenizer(spark))


def stream_manifest(spark, sf):
    """Every given document packed by the streaming job into a fresh folder."""
    out = fresh_folder(spark, "stream")
    # The pattern matches one file as well as a folder of files.
    stream = packer.read_document_stream(spark, f"{sf}/documents.parque[t]")
    packer.pack_stream(stream, out, SHARD).awaitTermination()
    return packer.streamed_manifest(spark, out, SHARD)


# --- loading -----------------------------------------------------------------------------


def window_summary(spark, sf):
    return loader.window_summary(windows(spark, sf))


def loader_plan(spark, sf):
    return plan(spark, sf).drop("n_tokens")


def loader_schedule(spark, sf):
    return loader.loader_schedule(plan(spark, sf, "train"), B, T, RANKS, epochs=EPOCHS)


def val_batches(spark, sf):
    return loader.val_batches(plan(spark, sf, "val"), B, T, RANKS)


def step_layout(spark, sf):
    return loader.step_layout(plan(spark, sf, "train"), B, T, RANKS, BATCH_TOKENS)


def resumed_layout(spark, sf):
    """The step layout of a run that resumes at a step, without replaying the steps before."""
    return loader.step_layout(plan(spark, sf, "train"), B, T, RANKS, BATCH_TOKENS, start_step=RESUME_STEP)


def training_batches(spark, sf):
    """Sums and ends of x and y of every row that every rank reads in one pass."""
    grad_accum = loader.micro_steps_per_step(BATCH_TOKENS, B, T, RANKS)
    schedule = loader.loader_schedule(plan(spark, sf, "train"), B, T, RANKS, epochs=1)
    rows = loader.training_batches(windows(spark, sf, "train"), schedule, B, T, grad_accum)
    return loader.window_summary(rows, ("rank", "step", "micro_step", "row_in_batch"))


def written_shards(spark, sf):
    """The manifest of shards written to a fresh folder and read back, both splits."""
    out = fresh_folder(spark, "shards")
    shards.write_shards(pieces(spark, sf), out)
    both = shards.read_shards(spark, out, "train").unionByName(shards.read_shards(spark, out, "val"))
    return pack.shard_manifest(both, SHARD)


def stored_batches(spark, sf):
    """The batches of every rank written by the stage and read back rank by rank."""
    folder, out = fresh_folder(spark, "shards"), fresh_folder(spark, "batches")
    shards.write_shards(pieces(spark, sf), folder)
    stages.training_batches(spark, folder, out, B, T, RANKS, BATCH_TOKENS, epochs=1)
    ranks = [batches.read_batches(spark, out, rank).withColumn("rank", F.lit(rank).cast("long")) for rank in range(RANKS)]
    rows = functools.reduce(DataFrame.unionByName, ranks)
    return loader.window_summary(rows, ("rank", "step", "micro_step", "row_in_batch"))


# --- questions ---------------------------------------------------------------------------


def mcq_items(spark, sf):
    return mcq.choice_rows(items(spark, sf)).select(
        "source", "split", "item_id", "choice_idx", "context", "choice"
    )


def mcq_labels(spark, sf):
    return mcq.gold_labels(arc_rows(spark, sf))


def split_counts(spark, sf):
    return mcq.split_counts(items(spark, sf))


def sft_examples(spark, sf):
    total = F.lit(0).cast("long")
    return sft.with_ids_and_mask(train_examples(spark, sf)).select(
        "item_id",
        "n_ids",
        "answer_start",
        F.aggregate("mask", total, lambda acc, v: acc + v).alias("n_loss"),
        F.aggregate("ids", total, lambda acc, v: acc + v).alias("id_sum"),
    )


def batched(spark, sf):
    return sft.assign_batches(train_examples(spark, sf), SFT_EPOCHS, seed=SEED)


def sft_batches(spark, sf):
    return sft.batch_summary(sft.collate(batched(spark, sf)))


# --- model and scores --------------------------------------------------------------------


def ngram_counts(spark, sf):
    return ngram.by_context_length(base_counts(spark, sf))


def ngram_counts_ft(spark, sf):
    return ngram.by_context_length(mixed_counts(spark, sf), "finetuned")


def val_logprobs(spark, sf, model):
    return metrics.token_logprob(windows(spark, sf, "val"), model)


def token_logprob(spark, sf):
    rows = val_logprobs(spark, sf, base_model(spark, sf))
    return rows.select(
        "shard_idx", "w", "n_targets", F.round("sum_logp_base", 6).alias("sum_logp")
    )


def _rounded(df, *names):
    for name in names:
        df = df.withColumn(name, F.round(name, 6))
    return df


def val_loss_ppl(spark, sf):
    model = all_models(spark, sf)
    table_ = metrics.loss_and_perplexity(val_logprobs(spark, sf, model), MODELS)
    return _rounded(table_, "loss", "ppl")


def val_loss_steps(spark, sf):
    model = all_models(spark, sf)
    schedule = cut_lineage(loader.val_batches(plan(spark, sf, "val"), B, T, RANKS), "val-schedule")
    rows = loader.scheduled_windows(windows(spark, sf, "val"), schedule, B, T)
    losses = metrics.batch_losses(rows, B, model)
    at = metrics.scheduled_losses(losses, schedule, B, T)
    return _rounded(metrics.stepped_val_loss(at, MODELS), "loss", "ppl")


def masked_loss(spark, sf):
    examples = cut_lineage(dealt(train_examples(spark, sf)), "examples")
    batches = sft.assign_batches(examples.select("item_id"), SFT_EPOCHS, seed=SEED)
    rows = metrics.masked_loss(examples, batches, base_model(spark, sf), "base")
    return _rounded(rows, "loss")


def step_loss(spark, sf):
    grad_accum = loader.micro_steps_per_step(BATCH_TOKENS, B, T, RANKS)
    train = loader.with_split_tokens(plan(spark, sf, "train"))
    horizon = F.call_function("div", F.col("split_tokens"), F.lit(BATCH_TOKENS)) * grad_accum
    schedule = loader.loader_schedule(train, B, T, RANKS, micro_steps=horizon)
    # The windows are read twice, to count n-grams and to score them, so they are written once.
    rows = cut_lineage(windows(spark, sf, "train"), "windows")
    counts = ngram.count_keys(ngram.targets(rows), "base")
    model = ngram.fit(counts, ("base",), BYTES.vocab_size)
    losses = metrics.batch_losses(rows, B, model, needed=model.counts)
    at = metrics.scheduled_losses(losses, schedule, B, T)
    return _rounded(metrics.step_loss(at, grad_accum, "base"), "loss")


def scores(spark, sf):
    sciq = written_sciq(spark, sf)
    return mcq.choice_scores(items(spark, sf, sciq), all_models(spark, sf, sciq))


def choice_scores(spark, sf):
    return _rounded(
        scores(spark, sf).select("model", "source", "split", "item_id", "choice_idx", "score"), "score"
    )


def mcq_predictions(spark, sf):
    return mcq.predictions(scores(spark, sf))


def mcq_accuracy(spark, sf):
    return _rounded(mcq.accuracy(mcq.predictions(scores(spark, sf))), "accuracy")


def validation_accuracy(spark, sf):
    """The check after an epoch: the first 500 validation rows in source order."""
    sciq = written_sciq(spark, sf)
    validation = mcq.from_sciq(sciq.where("split = 'validation'"))
    scored = mcq.choice_scores(mcq.first_items(validation), all_models(spark, sf, sciq))
    return _rounded(mcq.accuracy(mcq.predictions(scored)), "accuracy")


def results_table(spark, sf):
    return _rounded(mcq.leaderboard(mcq.accuracy(mcq.predictions(scores(spark, sf)))), "accuracy")


def stored_results(spark, sf):
    """The board stored twice, as by a repeated run, and read back: one set of rows per model."""
    out = fresh_folder(spark, "results")
    board = cut_lineage(results_table(spark, sf), "leaderboard")
    for _ in range(2):
        results.append_results(board, out)
    return results.read_results(spark, out)


def step_metrics(spark, sf):
    """The losses by step stored twice as one run's metric, as by a retry, and read back."""
    out = fresh_folder(spark, "metrics")
    values = cut_lineage(step_loss(spark, sf).withColumnRenamed("loss", "value"), "step-losses")
    for _ in range(2):
        results.write_metrics(values, out, "train_loss", "pass-0")
    return results.read_metrics(spark, out, "train_loss").drop("ts")


def plain_length_scorer(batch: pd.DataFrame) -> pd.Series:
    """A stand-in for a network: log P of an id falls with the id's value and the context's sum."""

    def summed(column, value):
        sizes = batch[column].map(len).to_numpy()
        flat = np.concatenate([np.zeros(0), *batch[column]]).astype("float64")
        owner = np.repeat(np.arange(len(sizes)), sizes)
        return np.bincount(owner, value(flat), len(sizes))

    logs = summed("choice_ids", lambda ids: -np.log(ids + 2.0))
    return pd.Series(logs - np.log(summed("ctx_ids", lambda ids: ids) + 1.0))


def user_choice_scores(spark, sf):
    rows = mcq.user_scores(items(spark, sf), plain_length_scorer, "user", USER_CONTEXT)
    return _rounded(
        rows.select("model", "source", "split", "item_id", "choice_idx", "score"), "score"
    )


def next_tokens(spark, sf):
    prompts = items(spark, sf).select(BYTES.encode(F.col("context")).alias("t"))
    contexts = prompts.select(codec.last_ids(F.col("t"), ngram.CONTEXT).alias("context"))
    return base_model(spark, sf).next_token_topk(contexts, "base", TOP_K, TEMPERATURE)


def next_token_topk(spark, sf):
    return next_tokens(spark, sf).select(
        ngram.context_string(F.col("context")).alias("h"),
        codec.id_of(F.col("w")).alias("w"),
        "rnk",
        F.round("p", 9).alias("p"),
    )


def next_token_draw(spark, sf):
    return ngram.next_token_draw(next_tokens(spark, sf), SEED).select(
        ngram.context_string(F.col("context")).alias("h"), codec.id_of(F.col("w")).alias("w")
    )


def run_throughput(spark, sf):
    rows = metrics.run_throughput(fixtures.run_log(spark.read.parquet(f"{sf}/events.parquet")), BATCH_TOKENS)
    return _rounded(rows, "tokens_per_sec", "ms_per_step")


def stored_throughput(spark, sf):
    """The given runs' losses stored as metrics by the stage, and their throughput read from there."""
    out = fresh_folder(spark, "metrics")
    stages.record_runs(fixtures.run_log(spark.read.parquet(f"{sf}/events.parquet")), out)
    rows = stages.throughput_of(spark, out, BATCH_TOKENS)
    return _rounded(rows.withColumn("run_id", F.col("run_id").cast("long")), "tokens_per_sec", "ms_per_step")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "doc_token_counts": doc_token_counts,
    "corpus_totals": corpus_totals,
    "doc_offsets": doc_offsets,
    "shard_pieces": shard_pieces,
    "spilled_docs": spilled_docs,
    "shard_manifest": manifest,
    "pretoken_dictionary": words,
    "token_unigrams": unigrams,
    "bpe_merges": bpe_merges,
    "doc_token_counts_bpe": doc_token_counts_bpe,
    "bpe_merges_5k": bpe_merges_5k,
    "doc_tokens_bpe_5k": doc_tokens_bpe_5k,
    "doc_tokens_gpt2": doc_tokens_gpt2,
    "stream_manifest": stream_manifest,
    "window_summary": window_summary,
    "loader_plan": loader_plan,
    "loader_schedule": loader_schedule,
    "val_batches": val_batches,
    "step_layout": step_layout,
    "resumed_layout": resumed_layout,
    "training_batches": training_batches,
    "written_shards": written_shards,
    "stored_batches": stored_batches,
    "mcq_items": mcq_items,
    "mcq_labels": mcq_labels,
    "split_counts": split_counts,
    "sft_examples": sft_examples,
    "sft_batches": sft_batches,
    "ngram_counts": ngram_counts,
    "ngram_counts_ft": ngram_counts_ft,
    "token_logprob": token_logprob,
    "val_loss_ppl": val_loss_ppl,
    "val_loss_steps": val_loss_steps,
    "masked_loss": masked_loss,
    "step_loss": step_loss,
    "choice_scores": choice_scores,
    "mcq_predictions": mcq_predictions,
    "mcq_accuracy": mcq_accuracy,
    "validation_accuracy": validation_accuracy,
    "results_table": results_table,
    "stored_results": stored_results,
    "step_metrics": step_metrics,
    "user_choice_scores": user_choice_scores,
    "next_token_topk": next_token_topk,
    "next_token_draw": next_token_draw,
    "run_throughput": run_throughput,
    "stored_throughput": stored_throughput,
}
