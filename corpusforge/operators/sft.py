"""Fine-tuning rows: truncation, loss masks, shuffled batches, padding, shift."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from corpusforge.functions import codec
from corpusforge.functions.codec import idiv
from corpusforge.functions.text import answer_text, question_context
from corpusforge.operators.prefix import exclusive_prefix
from corpusforge.operators.tokenize import BYTES, Tokenizer

MAX_LEN = 256
BATCH = 16
PAD_ID = 0


def loss_mask(n_ids: Column, answer_start: Column) -> Column:
    """0 before the answer, 1 from its first id on."""
    zero, one = F.lit(0), F.lit(1)
    return F.concat(
        F.array_repeat(zero, answer_start.cast("int")),
        F.array_repeat(one, (n_ids - answer_start).cast("int")),
    )


def sft_examples(
    items: DataFrame, max_len: int = MAX_LEN, tokenizer: Tokenizer = BYTES
) -> DataFrame:
    """(item_id, n_ids, answer_start, tokens) from question rows with ``correct_answer``.

    Context and answer are encoded apart and the document mark ends the answer. Too long a row
    keeps its last ``max_len`` ids; an answer as long as that starts at 0.
    """
    context = tokenizer.encode(question_context(F.col("support"), F.col("question")))
    answer = F.concat(
        tokenizer.encode(answer_text(F.col("correct_answer"))), codec.const_tokens(tokenizer.eot)
    )
    coded = items.select("item_id", context.alias("_ctx"), answer.alias("_ans"))
    n_ctx, n_ans = codec.n_ids(F.col("_ctx")), codec.n_ids(F.col("_ans"))
    sized = coded.select(
        "item_id",
        n_ctx.alias("_n_ctx"),
        n_ans.alias("_n_ans"),
        codec.last_ids(F.concat("_ctx", "_ans"), max_len).alias("tokens"),
    )
    n_all = F.col("_n_ctx") + F.col("_n_ans")
    start = F.when(
        n_all > max_len, F.greatest(F.lit(0).cast("long"), max_len - F.col("_n_ans"))
    ).otherwise(F.col("_n_ctx"))
    return sized.select(
        "item_id",
        F.least(n_all, F.lit(max_len)).cast("long").alias("n_ids"),
        start.cast("long").alias("answer_start"),
        "tokens",
    )


def with_ids_and_mask(examples: DataFrame) -> DataFrame:
    """Add ``ids`` and ``mask`` as arrays."""
    return examples.withColumn("ids", codec.ids(F.col("tokens"))).withColumn(
        "mask", loss_mask(F.col("n_ids"), F.col("answer_start"))
    )


def assign_batches(
    examples: DataFrame, epochs: int, batch_size: int = BATCH, seed: int = 0
) -> DataFrame:
    """Add ``epoch``, ``batch``, ``row_in_batch``: a new reproducible order every epoch.

    The order is that of md5(seed:epoch:item_id). Its first four hex digits split each epoch into
    65,536 even buckets; a row's number is its place in its bucket plus the buckets before.
    """
    digest = F.md5(
        F.concat_ws(":", F.lit(str(seed)), F.col("epoch"), F.col("item_id")).cast("binary")
    )
    rows = (
        examples.withColumn("epoch", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(epochs - 1).cast("long"))))
        .withColumn("_digest", digest)
        .withColumn("_bucket", F.conv(F.substring("_digest", 1, 4), 16, 10).cast("long"))
    )
    sizes = rows.groupBy("epoch", "_bucket").agg(F.count(F.lit(1)).alias("_size"))
    bases = exclusive_prefix(sizes, "_bucket", "_size", "_base", by=["epoch"], id_bits=16)
    inside = Window.partitionBy("epoch", "_bucket").orderBy("_digest", "item_id")
    number = F.col("_base") + F.row_number().over(inside) - 1
    return (
        rows.join(bases.drop("_size"), ["epoch", "_bucket"])
        .withColumn("_number", number)
        .withColumn("batch", idiv(F.col("_number"), F.lit(batch_size).cast("long")))
        .withColumn("row_in_batch", F.col("_number") % batch_size)
        .drop("_digest", "_bucket", "_base", "_number")
    )


def collate(batched: DataFrame) -> DataFrame:
    """Pad ids and mask on the right to the batch's longest row, then shift by one token.

    Adds ``max_len``, ``x`` (all but the last id), ``y`` (all but the first) and ``y_mask``.
    """
    in_batch = Window.partitionBy("epoch", "batch")
    padded = with_ids_and_mask(batched).withColumn("max_len", F.max("n_ids").over(in_batch))
    missing = (F.col("max_len") - F.col("n_ids")).cast("int")
    n = F.col("max_len").cast("int") - 1
    return (
        padded.withColumn("ids", F.concat("ids", F.array_repeat(F.lit(PAD_ID), missing)))
        .withColumn("mask", F.concat("mask", F.array_repeat(F.lit(0), missing)))
        .withColumn("x", F.slice("ids", F.lit(1), n))
        .withColumn("y", F.slice("ids", F.lit(2), n))
        .withColumn("y_mask", F.slice("mask", F.lit(2), n))
    )


def batch_summary(collated: DataFrame) -> DataFrame:
    """(epoch, batch, n_rows, max_len, n_pad, n_loss) of collated batches."""
    on = F.aggregate("y_mask", F.lit(0).cast("long"), lambda acc, v: acc + v)
    return collated.groupBy("epoch", "batch").agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.max("max_len").alias("max_len"),
        F.sum(F.size("ids") - F.col("n_ids")).alias("n_pad"),
        F.sum(on).alias("n_loss"),
    )
