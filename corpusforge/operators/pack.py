"""One ordered token stream cut into fixed-size shards."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from corpusforge.functions import codec
from corpusforge.functions.codec import idiv
from corpusforge.operators.prefix import exclusive_prefix

DEFAULT_SHARD_SIZE = 100_000_000

# Shard files carry this stem before their split and number.
FILE_STEM = "fineweb_edu"


# 2**36 documents of a few KB are hundreds of TB; wider ids only cost another level of sums.
ID_BITS = 36
# Documents travel with their tokens, so a block is a few MB and blocks are the unit of parallelism.
DOC_BLOCK_BITS = 8


def doc_offsets(
    tokenized: DataFrame, id_bits: int = ID_BITS, below: int | None = None
) -> DataFrame:
    """Add ``start`` (place of the document's first token in the stream) and ``total``.

    ``doc_id`` orders the corpus and is unique, in 0 .. 2**id_bits - 1; pass 63 for hashed ids.
    ``below`` asks for the documents that start before that token only, such as those of the
    validation shard; the others are counted but not moved.
    """
    return exclusive_prefix(
        tokenized, "doc_id", "n_tokens", "start", total="total",
        id_bits=id_bits, block_bits=DOC_BLOCK_BITS, write_totals=True, below=below, width=2 if "tokens" in tokenized.columns else 0,
    )


def split_of(shard_idx: Column, n_tokens: Column, shard_size: int) -> Column:
    """Shard 0 is validation once it is full; a short last shard is always training data."""
    full_first = (shard_idx == 0) & (n_tokens == shard_size)
    return F.when(full_first, F.lit("val")).otherwise(F.lit("train"))


def file_stem(split: Column, shard_idx: Column) -> Column:
    return F.concat_ws("_", F.lit(FILE_STEM), split, F.format_string("%06d", shard_idx))


def shard_pieces(offsets: DataFrame, shard_size: int) -> DataFrame:
    """One row per (document, shard) overlap: (split, shard_idx, lo, hi, shard_len, doc_id[, tokens]).

    ``lo``/``hi`` count from the shard's first token. A document spills into as many shards as
    it touches. ``shard_len`` follows from the stream's total, so no join is needed for it.
    """
    size = F.lit(shard_size).cast("long")
    start, n = F.col("start"), F.col("n_tokens")
    end = start + n
    shard = F.col("shard_idx")
    touched = F.sequence(idiv(start, size), idiv(end - 1, size))
    cut_from = F.greatest(start, shard * size)
    lo, hi = cut_from - shard * size, F.least(end, (shard + 1) * size) - shard * size
    shard_len = F.least(size, F.col("total") - shard * size)
    columns = [
        split_of(shard, shard_len, shard_size).alias("split"),
        shard,
        lo.alias("lo"),
        hi.alias("hi"),
        shard_len.alias("shard_len"),
        F.col("doc_id"),
    ]
    if "tokens" in offsets.columns:
        columns.append(codec.cut(F.col("tokens"), cut_from - start, hi - lo).alias("tokens"))
    return (
        offsets.where(n > 0).withColumn("shard_idx", F.explode(touched)).select(*columns)
    )


def spilled_docs(pieces: DataFrame) -> DataFrame:
    """(doc_id, n_pieces) of documents that cross a shard border."""
    return (
        pieces.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n_pieces")).where("n_pieces > 1")
    )


def shard_manifest(pieces: DataFrame, shard_size: int) -> DataFrame:
    """(shard_idx, split, file_stem, n_tokens, n_bytes), two bytes per token."""
    n = F.col("n_tokens")
    split = split_of(F.col("shard_idx"), n, shard_size)
    return (
        pieces.groupBy("shard_idx")
        .agg(F.sum(F.col("hi") - F.col("lo")).alias("n_tokens"))
        .select(
            "shard_idx",
            split.alias("split"),
            file_stem(split, F.col("shard_idx")).alias("file_stem"),
            "n_tokens",
            (n * 2).alias("n_bytes"),
        )
    )


def with_sizes_in_mib(manifest: DataFrame) -> DataFrame:
    return manifest.withColumn("mib", F.col("n_bytes") / F.lit(1024.0 * 1024.0))


def corpus_totals(tokenized: DataFrame, shard_size: int, vocab_size: int) -> DataFrame:
    """(n_docs, n_tokens, n_shards, max_id), failing when an id is outside the vocabulary.

    Takes the rows of ``tokenize`` or of ``tokenize_parts``.
    """
    first = F.col("part") == 0 if "part" in tokenized.columns else F.lit(True)
    summed = tokenized.agg(
        F.count_if(first).alias("n_docs"),
        F.sum("n_tokens").alias("n_tokens"),
        F.max(codec.max_id(F.col("tokens"))).cast("long").alias("max_id"),
    )
    guarded = F.when(F.col("max_id") < vocab_size, F.col("max_id")).otherwise(
        F.raise_error(F.lit("token id outside the vocabulary")).cast("long")
    )
    return summed.select(
        "n_docs",
        "n_tokens",
        idiv(F.col("n_tokens") + (shard_size - 1), F.lit(shard_size).cast("long")).alias("n_shards"),
        guarded.alias("max_id"),
    )
