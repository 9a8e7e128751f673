"""The packer as a Structured Streaming job: documents in, shard pieces out, batch by batch."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from corpusforge.operators.pack import DEFAULT_SHARD_SIZE, ID_BITS, doc_offsets, shard_manifest, shard_pieces
from corpusforge.operators.tokenize import BYTES, Tokenizer, tokenize
from corpusforge.session import scratch
from corpusforge.sources.corpus import DOCUMENTS

LEDGER = "batch_id long, before long, n_tokens long"
PIECES = "shard_idx long, lo long, hi long, doc_id long, tokens binary, batch_id long"


def read_document_stream(
    spark: SparkSession, path: str, max_files_per_batch: int | None = None
) -> DataFrame:
    reader = spark.readStream.schema(DOCUMENTS)
    if max_files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", max_files_per_batch)
    return reader.parquet(path)


def _table(spark: SparkSession, path: str, schema: str, base: str | None = None) -> DataFrame:
    """The rows under a folder, or none where the folder is missing."""
    try:
        return spark.read.schema(schema).option("basePath", base or path).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def tokens_before(spark: SparkSession, out: str, batch_id: int) -> int:
    """Where a batch begins in the stream.

    A ledger row holds the running total, so the row of the batch before tells it, whatever ran
    earlier. Where that number was never written, the last row below is looked up in the ledger.
    """
    ledger = f"{out}/ledger"
    rows = _table(spark, f"{ledger}/batch_id={batch_id - 1}", LEDGER, ledger).collect() if batch_id else []
    if not rows and batch_id:
        rows = _table(spark, ledger, LEDGER).where(F.col("batch_id") < batch_id).orderBy(F.desc("batch_id")).limit(1).collect()
    return rows[0]["before"] + rows[0]["n_tokens"] if rows else 0


def write_batch(
    batch: DataFrame,
    batch_id: int,
    out: str,
    shard_size: int,
    tokenizer: Tokenizer = BYTES,
    id_bits: int = ID_BITS,
) -> None:
    """Cut one micro-batch behind all earlier ones and write it under its batch number.

    The ledger row of the batch before says where the batch begins, so a replayed batch lands on the
    same tokens and overwrites its own folders. The pieces go first; the ledger row, read back from
    their lengths, completes the batch. A batch reads its own documents and one ledger row, however
    many batches came before, and its intermediate tables go with it.
    """
    spark = batch.sparkSession
    before = tokens_before(spark, out, batch_id)
    target = f"{out}/pieces/batch_id={batch_id}"
    with scratch(spark):
        offsets = doc_offsets(tokenize(batch, tokenizer), id_bits)
        moved = offsets.withColumn("start", F.col("start") + before).withColumn("total", F.col("total") + before)
        pieces = shard_pieces(moved, shard_size).select("shard_idx", "lo", "hi", "doc_id", "tokens")
        pieces.write.mode("overwrite").parquet(target)
    written = spark.read.schema(PIECES).parquet(target)
    n_tokens = F.coalesce(F.sum(F.col("hi") - F.col("lo")), F.lit(0)).alias("n_tokens")
    row = written.agg(n_tokens).select(F.lit(before).cast("long").alias("before"), "n_tokens")
    row.coalesce(1).write.mode("overwrite").parquet(f"{out}/ledger/batch_id={batch_id}")


def pack_stream(
    documents: DataFrame,
    out: str,
    shard_size: int = DEFAULT_SHARD_SIZE,
    tokenizer: Tokenizer = BYTES,
    id_bits: int = ID_BITS,
) -> StreamingQuery:
    """Pack everything that has arrived, in micro-batches, then stop; run again for later files.

    Order in the stream is (batch, doc_id).
    """
    return (
        documents.writeStream.foreachBatch(
            lambda batch, batch_id: write_batch(batch, batch_id, out, shard_size, tokenizer, id_bits)
        )
        .option("checkpointLocation", f"{out}/progress")
        .trigger(availableNow=True)
        .start()
    )


def streamed_pieces(spark: SparkSession, out: str) -> DataFrame:
    """The pieces of all batches named in the ledger."""
    done = _table(spark, f"{out}/ledger", LEDGER).select("batch_id")
    return _table(spark, f"{out}/pieces", PIECES).join(done, "batch_id", "left_semi")


def streamed_manifest(spark: SparkSession, out: str, shard_size: int) -> DataFrame:
    """The manifest so far. Full shards never change; the last one is open while files arrive."""
    return shard_manifest(streamed_pieces(spark, out), shard_size)


def open_shard(manifest: DataFrame, shard_size: int) -> DataFrame:
    """The shard that the next batch would go on filling, if any."""
    return manifest.where(F.col("n_tokens") < shard_size)
