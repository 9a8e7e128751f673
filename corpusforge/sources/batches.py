"""Training batches as files that a rank reads in its own order."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from corpusforge.functions.codec import idiv

BATCH_SCHEMA = "rank long, block long, step long, micro_step long, row_in_batch long, tokens binary"
STEPS_PER_FILE = 100


def write_batches(rows: DataFrame, path: str, steps_per_file: int = STEPS_PER_FILE) -> None:
    """Write rows of (rank, step, micro_step, row_in_batch, tokens), one sorted file per rank and block of steps.

    Blocks hold equally many tokens, so placing rows by block is even.
    """
    blocks = rows.withColumn("block", idiv(F.col("step"), F.lit(steps_per_file).cast("long")))
    placed = blocks.repartition("rank", "block").sortWithinPartitions("rank", "block", "step", "micro_step", "row_in_batch")
    placed.write.mode("overwrite").partitionBy("rank", "block").parquet(path)


def read_batches(
    spark: SparkSession, path: str, rank: int, first_step: int = 0, steps_per_file: int = STEPS_PER_FILE
) -> DataFrame:
    """(step, micro_step, row_in_batch, tokens) of one rank from a step on; earlier files are not opened."""
    rows = spark.read.schema(BATCH_SCHEMA).parquet(path)
    mine = rows.where((F.col("rank") == rank) & (F.col("block") >= first_step // steps_per_file))
    return mine.where(F.col("step") >= first_step).select("step", "micro_step", "row_in_batch", "tokens")
