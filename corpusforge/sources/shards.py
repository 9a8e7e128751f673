"""Shards as partitioned Parquet: ``split=<s>/shard_idx=<n>``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

SHARD_SCHEMA = (
    "split string, shard_idx long, lo long, hi long, shard_len long, doc_id long, tokens binary"
)


def write_shards(pieces: DataFrame, path: str, one_file_per_shard: bool = True) -> None:
    """Write shard pieces so that a split, or a shard, is read by pruning folders.

    Shards are all one size, so placing rows by shard is even. Without ``one_file_per_shard``
    the rows are written where the offset step left them, which saves that shuffle and leaves
    about one file per block of documents in a shard.
    """
    rows = pieces
    if one_file_per_shard:
        rows = rows.repartition("shard_idx").sortWithinPartitions("split", "shard_idx", "lo")
    rows.write.mode("overwrite").partitionBy("split", "shard_idx").parquet(path)


def read_shards(spark: SparkSession, path: str, split: str) -> DataFrame:
    """The pieces of one split's shards; an error when there are none."""
    pieces = spark.read.schema(SHARD_SCHEMA).parquet(path).where(F.col("split") == split)
    if pieces.isEmpty():
        raise FileNotFoundError(f"no shards of split {split!r} under {path}")
    return pieces
