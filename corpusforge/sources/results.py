"""Result tables, one set of rows per model, and metric tables, one set of rows per run and name."""

from __future__ import annotations

import time
import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

RESULT_SCHEMA = "model string, dataset string, correct long, total long, accuracy double"
METRIC_SCHEMA = "run_id string, step long, ts timestamp, name string, value double"


def append_results(board: DataFrame, path: str) -> None:
    """Write each model's rows in place of its former ones; the constant random row is not stored."""
    rows = board.where(F.col("total").isNotNull())
    rows.select("dataset", "correct", "total", "accuracy", "model").write.mode("overwrite").option(
        "partitionOverwriteMode", "dynamic"
    ).partitionBy("model").parquet(path)


def read_results(spark: SparkSession, path: str) -> DataFrame:
    rows = spark.read.schema(RESULT_SCHEMA).parquet(path)
    return rows.select("model", "dataset", "correct", "total", "accuracy")


def write_metrics(values: DataFrame, path: str, name: str, run_id: str | None = None) -> None:
    """Write rows of (step, value) under a run and a metric name, in place of those written before.

    So a repeated or restarted write leaves one set of rows to read. ``run_id`` may be a column of the
    values instead; ``ts`` is the time of writing unless the values have one. Each call writes a folder
    of its own, whatever the number of its runs; of a run's folders the last one written counts, so
    jobs that write other runs at the same time do not meet.
    """
    run = F.col("run_id").cast("string") if run_id is None else F.lit(run_id)
    ts = F.col("ts").cast("timestamp") if "ts" in values.columns else F.current_timestamp()
    rows = values.select(
        run.alias("run_id"),
        F.lit(name).alias("name"),
        F.col("step").cast("long"),
        ts.alias("ts"),
        F.col("value").cast("double"),
    )
    rows.write.partitionBy("name").parquet(f"{path.rstrip('/')}/written={time.time_ns():020d}-{uuid.uuid4().hex}")


def read_metrics(spark: SparkSession, path: str, name: str | None = None) -> DataFrame:
    """(run_id, step, ts, name, value), of one metric or all; other metrics are not read."""
    rows = spark.read.schema(f"{METRIC_SCHEMA}, written string").parquet(path)
    rows = rows if name is None else rows.where(F.col("name") == name)
    last = rows.groupBy(F.col("name").alias("_name"), F.col("run_id").alias("_run")).agg(F.max("written").alias("_last"))
    same = (F.col("name") == F.col("_name")) & F.col("run_id").eqNullSafe(F.col("_run")) & (F.col("written") == F.col("_last"))
    return rows.join(last, same, "left_semi").select("run_id", "step", "ts", "name", "value")
