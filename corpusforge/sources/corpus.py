"""Readers of documents and question rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F


# Schemas are stated, so that opening a table costs no job.
DOCUMENTS = "doc_id bigint, text string"
SCIQ = (
    "split string, item_id bigint, support string, question string, correct_answer string, "
    "distractor1 string, distractor2 string, distractor3 string"
)
ARC = (
    "split string, item_id bigint, question string, "
    "choices struct<text: array<string>, label: array<string>>, answerKey string"
)


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, text): only these two columns are read. ``doc_id`` orders the corpus."""
    return spark.read.schema(DOCUMENTS).parquet(path)


def read_sciq(spark: SparkSession, path: str, split: str | None = None) -> DataFrame:
    """Question rows with one correct answer and three distractors, of one split or all."""
    rows = spark.read.schema(SCIQ).parquet(path)
    return rows if split is None else rows.where(rows.split == split)


def read_arc(spark: SparkSession, path: str, split: str | None = None) -> DataFrame:
    """Question rows with nested choices and an answer key, of one split or all."""
    rows = spark.read.schema(ARC).parquet(path)
    return rows if split is None else rows.where(rows.split == split)


def read_ranks(spark: SparkSession, path: str) -> DataFrame:
    """(token, id) of a public rank file: one line per token, its bytes in base 64, a blank, its id."""
    parts = F.split("value", " ")
    return spark.read.text(path).where("value != ''").select(
        F.unbase64(parts[0]).alias("token"), parts[1].cast("int").alias("id")
    )
