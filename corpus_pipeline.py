"""The training-data pipeline: documents in, token ids out."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from corpusforge.llm.bpe_codec import encode_decode
from corpusforge.llm.decontaminate import decontaminate
from corpusforge.llm.line_dedup import line_dedup
from corpusforge.llm.simhash_dedup import simhash_near_dedup
from corpusforge.llm.toxicity import toxicity
from corpusforge.session import cut_lineage

VOCABULARY = "word_bpe_49k.json"


def without(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """The documents whose doc_id is not among ``ids``; a null doc_id is an id like any other.

    The ids are written first, so that Spark knows their size: few are broadcast and no document moves.
    """
    gone = cut_lineage(ids.select(F.col("doc_id").alias("gone")).distinct(), "gone")
    return docs.join(gone, docs["doc_id"].eqNullSafe(gone["gone"]), "left_anti")


def clean_of_toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier calls toxic go."""
    scored = toxicity(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return without(docs, scored.where("predicted = 1"))


def new_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that an earlier document holds are cut; every document stays, n_chars follows its text."""
    rest = tuple(name for name in docs.columns if name not in ("doc_id", "text"))
    rows = line_dedup(docs, carry=rest).withColumnRenamed("kept", "text")
    if "n_chars" in docs.columns:
        rows = rows.withColumn("n_chars", F.length("text").cast("long"))
    return rows.select(*docs.columns)


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each component of near copies (five words, 80 %) the document with the smallest doc_id stays."""
    found = simhash_near_dedup(docs)
    return without(docs, found.where(~F.col("doc_id").eqNullSafe(F.col("component_id"))))


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that leak a benchmark item go."""
    return without(docs, decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet")))


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens and the ids (unsigned 32-bit, little end first) of every document left."""
    return encode_decode(docs, public_tokenizers.path(VOCABULARY)).select("doc_id", "n_tokens", "ids")


STAGES = [
    ("toxicity", clean_of_toxicity),
    ("line_dedup", new_lines),
    ("simhash_dedup", one_of_each_group),
    ("decontamination", without_benchmark),
    ("bpe", token_ids),
]

ORACLE_SQL = None  # a fitted classifier and a tokenizer are beyond SQL


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = cut_lineage(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
