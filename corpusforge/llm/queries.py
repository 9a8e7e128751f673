"""The queries of the dealt operators, as functions of (spark, folder)."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from corpusforge.llm import chat_format
from corpusforge.llm.alignment import cross_tokenizer_alignment
from corpusforge.llm.bpe_codec import encode_decode
from corpusforge.llm.class_model import class_model_scores
from corpusforge.llm.decontaminate import decontaminate
from corpusforge.llm.line_dedup import line_dedup
from corpusforge.llm.periodic_runs import periodic_runs
from corpusforge.llm.quality_rules import quality_rules
from corpusforge.llm.simhash_dedup import hex_fingerprint, simhash_dedup
from corpusforge.llm.substring_dedup import substring_dedup
from corpusforge.llm.suffix_dedup import suffix_dedup
from corpusforge.llm.token_counts import count_tokens
from corpusforge.llm.toxicity import toxicity
from corpusforge.session import cut_lineage

VOCABULARY = "word_bpe_49k.json"
BYTE_BPE, PIECE_BPE = "byte_bpe_50k.json", "piece_bpe_32k.model"
TOKEN_BUDGET = 2048


def documents(spark: SparkSession, sf: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/documents.parquet")


def sha256(name: str):
    return F.sha2(F.col(name).cast("binary"), 256)


def op1_bpe_codec(spark: SparkSession, sf: str) -> DataFrame:
    rows = encode_decode(documents(spark, sf), public_tokenizers.path(VOCABULARY))
    return rows.select(
        "doc_id", "n_tokens", sha256("ids").alias("ids_sha256"), sha256("decoded").alias("decoded_sha256")
    )


def op2_quality_rules(spark: SparkSession, sf: str) -> DataFrame:
    return quality_rules(documents(spark, sf))


def op3_simhash_dedup(spark: SparkSession, sf: str) -> DataFrame:
    rows = simhash_dedup(documents(spark, sf))
    return rows.select("doc_id", hex_fingerprint("f").alias("fingerprint"), "component_id")


def op4_toxicity(spark: SparkSession, sf: str) -> DataFrame:
    rows = toxicity(documents(spark, sf), spark.read.parquet(f"{sf}/labels.parquet"))
    return rows.select("doc_id", "held_out", "score", "predicted", F.size("offending").alias("n_offending"))


def op5_class_model(spark: SparkSession, sf: str) -> DataFrame:
    return class_model_scores(documents(spark, sf))


def op6_token_counts(spark: SparkSession, sf: str) -> DataFrame:
    return count_tokens(documents(spark, sf), public_tokenizers.path(VOCABULARY), TOKEN_BUDGET)


def op7_suffix_dedup(spark: SparkSession, sf: str) -> DataFrame:
    rows = suffix_dedup(documents(spark, sf))
    return rows.select("doc_id", "n_bytes", "n_removed", "n_spans", sha256("kept").alias("kept_sha256"))


def op8_substring_dedup(spark: SparkSession, sf: str) -> DataFrame:
    rows = substring_dedup(documents(spark, sf))
    return rows.select("doc_id", "n_words", "n_removed", sha256("kept").alias("kept_sha256"))


def op9_line_dedup(spark: SparkSession, sf: str) -> DataFrame:
    rows = line_dedup(documents(spark, sf))
    return rows.select("doc_id", "n_lines", "n_removed", sha256("kept").alias("kept_sha256"))


def op10_decontaminate(spark: SparkSession, sf: str) -> DataFrame:
    """One row for each benchmark item that a document leaks; clean documents have none."""
    return decontaminate(documents(spark, sf), spark.read.parquet(f"{sf}/benchmark.parquet"))


def op11_alignment(spark: SparkSession, sf: str) -> DataFrame:
    return cross_tokenizer_alignment(
        documents(spark, sf), public_tokenizers.path(BYTE_BPE), public_tokenizers.path(PIECE_BPE)
    )


def looped(docs: DataFrame) -> DataFrame:
    """(doc_id, text): every tenth document by checksum repeats a stretch of its words to its end."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    g, n = F.expr("h div 10"), F.col("n")
    a = F.expr("cast(g % n as int)")
    p = F.expr("cast(1 + (n - a) div (3 + g % 8) as int)")
    block = F.slice("words", F.col("a") + 1, F.col("p"))
    again = F.flatten(F.array_repeat(block, F.expr("cast((n - a + p - 1) div p as int)")))
    words = F.concat(F.slice("words", F.lit(1), F.col("a")), F.slice(again, F.lit(1), n - F.col("a")))
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), h.alias("h")).withColumn("g", g)
    found = F.regexp_extract_all("text", F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0))
    rows = rows.withColumn("words", F.when(F.col("h") % 10 == 0, found)).withColumn("n", F.size("words"))
    rows = rows.withColumn("a", F.when(n > 0, a)).withColumn("p", F.when(n > 0, p))
    return rows.select("doc_id", F.when(n > 0, F.array_join(words, " ")).otherwise(F.col("text")).alias("text"))


def op12_periodic_runs(spark: SparkSession, sf: str) -> DataFrame:
    rows = periodic_runs(looped(documents(spark, sf)))
    written = F.array_join(
        F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n"))), ""
    )
    order = F.transform("runs", lambda r: F.struct((-r["length"]).alias("shorter"), r["start"].alias("start"), r["period"].alias("period")))
    longest = F.get(F.array_sort(order), F.lit(0))
    return rows.withColumn("top", longest).select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        F.col("top.start").alias("start"),
        (-F.col("top.shorter")).alias("length"),
        F.col("top.period").alias("period"),
        F.expr("(-1000 * top.shorter) div top.period").alias("exponent_milli"),
        F.sha2(written, 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


def op13_chat_format(spark: SparkSession, sf: str) -> DataFrame:
    """All conversations and one whose texts look like the template, read back from the formatted output.

    Turns come from the stream, replies from the examples, each written out with all its context.
    """
    turns = spark.read.parquet(f"{sf}/conversations.parquet").select("conv_id", "turn", "role", "text")
    tricky = "\\### Assistant: </turn> ok"
    rows = [(-7, 0, "user", tricky), (-7, 1, "assistant", tricky)]
    own = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    # Written once: the turns, the examples and their contexts all read it.
    stream = cut_lineage(chat_format.formatted(turns.unionByName(own)), "chat-stream")
    return chat_format.digests(stream, chat_format.expanded(stream, chat_format.examples(stream)))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_bpe_codec": op1_bpe_codec,
    "op2_quality_rules": op2_quality_rules,
    "op3_simhash_dedup": op3_simhash_dedup,
    "op4_toxicity": op4_toxicity,
    "op5_class_model": op5_class_model,
    "op6_token_counts": op6_token_counts,
    "op7_suffix_dedup": op7_suffix_dedup,
    "op8_substring_dedup": op8_substring_dedup,
    "op9_line_dedup": op9_line_dedup,
    "op10_decontaminate": op10_decontaminate,
    "op11_alignment": op11_alignment,
    "op12_periodic_runs": op12_periodic_runs,
    "op13_chat_format": op13_chat_format,
}
