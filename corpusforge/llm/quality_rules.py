"""Quality rules over documents and over lines that many documents of a host share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from corpusforge.llm.batches import columns_of

BLANK = r"[\x20\x09-\x0D]+"
SOLID = r"[^\x20\x09-\x0D]"
SYMBOLS = "[#*$%&|<>]"
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50

LEAST_DOCS = 20
"""A line in fewer different documents of its host is never removed."""
HOST_PERCENT = 5
"""Nor one in this share of the host's different documents or less."""
DEPLETED_PERCENT = 50
"""A document is rejected if removed lines held more than this share of its words."""
SALTS = 16


def words_of(text: Column) -> Column:
    return F.filter(F.split(text, BLANK), lambda w: w != "")


def with_repeat_words(rows: DataFrame) -> DataFrame:
    """Adds the number of words in windows of three that occur twice or more in the text.

    Only texts with an equal pair of ``windows`` are looked at further: windows are sorted with their
    positions, equal neighbours are repeats, and each repeat covers three words or as many as lie
    before the next one. Each array is a column of its own, so that none is built again per element.
    """
    has_repeat = F.size(F.array_distinct("windows")) < F.size("windows")
    ordered = F.sort_array(F.transform("windows", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    rows = rows.withColumn("ordered", F.when(has_repeat, ordered))

    def repeated(e, k):
        return (e.h == F.get(F.col("ordered"), k - 1).h) | (e.h == F.get(F.col("ordered"), k + 1).h)

    at = F.sort_array(F.transform(F.filter("ordered", repeated), lambda e: e.i))
    rows = rows.withColumn("at", at)
    sizes = F.transform("at", lambda p, k: F.least(F.lit(3), F.coalesce(F.get(F.col("at"), k + 1), p + 3) - p))
    total = F.aggregate(sizes, F.lit(0).cast("long"), lambda total, n: total + n)
    return rows.withColumn("n_repeat_words", F.coalesce(total, F.lit(0).cast("long"))).drop("ordered", "at")


def base_features(docs: DataFrame) -> DataFrame:
    """Counts of each text, with its host and a hash of the text."""
    text = F.coalesce(F.col("text"), F.lit(""))
    solid_lines = F.filter(F.split(text, "\n"), lambda line: line.rlike(SOLID))
    split = docs.select("doc_id", "source", "text", words_of(text).alias("words"), solid_lines.alias("lines"))
    n = F.size("words")
    windows = F.when(n < 3, F.array().cast("array<bigint>")).otherwise(
        F.transform(
            F.slice("words", F.lit(1), F.greatest(n - 2, F.lit(1))),
            lambda w, i: F.xxhash64(w, F.get(F.col("words"), i + 1), F.get(F.col("words"), i + 2)),
        )
    )
    counted = split.select(
        "doc_id",
        F.coalesce("source", F.lit("")).alias("host"),
        F.xxhash64(text).alias("text_hash"),
        n.cast("long").alias("n_words"),
        F.length(F.array_join("words", "")).cast("long").alias("word_chars"),
        F.coalesce(F.regexp_count(text, F.lit(SYMBOLS)), F.lit(0)).cast("long").alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        "words",
        windows.alias("windows"),
    )
    return with_repeat_words(counted).drop("words", "windows")


def document_lines(docs: DataFrame) -> DataFrame:
    """(doc_id, host, text_hash, line_no, line_hash, words) of every line with a word.

    Lines are normalised to lower case and single blanks before they are hashed.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(
        "doc_id",
        F.coalesce("source", F.lit("")).alias("host"),
        F.xxhash64(text).alias("text_hash"),
        F.posexplode(F.split(text, "\n")).alias("line_no", "line"),
    ).withColumn("line", words_of(F.col("line")))
    return rows.where(F.size("line") > 0).select(
        "doc_id", "host", "text_hash", "line_no",
        F.xxhash64(F.lower(F.array_join("line", " "))).alias("line_hash"),
        F.size("line").cast("long").alias("words"),
    )


def frequent_lines(docs: DataFrame, lines: DataFrame) -> DataFrame:
    """(host, line_hash) of the lines above the limits; identical texts count as one document."""
    once = lines.select("host", "line_hash", "text_hash").distinct()
    counts = once.groupBy("host", "line_hash").agg(F.count("*").alias("n_docs"))
    texts = docs.select(
        F.coalesce("source", F.lit("")).alias("host"), F.xxhash64(F.coalesce("text", F.lit(""))).alias("text_hash")
    )
    hosts = texts.distinct().groupBy("host").agg(F.count("*").alias("host_docs"))
    often = counts.where(F.col("n_docs") >= LEAST_DOCS).join(hosts, "host")
    return often.where(F.col("n_docs") * 100 > F.col("host_docs") * HOST_PERCENT).select("host", "line_hash")


def removed_words(docs: DataFrame) -> DataFrame:
    """(doc_id, text_hash, removed_words): words in lines above the limits.

    A line may stand in a third of all documents, so both sides of the join are salted.
    """
    lines = document_lines(docs)
    often = frequent_lines(docs, lines).withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    dealt = lines.withColumn("salt", F.pmod(F.xxhash64("doc_id", "line_no"), F.lit(SALTS)).cast("int"))
    hit = dealt.join(often, ["host", "line_hash", "salt"], "left_semi")
    once = hit.select("doc_id", "text_hash", "line_no", "words").distinct()
    return once.groupBy("doc_id", "text_hash").agg(F.sum("words").alias("removed_words"))


def quality_rules(docs: DataFrame) -> DataFrame:
    """Counts and verdicts of every document.

    Takes (doc_id, text, source), ignores other columns. Returns doc_id, n_words, word_chars,
    n_symbols, n_dup_lines, n_repeat_words, base_failed, removed_words, kept. Null and empty texts
    have no words and fail; a null source is a host of its own (the empty one); rows that repeat
    with the same doc_id and text get the same verdict each; a null doc_id comes back as null; an
    empty table gives no rows.
    """
    docs = columns_of(docs, "doc_id", "text", "source")
    base = base_features(docs)
    removed = removed_words(docs).withColumnRenamed("doc_id", "d").withColumnRenamed("text_hash", "t")
    both = base.join(removed, base.doc_id.eqNullSafe(F.col("d")) & (base.text_hash == F.col("t")), "left")
    gone = F.coalesce("removed_words", F.lit(0).cast("long"))
    failed = (F.col("n_words") < MIN_WORDS) | (
        F.col("n_repeat_words") * 100 > F.col("n_words") * MAX_REPEAT_PERCENT
    )
    return both.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        failed.alias("base_failed"),
        gone.alias("removed_words"),
        (~failed & (gone * 100 <= F.col("n_words") * DEPLETED_PERCENT)).alias("kept"),
    )
