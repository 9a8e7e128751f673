"""Question rows and a run log derived from the given tables, whole tables and whole texts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from corpusforge.functions.codec import idiv
from corpusforge.functions.text import strip
from corpusforge.operators.prefix import dense_rank_of, exclusive_prefix, followers
from corpusforge.session import cut_lineage

CONVERSATIONS = "conv_id bigint, turn bigint, role string, text string"
BENCHMARK = "item_id bigint, text string"

SENTENCE_END = r"[.!?\n]+"
WORD_GAP = r"[ \t\n\r\f]+"
TURN_BLOCK_BITS = 12


def _places(turns: DataFrame) -> DataFrame:
    """(conv_id, turn, _place): sentences before each turn, in order of conversation and turn.

    Sums over conversations and inside each, so any id and any number of sentences gets its place.
    The counts are written once: no text is read again for the levels of the sums.
    """
    sizes = cut_lineage(turns, "turn-sizes")
    whole = sizes.groupBy("conv_id").agg(F.sum("_n").alias("_n"))
    before = exclusive_prefix(whole, "conv_id", "_n", "_before").select("conv_id", "_before")
    inside = exclusive_prefix(sizes, "turn", "_n", "_inside", ["conv_id"])
    return inside.join(before, "conv_id").select(
        "conv_id", "turn", (F.col("_before") + F.col("_inside")).alias("_place")
    )


def sciq_shaped(conversations: DataFrame) -> DataFrame:
    """One question row per sentence of an assistant turn that answers a user turn.

    Question = the user's text, support = the conversation's system text or nothing, correct
    answer = the sentence, distractors = the next three rows' sentences in row order (the last
    three rows have too few and are dropped). Turns meet on (conversation, turn) and system texts
    on (conversation, block of turns), once per block that has an answer, so one huge conversation
    is spread like many small ones.
    """
    turns = conversations.select("conv_id", "turn", "role", "text")
    asked = turns.where("role = 'user'").select(
        "conv_id", (F.col("turn") + 1).alias("turn"), F.col("text").alias("question")
    )
    block = F.shiftright("turn", TURN_BLOCK_BITS)
    system = turns.where("role = 'system'").groupBy("conv_id").agg(F.min_by("text", "turn").alias("support"))
    sentences = F.filter(
        F.transform(F.split("text", SENTENCE_END), strip), lambda s: s != ""
    )
    answers = turns.where("role = 'assistant'").join(asked, ["conv_id", "turn"])
    blocks = turns.where("role = 'assistant'").select("conv_id", block.alias("_block")).distinct()
    system = blocks.join(system, "conv_id")
    rows = (
        answers.join(_places(answers.select("conv_id", "turn", F.size(sentences).alias("_n"))), ["conv_id", "turn"])
        .withColumn("_block", block)
        .join(system, ["conv_id", "_block"], "left")
        .select(
            "conv_id", "turn", "question", "support", "_place",
            F.posexplode(sentences).alias("_s", "correct_answer"),
        )
        .withColumn("item_id", F.col("_place") + F.col("_s"))
    )
    ranked = followers(rows, "item_id", "correct_answer", 3, "_next")
    bucket = F.col("conv_id") % 10
    split = F.when(bucket < 8, "train").when(bucket == 8, "validation").otherwise("test")
    return ranked.where(F.size("_next") == 3).select(
        split.alias("split"),
        "item_id",
        F.coalesce("support", F.lit("")).alias("support"),
        "question",
        "correct_answer",
        *[F.get("_next", F.lit(i)).alias(f"distractor{i + 1}") for i in range(3)],
    )


def _joined(words: Column, start: Column, count: Column) -> Column:
    return F.array_join(F.slice(words, start, count), " ")


def arc_shaped(benchmark: DataFrame) -> DataFrame:
    """One nested question row per benchmark text.

    Question = the first half of the words, choices = the second halves of this row and the next
    ones. Every fifth row has three choices, every third digit labels; some keys are digits over
    letter labels, as in the public data set.
    """
    words = F.filter(F.split("text", WORD_GAP), lambda s: s != "")
    half = idiv(F.size("_words"), 2).cast("int")
    rows = benchmark.select("item_id", words.alias("_words")).select(
        "item_id",
        _joined(F.col("_words"), F.lit(1), half).alias("question"),
        _joined(F.col("_words"), half + 1, F.size("_words") - half).alias("_tail"),
    )
    ranked = followers(dense_rank_of(rows, "item_id", "_rank", id_bits=43), "_rank", "_tail", 3, "_next")
    item, n = F.col("item_id"), F.col("_n")
    gold = (item % n).cast("int")
    letters = F.array(*[F.lit(c) for c in "ABCD"])
    digits = F.array(*[F.lit(c) for c in "1234"])
    labels = F.slice(F.when(item % 3 == 0, digits).otherwise(letters), F.lit(1), n)
    texts = F.concat(
        F.slice("_next", F.lit(1), gold),
        F.array("_tail"),
        F.slice("_next", gold + 1, n - 1 - gold),
    )
    digit_key = (item % 7 == 1) & (item % 3 != 0)
    return (
        ranked.withColumn("_n", F.when(item % 5 == 0, 3).otherwise(4))
        .where(F.size("_next") >= n - 1)
        .select(
            F.lit("test").alias("split"),
            "item_id",
            "question",
            F.struct(texts.alias("text"), labels.alias("label")).alias("choices"),
            F.get(F.when(digit_key, digits).otherwise(labels), gold).alias("answerKey"),
        )
    )


def run_log(events: DataFrame) -> DataFrame:
    """(run_id, step, ts, loss): each user's events in id order as the steps of a run."""
    rows = events.select(
        F.col("user_id").alias("run_id"),
        "event_id",
        F.col("ts").cast("timestamp").alias("ts"),
        F.col("value").alias("loss"),
    )
    ranked = dense_rank_of(rows, "event_id", "step", by=["run_id"], id_bits=43)
    return ranked.select("run_id", "step", "ts", "loss")
