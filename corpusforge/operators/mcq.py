"""Multiple-choice rows: choices, gold labels, scores, predictions, accuracy."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from corpusforge.functions import codec
from corpusforge.functions.text import answer_text, question_context, strip
from corpusforge.operators.ngram import CONTEXT, NgramModel
from corpusforge.operators.scoring import score_units
from corpusforge.operators.tokenize import BYTES, Tokenizer

# Digit keys stand for these letters where the labels are letters.
DIGIT_LABELS = {"1": "A", "2": "B", "3": "C", "4": "D"}

RANDOM_BASELINE = 0.25
FIRST_EXAMPLES = 500
# Scores tie where they agree to this many decimals.
SCORE_DECIMALS = 12


def from_sciq(rows: DataFrame, source: str = "sciq") -> DataFrame:
    """(source, split, item_id, context, choices, gold_idx): four fixed choices, gold first."""
    names = ["correct_answer", "distractor1", "distractor2", "distractor3"]
    return rows.select(
        F.lit(source).alias("source"),
        "split",
        "item_id",
        question_context(F.col("support"), F.col("question")).alias("context"),
        F.array(*[strip(F.col(c)) for c in names]).alias("choices"),
        F.lit(0).cast("long").alias("gold_idx"),
    )


def _position(labels: Column, key: Column) -> Column:
    """0-based place of ``key`` in ``labels``, null when it is missing."""
    found = F.array_position(labels, key)
    return F.when(found > 0, found - 1)


def with_gold(rows: DataFrame) -> DataFrame:
    """Add ``gold_idx`` and ``used_fallback``; an unresolved key leaves ``gold_idx`` null."""
    labels, key = F.col("choices.label"), F.col("answerKey")
    letters = F.create_map(*[F.lit(v) for pair in DIGIT_LABELS.items() for v in pair])
    direct = _position(labels, key)
    mapped = _position(labels, F.coalesce(F.try_element_at(letters, key), key))
    return rows.withColumn("gold_idx", F.coalesce(direct, mapped)).withColumn(
        "used_fallback", direct.isNull() & mapped.isNotNull()
    )


def from_arc(rows: DataFrame, source: str = "arc_easy") -> DataFrame:
    """The same columns from nested rows: three or four choices, gold from the answer key."""
    return with_gold(rows).select(
        F.lit(source).alias("source"),
        "split",
        "item_id",
        strip(F.col("question")).alias("context"),
        F.transform("choices.text", strip).alias("choices"),
        "gold_idx",
    )


def gold_labels(rows: DataFrame) -> DataFrame:
    """(item_id, n_choices, gold_idx, used_fallback)."""
    return with_gold(rows).select(
        "item_id", F.size("choices.text").cast("long").alias("n_choices"), "gold_idx", "used_fallback"
    )


def first_items(items: DataFrame, n: int = FIRST_EXAMPLES) -> DataFrame:
    """The first ``n`` items in source order."""
    return items.orderBy("item_id").limit(n)


def choice_rows(items: DataFrame) -> DataFrame:
    """(source, split, item_id, gold_idx, choice_idx, context, choice): one row per choice."""
    return items.select(
        "source", "split", "item_id", "gold_idx", "context", F.posexplode("choices").alias("choice_idx", "choice")
    ).withColumn("choice_idx", F.col("choice_idx").cast("long"))


def choice_scores(
    items: DataFrame, model: NgramModel, tokenizer: Tokenizer = BYTES
) -> DataFrame:
    """(model, source, split, item_id, gold_idx, choice_idx, score) by mean log-likelihood.

    The sum runs over the choice's ids and is divided by their number. The model looks two ids
    back, so of a context only its last two ids are unpacked. Without any context the first id
    has nothing to be predicted from and is left out of the sum, not of the divisor.
    """
    keep = ["source", "split", "item_id", "gold_idx", "choice_idx"]
    tails = items.withColumn(
        "context", codec.last_ids(tokenizer.encode(F.col("context")), CONTEXT)
    )
    coded = choice_rows(tails).select(
        *keep, "context", tokenizer.encode(answer_text(F.col("choice"))).alias("_choice")
    )
    rows = coded.select(
        *keep,
        codec.n_ids(F.col("context")).alias("_first"),
        codec.n_ids(F.col("_choice")).alias("n_choice"),
        F.concat("context", "_choice").alias("tokens"),
    )
    units = [*keep, "n_choice"]
    scored = score_units(rows, units, model, first=F.col("_first"))
    return scored.select(
        *keep, *[(F.col(f"sum_logp_{m}") / F.col("n_choice")).alias(m) for m in model.models]
    ).unpivot(keep, list(model.models), "model", "score")


def user_scores(
    items: DataFrame,
    score_batch: Callable[[pd.DataFrame], pd.Series],
    model: str,
    max_ctx: int = 1024,
    tokenizer: Tokenizer = BYTES,
) -> DataFrame:
    """The columns of :func:`choice_scores` from a scoring function the user brings.

    ``score_batch`` gets a frame of ``ctx_ids`` and ``choice_ids`` (lists of ids; the two together
    cropped on the left to ``max_ctx``) and returns log P(choice | context), one sum per row. The
    sum is divided by the ids that were scored, so a choice longer than ``max_ctx`` counts by its
    last ``max_ctx`` ids. Contexts are encoded once per item, before the choices are unfolded. It
    runs on Arrow batches inside the tasks; load a network once per process inside it.
    """
    keep = ["source", "split", "item_id", "gold_idx", "choice_idx"]
    contexts = items.withColumn(
        "context", codec.last_ids(tokenizer.encode(F.col("context")), max_ctx)
    )
    coded = choice_rows(contexts).select(
        *keep,
        F.col("context").alias("_ctx"),
        codec.last_ids(tokenizer.encode(answer_text(F.col("choice"))), max_ctx).alias("_choice"),
    )
    n_choice = codec.n_ids(F.col("_choice"))
    n_ctx = codec.n_ids(F.col("_ctx"))
    kept = F.least(n_ctx, max_ctx - n_choice)
    rows = coded.select(
        *keep,
        n_choice.alias("n_choice"),
        codec.ids(codec.cut(F.col("_ctx"), n_ctx - kept, kept)).alias("ctx_ids"),
        codec.ids(F.col("_choice")).alias("choice_ids"),
    )

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = batch[[*keep, "n_choice"]].copy()
            out["sum_logp"] = score_batch(batch[["ctx_ids", "choice_ids"]]).astype("float64")
            yield out

    schema = (
        "source string, split string, item_id long, gold_idx long, choice_idx long, "
        "n_choice long, sum_logp double"
    )
    return rows.mapInPandas(run, schema).select(
        F.lit(model).alias("model"), *keep, (F.col("sum_logp") / F.col("n_choice")).alias("score")
    )


def predictions(scores: DataFrame) -> DataFrame:
    """(model, source, split, item_id, pred_idx, gold_idx, hit): the first best choice wins.

    Scores are rounded so that equal scores tie; an unresolved gold label is never a hit.
    """
    rank = F.struct(
        F.round("score", SCORE_DECIMALS).alias("s"), (-F.col("choice_idx")).alias("back")
    )
    pred = F.col("pred_idx")
    return (
        scores.groupBy("model", "source", "split", "item_id")
        .agg((-F.max(rank)["back"]).alias("pred_idx"), F.max("gold_idx").alias("gold_idx"))
        .withColumn("hit", F.coalesce(pred == F.col("gold_idx"), F.lit(False)))
        .select("model", "source", "split", "item_id", "pred_idx", "gold_idx", "hit")
    )


def accuracy(predicted: DataFrame) -> DataFrame:
    """(model, source, split, total, correct, accuracy); unresolved items count in the total."""
    hit = F.col("hit").cast("long")
    return predicted.groupBy("model", "source", "split").agg(
        F.count(F.lit(1)).alias("total"),
        F.sum(hit).alias("correct"),
        F.avg(hit.cast("double")).alias("accuracy"),
    )


def leaderboard(accuracies: DataFrame) -> DataFrame:
    """(model, dataset, correct, total, accuracy) plus the constant random row per dataset."""
    dataset = F.concat(F.col("source"), F.lit(" ("), F.col("split"), F.lit(")"))
    rows = accuracies.select("model", dataset.alias("dataset"), "correct", "total", "accuracy")
    nothing = F.lit(None).cast("long")
    chance = rows.select("dataset").distinct().select(
        F.lit("random baseline").alias("model"),
        "dataset",
        nothing.alias("correct"),
        nothing.alias("total"),
        F.lit(RANDOM_BASELINE).alias("accuracy"),
    )
    return rows.unionByName(chance)


def split_counts(items: DataFrame) -> DataFrame:
    """(source, split, n)."""
    return items.groupBy("source", "split").agg(F.count(F.lit(1)).alias("n"))
