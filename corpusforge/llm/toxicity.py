"""Toxicity by multiple-instance learning: sentences are the instances, documents carry the labels.

P(document) = 1 - product over sentences of (1 - P(sentence)), with P(sentence) logistic in the
sentence's words and their beginnings. The fit sees document labels only; scoring the sentences
then says where the offending ones are.
"""

from __future__ import annotations

import math
import re
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from corpusforge.llm.batches import columns_of, give_back, slices
from corpusforge.llm.bpe_tables import Memo

FOLDS = 5
SAMPLE_PER_CLASS = 4_000
"""Labelled documents of each class that the model is fitted on, chosen by a hash of their ids."""
FEATURES = 4_000
STEPS = 150
RATE = 1.0
DECAY = 1e-4
SENTENCE = re.compile(r"[^.!?\n]+")
WORD = re.compile(r"\w+")


def fold(doc_id: Column) -> Column:
    return F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(FOLDS))


def features(word: str) -> tuple[str, ...]:
    """A word and its beginnings of four to six letters, marked so that they never mix."""
    return (word, *(word[:n] + "*" for n in (4, 5, 6) if len(word) > n))


def sentences(text: str | None):
    """(start, end, different words) of each sentence with a word."""
    for found in SENTENCE.finditer((text or "").lower()):
        words = set(WORD.findall(found.group()))
        if words:
            yield found.start(), found.end(), words


def chosen(seen: list[dict[str, int]], totals: list[int]) -> list[str]:
    """Features by the strength of their difference between the classes, at least in 3 documents."""
    odds = {}
    for name in set(seen[0]) | set(seen[1]):
        n = [c.get(name, 0) for c in seen]
        if sum(n) >= 3:
            rates = [(k + 0.5) / (t + 1) for k, t in zip(n, totals)]
            odds[name] = abs(math.log(rates[1] / rates[0])) * math.sqrt(sum(n))
    return sorted(odds, key=lambda name: (-odds[name], name))[:FEATURES]


def fit(table: pa.Table) -> pa.Table:
    """(feature, weight) rows; the feature '' is the intercept. No rows without both classes."""
    order = np.argsort(table.column("doc_id").to_numpy(), kind="stable")
    labels = table.column("toxic").to_numpy()[order]
    texts = table.column("text").to_pylist()
    if len(set(labels.tolist())) < 2:
        return pa.table({"feature": pa.array([], pa.string()), "weight": pa.array([], pa.float64())})
    # Two passes over the texts, so that only chosen features are ever held for all sentences.
    seen: list[dict[str, int]] = [{}, {}]
    for label, i in zip(labels, order):
        words = set().union(*(words for _, _, words in sentences(texts[i])))
        for name in set(chain.from_iterable(map(features, words))):
            seen[label][name] = seen[label].get(name, 0) + 1
    names = chosen(seen, [int((labels == c).sum()) for c in (0, 1)])
    column = {name: i for i, name in enumerate(names)}
    hits, docs = [], []
    for d, i in enumerate(order):
        for _, _, words in sentences(texts[i]):
            found = {column[x] for x in chain.from_iterable(map(features, words)) if x in column}
            hits.append(np.fromiter(found, np.int32, len(found)))
            docs.append(d)
    n, sizes = len(hits), [len(h) for h in hits]
    rows, docs = np.repeat(np.arange(n), sizes), np.array(docs, np.int64)
    cols = np.concatenate([np.zeros(0, np.int32), *hits])
    weight, bias = np.zeros(len(names)), -4.0
    # Both classes weigh the same, whatever their ratio in the sample, so 0.5 means the same at every size.
    share = 0.5 / np.bincount(labels, minlength=2)[labels]
    speed, speed_b = np.full(len(names), 1e-8), 1e-8
    # Rates grow with a feature's documents, so that beginnings learn before single words do.
    often = np.array([seen[0].get(x, 0) + seen[1].get(x, 0) for x in names], np.float64)
    rate = RATE * np.sqrt(often / often.max()) if len(names) else often
    for _ in range(STEPS):
        z = bias + np.bincount(rows, weight[cols], n)
        p = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
        clean = np.exp(np.bincount(docs, np.log1p(-np.minimum(p, 1 - 1e-12)), len(labels)))
        toxic = np.maximum(1 - clean, 1e-12)
        pull = (np.where(labels == 1, clean / toxic, -1.0) * share)[docs] * p
        step = np.bincount(cols, pull[rows], len(names)) - DECAY / len(labels) * weight
        speed += step**2
        weight += rate * step / np.sqrt(speed)
        speed_b += pull.sum() ** 2
        bias += RATE * pull.sum() / math.sqrt(speed_b)
    used = np.abs(weight) > 1e-6
    names = [name for name, u in zip(names, used) if u]
    return pa.table({"feature": ["", *names], "weight": [bias, *weight[used].tolist()]})


def training_rows(docs: DataFrame, labels: DataFrame, most: int = SAMPLE_PER_CLASS) -> DataFrame:
    """(doc_id, text, toxic) of the sample outside fold 0; the ids are at most twice ``most``."""
    known = columns_of(labels, "doc_id", "toxic").where("doc_id is not null and toxic in (0, 1)")
    known = known.groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic")).where(fold(F.col("doc_id")) != 0)
    by_hash = [F.xxhash64("doc_id"), F.col("doc_id")]
    picked = None
    present = columns_of(docs, "doc_id").where("doc_id is not null").distinct()
    known = known.join(present, "doc_id", "left_semi")
    for label in (0, 1):
        part = known.where(F.col("toxic") == label).orderBy(*by_hash).limit(most)
        picked = part if picked is None else picked.unionByName(part)
    ids = docs.sparkSession.createDataFrame([tuple(r) for r in picked.collect()], "doc_id long, toxic int")
    texts = columns_of(docs, "doc_id", "text").join(F.broadcast(ids), "doc_id")
    return texts.groupBy("doc_id").agg(F.min("text").alias("text"), F.first("toxic").alias("toxic"))


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, held_out, score, predicted, offending) of every document.

    ``labels`` (doc_id, toxic) are learnt from where crc32(doc_id as text) mod 5 is not 0 and never
    enter a score. ``offending`` lists (start, end, score) of the sentences with a score of 0.5 or
    more, as characters of the text. Both classes weigh the same in the fit. Texts without a word (null, empty, signs only) score 0; without
    labels of both classes all score 0; a null doc_id is not held out and comes back as null; rows
    that repeat score alike; an empty table gives no rows. Other columns are ignored.
    """
    rows = training_rows(docs, labels).withColumn("all", F.lit(0))
    # One task fits the model: its rows are bounded by SAMPLE_PER_CLASS.
    def fitted(table):
        model = fit(table)
        give_back()
        return model

    model = rows.groupBy("all").applyInArrow(fitted, "feature string, weight double").collect()
    weights = docs.sparkSession.sparkContext.broadcast({r[0]: r[1] for r in model})

    def run(batches):
        known = weights.value
        bias = known.get("")
        of_word = Memo(lambda word: tuple(f for f in features(word) if f in known and f))
        for batch in batches:
            for rows in slices(pa.table(batch)):
                scores, places = [], []
                for text in rows.column("text").to_pylist():
                    clean, found = 0.0, []
                    for start, end, words in sentences(text) if bias is not None else ():
                        z = bias + sum(map(known.__getitem__, set(chain.from_iterable(map(of_word.__getitem__, words)))))
                        p = 1 / (1 + math.exp(-max(-30.0, min(30.0, z))))
                        clean += math.log1p(-min(p, 1 - 1e-12))
                        if p >= 0.5:
                            found.append({"start": start, "end": end, "score": p})
                    scores.append(1 - math.exp(clean))
                    places.append(found)
                yield pa.record_batch(
                    {
                        "doc_id": rows.column("doc_id").combine_chunks(),
                        "score": pa.array(scores, pa.float64()),
                        "offending": pa.array(places, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("score", pa.float64())]))),
                    }
                )

    texts = columns_of(docs, "doc_id", "text").select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    scored = texts.mapInArrow(run, "doc_id long, score double, offending array<struct<start:long,end:long,score:double>>")
    return scored.select(
        "doc_id",
        F.coalesce(fold(F.col("doc_id")) == 0, F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
        "offending",
    )
