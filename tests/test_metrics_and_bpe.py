"""Losses and throughput on hand-made rows; merges against a plain sequential learner."""

import random
from collections import Counter

import pytest
import regex
from pyspark.sql import functions as F

from corpusforge.functions import codec
from corpusforge.functions.text import PRETOKEN_PATTERN
from corpusforge.operators import bpe, metrics
from corpusforge.operators.tokenize import tokenize
from corpusforge.plans import stages
from corpusforge.sources import results


def test_throughput_windows(spark):
    ts = ["2024-01-01 00:00:00", "2024-01-01 00:00:05", "2024-01-01 00:00:06", "2024-01-01 00:00:16"]
    log = spark.createDataFrame(list(zip("aaaa", [0, 10, 15, 20], ts)), "run_id string, step long, ts string")
    rows = metrics.run_throughput(log.withColumn("ts", F.to_timestamp("ts")), 100).orderBy("step").collect()
    assert [tuple(r)[1:] for r in rows] == [(0, None, None), (10, 200.0, 500.0), (20, 1000 / 11, 1100.0)]


def test_step_loss_is_a_mean_of_rank_means(spark):
    rows = [(0, 0, 1.0), (0, 1, 3.0), (1, 0, 5.0), (1, 1, 7.0), (0, 2, 9.0), (1, 2, 1.0)]
    df = spark.createDataFrame(rows, "rank long, micro_step long, loss_m double")
    got = {r["step"]: r["loss"] for r in metrics.step_loss(df, 2, "m").collect()}
    assert got == {0: 4.0, 1: 5.0}


def test_a_repeated_write_leaves_one_set_of_metric_rows(spark, tmp_path):
    path = str(tmp_path / "m")
    values = spark.createDataFrame([(0, 1.5), (10, 1.25)], "step long, value double")
    for name in ("loss", "ppl", "loss"):
        for run in ("a", "b"):
            results.write_metrics(values, path, name, run)
    assert results.read_metrics(spark, path).count() == 8
    assert results.read_metrics(spark, path, "ppl").where("run_id = 'a' and step = 10").first()["value"] == 1.25
    results.write_metrics(values.where("step = 0"), path, "loss", "a")  # a shorter retry replaces its run alone
    got = {(r.run_id, r.step) for r in results.read_metrics(spark, path, "loss").collect()}
    assert got == {("a", 0), ("b", 0), ("b", 10)}
    plan = results.read_metrics(spark, path, "ppl")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(name" in plan


def test_stored_runs_give_their_throughput(spark, tmp_path):
    rows = [(run, s, f"2024-01-01 00:00:{s + run:02d}", 1.0) for run in (1, 2) for s in range(25)]
    log = spark.createDataFrame(rows, "run_id long, step long, ts string, loss double").withColumn("ts", F.to_timestamp("ts"))
    for _ in range(2):
        stages.record_runs(log, str(tmp_path / "m"))
    got = stages.throughput_of(spark, str(tmp_path / "m"), 50).collect()
    assert sorted((r.run_id, r.step, r.tokens_per_sec) for r in got if r.step) == [(run, s, 50.0) for run in "12" for s in (10, 20)]


def sequential_merges(texts, n_merges):
    words = Counter(w for t in texts for w in regex.findall(PRETOKEN_PATTERN, t))
    split = {w: list(w.encode()) for w in words}
    out = []
    for i in range(n_merges):
        pairs = Counter()
        for w, ids in split.items():
            for pair in zip(ids, ids[1:]):
                pairs[pair] += words[w]
        if not pairs:
            break
        (left, right), n = min(pairs.items(), key=lambda kv: (-kv[1], kv[0]))
        out.append((left, right, 256 + i, n))
        for w, ids in split.items():
            merged, j = [], 0
            while j < len(ids):
                if ids[j : j + 2] == [left, right]:
                    merged.append(256 + i)
                    j += 2
                else:
                    merged.append(ids[j])
                    j += 1
            split[w] = merged
    return out


def corpus(spark, seed):
    rng = random.Random(seed)
    words = ["the", "then", "there", "aaaa", "aaa", "été", "hat", "that", "12", "1212", "x"]
    texts = [" ".join(rng.choices(words, k=rng.randrange(30))) for _ in range(30)]
    return texts, spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")


@pytest.mark.parametrize("seed, look, most", [(0, 4096, 10**6), (1, 4, 10**6), (2, 1, 10**6), (3, 64, 30), (4, 8, 60)])
def test_merges_equal_the_sequential_learner(spark, seed, look, most):
    """In one round, in rounds of few pairs, pair by pair, and with a bound that halves the rounds."""
    texts, docs = corpus(spark, seed)
    got = bpe.learn_merges(docs, 25, look=look, most_symbols=most)
    assert got == sequential_merges(texts, 25)


def test_learning_stops_when_nothing_is_left_to_merge(spark):
    docs = spark.createDataFrame([(0, "ab ab")], "doc_id long, text string")
    merges = bpe.learn_merges(docs, 50)
    assert merges == sequential_merges(["ab ab"], 50)


def test_both_encoders_agree_and_decode_to_the_text(spark, monkeypatch):
    texts, docs = corpus(spark, 3)
    merges = bpe.learn_merges(docs, 20)
    folded = tokenize(docs, bpe.bpe_tokenizer(merges))
    monkeypatch.setattr(bpe, "FOLD_LIMIT", 0)
    tokenizer = bpe.bpe_tokenizer(merges)
    by_words = tokenize(docs, tokenizer)
    assert sorted(map(tuple, folded.collect())) == sorted(map(tuple, by_words.collect()))
    text = bpe.decode_text(F.col("tokens"), merges, tokenizer.eot)
    decoded = {r["doc_id"]: r["t"] for r in folded.select("doc_id", text.alias("t")).collect()}
    assert decoded == dict(enumerate(texts))
    known = bpe.vocabulary(merges)
    for r in folded.select("doc_id", codec.ids(F.col("tokens")).alias("ids")).collect():
        assert r["ids"][0] == tokenizer.eot
        assert b"".join(known[i] for i in r["ids"][1:]).decode() == texts[r["doc_id"]]


def test_merges_table_round_trip(spark):
    merges = [(97, 98, 256, 5), (256, 99, 257, 2)]
    assert bpe.load_merges(bpe.merges_table(spark, merges)) == merges
