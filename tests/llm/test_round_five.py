"""Faults found by the review of round four."""

import random
import tracemalloc

import numpy as np
import pyarrow as pa

from corpusforge.llm import class_model, simhash_dedup


def test_later_rounds_of_near_copies_deal_only_documents_that_met(spark, monkeypatch):
    r = random.Random(3)
    words = [f"w{i}" for i in range(120)]
    texts = [" ".join(r.choices([f"u{i}" for i in range(5000)], k=60)) for _ in range(300)]
    for _ in range(24):  # one group, larger than the candidates of the first round
        text = list(words)
        for _ in range(r.randint(0, 2)):
            i = r.randrange(len(text) - 1)
            text[i], text[i + 1] = text[i + 1], text[i]
        texts.append(" ".join(text))
    dealt, sizes = simhash_dedup.dealt_points, []

    def counted(points, *rest):
        sizes.append(points.count())
        return dealt(points, *rest)

    monkeypatch.setattr(simhash_dedup, "dealt_points", counted)
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {x.doc_id: x.component_id for x in simhash_dedup.simhash_near_dedup(rows).collect()}
    assert all(got[d] == d for d in range(300)) and sum(got[d] == 300 for d in range(300, 324)) >= 12
    assert len(sizes) > simhash_dedup.WORD_MIXES and sizes[0] > 300
    assert max(sizes[simhash_dedup.WORD_MIXES :]) <= 24


def test_candidates_are_named_once_and_no_pair_is_lost():
    rng = np.random.default_rng(4)
    fine = rng.integers(0, 1 << 62) ^ (1 << rng.integers(0, 62, 200)).astype(np.int64)
    rows = pa.table({"f": np.zeros(200, np.int64), "fine": fine, "first": rng.permutation(200).astype(np.int64)})
    plain = simhash_dedup.nearest_earlier(rows, 2, 16, 4)
    named = simhash_dedup.nearest_earlier(rows, 2, 16, 4, named=True)
    some = named.column("bits").to_numpy() != simhash_dedup.NO_PAIR
    assert named.filter(pa.array(some)).equals(plain)
    assert set(named.column("a").to_pylist()) == set(range(200)) and named.filter(pa.array(~some)).column("a").to_pylist() == [0]


def test_hashing_a_slice_holds_little_memory(monkeypatch):
    r = random.Random(5)
    texts = [None, "", " \t", *(" ".join(r.choices(["Ab", "c", "dé"], k=r.randint(1, 3000))) for _ in range(600))]
    rows = pa.table({"text": pa.array(texts, pa.string())})
    class_model.tokens_of(rows)  # tables of powers are made once
    tracemalloc.start()
    tokens, first = class_model.tokens_of(rows)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 8 * class_model.HASHED_AT_ONCE * 8 + 3 * tokens.nbytes
    monkeypatch.setattr(class_model, "HASHED_AT_ONCE", 1 << 40)
    whole, start = class_model.tokens_of(rows)
    assert (tokens == whole).all() and (first == start).all() and first[-1] == len(tokens)
    assert len(class_model.tokens_of(rows.slice(0, 0))[0]) == 0
