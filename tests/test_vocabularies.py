"""Vocabularies of usual size: many merges learned, a user's numbered bytes, the public ids, scratch tables."""

import base64
import random
from collections import Counter, defaultdict
from pathlib import Path

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import regex
import tiktoken
from pyspark.sql import functions as F

from corpusforge.functions import codec
from corpusforge.functions.text import PRETOKEN_PATTERN
from corpusforge.operators import bpe
from corpusforge.operators.tokenize import tokenize
from corpusforge.plans import catalogue, stages
from corpusforge.session import cut_lineage, scratch, shared_dir

SF = "/root/testdata/sf0.001"


def learned_one_by_one(texts, n_merges):
    """One merge after the other over a plain list of words; only an index of words saves time."""
    words = Counter(w for t in texts for w in regex.findall(PRETOKEN_PATTERN, t))
    split, weight = [list(w.encode()) for w in words], list(words.values())
    counts, index = Counter(), defaultdict(set)
    for w, ids in enumerate(split):
        for pair in zip(ids, ids[1:]):
            counts[pair] += weight[w]
            index[pair].add(w)
    out = []
    while len(out) < n_merges:
        pair, n = min(counts.items(), key=lambda kv: (-kv[1], kv[0]))
        if n <= 0:
            break
        out.append((*pair, 256 + len(out), n))
        for w in list(index[pair]):
            ids, merged, i = split[w], [], 0
            counts.subtract({p: k * weight[w] for p, k in Counter(zip(ids, ids[1:])).items()})
            while i < len(ids):
                hit = tuple(ids[i : i + 2]) == pair
                merged.append(out[-1][2] if hit else ids[i])
                i += 2 if hit else 1
            split[w] = merged
            for p in zip(merged, merged[1:]):
                counts[p] += weight[w]
                index[p].add(w)
        counts += Counter()
    return out


def test_two_thousand_merges_equal_the_sequential_learner(spark):
    docs = catalogue.documents(spark, SF)
    want = learned_one_by_one([r.text for r in docs.collect()], 2000)
    assert len(want) == 2000
    assert bpe.learn_merges(docs, 2000) == want
    assert bpe.learn_merges(docs, 2000, most_symbols=8_000) == want


def test_learning_leaves_no_table(spark):
    before = set(Path(shared_dir(spark), "corpusforge").iterdir())
    databases = spark.sql("SHOW DATABASES").count()
    bpe.learn_merges(catalogue.documents(spark, SF), 20)
    assert set(Path(shared_dir(spark), "corpusforge").iterdir()) == before
    assert spark.sql("SHOW DATABASES").count() == databases


def test_scratch_tables_go_even_when_the_block_fails(spark):
    with pytest.raises(ZeroDivisionError):
        with scratch(spark) as name:
            assert cut_lineage(spark.range(3), "three-rows").count() == 3
            place = Path(shared_dir(spark), "corpusforge", name)
            assert any(place.rglob("*.parquet"))
            1 / 0
    assert not place.exists()
    assert cut_lineage(spark.range(3), "three-rows").count() == 3  # outside a block the table stays


def merged_naively(ids, pairs):
    while True:
        found = [(pairs[l << 16 | r][0], i) for i, (l, r) in enumerate(zip(ids, ids[1:])) if l << 16 | r in pairs]
        if not found:
            return ids
        _, i = min(found)
        ids = [*ids[:i], pairs[ids[i] << 16 | ids[i + 1]][1], *ids[i + 2 :]]


def test_merging_a_sequence():
    r = random.Random(3)
    for _ in range(300):
        top = r.randint(2, 5)
        merges = []
        for new in range(top, top + r.randint(1, 8)):
            merges.append((r.randrange(new), r.randrange(new), new, 1))
        pairs = bpe.vocabulary_of(merges).pairs
        ids = [r.randrange(top) for _ in range(r.randint(0, 25))]
        assert bpe.merge_ids(ids, pairs) == merged_naively(ids, pairs)
    assert len(bpe.merge_ids([0] * 100_001, {0: (0, 1), 1 << 16 | 1: (1, 2)})) == 25_001


def ranks():
    lines = Path(public_tokenizers.path(catalogue.RANK_FILE)).read_bytes().splitlines()
    return {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}


def test_public_ids_equal_the_public_library(spark):
    odd = ["", None, "  two  blanks ", "don't I'LL\n\n x \t y", "a  b　c  d \x1c\x85 e", "日本 ½ Ⅷ ١٢ éèÉ ǅ", "🙂🙂 ‍ ﬁ", "x" * 3000, "<|endoftext|>"]
    docs = spark.createDataFrame(list(enumerate(odd)), "doc_id long, text string")
    docs = docs.unionByName(catalogue.documents(spark, SF).select(F.col("doc_id") + 100, "text").toDF("doc_id", "text"))
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks(), special_tokens={})
    tokenizer = catalogue.gpt2_tokenizer(spark)
    rows = tokenize(docs, tokenizer)
    got = {r.doc_id: r.ids for r in rows.select("doc_id", codec.ids(F.col("tokens")).alias("ids")).collect()}
    texts = {r.doc_id: r.text or "" for r in docs.collect()}
    assert got == {d: [catalogue.GPT2_EOT, *library.encode_ordinary(t)] for d, t in texts.items()}
    words = bpe.load_ranks(catalogue.read_ranks(spark, "file://" + public_tokenizers.path(catalogue.RANK_FILE)))
    back = rows.select("doc_id", bpe.decode_tokens(F.col("tokens"), words, catalogue.GPT2_EOT).alias("t"))
    assert {r.doc_id: r.t for r in back.collect()} == texts


def test_permuted_bytes_load(spark):
    order = random.Random(8).sample(range(256), 256)
    table = [(bytes([b]), i + 100) for b, i in enumerate(order)] + [(b"ab", 400), (b"aba", 65_535), ("é".encode(), 401)]
    words = bpe.load_ranks(spark.createDataFrame(table, "token binary, id int"))
    docs = spark.createDataFrame([(1, "abab é c"), (2, None)], "doc_id long, text string")
    tokenizer = bpe.vocabulary_tokenizer(words, eot=7, pattern=PRETOKEN_PATTERN)
    got = tokenize(docs, tokenizer).select("doc_id", codec.ids(F.col("tokens")).alias("ids"))
    blank, c = (order[b] + 100 for b in b" c")
    assert {r.doc_id: r.ids for r in got.collect()} == {1: [7, 400, 400, blank, 401, blank, c], 2: [7]}
    assert tokenizer.vocab_size == 65_536


@pytest.mark.parametrize("rows", [[(b"a", 1)], [(bytes([b]), b) for b in range(256)] + [(b"ab", 70_000)], [(bytes([b]), b) for b in range(256)] + [(b"a", 300)]])
def test_bad_vocabularies_are_refused(spark, rows):
    with pytest.raises(ValueError):
        bpe.load_ranks(spark.createDataFrame(rows, "token binary, id int"))


def test_shards_with_public_ids(spark, tmp_path):
    tokenizer = catalogue.gpt2_tokenizer(spark)
    manifest = stages.prepare_shards(spark, f"{SF}/documents.parquet", str(tmp_path / "s"), 40_000, tokenizer).collect()
    counted = sum(r.n_tokens for r in catalogue.doc_tokens_gpt2(spark, SF).collect())
    assert sum(r["n_tokens"] for r in manifest) == counted


def test_many_sequences_are_merged_side_by_side():
    r = random.Random(5)
    for _ in range(60):
        top = r.randint(2, 5)
        merges = [(r.randrange(new), r.randrange(new), new, 1) for new in range(top, top + r.randint(0, 8))]
        pairs = bpe.vocabulary_of(merges).pairs
        rows = [[r.randrange(top) for _ in range(r.choice((0, 1, 2, 3, 5, 9, 20, 60)))] for _ in range(40)]
        flat, bounds = np.array([i for row in rows for i in row], np.uint32), np.cumsum([0, *map(len, rows)])
        got = bpe.merge_all(flat, bounds, bpe.PairTable(pairs))
        assert [bpe.unpacked_ids(x) for x in got] == [merged_naively(row, pairs) for row in rows]


def test_no_step_of_python_per_merge_of_a_new_word(spark, monkeypatch):
    monkeypatch.setattr(bpe, "merge_ids", None)
    pairs = {ord("a") << 16 | ord("b"): (0, 256), 256 << 16 | 256: (1, 257)}
    encode = bpe.encoder(bpe.Vocabulary(tuple(range(256)), pairs)).func
    batch = pa.array([["abab", " x"], None, [], ["b", "ab"]], pa.list_(pa.string()))
    assert [bpe.unpacked_ids(t) for t in next(encode(iter([batch]))).to_pylist()] == [[257, 32, 120], [], [], [98, 256]]


def test_words_are_not_taken_apart_before_they_are_counted(spark):
    docs = spark.createDataFrame([(1, "a é ab ab"), (2, None)], "doc_id long, text string")
    words = bpe.longer_words(docs)
    assert {bytes(r.tokens)[1::2]: r.n for r in words.collect()} == {" é".encode(): 1, b" ab": 2}
    plan = words._jdf.queryExecution().optimizedPlan().toString()
    tests = [line for line in plan.splitlines() if "Filter" in line]
    assert tests and not any("encode(" in line for line in tests)
    assert len(bpe.learn_merges(docs, 2)) == 2


def test_some_dozen_merges_take_no_pass_over_the_text_each(spark, monkeypatch):
    odd = [(1, "the then  ten\n the"), (2, None), (3, ""), (4, " é日本 aaaa"), (5, "\x00\xff th")]
    docs = spark.createDataFrame(odd, "doc_id long, text string")
    merges = [(a, b, 256 + i, 1) for i, (a, b) in enumerate(zip(b"the " * 8, b"he t" * 8))][:4]
    merges += [(97, 97, 260, 1), (260, 260, 261, 1)] + [(i, i, 262 + i, 1) for i in range(58)]
    coded = tokenize(docs, bpe.bpe_tokenizer(merges))
    assert "replace(replace(" not in coded._jdf.queryExecution().optimizedPlan().toString()
    monkeypatch.setattr(bpe, "FOLD_LIMIT", 512)
    folded = tokenize(docs, bpe.bpe_tokenizer(merges))
    assert sorted(map(tuple, coded.collect())) == sorted(map(tuple, folded.collect()))
