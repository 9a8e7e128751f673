"""Column expressions against plain Python."""

import random
import struct
from collections import Counter

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from corpusforge.functions import codec, text
from corpusforge.operators import loader, ngram, pack
from corpusforge.operators.tokenize import check_ids, text_parts, token_unigrams, tokenize, tokenize_parts

TEXTS = ["", "a", "héé\n\t x", "<|endoftext|> plain", "日本 12,3!!  end ", " nb \x1f", "🙂 ok"]


def docs(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")


def test_document_mark_comes_first_and_ids_are_bytes(spark):
    rows = tokenize(docs(spark, TEXTS)).select("doc_id", "n_tokens", codec.ids(F.col("tokens")).alias("ids"))
    for row in rows.collect():
        expected = [256, *TEXTS[row["doc_id"]].encode()]
        assert row["ids"] == expected and row["n_tokens"] == len(expected)


@settings(max_examples=10, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.text(max_size=40), min_size=1, max_size=8))
def test_any_text_survives(spark, texts):
    texts = [t.encode("utf-8", "ignore").decode() for t in texts]
    rows = tokenize(docs(spark, texts)).select("doc_id", codec.ids(F.col("tokens")).alias("ids"))
    got = {r["doc_id"]: bytes(r["ids"][1:]).decode() for r in rows.collect()}
    assert got == dict(enumerate(texts))


def test_null_text_counts_as_empty(spark):
    rows = tokenize(spark.createDataFrame([(1, None)], "doc_id long, text string"))
    assert rows.first()["n_tokens"] == 1


def test_strip_is_pythons_strip(spark):
    odd = ["\t a b \n", " x　", " y\x85", "\x1cz\x1f", "", "   ", "in side", "​kept"]
    got = docs(spark, odd).select("doc_id", text.strip(F.col("text")).alias("s")).collect()
    assert {r["doc_id"]: r["s"] for r in got} == {i: t.strip() for i, t in enumerate(odd)}


def test_pretokens_concatenate_to_the_text(spark):
    joined = F.array_join(text.pretokens(F.col("text")), "")
    assert docs(spark, TEXTS).where(joined != F.col("text")).count() == 0


def test_context_has_no_leading_blank_without_support(spark):
    rows = spark.createDataFrame(
        [("s ", " q"), (" ", "q "), (None, "q")], "support string, question string"
    )
    got = rows.select(text.question_context(F.col("support"), F.col("question")).alias("c")).collect()
    assert [r["c"] for r in got] == ["s q", "q", "q"]


def test_cuts(spark):
    row = spark.range(1).select(codec.const_tokens(1, 2, 3, 300).alias("t"))
    t = F.col("t")
    got = row.select(
        codec.ids(codec.cut(t, F.lit(1), F.lit(2))).alias("mid"),
        codec.ids(codec.last_ids(t, 2)).alias("last"),
        codec.ids(codec.last_ids(t, 9)).alias("all"),
        codec.ids(F.lit(b"")).alias("none"),
        codec.max_id(t).alias("top"),
    ).first()
    assert (got["mid"], got["last"], got["all"], got["none"], got["top"]) == (
        [2, 3], [3, 300], [1, 2, 3, 300], [], 300,
    )


def test_unigrams(spark):
    got = {r["token_id"]: r["n"] for r in token_unigrams(tokenize(docs(spark, ["aab", ""]))).collect()}
    assert got == {256: 2, 97: 2, 98: 1}


def test_id_guard(spark):
    rows = tokenize(docs(spark, ["abc"]))
    assert check_ids(rows, 257).count() == 1
    with pytest.raises(Exception, match="outside the vocabulary"):
        check_ids(rows, 256).collect()


def test_every_sixteen_bit_id_survives(spark):
    """Ids in the surrogate range too, through offsets, shards, windows and n-grams."""
    rng = random.Random(4)
    texts = {d: [rng.choice([0, 255, 0xD7FF, 0xD800, 0xDBFF, 0xDC00, 0xDFFF, 0xE000, 65_535]) for _ in range(40)] for d in range(3)}
    rows = [(d, 40, struct.pack(">40H", *ids)) for d, ids in texts.items()]
    tokenized = spark.createDataFrame(rows, "doc_id long, n_tokens long, tokens binary")
    got = tokenized.select("doc_id", codec.ids(F.col("tokens")).alias("ids"), codec.max_id(F.col("tokens")).alias("top"))
    assert {r.doc_id: (r.ids, r.top) for r in got.collect()} == {d: (ids, max(ids)) for d, ids in texts.items()}
    stream = [i for d in sorted(texts) for i in texts[d]]
    counted = {r.token_id: r.n for r in token_unigrams(tokenized).collect()}
    assert counted == Counter(stream)
    assert check_ids(tokenized, 65_536).count() == 3
    with pytest.raises(Exception, match="outside the vocabulary"):
        check_ids(tokenized, 65_535).collect()
    windows = loader.windows(pack.shard_pieces(pack.doc_offsets(tokenized), 1000), 1, 7)
    cut = {r.w: r.ids for r in windows.select("w", codec.ids(F.col("tokens")).alias("ids")).collect()}
    assert cut == {w: stream[w * 7 : w * 7 + 8] for w in range(119 // 7)}
    grams = ngram.by_context_length(ngram.count_keys(ngram.targets(tokenized)))
    pairs = Counter((f"{a}", b) for ids in texts.values() for a, b in zip(ids, ids[1:]))
    assert {(r.h, r.w): r.n for r in grams.where("k = 1").collect()} == pairs


@pytest.mark.parametrize("part", [3, 7, 50])
def test_parts_of_a_text_make_it_up_and_keep_its_pretokens(spark, part):
    rng = random.Random(part)
    signs = ["a", "é", " ", "\n", "12", "!", "日", "🙂"]
    texts = TEXTS + ["".join(rng.choices(signs, k=rng.randint(0, 60))) for _ in range(150)] + ["x" * 200, "\n" * 40, None]
    table = docs(spark, texts)
    for safe in (True, False):
        joined = {}
        for r in sorted(text_parts(table, safe, part).collect(), key=lambda r: (r.doc_id, r.part)):
            joined[r.doc_id] = joined.get(r.doc_id, b"") + bytes(r.raw)
        assert joined == {i: (t or "").encode() for i, t in enumerate(texts)}
    parts = text_parts(table, True, part).select(F.explode(text.pretokens(F.decode("raw", "UTF-8"))).alias("w"))
    whole = table.select(F.explode(text.pretokens(F.col("text"))).alias("w"))
    assert sorted(map(tuple, parts.groupBy("w").count().collect())) == sorted(map(tuple, whole.groupBy("w").count().collect()))
    by_part = tokenize_parts(table, part=part).groupBy("doc_id").agg(F.expr("listagg(tokens) within group (order by part)").alias("tokens"))
    assert by_part.exceptAll(tokenize(table).select("doc_id", "tokens")).count() == 0
    totals = [pack.corpus_totals(t, 10, 257).first() for t in (tokenize(table), tokenize_parts(table, part=part))]
    assert totals[0] == totals[1]
