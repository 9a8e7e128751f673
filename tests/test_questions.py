"""Fine-tuning rows, choices, labels, scores, predictions on hand-made rows."""

import hashlib
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from corpusforge.functions import codec
from corpusforge.operators import mcq, ngram, sft
from corpusforge.operators.scoring import score_units
from corpusforge.sources import corpus, fixtures, results


def sciq(spark, rows):
    columns = (
        "split string, item_id long, support string, question string, correct_answer string, "
        "distractor1 string, distractor2 string, distractor3 string"
    )
    return spark.createDataFrame(rows, columns)


def one(support, question, answer, item=0):
    return ("train", item, support, question, answer, "x", "y", "z")


def wanted(support, question, answer, limit):
    """The last ids of the joined texts; the mask holds the answer, its blank and the end mark."""
    text = " ".join(filter(None, map(str.strip, (support, question, answer))))
    ids = [*text.encode(), 256][-limit:]
    scored = len(answer.strip().encode()) + 2
    return ids, [int(left <= scored) for left in range(len(ids), 0, -1)]


@pytest.mark.parametrize("total", [255, 256, 257, 300])
def test_examples_around_the_length_limit(spark, total):
    question = "q" * (total - 5)
    rows = [one("", question, "abc"), one("s", "q" * 10, "a" * (total - 14), 1), one(" ", "é ", " ü", 2)]
    got = sft.with_ids_and_mask(sft.sft_examples(sciq(spark, rows))).collect()
    for r in got:
        expected = wanted(*rows[r["item_id"]][2:5], 256)
        assert (r["ids"], r["mask"]) == expected and r["n_ids"] == len(expected[0])


def test_answer_longer_than_the_limit_starts_at_zero(spark):
    row = sft.sft_examples(sciq(spark, [one("", "q", "a" * 400)])).first()
    assert (row["n_ids"], row["answer_start"]) == (256, 0)
    keys = ngram.targets(sft.sft_examples(sciq(spark, [one("", "q", "a" * 400)])), first=F.col("answer_start"))
    assert keys.count() == 255


def test_batches_follow_the_md5_order_and_are_padded_and_shifted(spark):
    rows = [one("", "q" * (1 + i % 7), "a", i) for i in range(37)]
    examples = sft.sft_examples(sciq(spark, rows))
    got = sft.collate(sft.assign_batches(examples, epochs=2, seed=3)).collect()
    for epoch in range(2):
        order = sorted(range(37), key=lambda i: (hashlib.md5(f"3:{epoch}:{i}".encode()).hexdigest(), i))
        mine = {(r["batch"], r["row_in_batch"]): r for r in got if r["epoch"] == epoch}
        assert [mine[k]["item_id"] for k in sorted(mine)] == order
        assert sorted({b for b, _ in mine}) == [0, 1, 2]
    for r in got:
        ids, mask = wanted(*rows[r["item_id"]][2:5], 256)
        pad = r["max_len"] - len(ids)
        ids, mask = ids + [0] * pad, mask + [0] * pad
        assert (r["x"], r["y"], r["y_mask"]) == (ids[:-1], ids[1:], mask[1:])
        assert r["max_len"] == max(o["n_ids"] for o in got if (o["epoch"], o["batch"]) == (r["epoch"], r["batch"]))


ARC = (
    "split string, item_id long, question string, "
    "choices struct<text: array<string>, label: array<string>>, answerKey string"
)


def test_gold_labels_and_the_digit_fallback(spark):
    rows = [
        ("test", 1, "q", (["a", "b", "c", "d"], ["A", "B", "C", "D"]), "C"),
        ("test", 2, "q", (["a", "b", "c"], ["A", "B", "C"]), "2"),
        ("test", 3, "q", (["a", "b", "c", "d"], ["1", "2", "3", "4"]), "4"),
        ("test", 4, "q", (["a", "b", "c"], ["1", "2", "3"]), "B"),
        ("test", 5, "q", (["a", "b", "c"], ["A", "B", "C"]), "D"),
    ]
    got = mcq.gold_labels(spark.createDataFrame(rows, ARC)).orderBy("item_id").collect()
    assert [tuple(r)[1:] for r in got] == [
        (4, 2, False), (3, 1, True), (4, 3, False), (3, None, False), (3, None, False),
    ]


def scores(spark, rows):
    schema = "model string, source string, split string, item_id long, gold_idx long, choice_idx long, score double"
    return spark.createDataFrame([("m", "s", "test", *r) for r in rows], schema)


def test_first_of_equal_scores_wins_and_unresolved_gold_never_hits(spark):
    df = scores(spark, [
        (1, 0, 0, -1.0), (1, 0, 1, -1.0 + 1e-14), (1, 0, 2, -3.0),
        (2, 0, 0, -2.0), (2, 0, 1, -1.0),
        (3, None, 0, -1.0), (3, None, 1, -2.0),
        (4, 1, 0, None), (4, 1, 1, -5.0),
    ])
    got = {r["item_id"]: (r["pred_idx"], r["hit"]) for r in mcq.predictions(df).collect()}
    assert got == {1: (0, True), 2: (1, False), 3: (0, False), 4: (1, True)}
    acc = mcq.accuracy(mcq.predictions(df)).first()
    assert (acc["total"], acc["correct"], acc["accuracy"]) == (4, 2, 0.5)


def brute_counts(sequences):
    counts = {}
    for seq, first in sequences:
        for p in range(max(1, first), len(seq)):
            key = (tuple(seq[max(0, p - 2) : p]), seq[p])
            counts[key] = counts.get(key, 0) + 1
    return counts


def brute_logp(counts, context, w, vocab):
    def total(pred):
        return sum(n for (h, y), n in counts.items() if pred(h, y))

    p = (total(lambda h, y: y == w) + 1) / (sum(counts.values()) + vocab)
    for length in (1, 2):
        if len(context) >= length:
            tail = tuple(context[-length:])
            seen = total(lambda h, y: len(h) >= length and h[-length:] == tail)
            if seen:
                hits = total(lambda h, y: len(h) >= length and h[-length:] == tail and y == w)
                p = 0.7 * hits / seen + 0.3 * p
    return math.log(p)


def make_model(spark, sequences, name="base"):
    rows = spark.createDataFrame(
        [(bytearray(b"".join(i.to_bytes(2, "big") for i in s)), f) for s, f in sequences], "tokens binary, first long"
    )
    counts = ngram.count_keys(ngram.targets(rows, first=F.col("first"))).withColumnRenamed("n", name)
    return ngram.fit(counts, (name,), 257)


CORPUS = [([256, *b"the cat sat on the mat"], 0), ([*b"a hat and a cat"], 3), ([256], 0)]


def test_choice_scores_against_brute_force(spark):
    items = spark.createDataFrame(
        [("s", "test", 1, "the c", ["at", "zq"], 0), ("s", "test", 2, "", ["a mat", "on"], 1), ("s", "test", 3, "t", ["he"], 0)],
        "source string, split string, item_id long, context string, choices array<string>, gold_idx long",
    )
    counts = brute_counts(CORPUS)
    got = mcq.choice_scores(items, make_model(spark, CORPUS)).collect()
    assert len(got) == 5
    contexts = {1: "the c", 2: "", 3: "t"}
    choices = {1: ["at", "zq"], 2: ["a mat", "on"], 3: ["he"]}
    for r in got:
        ctx = list(contexts[r["item_id"]].encode())
        choice = list((" " + choices[r["item_id"]][r["choice_idx"]]).encode())
        seq = ctx + choice
        logp = sum(brute_logp(counts, seq[:p], seq[p], 257) for p in range(max(1, len(ctx)), len(seq)))
        assert r["score"] == pytest.approx(logp / len(choice), abs=1e-12)


@pytest.mark.parametrize("top_k, temperature", [(3, 1.0), (1, 0.5), (None, 2.0)])
def test_next_tokens_against_brute_force(spark, top_k, temperature):
    counts = brute_counts(CORPUS)
    contexts = [b"he", b"zz", b"t", b"", b"zt"]
    df = spark.createDataFrame([(bytearray(b"".join(bytes([0, c]) for c in ctx)),) for ctx in contexts], "context binary")
    rows = make_model(spark, CORPUS).next_token_topk(df, "base", top_k, temperature).collect()
    for ctx in contexts:
        mine = {int.from_bytes(r["w"], "big"): r["p"] for r in rows if bytes(r["context"])[1::2] == ctx}
        logits = {w: math.exp(round(brute_logp(counts, list(ctx), w, 257), 10)) for w in range(257)}
        kth = sorted(logits.values(), reverse=True)[(top_k or 257) - 1]
        kept = {w: p ** (1 / temperature) for w, p in logits.items() if p >= kth}
        assert set(mine) == set(kept) and sum(mine.values()) == pytest.approx(1.0)
        for w, p in mine.items():
            assert p == pytest.approx(kept[w] / sum(kept.values()), rel=1e-6)


def test_tiny_probabilities_rank_apart(spark):
    """Far below any fixed number of decimals: about 1e-13 for the rarer tokens."""
    key = lambda w: bytearray([0, 9, 0, w])
    counts = spark.createDataFrame([(key(1), 10**13), (key(2), 3), (key(3), 2), (key(4), 2), (key(5), 1)], "key binary, base long")
    model = ngram.NgramModel(counts, ("base",), 20)
    contexts = spark.createDataFrame([(bytearray(),)], "context binary")
    ranked = {r["w"][1]: r["rnk"] for r in model.next_token_topk(contexts, "base", 5).collect()}
    assert ranked == {1: 1, 2: 2, 3: 3, 4: 3, 5: 5}
    rows = model.next_token_topk(contexts, "base", None).collect()
    assert len(rows) == 20 and max(r["rnk"] for r in rows) == 6


def test_draws_follow_the_distribution(spark):
    dist = spark.createDataFrame(
        [(bytearray(i.to_bytes(2, "big")), bytearray(bytes([0, w])), 1, p) for i in range(2000) for w, p in ((1, 0.7), (2, 0.3))],
        "context binary, w binary, rnk long, p double",
    )
    drawn = ngram.next_token_draw(dist, 5)
    share = drawn.where(codec.id_of(F.col("w")) == 1).count() / 2000
    assert 0.66 < share < 0.74
    assert sorted(map(tuple, drawn.collect())) == sorted(map(tuple, ngram.next_token_draw(dist, 5).collect()))


def test_user_scorer_gets_cropped_ids(spark):
    items = spark.createDataFrame(
        [("s", "test", 1, "abcdef", ["xy"], 0)],
        "source string, split string, item_id long, context string, choices array<string>, gold_idx long",
    )
    seen = lambda b: b.apply(lambda r: float(len(r.ctx_ids) * 100 + len(r.choice_ids) + np.asarray(r.ctx_ids)[0]), axis=1)
    assert mcq.user_scores(items, seen, "net", max_ctx=5).first()["score"] == (200 + 3 + ord("e")) / 3


def test_leaderboard_appends_without_the_random_row(spark, tmp_path):
    df = scores(spark, [(1, 0, 0, -1.0), (1, 0, 1, -2.0)])
    board = mcq.leaderboard(mcq.accuracy(mcq.predictions(df)))
    assert {r["model"]: r["accuracy"] for r in board.collect()} == {"m": 1.0, "random baseline": 0.25}
    for _ in range(2):
        results.append_results(board, str(tmp_path / "results"))
    stored = results.read_results(spark, str(tmp_path / "results")).collect()
    assert [tuple(r) for r in stored] == [("m", "s (test)", 1, 1, 1.0)]


def test_first_items_are_the_first_in_order(spark):
    df = spark.range(20, 0, -1).withColumnRenamed("id", "item_id")
    assert sorted(r["item_id"] for r in mcq.first_items(df, 3).collect()) == [1, 2, 3]


def test_readers_take_one_split(spark, tmp_path):
    sciq(spark, [one("", "q", "a"), ("test", 1, "", "q", "a", "x", "y", "z")]).write.parquet(str(tmp_path / "sciq"))
    assert corpus.read_sciq(spark, str(tmp_path / "sciq"), "test").count() == 1
    assert corpus.read_sciq(spark, str(tmp_path / "sciq")).count() == 2
    arc = spark.createDataFrame([("test", 1, "q", (["a"], ["A"]), "A")], ARC)
    arc.write.parquet(str(tmp_path / "arc"))
    assert corpus.read_arc(spark, str(tmp_path / "arc"), "test").collect() == arc.collect()


def test_one_huge_conversation_loses_nothing(spark):
    turns = [(7, 0, "system", "Sys.")]
    for t in range(1, 400, 2):
        turns += [(7, t, "user", f"question {t}?"), (7, t + 1, "assistant", f"one {t}. two {t}!\n\nthree {t}")]
    rows = fixtures.sciq_shaped(spark.createDataFrame(turns, fixtures.CONVERSATIONS)).orderBy("item_id").collect()
    answers = [f"{w} {t}" for t in range(1, 400, 2) for w in ("one", "two", "three")]
    assert [r["correct_answer"] for r in rows] == answers[:-3]
    assert all(r["support"] == "Sys." for r in rows)
    assert [r["distractor3"] for r in rows] == answers[3:]


def test_broadcast_and_shuffle_joins_score_alike(spark):
    rows = [(u, bytearray(b"".join(i.to_bytes(2, "big") for i in seq)), f) for u, (seq, f) in enumerate(CORPUS)]
    rows += [(9, bytearray(b"\0a" * 500), 0)]
    df = spark.createDataFrame(rows, "u long, tokens binary, first long")
    model = make_model(spark, CORPUS)
    small, large = (
        sorted(map(tuple, score_units(df, ["u"], model, F.col("first"), broadcast_rows=limit).collect()))
        for limit in (400_000, 0)
    )
    assert [r[:2] for r in small] == [r[:2] for r in large] and len(small) == 4
    for a, b in zip(small, large):
        assert a[2] == b[2] or a[2] == pytest.approx(b[2])


@pytest.mark.parametrize("limit", [1, 3, 50])
def test_a_hot_ngram_is_scored_apart(spark, limit):
    """A thousand units share one n-gram: above the limit it is broadcast, rare ones are shuffled."""
    one = lambda seq: bytearray(b"".join(i.to_bytes(2, "big") for i in seq))
    rows = [(u, one([1, 2, 3] if u % 10 else [1, 2, 3, u % 7, u % 5]), 1) for u in range(1000)]
    rows.append((1000, one([4]), 1))
    df = spark.createDataFrame(rows, "u long, tokens binary, first long")
    model = make_model(spark, CORPUS)
    whole, parts = (
        {r["u"]: r for r in score_units(df, ["u"], model, F.col("first"), broadcast_rows=x).collect()}
        for x in (400_000, limit)
    )
    assert len(parts) == 1001 and parts[1000]["n_targets"] == 0
    for u, row in parts.items():
        assert row["n_targets"] == whole[u]["n_targets"]
        assert row[2] == whole[u][2] or row[2] == pytest.approx(whole[u][2])


def test_long_choices_count_by_the_ids_scored(spark):
    items = spark.createDataFrame(
        [("s", "test", 1, "abc", ["x" * 9], 0)],
        "source string, split string, item_id long, context string, choices array<string>, gold_idx long",
    )
    lengths = lambda b: -(b["ctx_ids"].map(len) * 100 + b["choice_ids"].map(len)).astype(float)
    assert mcq.user_scores(items, lengths, "net", max_ctx=4).first()["score"] == -1


def test_places_of_long_replies_and_large_ids(spark):
    """Ids are places in the order of conversation, turn and sentence, whatever their sizes."""
    schema = "conv_id long, turn long, role string, text string"
    talk = [(c, t, r, x) for c in (7, 2**40) for t, r, x in ((0, "user", "q"), (1, "assistant", "a. " * 10_010), (2, "user", "q"), (3, "assistant", "b. c. d. e"))]
    rows = fixtures.sciq_shaped(spark.createDataFrame(talk, schema)).select("item_id", "question")
    assert sorted(r["item_id"] for r in rows.collect()) == list(range(2 * 10_014 - 3))
