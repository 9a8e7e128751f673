"""The dealt operators on hand-made tables: odd rows for all, brute force for each."""

import hashlib
import math
import random
import re
import struct
import zlib
from collections import Counter

import brute
import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from corpusforge.llm import class_model, decontaminate, line_dedup, quality_rules, simhash_dedup, toxicity
from corpusforge.llm import bpe_codec, token_counts
from corpusforge.llm.suffix_dedup import suffix_dedup
from corpusforge.llm.substring_dedup import substring_dedup

PATH = public_tokenizers.path("word_bpe_49k.json")
SCHEMA = "doc_id long, text string, source string, g int, kept string, word string, lang string, n_chars long"
LONG = " ".join(f"word{i % 977} item{i % 89}" for i in range(60_000))


def table(spark, rows):
    """Documents with extra columns whose names the operators use inside."""
    return spark.createDataFrame([(d, t, s, 1, "x", None, "en", None) for d, t, s in rows], SCHEMA)


ODD = [
    (1, None, None), (2, "", "a"), (3, " \t\n ", "a"), (4, "one", "a"), (5, "one", "a"), (5, "one", "a"),
    (6, "same words here " * 40, "a"), (7, "same words here " * 40, "b"), (None, "same words here " * 40, "b"),
    (None, None, None), (8, LONG, "b"), (9, LONG[:200_000], "b"), (-3, "ÉÀ Straße <|endoftext|> it's 12!?", "a"),
]


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(1, 0), (4, None), (None, 1), (77, 1)], "doc_id long, toxic int")


@pytest.fixture(scope="module")
def benchmark(spark):
    return spark.createDataFrame([(1, None), (2, ""), (None, "what is one? two three four five six seven"), (3, "x")], "item_id long, text string")


def operators(labels, benchmark):
    return {
        "op1": lambda d: bpe_codec.encode_decode(d, PATH),
        "op2": quality_rules.quality_rules,
        "op3": simhash_dedup.simhash_dedup,
        "op4": lambda d: toxicity.toxicity(d, labels),
        "op5": class_model.class_model_scores,
        "op6": lambda d: token_counts.count_tokens(d, PATH, 50),
        "op7": suffix_dedup,
        "op8": substring_dedup,
        "op9": line_dedup.line_dedup,
        "op10": lambda d: decontaminate.decontaminate(d, benchmark),
    }


@pytest.mark.parametrize("name", ["op1", "op2", "op3", "op4", "op5", "op6", "op7", "op8", "op9"])
def test_odd_rows_and_empty_tables(spark, labels, benchmark, name):
    run = operators(labels, benchmark)[name]
    rows = run(table(spark, ODD)).collect()
    assert Counter(r["doc_id"] for r in rows) == Counter(d for d, _, _ in ODD)
    assert run(table(spark, [])).count() == 0


def test_nothing_leaks_from_odd_rows(spark, labels, benchmark):
    run = operators(labels, benchmark)["op10"]
    assert run(table(spark, [])).count() == 0
    assert run(table(spark, ODD)).where("doc_id is not null").count() == 0
    found = run(table(spark, [(1, "so What is ONE? two three four five six seven", "a"), (2, "what is one", "a")])).collect()
    assert [(r.doc_id, r.item_id) for r in found] == [(1, None)]


def random_texts(seed, n=120):
    r = random.Random(seed)
    words = [f"{a}{b}" for a in "bcdfgh" for b in ("a", "é", "on", "ish")]
    passage = [r.choice(words) for _ in range(40)]
    rows = []
    for i in range(n):
        text = [r.choice(words) for _ in range(r.randint(0, 60))]
        for _ in range(r.randint(0, 2)):
            a, b = sorted((r.randint(0, 40), r.randint(0, 40)))
            at = r.randint(0, len(text))
            text[at:at] = passage[a:b]
        rows.append((i, r.choice([" ", "\n", "  "]).join(text), "host"))
    return rows + [(n, None, None), (n + 1, rows[0][1], "host")]


def test_codec_equals_the_library(spark):
    r = random.Random(5)
    alphabet = "abcdefgABC'sdtrvem ll12 \n\t!?<|endoftext|>éÉΣσßİ\x1c\x85中文🙂"
    texts = ["".join(r.choice(alphabet) for _ in range(r.randint(0, 60))) for _ in range(300)] + ["ab" * 3000]
    library = Tokenizer.from_file(PATH)
    rows = bpe_codec.encode_decode(table(spark, [(i, t, None) for i, t in enumerate(texts)]), PATH)
    got = {r.doc_id: r for r in bpe_codec.decode(rows.withColumnRenamed("decoded", "first"), PATH).collect()}
    counts = {r.doc_id: r for r in token_counts.count_tokens(table(spark, [(i, t, None) for i, t in enumerate(texts)]), PATH, 9).collect()}
    for i, text in enumerate(texts):
        ids = library.encode(text, add_special_tokens=False).ids
        assert bytes(got[i].ids) == struct.pack(f"<{len(ids)}I", *ids)
        assert got[i].first == got[i].decoded == library.decode(ids, skip_special_tokens=False)
        assert counts[i].n_tokens == len(ids) and counts[i].over_limit == (len(ids) > 9)
        fitting = library.encode(text[: counts[i].fitting_chars], add_special_tokens=False).ids
        assert len(fitting) <= 9 or not counts[i].over_limit


def test_counts_at_every_prefix_of_a_word():
    counter = token_counts.counter(open(PATH).read())
    library = Tokenizer.from_file(PATH)
    for word in ("unbelievable", "zzzzzzzz", "thestraightforwardness"):
        want = [len(library.encode(word[:i], add_special_tokens=False).ids) for i in range(len(word) + 1)]
        assert counter.word_counts(word) == want


def test_repeated_bytes_and_words(spark, monkeypatch):
    rows = random_texts(1)
    monkeypatch.setattr("corpusforge.llm.repeats.group_count", lambda docs: 7)
    for hot in (512, 1):  # with 1, all contexts of shared anchors are dealt window by window
        monkeypatch.setattr("corpusforge.llm.repeats.HOT_CONTEXTS", hot)
        got = suffix_dedup(table(spark, rows)).select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256))
        assert sorted(map(tuple, got.collect())) == brute.bytes_removed([r[:2] for r in rows])
        got = substring_dedup(table(spark, rows)).select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept").cast("binary"), 256))
        assert sorted(map(tuple, got.collect())) == brute.words_removed([r[:2] for r in rows])


def test_near_lines(spark, monkeypatch):
    monkeypatch.setattr("corpusforge.llm.repeats.group_count", lambda docs: 5)
    r = random.Random(2)
    base = ["the quick brown fox jumps over the lazy dog", "lorem ipsum dolor sit amet élit sed", "short"]
    rows = []
    for i in range(150):
        lines = []
        for _ in range(r.randint(0, 5)):
            line = list(r.choice(base))
            for _ in range(r.randint(0, 4)):
                at = r.randrange(len(line))
                line[at : at + r.randint(0, 1)] = r.choice(["", "x", "yz"])
            lines.append("".join(line))
        rows.append((i, "\n".join(lines), None))
    got = sorted(map(tuple, line_dedup.line_dedup(table(spark, rows)).collect()))
    assert got == brute.lines_removed([x[:2] for x in rows])


def test_banded_distance_equals_the_table():
    r = random.Random(3)
    pairs = [("".join(r.choice("ab") for _ in range(r.randint(0, 9))), "".join(r.choice("ab") for _ in range(r.randint(0, 9)))) for _ in range(500)]
    text = "".join(a + b for a, b in pairs) + " "
    ends = np.cumsum([len(x) for pair in pairs for x in pair])
    starts = np.concatenate(([0], ends[:-1]))
    values = np.array([ord(c) for c in text], np.uint32)
    for edits in (1, 2, 3):
        got = line_dedup.within(values, starts[::2], ends[::2], starts[1::2], ends[1::2], edits)
        assert got.tolist() == [brute.edit_distance(a, b) <= edits for a, b in pairs]


def test_simhash_components(spark, monkeypatch):
    monkeypatch.setattr(simhash_dedup, "LEAF", 64)
    r = random.Random(4)
    words = [f"w{i}" for i in range(400)]
    texts = [[r.choice(words) for _ in range(120)] for _ in range(150)]
    for i in range(300):
        near = list(texts[i % 150])
        near[r.randrange(len(near))] = r.choice(words)
        texts.append(near)
    rows = [(i, " ".join(t), None) for i, t in enumerate(texts)] + [(900, "", None), (901, None, None)]
    got = {x.doc_id: x for x in simhash_dedup.simhash_dedup(table(spark, rows)).collect()}
    prints = [simhash_dedup.fingerprint(t) for _, t, _ in rows]
    label = list(range(len(rows)))
    changed = True
    while changed:
        changed = False
        for i in range(len(rows)):
            low = min(label[j] for j in range(len(rows)) if (prints[i] ^ prints[j]).bit_count() <= 2)
            changed |= low != label[i]
            label[i] = low
    assert [got[d].component_id for d, _, _ in rows] == [rows[k][0] for k in label]
    assert len(set(label)) < len(rows) - 50
    assert got[900].f == 0 and got[901].component_id == 900


def test_near_copies_leave_the_pipeline(spark, tmp_path):
    """Against all pairs: five-word shingles, Jaccard similarity of 0.8 or more, by fingerprints."""
    r = random.Random(12)
    words = [f"w{i}" for i in range(500)]
    footer = [f"foot{i}" for i in range(30)]
    texts = [[r.choice(words) for _ in range(r.randint(1, 200))] for _ in range(100)]
    for i in range(200):
        near = list(texts[i % 100])
        for _ in range(r.randint(1, 4)):
            near[r.randrange(len(near))] = r.choice(words)
        texts.append(near + footer * (i % 3 == 0))
    rows = [(i, " ".join(t), None) for i, t in enumerate(texts)] + [(900, "", None), (901, None, None), (None, "W1 w2", None), (902, "w1 w2", None)]

    def shingles(text):
        own = (text or "").lower().split()
        return {tuple(own[i : i + 5]) for i in range(max(1, len(own) - 4))}

    sets = [shingles(t) for _, t, _ in rows]
    ids = [2**63 - 1 if d is None else d for d, _, _ in rows]
    label, pairs = list(ids), []
    for i in range(len(rows)):
        pairs += [(i, j) for j in range(i) if 10 * len(sets[i] & sets[j]) >= 8 * len(sets[i] | sets[j])]
    while True:
        before = list(label)
        for i, j in pairs:
            label[i] = label[j] = min(label[i], label[j])
        if label == before:
            break
    assert sum(sets[i] != sets[j] for i, j in pairs) > 50
    docs = table(spark, rows)
    kept = corpus_pipeline.one_of_each_group(spark, docs, str(tmp_path)).collect()
    # The search by fingerprints finds most near copies; whatever goes is one, and equal sets always go.
    want, stay = {d for d, low in zip(ids, label) if d == low}, {x.doc_id for x in kept}
    assert want <= stay
    assert len(ids) - len(kept) >= 0.85 * (len(ids) - len(want))
    assert 901 not in stay and None not in stay


def test_shards_hold_every_close_pair():
    r = np.random.default_rng(1)
    points = np.unique(r.integers(0, 2**63, 4000).astype(np.uint64))
    close = points[:500] ^ (np.uint64(1) << r.integers(0, 63, 500).astype(np.uint64))
    points = np.unique(np.concatenate((points, close)))
    tree = simhash_dedup.grow(points[::3], len(points) * 8)
    together = set()
    for _, rows in simhash_dedup.shards(tree, points, np.arange(len(points))):
        here = points[rows]
        i, j = np.nonzero(np.bitwise_count(here[:, None] ^ here[None]) <= 2)
        together |= set(zip(rows[i].tolist(), rows[j].tolist()))
    i, j = np.nonzero(np.bitwise_count(points[:, None] ^ points[None]) <= 2)
    assert together == set(zip(i.tolist(), j.tolist()))


def test_quality_base_counts(spark):
    rows = random_texts(6) + [(500, "a b c " * 30 + "#*$%\nx\nx\n\n", "host")]
    got = {r.doc_id: r for r in quality_rules.quality_rules(table(spark, rows)).collect()}
    for doc, text, _ in rows:
        words = brute.WORD.findall(text or "")
        three = Counter(zip(words, words[1:], words[2:]))
        repeat = {i + k for i in range(len(words) - 2) if three[tuple(words[i : i + 3])] > 1 for k in range(3)}
        lines = [x for x in (text or "").split("\n") if brute.WORD.search(x)]
        r = got[doc]
        assert (r.n_words, r.word_chars, r.n_repeat_words) == (len(words), sum(map(len, words)), len(repeat))
        assert (r.n_symbols, r.n_dup_lines) == (len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)))
        assert r.base_failed == (len(words) < 50 or 100 * len(repeat) > 50 * len(words))


def test_lines_of_a_host_above_the_limits(spark):
    rows = [(i, f"{' '.join(f'own{i}x{k}' for k in range(60))}\nShared   line of the host", "h") for i in range(40)]
    rows.append((99, "shared line of the host\n" * 14 + "some few other words", "h"))
    got = {r.doc_id: r for r in quality_rules.quality_rules(table(spark, rows)).collect()}
    assert got[3].removed_words == 5 and got[3].kept and got[99].removed_words == 70 and not got[99].kept


def test_toxic_sentences_are_found(spark):
    r = random.Random(7)
    plain = [f"word{i}" for i in range(200)]
    rows, marks = [], []
    for i in range(600):
        lines = [" ".join(r.choice(plain) for _ in range(8)) for _ in range(5)]
        toxic = i % 3 == 0
        if toxic:
            lines[2] += " grumpus" + r.choice(["", "es", "ly"])
        rows.append((i, ". ".join(lines), None))
        marks.append((i, int(toxic)))
    got = toxicity.toxicity(table(spark, rows), spark.createDataFrame(marks, "doc_id long, toxic int")).collect()
    held = [x for x in got if x.held_out]
    assert all(x.held_out == (zlib.crc32(str(x.doc_id).encode()) % 5 == 0) for x in got)
    assert sum(x.predicted == (x.doc_id % 3 == 0) for x in held) >= 0.95 * len(held)
    text = dict((d, t) for d, t, _ in rows)
    spots = [text[x.doc_id][s.start : s.end] for x in held for s in x.offending if x.doc_id % 3 == 0]
    assert spots and sum("grumpus" in s for s in spots) >= 0.95 * len(spots)


def test_scores_are_noisy_or_of_sentences(spark, monkeypatch):
    """With a given model every score is 1 minus the product of its sentences' chances to be clean."""
    model = {"": -2.0, "bad": 2.5, "wors*": 1.5, "fine": -1.0}
    monkeypatch.setattr(toxicity, "fit", lambda t: pa.table({"feature": list(model), "weight": list(model.values())}))
    r = random.Random(14)
    rows = [(d, "".join(r.choice(["bad ", "worse ", "fine ", "word ", ". ", "! ", "\n"]) for _ in range(r.randint(0, 40))), None) for d in range(60)]
    labels = spark.createDataFrame([(d, d % 2) for d in range(60)], "doc_id long, toxic int")
    for x in toxicity.toxicity(table(spark, rows), labels).collect():
        clean = 1.0
        for sentence in re.split(r"[.!?\n]+", rows[x.doc_id][1]):
            words = set(sentence.split())
            if words:
                z = -2.0 + 2.5 * ("bad" in words) + 1.5 * ("worse" in words) - ("fine" in words)
                clean *= 1 - 1 / (1 + math.exp(-z))
        assert math.isclose(x.score, 1 - clean, abs_tol=1e-9) and x.predicted == (x.score >= 0.5)


def test_copies_of_one_class_do_not_move_the_threshold():
    r = random.Random(15)
    plain = [f"word{i}" for i in range(50)]

    def texts(n, mark):
        return [" ".join(r.choice(plain) for _ in range(12)) + mark for _ in range(n)]

    rows = [(t, 0) for t in texts(60, "")] + [(t, 1) for t in texts(60, " grumpus")]
    fitted = []
    for times in (1, 5):
        seen = [(t, c) for t, c in rows for _ in range(times if c == 0 else 1)]
        ids, labels = pa.array(range(len(seen)), pa.int64()), pa.array([c for _, c in seen], pa.int32())
        model = toxicity.fit(pa.table({"doc_id": ids, "text": [t for t, _ in seen], "toxic": labels}))
        fitted.append(dict(zip(model.column("feature").to_pylist(), model.column("weight").to_pylist())))
    assert abs(fitted[0][""] - fitted[1][""]) < 0.2
    assert all(f[""] + sum(f.get(x, 0) for x in toxicity.features("grumpus")) > 0 > f[""] for f in fitted)


def test_class_model(spark):
    rows = [(d, t, None) for d, t, _ in random_texts(8)]
    got = {r.doc_id: r for r in class_model.class_model_scores(table(spark, rows)).collect()}
    texts = {d: [w.lower() for w in brute.WORD.findall(t or "")] + [None] for d, t, _ in rows}
    held = {d: zlib.crc32(str(d).encode()) % 5 == 1 for d in texts}
    seen = Counter(w for d, t in texts.items() if not held[d] for w in t)
    n, v = sum(seen.values()), len(seen)
    for d, words in texts.items():
        r = got[d]
        base = sum(math.log10((seen[w] + 0.5) / (n + 0.5 * (v + 1))) for w in words)
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (held[d], len(words), sum(seen[w] > 0 for w in words), n)
        assert math.isclose(r.base_score, base, rel_tol=1e-9, abs_tol=1e-9) and r.score < 0


def test_class_probabilities_sum_to_one():
    """After any class the chances of all words, the unknown one and the end add up to one."""
    r = np.random.default_rng(9)
    k = class_model.END + 1
    classes = np.concatenate((r.choice([0, 3, 7], 500), np.full(41, class_model.RARE), [class_model.END]))
    counts = np.where(classes == class_model.RARE, 1, r.integers(2, 90, len(classes)))
    counts[540] = 0  # the unknown word
    size = np.bincount(classes, counts, k)
    members = np.bincount(classes, minlength=k)
    moves = np.zeros((k, k))
    used = np.unique(classes)
    moves[np.ix_(used, used)] = r.integers(0, 50, (len(used), len(used)))
    chance = class_model.chances(moves, members) @ np.eye(k)[:, classes]
    total = (chance * class_model.shares(counts, classes, size, members)).sum(axis=1)
    assert np.allclose(total, 1, rtol=0, atol=1e-9)


def test_words_without_evidence_are_rare(spark, monkeypatch):
    """With the end as the only frequent word, inner words have no evidence: a chain of two states by hand."""
    monkeypatch.setattr(class_model, "FREQUENT", 1)
    rows = [(i, " ".join([f"a{i}", *(f"mid{(i + k) % 7}" for k in range(i % 5)), f"z{i}"]), None) for i in range(150)]
    held = {d: zlib.crc32(str(d).encode()) % 5 == 1 for d, _, _ in rows}
    learnt = [t.split() for d, t, _ in rows if not held[d]]
    members = len({w for t in learnt for w in t}) + 1
    inner, n = sum(len(t) - 1 for t in learnt), len(learnt)
    # moves: rare-rare, rare-end and end-rare; an end never follows an end
    prior_rare, prior_end = inner + n + 0.5, n + 0.5
    prior_rare, prior_end = (x / (prior_rare + prior_end) for x in (prior_rare, prior_end))
    s = class_model.SMOOTHING
    after_rare = inner + n + s
    logs = [math.log10(x) for x in ((inner + s * prior_rare) / after_rare, (n + s * prior_end) / after_rare, (n + s * prior_rare) / (n + s))]
    for x in class_model.class_model_scores(table(spark, rows)).collect():
        want = (x.n_tokens - 2) * logs[0] + logs[1] + logs[2] - (x.n_tokens - 1) * math.log10(members)
        assert math.isclose(x.score, want, rel_tol=1e-9)


def test_neighbours_of_any_frequency_count(spark, monkeypatch):
    """Words that never stand beside a frequent one get their classes from their neighbours all the same."""
    monkeypatch.setattr(class_model, "FREQUENT", 2)
    r = random.Random(12)
    rows = [(i, " ".join(["start", *(f"{x}{int(20 * r.random() ** 3)}" for x in "abcd")]), None) for i in range(900)]
    fresh = [d for d in range(1000, 9000) if zlib.crc32(str(d).encode()) % 5 == 1][:2]
    ask = list(zip(fresh, ("start a1 b0 c1 d1", "start a1 b15 c1 d1"), (None, None)))
    got = {x.doc_id: x.score for x in class_model.class_model_scores(table(spark, rows + ask)).collect()}
    assert got[fresh[0]] > got[fresh[1]] + 0.5  # b0 is common


def test_pair_counts_beyond_three_bytes():
    """A word that stands 2^24 + 5 times after a frequent class keeps its class."""
    word = np.array([7], np.uint64)
    known = pa.table({"bucket": pa.array([0], pa.int32()), "words": [class_model.packed(word)], "counts": [class_model.packed(np.array([1 << 25]))]})
    codes, ns = class_model.packed(np.array([4, 5]), 1), class_model.packed(np.array([(1 << 24) + 5, 50]), 5)
    seen = pa.table({"words": [class_model.packed(word)], "sizes": [class_model.packed(np.array([2]), 2)], "codes": [codes], "ns": [ns]})
    scores = np.zeros((2 * (class_model.CLASSES + 1), class_model.CLASSES))
    scores[4, 1], scores[5, 2] = 1.0, 1.0
    got = class_model.assigned(known, seen, np.zeros(0, np.uint64), np.zeros(0, np.int64), scores)
    assert class_model.unpacked(got.column("classes")[0].as_py(), 1).tolist() == [1]


def test_one_word_texts_take_part_of_the_probability(spark):
    """All one-word texts and the empty one: the first token's chances add up over words and the end."""
    words = [f"w{i}" for i in range(30)]
    r = random.Random(9)
    rows = [(i, " ".join(r.choice(words) for _ in range(9)), None) for i in range(200)]
    ask = [(1000 + 5 * i, w, None) for i, w in enumerate([*words, "never"])]
    ask = [(d + next(k for k in range(50) if zlib.crc32(str(d + 1000 * k).encode()) % 5 == 1) * 1000, t, s) for d, t, s in ask]
    got = {x.doc_id: x.score for x in class_model.class_model_scores(table(spark, rows + ask + [(10**6 + k, "", None) for k in range(40)])).collect()}
    empty = next(got[d] for d in got if d >= 10**6)
    assert empty < 0 and all(got[d] < 0 for d, _, _ in ask)
    assert sum(10 ** got[d] for d, _, _ in ask) + 10**empty < 1


def test_exchange_finds_alternating_words():
    table_ = np.zeros((6, 6))
    table_[:3, 3:] = 50
    table_[3:, :3] = 50
    label = class_model.exchange(table_, 2, np.zeros(6, bool))
    assert len(set(label[:3])) == len(set(label[3:])) == 1 and label[0] != label[3]


def test_all_leaks_are_found(spark, benchmark):
    r = random.Random(10)
    words = [f"t{i}" for i in range(300)]
    items = [(i, " ".join(r.choice(words) for _ in range(r.randint(15, 150)))) for i in range(40)]
    rows = []
    for d in range(120):
        text = [r.choice(words) for _ in range(r.randint(0, 300))]
        if d % 4 == 0:
            text[len(text) // 2 : len(text) // 2] = items[d % 40][1].upper().split()
        rows.append((d, " ".join(text), None))
    got = decontaminate.decontaminate(table(spark, rows), spark.createDataFrame(items, "item_id long, text string"))
    assert {(x.doc_id, x.item_id) for x in got.collect()} == {(d, d % 40) for d in range(0, 120, 4)}


def test_chunks_give_the_scores_of_the_whole_benchmark(spark, monkeypatch):
    r = random.Random(12)
    words = [f"t{i}" for i in range(200)]
    items = [(i if i % 9 else None, " ".join(r.choice(words) for _ in range(r.randint(5, 150)))) for i in range(30)]
    rows = [(d, " ".join([*(r.choice(words) for _ in range(80)), items[d % 30][1], "end"]), None) for d in range(60)]
    leaks = {}
    for most in (decontaminate.CHUNK_ITEMS, 7):
        monkeypatch.setattr(decontaminate, "CHUNK_ITEMS", most)
        got = decontaminate.decontaminate(table(spark, rows), spark.createDataFrame(items, "item_id long, text string")).collect()
        leaks[most] = sorted((x.doc_id, -1 if x.item_id is None else x.item_id, x.n_passages, round(x.score, 4), x.question_overlap) for x in got)
    whole, chunked = leaks.values()
    assert whole == chunked
    assert len({x[0] for x in chunked}) == 60


def test_overlaps_equal_sets_of_word_grams():
    r = random.Random(13)
    words = [f"t{i}" for i in range(25)]
    items = [" ".join(r.choice(words) for _ in range(r.randint(1, 40))) for _ in range(30)]
    items = [t.replace(" ", "? ", 1) if i % 3 == 0 else t for i, t in enumerate(items)]
    texts = [" ".join([*(r.choice(words) for _ in range(r.randint(0, 60))), *items[i % 30].split()[: r.randint(0, 40)]]) for i in range(50)]
    index = decontaminate.build_index(list(range(30)), items)
    own, first = decontaminate.words_of(pa.array(texts))
    held = decontaminate.overlaps(index, own, first, np.arange(50))

    def grams(side, size):
        return {tuple(side[i : i + size]) for i in range(len(side) - size + 1)} if size else set()

    for i, item in enumerate(items):
        all_words = item.split()
        cut = len(item[: item.rindex("?") + 1].split()) if "?" in item else 0
        if not 0 < cut < len(all_words):
            cut = math.ceil(len(all_words) * 2 / 3)
        sides = [(side, min(5, len(side))) for side in (all_words[:cut], all_words[cut:])]
        for d, text in enumerate(texts):
            want = [len(grams(side, size) & grams(text.split(), size)) for side, size in sides]
            assert held.get((d, i), [0, 0]) == want


def test_bounds_lose_no_passage():
    r = random.Random(11)
    words = [f"t{i}" for i in range(60)]
    items = [" ".join(r.choice(words) for _ in range(30)) for _ in range(50)]
    index = decontaminate.build_index(list(range(50)), items)
    own, first = decontaminate.words_of(pa.array([" ".join(r.choice(words) for _ in range(200)) for _ in range(20)]))
    got = {(int(d), int(p), round(float(s), 4)) for ds, ps, ss in decontaminate.retrieved(index, own, first) for d, p, s in zip(ds, ps, ss)}
    term, want = decontaminate.lookup(index.terms, own), set()
    for d in range(20):
        for a in range(first[d], max(first[d + 1] - 64, first[d]) + 32, 32):
            score = index.impact[term[a : min(a + 64, first[d + 1])]].astype(float).sum(axis=0)
            want |= {(d, p, round(float(score[p]), 4)) for p in np.flatnonzero(score >= index.least)}
    assert got == want and want


def test_pipeline_stages_on_odd_rows(spark, tmp_path):
    docs = spark.createDataFrame([(d, t, "en", s, len(t or "")) for d, t, s in ODD], "doc_id long, text string, lang string, source string, n_chars long")
    spark.createDataFrame([(4, 0)], "doc_id long, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, "no such words in any text at all here")], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    for rows in (docs, docs.limit(0)):
        at = rows
        for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
            at = stage(spark, at, str(tmp_path))
            if k < 4:
                assert at.columns == docs.columns
            at.write.parquet(f"{tmp_path}/{name}-{rows is docs}")
            at = spark.read.parquet(f"{tmp_path}/{name}-{rows is docs}")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    kept = {r.doc_id for r in corpus_pipeline.run(spark, str(tmp_path)).collect()}
    assert {-3, 4, 6, 8} <= kept and 5 not in kept and 2 not in kept
