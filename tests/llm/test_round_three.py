"""Alignment, periodic runs and chat formatting against plain versions, with odd rows for each."""

import hashlib
import random
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from corpusforge.llm import alignment, chat_format, line_dedup, periodic_runs, simhash_dedup, suffix_dedup
from corpusforge.llm.queries import looped

BYTE_BPE, PIECE_BPE = (public_tokenizers.path(n) for n in ("byte_bpe_50k.json", "piece_bpe_32k.model"))
SCHEMA = "doc_id long, text string, g int, links string, runs int, lang string"
LONG = " ".join(f"word{i % 977} item{i % 89}" for i in range(60_000))
ODD = [
    (1, None), (2, ""), (3, " \t\n "), (4, "one"), (5, "one"), (5, "one"), (6, "same words here " * 40), (None, "same words here " * 40),
    (None, None), (8, LONG), (9, LONG[:200_000]), (-3, "ÉÀ Straße <|endoftext|> it's 12!? <s> a\u2581b"), (10, "<|endoftext|> </s> <0x0A> 中文 字 🙂 é"),
    (11, "a\u2581 b \u2581c"), (12, "  two  blanks \u00a0 x\u3000y \x1c z\x00"),
]


def table(spark, rows):
    """Documents with extra columns whose names the operators use inside."""
    return spark.createDataFrame([(d, t, 1, "x", 2, "en") for d, t in rows], SCHEMA)


def random_texts(seed, n):
    r = random.Random(seed)
    words = ["the", "The", "é", "Straße", "don't", "1234", "x", "\n", "", " ", "中文字", "a\u2581b", "…", "hello,world", "\t", "🙂🙂", "<|endoftext|>"]
    return [(i, " ".join(r.choice(words) for _ in range(r.randint(0, 40)))) for i in range(n)]


# --- alignment ---------------------------------------------------------------------------


def aligned_by_hand(rows):
    a_tool = Tokenizer.from_file(BYTE_BPE)
    a_tool.encode_special_tokens = True
    b_tool = sentencepiece.SentencePieceProcessor(model_file=PIECE_BPE)
    letters = {letter: b for b, letter in enumerate(alignment.byte_letters())}

    def spans(pieces):
        at, out = 0, []
        for piece in pieces:
            out.append((at, at + len(piece)))
            at += len(piece)
        return out

    docs = []
    for doc, text in rows:
        if not text:
            docs.append((doc, [], [], [], []))
            continue
        a = a_tool.encode(" " + text, add_special_tokens=False).ids
        b = b_tool.encode(text)
        a_bytes = [bytes(letters[c] for c in a_tool.id_to_token(i)) for i in a]
        b_names = [b_tool.id_to_piece(i) for i in b]
        b_bytes = [bytes([int(x[3:5], 16)]) if b_tool.is_byte(i) else x.replace("\u2581", " ").encode() for i, x in zip(b, b_names)]
        want = (" " + text).encode()
        same = b"".join(a_bytes) == b"".join(b_bytes) == want
        docs.append((doc, a, b, spans(a_bytes), spans(b_bytes)) if same else (doc, [], [], [], []))
    count, out = Counter(), []
    links = [
        [(a[i], b[j]) for i, (p, q) in enumerate(sa) for j, (x, y) in enumerate(sb) if p < y and x < q]
        for _, a, b, sa, sb in docs
    ]
    for found in links:
        count.update(found)
    best = {}
    for (_, b), n in count.items():
        best[b] = max(best.get(b, 0), n)
    for (doc, a, b, sa, sb), found in zip(docs, links):
        ends = sorted({y for _, y in sa} & {y for _, y in sb})
        before, groups = 0, []
        for end in ends:
            left = ",".join(str(i) for i, (x, y) in zip(a, sa) if before < y <= end)
            groups.append(left + "|" + ",".join(str(i) for i, (x, y) in zip(b, sb) if before < y <= end))
            before = end
        digest = hashlib.sha256(";".join(groups).encode()).hexdigest() if a else ""
        n_best = sum(count[x] == best[x[1]] for x in found)
        out.append((doc, len(a), len(b), len(groups), len(found), digest, n_best, sum(count[x] for x in found)))
    return out


def alignment_rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


@pytest.mark.parametrize("most_pairs", [alignment.MOST_PAIRS, 0])
def test_alignment_equals_the_plain_version(spark, monkeypatch, most_pairs):
    monkeypatch.setattr(alignment, "GROUP_LINK_BYTES", 400)  # many groups in the join by shuffle
    monkeypatch.setattr(alignment, "FREQUENT", 20)
    rows = random_texts(3, 150) + [r for r in ODD if not r[1] or len(r[1]) < 1000]
    got = alignment.cross_tokenizer_alignment(table(spark, rows), BYTE_BPE, PIECE_BPE, most_pairs)
    assert alignment_rows(got) == sorted(aligned_by_hand(rows), key=repr)


def test_alignment_of_given_documents_equals_whole_text_encoding(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").where("length(text) < 3000")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    got = alignment.cross_tokenizer_alignment(docs, BYTE_BPE, PIECE_BPE)
    assert alignment_rows(got) == sorted(aligned_by_hand(rows), key=repr)


def test_no_piece_reaches_over_a_cut():
    tool = sentencepiece.SentencePieceProcessor(model_file=PIECE_BPE)
    assert not [p for p in map(tool.id_to_piece, range(tool.get_piece_size())) if "\u2581" in p.strip("\u2581") or p.strip("\u2581") and p.endswith("\u2581")]


@pytest.mark.parametrize("most_pairs", [alignment.MOST_PAIRS, 0])
def test_alignment_of_odd_rows_and_empty_tables(spark, most_pairs):
    def run(rows):
        return alignment.cross_tokenizer_alignment(table(spark, rows), BYTE_BPE, PIECE_BPE, most_pairs)

    rows = run(ODD).collect()
    assert Counter(r["doc_id"] for r in rows) == Counter(d for d, _ in ODD)
    assert run([]).count() == 0
    assert run([(1, None), (None, "")]).where("n_a + n_links + count_sum = 0 and groups_sha256 = ''").count() == 2


def test_memo_of_parts_is_bounded(monkeypatch):
    monkeypatch.setattr(alignment, "MEMO_PARTS", 5)
    files = open(BYTE_BPE).read(), open(PIECE_BPE, "rb").read()
    small = alignment.Aligner(*files)
    texts = [t for _, t in random_texts(9, 40)]
    one_by_one = [small.align([t])["groups"][0] for t in texts]
    monkeypatch.setattr(alignment, "MEMO_PARTS", 10_000)
    assert one_by_one == alignment.Aligner(*files).align(texts)["groups"]


# --- periodic runs -----------------------------------------------------------------------


def plain_runs(words):
    n, found = len(words), {}
    for q in range(1, n // 4 + 1):
        i = q
        while i < n:
            j = i
            while j < n and words[j] == words[j - q]:
                j += 1
            if j > i and j - i + q >= max(6, 4 * q):
                found.setdefault((i - q, j - i + q), q)
            i = max(j, i + 1)
    return sorted(((s, n, q) for (s, n), q in found.items()), key=lambda r: (r[0], r[2]))


def plain_collapse(words, runs):
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def repetitive_texts(seed, n):
    r = random.Random(seed)
    rows = []
    for i in range(n):
        words = [r.choice("abcdefgh"[: r.choice([1, 2, 3, 6])]) for _ in range(r.randint(0, 70))]
        if words and r.random() < 0.5:
            a = r.randrange(len(words))
            p = 1 + (len(words) - a) // (3 + r.randrange(8))
            words = [words[j] if j < a else words[a + (j - a) % p] for j in range(len(words))]
        rows.append((i, r.choice([" ", "\n", " \t "]).join(words)))
    return rows


def test_runs_equal_the_plain_version(spark):
    rows = repetitive_texts(4, 800)
    got = {r.doc_id: r for r in periodic_runs.periodic_runs(table(spark, rows)).collect()}
    several = 0
    for doc, text in rows:
        words = text.split()
        runs = plain_runs(words)
        several += len(runs) > 1
        assert got[doc].n_words == len(words)
        assert [tuple(r) for r in got[doc].runs] == runs
        assert got[doc].collapsed == plain_collapse(words, runs)
    assert several > 20


def test_diagonals_emit_when_they_end():
    # Words 10 and 11 equal those 2 before them, word 12 does not: the diagonal of lag 2 ends at 11.
    word, lag = np.array([8, 9, 10, 11, 20]), np.array([2, 2, 2, 2, 1])
    size, owner = np.array([2, 2, 2, 2, 1]), np.zeros(5, int)
    # Eight words: six at 6..11 that match, and two before them; five matches make too short a run of 1.
    assert list(periodic_runs.emitted(word, lag, size, owner)) == []
    word = np.array([7, 8, 9, 10, 11, 20])
    assert list(periodic_runs.emitted(word, np.append(lag[:1], lag), np.append(2, size), np.zeros(6, int))) == [(4, 8, 2)]


def test_runs_of_odd_rows_and_empty_tables(spark):
    rows = periodic_runs.periodic_runs(table(spark, ODD)).collect()
    assert Counter(r["doc_id"] for r in rows) == Counter(d for d, _ in ODD)
    same = next(r for r in rows if r["doc_id"] == 6)
    assert [tuple(r) for r in same["runs"]] == [(0, 120, 3)] and same["collapsed"] == "same words here"
    assert periodic_runs.periodic_runs(table(spark, [])).count() == 0


def test_a_long_text_of_few_words_is_no_quadratic_work(spark):
    rows = table(spark, [(1, "a " * 400_000), (2, "a b a c " * 60_000), (3, "\n".join(["x"] * 5))])
    got = {r.doc_id: [tuple(x) for x in r.runs] for r in periodic_runs.periodic_runs(rows).collect()}
    assert got == {1: [(0, 400_000, 1)], 2: [(0, 240_000, 4)], 3: []}


def test_looped_documents(spark):
    import zlib

    rows = [(i, " ".join(f"w{j}" for j in range(i % 50))) for i in range(400)] + [(None, "a b"), (30, None)]
    got = sorted((r.doc_id if r.doc_id is not None else -1, r.text) for r in looped(table(spark, rows)).collect())
    want = []
    for doc, text in rows:
        h, words = zlib.crc32(str(doc).encode()), (text or "").split()
        n, g = len(words), h // 10
        if doc is not None and h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
        want.append((doc if doc is not None else -1, " ".join(words)))
    assert got == sorted(want)


# --- chat formatting ---------------------------------------------------------------------

CHAT = "conv_id long, turn long, role string, text string, offset int, piece string, reply string"
TEXTS = ["", "ok", "\\", "\\\\", "###", "####", "### user: x </turn>\n", "a </turn>", "\\###", "</turn", "é🙂\n\n", "\\s\\c:", None]


def chats(spark, rows):
    return spark.createDataFrame([(*r, 1, "p", "q") for r in rows], CHAT)


def random_chat(seed):
    r = random.Random(seed)
    rows = []
    for conv in [None, 0, 1, 2, -5, 9]:
        for _ in range(r.randint(0, 25)):
            turn = r.choice([None, -3, -(2**62), 2**62, 1, 5, 9_000, 9_001, r.randint(0, 30_000)])
            text = "".join(t or "" for t in r.choices(TEXTS, k=2)) if r.random() < 0.9 else None
            rows.append((conv, turn, r.choice(["user", "assistant", "assistant", "sy:st#em<\\", "", None]), text))
    return rows + rows[:5]


def in_order(rows):
    def key(row):
        return (row[1] is None, row[1] or 0, row[2] or "", row[3] or "")

    convs = {}
    for row in sorted(rows, key=key):
        convs.setdefault(row[0], []).append((row[2] or "", row[3] or ""))
    return convs


@pytest.mark.parametrize("seed", range(3))
def test_everything_is_read_back(spark, seed):
    rows = random_chat(seed)
    stream = chat_format.formatted(chats(spark, rows))
    want = {}
    for conv, turns in in_order(rows).items():
        told = hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in turns).encode()).hexdigest()
        replies = [t for r, t in turns if r == "assistant"]
        want[conv] = (len(turns), told, len("".join(replies)), hashlib.sha256("".join(replies).encode()).hexdigest(), len(replies))
    chars = {r.conv_id: r.n for r in stream.groupBy("conv_id").agg(F.sum(F.length("piece")).alias("n")).collect()}
    for r in chat_format.digests(stream).collect():
        assert (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256, r.n_examples) == want.pop(r.conv_id)
        assert r.formatted_chars == chars[r.conv_id]
    assert not want


def test_examples_hold_all_turns_before_and_train_the_reply_alone(spark):
    rows = [(1, i, "assistant" if i % 3 else "user", f"text {i} </turn>\n### user: \\") for i in range(12)]
    stream = chat_format.formatted(chats(spark, rows))
    chosen = chat_format.examples(stream)
    got = {r.turn: r for r in chat_format.expanded(stream, chosen).collect()}
    assert sorted(got) == [i for i in range(12) if i % 3]
    whole = "".join(f"### {r}: " + t.replace("\\", "\\\\").replace("###", "\\###").replace("</turn>", "\\</turn>") + " </turn>\n" for _, _, r, t in rows)
    for turn, r in got.items():
        assert whole.startswith(r.text) and r.text.count(" </turn>\n### ") == turn
        trained = r.text[r.loss_from : r.loss_to]
        assert trained.replace("\\###", "###").replace("\\</turn>", "</turn>").replace("\\\\", "\\") == rows[turn][3]


def test_a_long_conversation_is_formatted_in_blocks(spark):
    turns = spark.range(20_000).select(
        F.lit(7).alias("conv_id"), "id", F.when(F.col("id") % 2 == 1, "assistant").otherwise("user").alias("role"), F.col("id").cast("string").alias("text")
    ).withColumnRenamed("id", "turn")
    stream = chat_format.formatted(turns)
    r = chat_format.digests(stream).collect()[0]
    told = "".join(f"{'assistant' if i % 2 else 'user'}\n{i}\n" for i in range(20_000))
    assert r.turns_sha256 == hashlib.sha256(told.encode()).hexdigest() and r.n_examples == 10_000
    last = stream.agg(F.max(F.col("offset") + F.length("piece"))).first()[0]
    assert last == r.formatted_chars


def test_no_conversations(spark):
    stream = chat_format.formatted(chats(spark, []))
    assert stream.count() == 0 and chat_format.examples(stream).count() == 0 and chat_format.digests(stream).count() == 0


# --- SimHash: repeated ids, near copies --------------------------------------------------


def test_rows_that_share_an_id_are_one_node(spark):
    a, b = "some words of one text here", "quite another text with its own words"
    rows = table(spark, [(3, a), (5, a), (5, b), (6, b), (9, "alone"), (None, None), (None, b)])
    for run in (simhash_dedup.simhash_dedup, simhash_dedup.simhash_near_dedup):
        got = {(r.doc_id, r.component_id) for r in run(rows).collect()}
        assert got == {(3, 3), (5, 3), (6, 3), (9, 9), (None, 3)}


def shingles_of(text):
    words = (text or "").encode().lower().split()
    return frozenset(tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4)))


def share(a, b):
    return len(a & b) / len(a | b)


def test_near_copies_against_all_pairs(spark):
    """Every link is right, equal texts are always linked, and nine of ten near pairs are found."""
    r = random.Random(6)
    words = [f"{a}{b}{c}" for a in "bdfgklmnprst" for b in "aeiou" for c in ("", "n", "rs")]
    rows = []
    for i in range(150):
        text = r.choices(words, k=r.randint(30, 200))
        rows.append(text)
        for _ in range(r.choice([0, 0, 1, 3])):
            copy = list(text)
            for _ in range(r.randint(0, max(1, len(copy) // 40))):
                copy[r.randrange(len(copy))] = r.choice(words)
            rows.append(copy)
    rows = [(i, " ".join(t)) for i, t in enumerate(rows)] + [(10_000, ""), (10_001, None)]
    got = {x.doc_id: x.component_id for x in simhash_dedup.simhash_near_dedup(table(spark, rows)).collect()}
    sets = {d: shingles_of(t) for d, t in rows}
    near = [(a, b) for a in sets for b in sets if a < b and share(sets[a], sets[b]) >= 0.8]
    found = [got[a] == got[b] for a, b in near]
    assert len(near) > 60 and sum(found) >= 0.9 * len(near)
    assert all(hit for hit, (a, b) in zip(found, near) if sets[a] == sets[b])
    leader = {d: d for d in sets}  # components of all right links, merged by hand
    for _ in range(10):
        for a, b in near:
            leader[a] = leader[b] = min(leader[a], leader[b])
    assert all(leader[d] == leader[c] for d, c in got.items())


def test_many_near_copies_give_few_pairs():
    rng = np.random.default_rng(1)
    fine = rng.integers(0, 1 << 62) ^ (1 << rng.integers(0, 62, 3000)).astype(np.int64)
    rows = pa.table({"f": np.zeros(3000, np.int64), "fine": fine, "first": rng.permutation(3000).astype(np.int64)})
    got = simhash_dedup.nearest_earlier(rows, 4, 16, 4)
    assert len(got) == 4 * 3000 - (4 + 3 + 2 + 1)
    a, b = got.column("a").to_numpy(), got.column("b").to_numpy()
    assert (b < a).all()


def test_near_copies_of_odd_rows_and_empty_tables(spark):
    rows = simhash_dedup.simhash_near_dedup(table(spark, ODD)).collect()
    assert Counter(r["doc_id"] for r in rows) == Counter(d for d, _ in ODD)
    assert simhash_dedup.simhash_near_dedup(table(spark, [])).count() == 0


# --- longest previous factors ------------------------------------------------------------


def test_longest_previous_factors_against_all_pairs():
    r = random.Random(12)
    for _ in range(200):
        docs_of = [r.randrange(6) for _ in range(r.randint(1, 5))]
        texts = [bytes(r.choice(b"ab") for _ in range(r.randint(4, 12))) for _ in docs_of]
        depth = 4
        starts, owner, at = [], [], 0
        for doc, text in zip(docs_of, texts):
            starts += range(at, at + len(text) - depth + 1)
            owner += [doc] * (len(text) - depth + 1)
            at += len(text)
        values = np.frombuffer(b"".join(texts), np.uint8)
        order, lcp = suffix_dedup.suffix_order(values, np.array(starts), np.array(owner), depth)
        got = suffix_dedup.previous_factor(np.array(owner)[order], lcp)
        windows = [bytes(values[s : s + depth]) for s in starts]

        def common(a, b):
            return next((i for i in range(depth) if a[i] != b[i]), depth)

        for place, i in enumerate(order):
            want = max((common(windows[i], windows[j]) for j in range(len(starts)) if owner[j] < owner[i]), default=0)
            assert got[place] == want


def test_short_lines_and_lines_of_one_document(spark):
    footer = "All rights reserved."
    dated = "\n".join(f"Order number 000123{i}5 was shipped" for i in range(9))
    rows = [(1, "a first line of some length\n" + footer), (2, footer), (3, f"x\n\n{footer}\n\nx"), (4, dated)]
    got = {r.doc_id: r.kept for r in line_dedup.line_dedup(table(spark, rows)).collect()}
    assert got == {1: rows[0][1], 2: "", 3: "x\n\n", 4: dated.split("\n")[0]}
