"""Faults found by the review of round three."""

import hashlib
import random

from corpusforge.llm import chat_format, queries, simhash_dedup


def test_op13_reads_replies_from_written_examples(spark, monkeypatch, tmp_path):
    rows = [(1, t, ("user", "assistant")[t % 2], f"t{t} ### \\\\") for t in range(6)] + [(None, 0, "assistant", "lone")]
    spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").write.parquet(f"{tmp_path}/conversations.parquet")
    texts = {}
    expanded = chat_format.expanded

    def kept(stream, chosen):
        done = expanded(stream, chosen)
        texts.update({(r.conv_id, r.turn): r.text for r in done.collect()})
        return done

    monkeypatch.setattr(chat_format, "expanded", kept)
    got = {r.conv_id: r for r in queries.op13_chat_format(spark, str(tmp_path)).collect()}
    assert sorted(texts, key=str) == sorted([(1, 1), (1, 3), (1, 5), (None, 0), (-7, 1)], key=str)
    assert texts[1, 5].startswith(texts[1, 3]) and texts[1, 5].count(" </turn>\n") == 5
    replies = "".join(t for c, n, r, t in rows if c == 1 and r == "assistant")
    assert got[1].loss_sha256 == hashlib.sha256(replies.encode()).hexdigest() and got[1].n_examples == 3
    assert got[None].loss_chars == 4 and got[1].n_turns == 6


def test_near_copies_behind_closer_strangers_are_linked(spark):
    """Same words in another order: ten texts with a closer fingerprint that are no near copies come first."""
    r = random.Random(2)
    words = [f"w{i}" for i in range(160)]

    def moved(swaps):
        text = list(words)
        for _ in range(swaps):
            i = r.randrange(len(text) - 1)
            text[i], text[i + 1] = text[i + 1], text[i]
        return text

    def shingles(text):
        return simhash_dedup.shingled(" ".join(text), 5)

    base, seen = set(shingles(words)), []
    whole = simhash_dedup.majority(simhash_dedup.hashed(shingles(words)))
    for _ in range(800):
        text = moved(r.randint(2, 12))
        found = set(shingles(text))
        bits = (simhash_dedup.majority(simhash_dedup.hashed(shingles(text))) ^ whole).bit_count()
        seen.append((bits, len(base & found) / len(base | found) >= 0.8, text))
    partner = max((x for x in seen if x[1] and x[0] <= simhash_dedup.NEAR_DISTANCE), key=lambda x: x[0])
    strangers = [x for x in seen if not x[1] and x[0] < partner[0] and len(set(shingles(x[2])) & set(shingles(partner[2]))) < 130]
    texts = [partner[2], *[x[2] for x in sorted(strangers, key=lambda x: x[0])[:10]], words]
    assert len(texts) == 12
    rows = spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(texts)], "doc_id long, text string")
    got = {x.doc_id: x.component_id for x in simhash_dedup.simhash_near_dedup(rows).collect()}
    assert got[11] == 0


def test_the_codec_holds_no_words_after_a_task():
    import public_tokenizers
    from corpusforge.llm import bpe_codec

    with open(public_tokenizers.path("word_bpe_49k.json")) as f:
        tool = bpe_codec.Codec(f.read())
    want = tool.encode("some words some more")
    assert len(tool.chunk) == 3
    tool.forget()
    assert not tool.chunk and not tool.piece and not tool.chunk.old
    assert tool.encode("some words some more") == want


def test_plain_words_are_remembered_once_and_ascii_equals_the_library():
    import random

    import public_tokenizers
    from corpusforge.llm import bpe_codec
    from tokenizers import Tokenizer

    path = public_tokenizers.path("word_bpe_49k.json")
    with open(path) as f:
        tool = bpe_codec.Codec(f.read())
    tool.encode("lower words alone")
    assert len(tool.chunk) == 3 and not tool.piece
    library, r = Tokenizer.from_file(path), random.Random(5)
    library.no_truncation()
    library.no_padding()
    letters = [chr(c) for c in range(1, 128)] + ["'s", "'T", "'re", "'ll", "<|", "<|endoftext|>", "aZ", " "]
    for _ in range(600):
        text = "".join(r.choice(letters) for _ in range(r.randrange(60)))
        want = library.encode(text, add_special_tokens=False).ids
        assert memoryview(tool.encode(text)).cast("I").tolist() == want
