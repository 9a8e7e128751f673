"""Offsets, shards, loader tables against a plain replay of the sequential rules."""

import itertools
import random
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from corpusforge.functions import codec
from corpusforge.operators import loader, pack
from corpusforge.operators.prefix import exclusive_prefix, followers, level_shifts, previous_value
from corpusforge.operators.tokenize import tokenize
from corpusforge.plans import stages
from corpusforge.session import shared_dir
from corpusforge.sources import batches as batch_io, shards as shard_io
from corpusforge.streaming import packer


def make_docs(spark, texts, ids=None):
    ids = ids or range(len(texts))
    return spark.createDataFrame(list(zip(ids, texts)), "doc_id long, text string")


def sequential_shards(texts, size):
    """All ids in one list, sliced; the first slice is validation if it is a whole one."""
    ids = [i for t in texts for i in (256, *t.encode())]
    slices = [ids[at : at + size] for at in range(0, len(ids), size)]
    return [("val" if k == 0 and len(x) == size else "train", x) for k, x in enumerate(slices)]


def texts_of(seed, n=60):
    rng = random.Random(seed)
    return ["".join(rng.choice("ab é\n") for _ in range(rng.choice([0, 1, 5, 30, 90]))) for _ in range(n)]


@pytest.mark.parametrize("size", [7, 40, 100])
def test_shards_equal_the_sequential_packer(spark, size):
    texts = texts_of(size)
    order = random.Random(1).sample(range(len(texts)), len(texts))
    docs = make_docs(spark, [texts[i] for i in order], [i * 1000 for i in order])
    pieces = pack.shard_pieces(pack.doc_offsets(tokenize(docs)), size)
    rows = pieces.select("split", "shard_idx", "lo", codec.ids(F.col("tokens")).alias("ids")).collect()
    got = {}
    for r in sorted(rows, key=lambda r: (r["shard_idx"], r["lo"])):
        split, ids = got.setdefault(r["shard_idx"], (r["split"], []))
        assert split == r["split"] and len(ids) == r["lo"]
        ids.extend(r["ids"])
    assert [got[i] for i in sorted(got)] == sequential_shards(texts, size)


@pytest.mark.parametrize(
    "length, expected", [(9, [("val", 10)]), (19, [("val", 10), ("train", 10)]), (5, [("train", 6)])]
)
def test_split_rule_at_the_edges(spark, length, expected):
    pieces = pack.shard_pieces(pack.doc_offsets(tokenize(make_docs(spark, ["x" * length]))), 10)
    manifest = pack.shard_manifest(pieces, 10).orderBy("shard_idx").collect()
    assert [(r["split"], r["n_tokens"]) for r in manifest] == expected
    assert manifest[0]["file_stem"] == f"fineweb_edu_{expected[0][0]}_000000"
    assert manifest[0]["n_bytes"] == 2 * expected[0][1]


def test_file_stems_of_long_shard_numbers(spark):
    numbers = spark.createDataFrame([(n,) for n in (7, 999_999, 1_000_000, 10_000_000)], "n long")
    stems = [r[0] for r in numbers.select(pack.file_stem(F.lit("train"), F.col("n"))).collect()]
    assert [x.rpartition("_")[2] for x in stems] == ["000007", "999999", "1000000", "10000000"]


def test_shard_numbers_beyond_twenty_bits(spark):
    shards = spark.createDataFrame([("train", n, 100) for n in (0, 1 << 20, 3 << 30)], "split string, shard_idx long, n_tokens long")
    rows = loader.loader_schedule(loader.loader_plan(shards, 1, 10, 1), 1, 10, 1, epochs=1).collect()
    order = [r["shard_idx"] for r in sorted(rows, key=lambda r: r["micro_step"])]
    assert order == sorted(order) and set(order) == {0, 1 << 20, 3 << 30}


def test_document_over_three_shards_is_spilled(spark):
    pieces = pack.shard_pieces(pack.doc_offsets(tokenize(make_docs(spark, ["x" * 25, "y"]))), 10)
    assert {r["doc_id"]: r["n_pieces"] for r in pack.spilled_docs(pieces).collect()} == {0: 3}


@pytest.mark.parametrize("id_bits, block_bits", [(63, 20), (63, 8), (63, 2), (36, 8)])
def test_prefix_sum_for_spread_and_clustered_keys(spark, id_bits, block_bits):
    rng = random.Random(id_bits + block_bits)
    keys = sorted({rng.randrange(2 ** min(id_bits, 40)) for _ in range(200)} | set(range(5000, 5200)))
    rows = [(g, k, rng.randrange(9)) for g in ("hot", "cold") for k in keys]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "g string, k long, v long")
    got = exclusive_prefix(df, "k", "v", "s", ["g"], "all", id_bits, block_bits).collect()
    sums = {"hot": 0, "cold": 0}
    for r in sorted(got, key=lambda r: (r["g"], r["k"])):
        assert r["s"] == sums[r["g"]]
        sums[r["g"]] += r["v"]
    assert all(r["all"] == sums[r["g"]] for r in got) and len(got) == len(rows)


def test_key_outside_the_stated_range_fails(spark):
    df = spark.createDataFrame([(2**36, 1), (1, 1)], "k long, v long")
    with pytest.raises(Exception, match="larger id_bits"):
        exclusive_prefix(df, "k", "v", "s", id_bits=36).collect()


def test_top_level_is_bounded_for_any_width():
    for bits in range(1, 64):
        for block in (2, 8, 12, 20):
            assert bits - sum(level_shifts(bits, block)) <= 23


def test_followers_cross_block_borders(spark):
    n = 4096 * 2 + 2
    rows = spark.range(n).select(F.col("id").alias("r"), F.col("id").alias("v"))
    got = {r["r"]: r["f"] for r in followers(rows, "r", "v", 3, "f").collect()}
    assert len(got) == n and all(f == [x for x in range(r + 1, r + 4) if x < n] for r, f in got.items())


def test_previous_value_crosses_blocks(spark):
    steps = [0, 10, 4090, 4100, 20000]
    df = spark.createDataFrame([("r", s, s * 2) for s in steps], "run string, step long, v long")
    got = {r["step"]: r["p"] for r in previous_value(df, ["run"], "step", F.col("v"), "p").collect()}
    assert got == dict(zip(steps, [None, 0, 20, 8180, 8200]))


# --- loader ------------------------------------------------------------------------------


def reads_of(lengths, B, T, N, rank):
    """Endless (shard, position): a rank's first batch of each shard and all whose stride still fits."""
    stride = B * T * N
    for shard, length in itertools.cycle(enumerate(lengths)):
        starts = range(B * T * rank, length, stride)
        yield from ((shard, p) for k, p in enumerate(starts) if k == 0 or p + stride < length)


@pytest.mark.parametrize("B, T, N", [(1, 2, 1), (2, 3, 2), (1, 5, 4), (3, 1, 2)])
def test_schedule_equals_the_moving_cursor(spark, B, T, N):
    lengths = [B * T * N + 1 + extra for extra in (0, 1, B * T, 3 * B * T + 2, 7 * B * T * N)]
    shards = spark.createDataFrame(
        [("train", i, n) for i, n in enumerate(lengths)], "split string, shard_idx long, n_tokens long"
    )
    plan = loader.loader_plan(shards, B, T, N)
    rows = loader.loader_schedule(plan, B, T, N, micro_steps=37).collect()
    for rank in range(N):
        mine = sorted((r for r in rows if r["rank"] == rank), key=lambda r: r["micro_step"])
        assert [r["micro_step"] for r in mine] == list(range(37))
        assert [(r["shard_idx"], r["pos"]) for r in mine] == list(itertools.islice(reads_of(lengths, B, T, N, rank), 37))
        passes = [r["epoch"] for r in mine]
        assert passes == sorted(passes)
    reads = [(r["epoch"], r["rank"], r["shard_idx"], r["pos"]) for r in rows]
    assert len(set(reads)) == len(reads)


def test_unreadable_shard_counts_zero_and_unused_is_what_nobody_reads(spark):
    shards = spark.createDataFrame(
        [("train", 0, 8), ("train", 1, 9), ("train", 2, 100_000_000)],
        "split string, shard_idx long, n_tokens long",
    )
    small = {(r["shard_idx"], r["rank"]): r for r in loader.loader_plan(shards.where("shard_idx < 2"), 2, 4, 2).collect()}
    assert small[0, 0]["n_batches"] == 0 and small[1, 0]["n_batches"] == 1 and small[1, 1]["n_batches"] == 0
    big = loader.loader_plan(shards.where("shard_idx = 2"), 32, 1024, 1).first()
    assert (big["n_batches"], big["unused_tokens"]) == (3051, 24832)


@pytest.mark.parametrize("B, T, size", [(1, 3, 40), (2, 4, 50), (2, 5, 200)])
def test_windows_equal_cut_shards(spark, B, T, size):
    texts = texts_of(size + T)
    pieces = pack.shard_pieces(pack.doc_offsets(tokenize(make_docs(spark, texts))), size)
    rows = loader.inputs_and_targets(loader.windows(pieces, B, T)).collect()
    got = {(r["shard_idx"], r["w"]): (r["x"], r["y"]) for r in rows}
    expected = {}
    for shard, (_, ids) in enumerate(sequential_shards(texts, size)):
        for w in range((len(ids) - 1) // (B * T) * B):
            cut = ids[w * T : w * T + T + 1]
            expected[shard, w] = (cut[:-1], cut[1:])
    assert got == expected and len(rows) == len(expected)


def test_steps_follow_the_schedule_and_resume(spark):
    B, T, N, batch_tokens = 2, 2, 2, 24
    lengths = [61, 33, 90]
    shards = spark.createDataFrame(
        [("train", i, n) for i, n in enumerate(lengths)], "split string, shard_idx long, n_tokens long"
    )
    plan = loader.loader_plan(shards, B, T, N)
    rows = loader.step_layout(plan, B, T, N, batch_tokens, total_tokens=300, val_every=4, log_every=2).collect()
    assert len(rows) == (300 // batch_tokens) * N
    for r in rows:
        reads = list(itertools.islice(reads_of(lengths, B, T, N, r["rank"]), (r["step"] + 1) * 3))[-3:]
        assert (r["first_shard"], r["last_shard"]) == (reads[0][0], reads[-1][0])
        assert (r["n_micro"], r["n_tokens"]) == (3, 12)
        assert r["is_val"] == (r["step"] % 4 == 0) and r["is_log"] == (r["step"] % 2 == 0)
    later = loader.step_layout(plan, B, T, N, batch_tokens, total_tokens=300, start_step=9).collect()
    assert {r["step"] for r in later} == {9, 10, 11}
    with pytest.raises(ValueError):
        loader.step_layout(plan, B, T, N, 25)


# --- sinks and stream --------------------------------------------------------------------


@pytest.mark.parametrize("one_file", [True, False])
def test_shards_on_disk(spark, tmp_path, one_file):
    path = str(tmp_path / "shards")
    pieces = pack.shard_pieces(pack.doc_offsets(tokenize(make_docs(spark, texts_of(3)))), 100)
    shard_io.write_shards(pieces, path, one_file)
    train = shard_io.read_shards(spark, path, "train")
    whole = pieces.where("split = 'train'").select(*train.columns)
    assert train.exceptAll(whole).count() == 0 and whole.exceptAll(train).count() == 0
    if one_file:
        for folder in (tmp_path / "shards").glob("split=*/shard_idx=*"):
            assert len(list(folder.glob("*.parquet"))) == 1
    with pytest.raises(FileNotFoundError):
        shard_io.read_shards(spark, path, "test")


def test_stream_equals_batch_and_replay_changes_nothing(spark, tmp_path):
    texts, size, source, out = texts_of(9), 100, str(tmp_path / "in"), str(tmp_path / "out")
    docs = make_docs(spark, texts)

    def arrive(lo, hi):
        docs.where((F.col("doc_id") >= lo) & (F.col("doc_id") < hi)).coalesce(1).write.mode("append").parquet(source)

    def run():
        packer.pack_stream(packer.read_document_stream(spark, source, 1), out, size).awaitTermination()

    for lo in range(0, 45, 15):
        arrive(lo, lo + 15)
        run()
    partial = packer.streamed_manifest(spark, out, size)
    full_so_far = partial.where(F.col("n_tokens") == size).collect()
    assert packer.open_shard(partial, size).count() <= 1
    arrive(45, 60)
    run()
    columns = ["shard_idx", "lo", "hi", "doc_id", "tokens"]
    batch = pack.shard_pieces(pack.doc_offsets(tokenize(docs)), size)
    expected = sorted(map(tuple, batch.select(columns).collect()))
    streamed = lambda: sorted(map(tuple, packer.streamed_pieces(spark, out).select(columns).collect()))
    assert streamed() == expected
    final = packer.streamed_manifest(spark, out, size).collect()
    assert sorted(final) == sorted(pack.shard_manifest(batch, size).collect())
    assert all(r in final for r in full_so_far)
    packer.write_batch(docs.where("doc_id >= 15 and doc_id < 30"), 1, out, size)
    assert streamed() == expected


def test_a_batch_reads_one_ledger_row(spark, tmp_path):
    """Neither earlier ledger rows nor earlier pieces are opened, and nothing is left behind."""
    out, docs = str(tmp_path / "out"), make_docs(spark, texts_of(4))
    parts = [docs.where(f"doc_id div 15 = {i}") for i in range(4)]
    for i in range(3):
        packer.write_batch(parts[i], i, out, 50)
    expected = packer.tokens_before(spark, out, 3)
    assert expected == sum(1 + len(t.encode()) for t in texts_of(4)[:45])
    for i in range(2):
        for folder in ("ledger", "pieces"):
            for file in (tmp_path / "out" / folder / f"batch_id={i}").glob("*.parquet"):
                file.write_bytes(b"not a table")
    left = set((Path(shared_dir(spark)) / "corpusforge").iterdir())
    packer.write_batch(parts[3], 3, out, 50)
    assert packer.tokens_before(spark, out, 4) > expected
    assert set((Path(shared_dir(spark)) / "corpusforge").iterdir()) == left


def test_a_gap_in_batch_numbers(spark, tmp_path):
    out, docs = str(tmp_path / "out"), make_docs(spark, ["abc", "de"])
    assert packer.tokens_before(spark, out, 0) == packer.tokens_before(spark, out, 5) == 0
    packer.write_batch(docs, 2, out, 50)
    assert packer.tokens_before(spark, out, 9) == 7 and packer.tokens_before(spark, out, 2) == 0


def test_stored_batches_are_read_rank_by_rank(spark, tmp_path):
    shards, out = str(tmp_path / "shards"), str(tmp_path / "batches")
    pieces = pack.shard_pieces(pack.doc_offsets(tokenize(make_docs(spark, texts_of(5)))), 400)
    shard_io.write_shards(pieces, shards)
    stages.training_batches(spark, shards, out, 2, 8, 2, 64, micro_steps=60)
    train = shard_io.read_shards(spark, shards, "train")
    sizes = train.groupBy("split", "shard_idx").agg(F.max("shard_len").alias("n_tokens"))
    schedule = loader.loader_schedule(loader.loader_plan(sizes, 2, 8, 2), 2, 8, 2, micro_steps=60)
    rows = loader.training_batches(loader.windows(train, 2, 8), schedule, 2, 8, 2).collect()
    for rank in range(2):
        for first in (0, 7):
            got = batch_io.read_batches(spark, out, rank, first).collect()
            assert sorted(map(tuple, got)) == sorted(tuple(r)[1:] for r in rows if r["rank"] == rank and r["step"] >= first)
    plan = batch_io.read_batches(spark, out, 1, 205)._jdf.queryExecution().executedPlan().toString()
    assert "(rank#" in plan and "block" in plan.partition("PartitionFilters")[2].partition("PushedFilters")[0]


def test_only_scheduled_windows_are_scored(spark):
    sizes = spark.createDataFrame([("val", 0, 1000)], "split string, shard_idx long, n_tokens long")
    schedule = loader.val_batches(loader.loader_plan(sizes, 2, 8, 2), 2, 8, 2, 3)
    windows = spark.range(124).select(F.lit(0).cast("long").alias("shard_idx"), F.col("id").alias("w"), F.lit(b"xx").alias("tokens"))
    assert sorted(r.w for r in loader.scheduled_windows(windows, schedule, 2, 8).collect()) == list(range(12))


def test_leading_offsets_equal_the_cut_of_all(spark):
    """Documents before a token, found block by block, are those that the whole stream gives."""
    rows = [(i * 97, 1 + i % 13) for i in range(400)]
    df = spark.createDataFrame(rows, "doc_id long, n_tokens long")
    everything = pack.doc_offsets(df).collect()
    for below in (1, 500, 10_000):
        some = pack.doc_offsets(df, below=below).collect()
        assert sorted(some) == sorted(r for r in everything if r["start"] < below)


def test_batches_resume_where_they_stopped(spark):
    """Rows of later steps do not depend on where the run starts; y is x moved on by one id."""
    ids = list(range(1, 200))
    piece = (("train", 0, 0, len(ids), len(ids), 0, bytearray(b"".join(i.to_bytes(2, "big") for i in ids))))
    pieces = spark.createDataFrame(
        [piece], "split string, shard_idx long, lo long, hi long, shard_len long, doc_id long, tokens binary"
    )
    shards = pieces.select("split", "shard_idx", F.col("shard_len").alias("n_tokens"))
    schedule = loader.loader_schedule(loader.loader_plan(shards, 2, 8, 2), 2, 8, 2, epochs=2)
    windows = loader.windows(pieces, 2, 8)
    names = ["rank", "step", "micro_step", "row_in_batch", "x", "y"]
    whole, later = (
        [tuple(r) for r in loader.inputs_and_targets(loader.training_batches(windows, schedule, 2, 8, 2, start)).select(names).collect()]
        for start in (0, 3)
    )
    assert sorted(later) == sorted(r for r in whole if r[1] >= 3) and later
    for rank, step, micro, row, x, y in whole:
        assert x[1:] == y[:-1] and step == micro // 2
    first = {(r[0], r[3]): r[4] for r in whole if r[2] == 0}
    assert first[0, 0] == list(range(1, 9)) and first[1, 1] == list(range(25, 33))
