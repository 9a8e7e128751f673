"""Work and files that must not grow faster than the input."""

import struct
import tracemalloc
from pathlib import Path

import pyarrow as pa
from pyspark.sql import functions as F

from corpusforge.operators import bpe, loader, metrics, pack, prefix
from corpusforge.operators.tokenize import tokenize
from corpusforge.plans import catalogue
from corpusforge.session import cut_lineage, tasks_for
from corpusforge.sources import results


def test_window_summary_makes_no_list_of_ids(spark):
    sequences = [[0, 65_535], [256, 1, 2], [9], [65_535] * 70_000]
    rows = [(0, i, bytearray(struct.pack(f">{len(x)}H", *x))) for i, x in enumerate(sequences)] + [(0, 9, None), (0, 10, bytearray())]
    table = loader.window_summary(spark.createDataFrame(rows, "shard_idx long, w long, tokens binary"))
    plan = table._jdf.queryExecution().executedPlan().toString()
    assert "regexp_extract_all" not in plan
    got = {r.w: (r.sum_x, r.sum_y, r.first_id, r.last_id) for r in table.collect()}
    for i, x in enumerate(sequences):
        assert got[i] == (sum(x[:-1]), sum(x[1:]), x[0], x[-1])
    assert got[9] == got[10] == (None, None, None, None)


def test_many_runs_are_few_files(spark, tmp_path):
    values = spark.range(3_000).select(F.col("id").alias("run_id"), F.lit(0).alias("step"), F.col("id").cast("double").alias("value"))
    results.write_metrics(values, str(tmp_path / "m"), "loss")
    assert len(list(Path(tmp_path, "m").rglob("*.parquet"))) < 100
    again = values.where("run_id < 10").withColumn("value", F.lit(-1.0)).unionByName(values.limit(0))
    results.write_metrics(again, str(tmp_path / "m"), "loss")
    got = {r.run_id: r.value for r in results.read_metrics(spark, str(tmp_path / "m"), "loss").collect()}
    assert len(got) == 3_000 and got["3"] == -1.0 and got["11"] == 11.0


def test_a_large_batch_is_encoded_piece_by_piece(spark):
    encode = bpe.encoder(bpe.vocabulary_of([])).func
    rows = [[], [" word" * 8] * 400, None, ["é"]] + [[" some", " words"] * 500] * 2_000
    batch = pa.array(rows, pa.list_(pa.string()))
    tracemalloc.start()
    got = next(encode(iter([batch])))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 8 * got.nbytes
    assert [bytes(x) for x in got.to_pylist()] == [b"".join(bytes([0, b]) for w in r or [] for b in w.encode()) for r in rows]
    assert len(next(encode(iter([pa.array([], pa.list_(pa.string()))])))) == 0


def test_many_readings_and_documents_take_more_tasks_not_larger_ones(spark, monkeypatch):
    docs = catalogue.documents(spark, "/root/testdata/sf0.001").where("doc_id < 2000")
    few = sorted(map(tuple, catalogue.training_batches(spark, "/root/testdata/sf0.001").collect()))
    fine = lambda spark, size, most=0: max(8, -(-size // 50_000))
    for module in (prefix, loader):
        monkeypatch.setattr(module, "tasks_for", fine)
    monkeypatch.setattr(loader, "BROADCAST_READINGS", 0)
    offsets = pack.doc_offsets(tokenize(docs))
    plan = offsets._jdf.queryExecution().executedPlan().toString()
    assert "REPARTITION_BY_NUM" in plan
    many = catalogue.training_batches(spark, "/root/testdata/sf0.001")
    assert "SortMergeJoin [shard_idx" in many._jdf.queryExecution().executedPlan().toString()
    assert few and sorted(map(tuple, many.collect())) == few
    assert tasks_for(spark, 100 << 26) == 100 and tasks_for(spark, 0) == 8


def test_an_unfolded_schedule_is_not_broadcast_to_its_losses(spark):
    plan = spark.createDataFrame([("train", r, s, 40_000, 4_000, 0) for r in (0, 1) for s in (1, 2)], "split string, rank long, shard_idx long, n_tokens long, n_batches long, unused_tokens long")
    schedule = loader.loader_schedule(plan, 1, 1, 2, epochs=1)
    losses = spark.range(1, 3).select(F.col("id").alias("shard_idx"), F.explode(F.sequence(F.lit(0).cast("long"), F.lit(7_999).cast("long"))).alias("batch"))
    losses = losses.groupBy("shard_idx", "batch").agg(F.avg(F.col("shard_idx") * 10_000.0 + F.col("batch")).alias("loss_m"))
    at = metrics.scheduled_losses(losses, schedule, 1, 1)
    got = {(r.rank, r.micro_step): r.loss_m for r in at.collect()}
    assert got == {(r, m): (1 + m // 4_000) * 10_000 + r + m % 4_000 * 2 for r in (0, 1) for m in range(8_000)}
    final = at._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin [shard_idx" in final and "BroadcastHashJoin [shard_idx" not in final
    whole = catalogue.step_loss(spark, "/root/testdata/sf0.001")
    assert whole.collect()
    final = whole._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin [shard_idx" in final and "BroadcastHashJoin [shard_idx" not in final


def test_stored_step_losses_are_made_without_a_broadcast_schedule(spark, monkeypatch):
    plans = {}

    def noted(df, name):
        df.collect()  # the plan is final after a run
        plans[name] = df._jdf.queryExecution().executedPlan().toString()
        return cut_lineage(df, name)

    monkeypatch.setattr(catalogue, "cut_lineage", noted)
    stored = {r.step: (r.run_id, r.name, r.value) for r in catalogue.step_metrics(spark, "/root/testdata/sf0.001").collect()}
    assert "SortMergeJoin [shard_idx" in plans["step-losses"] and "BroadcastHashJoin [shard_idx" not in plans["step-losses"]
    losses = catalogue.step_loss(spark, "/root/testdata/sf0.001").collect()
    assert losses and stored == {r.step: ("pass-0", "train_loss", r.loss) for r in losses}
