"""The four stages over one small folder, with byte tokens and with learned merges."""

from pathlib import Path

import pytest

from corpusforge.operators import bpe, ngram
from corpusforge.operators.tokenize import BYTES
from corpusforge.plans import catalogue, stages
from corpusforge.session import shared_dir
from corpusforge.sources import fixtures
from corpusforge.sources.corpus import read_documents
from corpusforge.sources.results import read_results

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("kind", ["bytes", "merges"])
def test_stages(spark, tmp_path, kind):
    documents, shards = f"{SF}/documents.parquet", str(tmp_path / "shards")
    tokenizer = BYTES
    if kind == "merges":
        tokenizer = bpe.bpe_tokenizer(bpe.learn_merges(read_documents(spark, documents), 16))
    manifest = stages.prepare_shards(spark, documents, shards, 60_000, tokenizer).collect()
    assert [r["split"] for r in sorted(manifest)] == ["val"] + ["train"] * (len(manifest) - 1)
    assert sum(r["n_tokens"] for r in manifest) > 200_000
    left = set((Path(shared_dir(spark)) / "corpusforge").iterdir())
    windows, steps = stages.training_layout(spark, shards, 4, 64, 2, 2048)
    assert steps.count() > 0
    sciq = fixtures.sciq_shaped(spark.read.parquet(f"{SF}/conversations.parquet"))
    arc = fixtures.arc_shaped(spark.read.parquet(f"{SF}/benchmark.parquet"))
    sciq.write.parquet(str(tmp_path / "sciq"))
    sciq = spark.read.parquet(str(tmp_path / "sciq"))
    made = set((Path(shared_dir(spark)) / "corpusforge").iterdir()) - left  # by the question rows
    model = stages.fit_models(windows, sciq.where("split = 'train'"), 5, tokenizer, str(tmp_path / "counts"))
    losses = {r["model"]: r["ppl"] for r in stages.validation_loss(spark, shards, 4, 64, model).collect()}
    assert 1 < losses["base"] < losses["sft_only"] < tokenizer.vocab_size * 2
    out = str(tmp_path / "results")
    board = stages.evaluate(sciq, arc, model, out, tokenizer)
    assert read_results(spark, out).count() == board.where("total is not null").count() > 0
    mine = stages.evaluate(sciq, arc, None, tokenizer=tokenizer, scorers={"mine": catalogue.plain_length_scorer})
    assert {r["model"] for r in mine.collect()} == {"mine", "random baseline"}
    # The stages leave their outputs and nothing else.
    assert set((Path(shared_dir(spark)) / "corpusforge").iterdir()) - left == made
    again = ngram.load_model(spark, str(tmp_path / "counts"), model.models, tokenizer.vocab_size)
    assert again.counts.count() == model.counts.count() > 0
