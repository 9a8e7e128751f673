"""Headline timings on one machine: prints one JSON line.

``BENCH_SF_DIR`` names the data folder, ``BENCH_CPUS`` the cores. Each query runs once to warm up
on the smallest data, then once timed over the whole tables.
"""

from __future__ import annotations

import json
import os
import time

from corpusforge.operators import loader, pack
from corpusforge.operators.tokenize import tokenize
from corpusforge.plans import catalogue as c
from corpusforge.session import local_session, shared_dir
from corpusforge.sources.shards import write_shards

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
WARM_DIR = "/root/testdata/sf0.001"
CPUS = os.environ.get("BENCH_CPUS", "8")

HEADLINE = [
    "shard_manifest",
    "token_unigrams",
    "pretoken_dictionary",
    "window_summary",
    "loader_schedule",
    "step_layout",
    "ngram_counts",
    "token_logprob",
    "val_loss_ppl",
    "step_loss",
    "sft_batches",
    "masked_loss",
    "choice_scores",
    "next_token_topk",
    "run_throughput",
    "bpe_merges",
    "bpe_merges_5k",
    "doc_tokens_gpt2",
    "stored_batches",
    "stream_manifest",
]


def run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def timed(action) -> float:
    begun = time.perf_counter()
    action()
    return round(time.perf_counter() - begun, 3)


def tokenize_and_pack(spark, sf_dir, path):
    pieces = pack.shard_pieces(pack.doc_offsets(tokenize(c.documents(spark, sf_dir))), c.SHARD)
    write_shards(pieces, path)


def main() -> None:
    spark = local_session(CPUS, int(CPUS))
    queries = {name: (lambda sf, q=c.QUERIES[name]: run(q(spark, sf))) for name in HEADLINE}
    scratch = f"{shared_dir(spark).rstrip('/')}/corpusforge/bench-{os.getpid()}-{time.time_ns()}"
    queries["tokenize_pack_write"] = lambda sf: tokenize_and_pack(
        spark, sf, f"{scratch}/{os.path.basename(sf)}"
    )
    queries["window_cut"] = lambda sf: run(
        loader.windows(c.pieces(spark, sf), c.B, c.T)
    )
    seconds = {}
    for name, query in queries.items():
        query(WARM_DIR)
        seconds[name] = timed(lambda: query(SF_DIR))
    n_tokens = c.corpus_totals(spark, SF_DIR).first()["n_tokens"]
    n_items = c.items(spark, SF_DIR).count()
    gpt2_tokens = c.doc_tokens_gpt2(spark, SF_DIR).agg({"n_tokens": "sum"}).first()[0]
    rates = {
        "gpt2_encode_tokens_per_sec": round(gpt2_tokens / seconds["doc_tokens_gpt2"]),
        "bpe_merges_5k_ms_per_merge": round(1000 * seconds["bpe_merges_5k"] / c.MANY_MERGES, 2),
        "tokenize_pack_write_tokens_per_sec": round(n_tokens / seconds["tokenize_pack_write"]),
        "window_cut_tokens_per_sec": round(n_tokens / seconds["window_cut"]),
        "ngram_count_tokens_per_sec": round(n_tokens / seconds["ngram_counts"]),
        "choice_scores_items_per_sec_3_models": round(n_items / seconds["choice_scores"]),
    }
    print(
        json.dumps(
            {
                "metric": "total_headline_seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "rates": rates,
                "n_tokens": n_tokens,
                "n_items": n_items,
                "sf": os.path.basename(SF_DIR.rstrip("/")),
                "cpus": CPUS,
            }
        )
    )


if __name__ == "__main__":
    main()
