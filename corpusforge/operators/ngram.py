"""An interpolated n-gram model counted by Spark: the source of log P(token | context).

Counts are kept once, at the longest context, under one binary key per n-gram: the target's two
bytes behind those of the up to two ids before it. Shorter contexts are sums of that much smaller
table, so the corpus is exploded a single time.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from corpusforge.functions import codec
from corpusforge.session import cut_lineage

ADD = 1.0
LAMBDA = 0.7
CONTEXT = 2
# Probabilities tie where their logarithms agree to this many decimals, however small they are.
LOG_DECIMALS = 10


def key_parts(key: Column) -> dict[str, Column]:
    """Named cuts of an n-gram key: ``w``, ``h1``, ``h1w`` and, where there are two, ``h2h1``."""
    n = F.octet_length(key)
    return {
        "w": F.substring(key, n - 1, F.lit(2)),
        "h1": F.substring(key, n - 3, F.lit(2)),
        "h1w": F.substring(key, n - 3, F.lit(4)),
        "h2h1": F.when(n == 6, F.substring(key, 1, 4)),
    }


def targets(rows: DataFrame, *keep: str, first: Column | None = None) -> DataFrame:
    """One row (keep.., key) per target of ``tokens``, from position ``max(first, 1)`` on.

    A sequence's first id is never a target, and no context reaches before the sequence.
    """
    start = F.lit(1) if first is None else first
    at = rows.select(
        *keep, "tokens", F.explode(codec.target_positions(F.col("tokens"), start)).alias("_p")
    )
    return at.select(*keep, codec.ngrams(F.col("tokens"), F.col("_p")).alias("key"))


def count_keys(target_rows: DataFrame, name: str = "n") -> DataFrame:
    """(key, name): partial counts before the shuffle, so a hot n-gram costs a row per task."""
    return target_rows.groupBy("key").agg(F.count(F.lit(1)).alias(name))


def mix_counts(base: DataFrame, tuned: DataFrame, weight: int) -> DataFrame:
    """(key, base, finetuned, sft_only) from two (key, n) tables: base + weight * tuned."""
    zero = F.lit(0).cast("long")
    both = base.select("key", F.col("n").alias("base"), zero.alias("sft_only")).unionByName(
        tuned.select("key", zero.alias("base"), (F.col("n") * weight).alias("sft_only"))
    )
    return (
        both.groupBy("key")
        .agg(F.sum("base").alias("base"), F.sum("sft_only").alias("sft_only"))
        .select("key", "base", (F.col("base") + F.col("sft_only")).alias("finetuned"), "sft_only")
    )


def context_string(context: Column) -> Column:
    """A context's ids as text: "" for none, "h1", or "h2 h1"."""
    return F.array_join(F.transform(codec.ids(context), lambda i: i.cast("string")), " ")


def by_context_length(counts: DataFrame, name: str = "n") -> DataFrame:
    """(k, h, w, n) for context lengths 0..2 from one (key, n) table."""
    parts = key_parts(F.col("key"))
    # Each count stands for one row per context length it has.
    contexts = F.array(F.lit(b""), parts["h1"], parts["h2h1"])
    levels = counts.select(
        parts["w"].alias("w"), F.col(name).alias("n"), F.posexplode(contexts).alias("k", "h")
    )
    summed = levels.where("h is not null").groupBy("k", "h", "w").agg(F.sum("n").alias("n"))
    return summed.select(
        F.col("k").cast("long").alias("k"),
        context_string(F.col("h")).alias("h"),
        codec.id_of(F.col("w")).alias("w"),
        "n",
    )


@dataclass(frozen=True)
class NgramModel:
    """Counts of one or more models over the same keys: (key, <model>, <model>..)."""

    counts: DataFrame
    models: tuple[str, ...]
    vocab_size: int
    add: float = ADD
    weight: float = LAMBDA

    def only(self, model: str) -> NgramModel:
        counts = self.counts.select("key", model)
        return NgramModel(counts, (model,), self.vocab_size, self.add, self.weight)

    def _sums(self, prefix: str, **by: Column) -> DataFrame:
        """Counts summed by parts of the key, as (by.., prefix_<model>..)."""
        sums = [F.sum(m).alias(f"{prefix}_{m}") for m in self.models]
        return self.counts.groupBy(*[c.alias(n) for n, c in by.items()]).agg(*sums)

    def _two_before(self) -> NgramModel:
        counts = self.counts.where(F.octet_length("key") == 6)
        return NgramModel(counts, self.models, self.vocab_size, self.add, self.weight)

    def unigram(self) -> DataFrame:
        """(w, p0_<model>..) for every id of the vocabulary: at most 65,536 rows."""
        spark = self.counts.sparkSession
        vocab = spark.range(0, self.vocab_size, 1, 1).select(codec.one_id(F.col("id")).alias("w"))
        c0 = self._sums("c0", w=key_parts(F.col("key"))["w"])
        full = vocab.join(c0, "w", "left").fillna(0)
        everything = Window.partitionBy()
        return full.select(
            "w",
            *[
                (
                    (F.col(f"c0_{m}") + self.add)
                    / (F.sum(f"c0_{m}").over(everything) + self.add * self.vocab_size)
                ).alias(f"p0_{m}")
                for m in self.models
            ],
        )

    def _mix(self, hits: str, seen: str, lower: str, out: str) -> list[Column]:
        mixed = []
        for m in self.models:
            c = F.coalesce(F.col(f"{hits}_{m}"), F.lit(0))
            n = F.coalesce(F.col(f"{seen}_{m}"), F.lit(0))
            p = F.col(f"{lower}_{m}")
            mixed.append(
                F.when(n > 0, self.weight * (c / n) + (1 - self.weight) * p)
                .otherwise(p)
                .alias(f"{out}_{m}")
            )
        return mixed

    def one_token_level(self, rows: DataFrame) -> DataFrame:
        """Add p1_<model> to rows with ``h1`` and ``w`` (``h1`` may be empty).

        The unigram table and the one-id context totals have at most a vocabulary's rows, so they
        are broadcast; the pair counts may grow with the data and join by Spark's choice.
        """
        parts = key_parts(F.col("key"))
        names = rows.columns
        return (
            rows.withColumn("_h1w", F.concat("h1", "w"))
            .join(F.broadcast(self.unigram()), "w")
            .join(self._sums("c1", _h1w=parts["h1w"]), "_h1w", "left")
            .join(F.broadcast(self._sums("n1", h1=parts["h1"])), "h1", "left")
            .select(*names, *self._mix("c1", "n1", "p0", "p1"))
        )

    def two_token_level(self, rows: DataFrame) -> DataFrame:
        """Add p2_<model> to rows with ``h2h1`` (null: one id or none), ``w`` and p1_<model>."""
        names = [c for c in rows.columns if not c.startswith("p1_")]
        full = self._two_before()
        c2 = full.counts.select(
            F.col("key").alias("_key"), *[F.col(m).alias(f"c2_{m}") for m in self.models]
        )
        n2 = full._sums("n2", h2h1=key_parts(F.col("key"))["h2h1"])
        return (
            rows.withColumn("_key", F.concat("h2h1", "w"))
            .join(c2, "_key", "left")
            .join(n2, "h2h1", "left")
            .select(*names, *self._mix("c2", "n2", "p1", "p2"))
        )

    def log_probs(self, needed: DataFrame) -> DataFrame:
        """(key, logp_<model>..) for each distinct key in ``needed``.

        Both sides of every join hold a key at most once per longer context, so none is hot.
        """
        parts = key_parts(F.col("key"))
        keys = needed.select("key").distinct()
        rows = keys.select("key", *[parts[n].alias(n) for n in ("w", "h1", "h2h1")])
        p = self.two_token_level(self.one_token_level(rows))
        return p.select("key", *[F.log(f"p2_{m}").alias(f"logp_{m}") for m in self.models])

    def next_token_topk(
        self, contexts: DataFrame, model: str, top_k: int | None, temperature: float = 1.0
    ) -> DataFrame:
        """(context, w, rnk, p) of the kept tokens after each distinct ``context``.

        ``context`` is a token binary of at most two ids. Scores are divided by the temperature,
        tokens below the k-th best are dropped (ties at k survive), and the rest is normalised.
        A token never seen after a context keeps the order it has at the next shorter context,
        so seen tokens plus the best of the shorter context hold every survivor and the
        vocabulary is never paired with the contexts.
        """
        one = self.only(model)
        k = min(top_k or self.vocab_size, self.vocab_size)
        p0, p1, p2 = (f"{level}_{model}" for level in ("p0", "p1", "p2"))
        c = F.col("context")
        contexts = contexts.select("context").distinct().select(
            "context",
            codec.last_ids(c, 1).alias("h1"),
            F.when(F.octet_length(c) == 4, c).alias("h2h1"),
        )
        heads = contexts.select("h1").distinct()

        # Candidates keep a margin far above rounding, so cutting early never cuts a tie.
        def best(df: DataFrame, score: str, *by: str) -> DataFrame:
            group = Window.partitionBy(*by)
            place = F.row_number().over(group.orderBy(F.desc(score)))
            return (
                df.withColumn("_place", place)
                .withColumn("_kth", F.min(F.when(F.col("_place") <= k, F.col(score))).over(group))
                .where(F.col(score) >= F.col("_kth") * (1 - 1e-9))
                .drop("_place", "_kth")
            )

        parts = key_parts(F.col("key"))
        general = best(one.unigram(), p0).agg(F.collect_list("w").alias("ws")).scalar()
        after_one = one.counts.select(parts["h1"].alias("h1"), parts["w"].alias("w")).distinct()
        pairs = (
            heads.join(after_one, "h1")
            .unionByName(heads.withColumn("w", F.explode(general)))
            .distinct()
        )
        likely = best(one.one_token_level(pairs), p1, "h1").select("h1", "w")
        after_two = one._two_before().counts.select(parts["h2h1"].alias("h2h1"), parts["w"].alias("w"))
        triples = (
            contexts.join(after_two, "h2h1")
            .select("context", "h1", "h2h1", "w")
            .unionByName(contexts.join(likely, "h1").select("context", "h1", "h2h1", "w"))
            .distinct()
        )
        scored = one.two_token_level(one.one_token_level(triples))

        group = Window.partitionBy("context")
        order = F.desc(rank_value(F.col(p2)))
        kept = scored.withColumn("rnk", F.rank().over(group.orderBy(order)).cast("long")).where(
            F.col("rnk") <= k
        )
        return (
            kept.withColumn("_logit", F.log(p2) / F.lit(float(temperature)))
            .withColumn("_e", F.exp(F.col("_logit") - F.max("_logit").over(group)))
            .withColumn("p", F.col("_e") / F.sum("_e").over(group))
            .select("context", "w", "rnk", "p")
        )


def fit(
    counts: DataFrame, models: tuple[str, ...], vocab_size: int, path: str | None = None
) -> NgramModel:
    """Write the counts once, as training leaves a checkpoint, and build the model on that table.

    ``path`` names the checkpoint; without one it is an intermediate table.
    """
    if path is None:
        return NgramModel(cut_lineage(counts, "ngram-counts"), models, vocab_size)
    counts.write.mode("overwrite").parquet(path)
    return load_model(counts.sparkSession, path, models, vocab_size)


def load_model(spark: SparkSession, path: str, models: tuple[str, ...], vocab_size: int) -> NgramModel:
    """A model from the counts that ``fit`` wrote."""
    schema = ", ".join(["key binary", *[f"{m} long" for m in models]])
    return NgramModel(spark.read.schema(schema).parquet(path), models, vocab_size)


def rank_value(p: Column) -> Column:
    """What probabilities are ranked by: equal for values that differ by rounding alone."""
    return F.round(F.log(p), LOG_DECIMALS)


def unit_draw(*parts: Column) -> Column:
    """A reproducible number in [0, 1) from the md5 of the parts."""
    digest = F.md5(F.concat_ws(":", *parts).cast("binary"))
    return F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") / float(1 << 52)


def next_token_draw(distribution: DataFrame, seed: int) -> DataFrame:
    """(context, w): one draw per context by inverse distribution function."""
    group = Window.partitionBy("context")
    order = group.orderBy(F.desc(rank_value(F.col("p"))), "w")
    running = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    u = unit_draw(F.lit(str(seed)), context_string(F.col("context")))
    passed = (F.col("cdf") > u) | (F.col("_place") == F.col("_size"))
    return (
        distribution.withColumn("cdf", F.sum("p").over(running))
        .withColumn("_place", F.row_number().over(order))
        .withColumn("_size", F.count(F.lit(1)).over(group))
        .where(passed)
        .groupBy("context")
        .agg(F.min_by("w", "_place").alias("w"))
    )
