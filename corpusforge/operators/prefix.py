"""Running sums, neighbour look-ups and ranks in a total order, without one big sorted group."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from corpusforge.functions.codec import idiv
from corpusforge.session import cut_lineage, tasks_for

# The last level of a running sum is one sorted group; it never has more rows than this.
TOP_BITS = 23
RANK_BLOCK = 4096


def level_shifts(id_bits: int, block_bits: int) -> tuple[int, ...]:
    """How many high-bit levels keys below 2**id_bits need to leave at most 2**TOP_BITS groups."""
    if id_bits <= TOP_BITS and id_bits <= block_bits:
        return ()
    shifts, left = [block_bits], id_bits - block_bits
    while left > TOP_BITS:
        shifts.append(20)
        left -= 20
    return tuple(shifts)


def exclusive_prefix(
    df: DataFrame,
    key: str,
    value: str,
    out: str,
    by: Sequence[str] = (),
    total: str | None = None,
    id_bits: int = 63,
    block_bits: int = 20,
    write_totals: bool = False,
    below: int | None = None,
    width: int = 0,
) -> DataFrame:
    """Add ``out`` = sum of ``value`` over rows with a smaller ``key`` (inside each ``by`` group).

    ``key`` is a whole number in 0 .. 2**id_bits - 1, unique inside its ``by`` group; a key
    outside that range fails the job. Rows are windowed inside blocks of 2**block_bits
    neighbouring keys; block totals go through the same step until few remain, and each block's
    base comes back by an equi-join on the block. So neither a window nor a join sees more rows
    of one group than a block holds, however the keys are spread, and ``df`` is moved once.
    ``total`` names an extra column with the group's full sum.

    ``write_totals`` writes the block totals once, so that ``df`` is read twice however many
    levels there are. ``below`` keeps only rows whose ``out`` is smaller: blocks that begin at or
    beyond it are dropped before their rows are moved. ``width`` is the bytes that rows carry per unit
    of ``value``; with written totals, large rows are dealt to as many tasks as their bytes need.
    """
    in_range = F.shiftright(F.col(key).cast("long"), min(id_bits, 62)) == 0
    too_big = F.raise_error(F.lit(f"{key} is not in 0 .. 2**{id_bits} - 1; pass a larger id_bits"))
    if id_bits >= 63:
        in_range = F.col(key) >= 0
    value_column = F.when(in_range, F.col(value)).otherwise(too_big.cast("long")).cast("long")
    df = df.withColumn("_value", value_column)
    shifts = level_shifts(id_bits, block_bits)
    done = _prefix(df, key, "_value", out, list(by), total, shifts, write_totals, below, width)
    return (done if below is None else done.where(F.col(out) < below)).drop("_value")


def _prefix(
    df: DataFrame,
    key: str,
    value: str,
    out: str,
    by: list[str],
    total: str | None,
    shifts: Sequence[int],
    write_totals: bool = False,
    below: int | None = None,
    width: int = 0,
) -> DataFrame:
    if not shifts:
        group = Window.partitionBy(*by)
        running = group.orderBy(key).rowsBetween(Window.unboundedPreceding, -1)
        df = df.withColumn(out, F.coalesce(F.sum(value).over(running), F.lit(0)).cast("long"))
        return df.withColumn(total, F.sum(value).over(group)) if total else df

    block, level_sum, base = (f"_{name}_{len(shifts)}" for name in ("block", "sum", "base"))
    df = df.withColumn(block, F.shiftright(F.col(key).cast("long"), shifts[0]))
    totals = df.groupBy(*by, block).agg(F.sum(value).alias(level_sum))
    if write_totals:
        totals = cut_lineage(totals, "block-totals")
        if width and below is None:
            tasks = tasks_for(df.sparkSession, width * (totals.agg(F.sum(level_sum)).first()[0] or 0))
            if tasks > tasks_for(df.sparkSession, 0):
                df = df.repartition(tasks, *by, block)
    bases = _prefix(totals, block, level_sum, base, by, total, shifts[1:])
    bases = bases.select(*by, block, base, *([total] if total else []))
    if below is not None:
        # Written, so that Spark knows how few they are before it plans the join.
        bases = cut_lineage(bases.where(F.col(base) < below), "leading-blocks")
        df = df.join(bases.select(*by, block), [*by, block], "left_semi")
    running = (
        Window.partitionBy(*by, block).orderBy(key).rowsBetween(Window.unboundedPreceding, -1)
    )
    return (
        df.withColumn(out, F.coalesce(F.sum(value).over(running), F.lit(0)))
        .join(bases, [*by, block])
        .withColumn(out, (F.col(out) + F.col(base)).cast("long"))
        .drop(block, base)
    )


def dense_rank_of(
    df: DataFrame, key: str, out: str, by: Sequence[str] = (), id_bits: int = 63
) -> DataFrame:
    """Add ``out`` = 0-based position of each row in ``key`` order."""
    ones = df.withColumn("_one", F.lit(1))
    return exclusive_prefix(ones, key, "_one", out, by, id_bits=id_bits).drop("_one")


def followers(df: DataFrame, rank: str, value: str, count: int, out: str) -> DataFrame:
    """Add ``out`` = array of ``value`` of the next ``count`` rows by dense ``rank``.

    Blocks of ranks are windowed on their own; the first ``count`` rows of a block are also sent
    to the block before it, so that its last rows see their followers.
    """
    r = F.col(rank)
    home = idiv(r, RANK_BLOCK)
    halo = (r % RANK_BLOCK < count) & (r >= RANK_BLOCK)
    places = F.when(halo, F.array(home, home - 1)).otherwise(F.array(home))
    w = Window.partitionBy("_place").orderBy(rank)
    ahead = [F.lead(value, i).over(w) for i in range(1, count + 1)]
    return (
        df.withColumn("_place", F.explode(places))
        .withColumn(out, F.filter(F.array(*ahead), lambda x: x.isNotNull()))
        .where(F.col("_place") == home)
        .drop("_place")
    )


def previous_value(
    df: DataFrame, by: Sequence[str], order: str, value: Column, out: str
) -> DataFrame:
    """Add ``out`` = ``value`` of the row before, in ``order`` inside each ``by`` group.

    The lag runs inside blocks of neighbouring order keys; the first row of a block takes the
    last value of the nearest block before it.
    """
    by = list(by)
    df = df.withColumn("_v", value).withColumn("_b", F.shiftright(F.col(order).cast("long"), 12))
    tails = df.groupBy(*by, "_b").agg(F.max_by("_v", order).alias("_tail"))
    over_blocks = Window.partitionBy(*by).orderBy("_b")
    tails = tails.withColumn("_carry", F.lag("_tail").over(over_blocks)).drop("_tail")
    inside = Window.partitionBy(*by, "_b").orderBy(order)
    return (
        df.withColumn("_lag", F.lag("_v").over(inside))
        .join(tails, [*by, "_b"])
        .withColumn(out, F.coalesce("_lag", "_carry"))
        .drop("_v", "_b", "_lag", "_carry")
    )
