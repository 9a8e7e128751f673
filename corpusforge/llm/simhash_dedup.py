"""SimHash near-dedup: fingerprints linked at a small Hamming distance through vantage-point trees."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from corpusforge.llm.batches import columns_of, give_back, heads, mixed, runs_of, slices
from corpusforge.llm.components import components
from corpusforge.session import cut_lineage

SHINGLE = 3
SEED = 42
DISTANCE = 2
SAMPLE = 16_384
"""Fingerprints that the shard tree is fitted on; every fingerprint is indexed."""
LEAF = 2_048
"""Fingerprints of a shard or of a leaf inside a shard, about."""
BLOCK_CELLS = 1 << 20
"""Pairs of fingerprints compared at once."""
NULL_ID = (1 << 63) - 1


def shingled(text: str | None, size: int) -> list[bytes]:
    """Runs of ``size`` words in lower case, repeats included; fewer words are one run, none give none."""
    words = (text or "").encode().lower().split()
    if not words:
        return []
    return [b" ".join(x) for x in zip(*(words[i:] for i in range(size)))] or [b" ".join(words)]


def hashed(shingles: list[bytes]) -> np.ndarray:
    return np.fromiter((xxhash.xxh64_intdigest(s, SEED) for s in shingles), np.uint64, len(shingles))


def majority(hashes: np.ndarray) -> int:
    """Majority of the bits of all shingle hashes, as an unsigned integer; 0 without shingles."""
    counts = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 65_536):
        part = hashes[at : at + 65_536]
        counts += np.unpackbits(part.astype(">u8").view(np.uint8).reshape(-1, 8), axis=1).sum(0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * counts > len(hashes)).tobytes(), "big")


def fingerprint(text: str | None, size: int = SHINGLE) -> int:
    return majority(hashed(shingled(text, size)))


def fingerprints(docs: DataFrame) -> DataFrame:
    """(doc_id, f): the fingerprint of each text as a signed 64-bit number."""

    def run(batches):
        for batch in batches:
            for rows in slices(pa.table(batch)):
                found = np.array([fingerprint(t) for t in rows.column("text").to_pylist()], np.uint64)
                yield pa.record_batch({"doc_id": rows.column("doc_id").combine_chunks(), "f": pa.array(found.view(np.int64))})

    rows = columns_of(docs, "doc_id", "text").select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id long, f long")


def distance(point: int, others: np.ndarray) -> np.ndarray:
    return np.bitwise_count(others ^ point)


def split(points: np.ndarray) -> tuple[np.uint64, int] | None:
    """(vantage point, radius) with the median distance inside; None if all are equally far.

    The vantage point is a fixed mixture of the points, so fits repeat exactly.
    """
    vantage = np.bitwise_xor.reduce(points[:: max(1, len(points) // 7)])
    d = distance(vantage, points)
    radius = int(np.median(d))
    if radius >= d.max():
        radius = int(d.max()) - 1
    return None if radius < d.min() else (vantage, radius)


def grow(points: np.ndarray, expected: float, reach: int = DISTANCE, leaf: int = LEAF, depth: int = 0):
    """A tree (vantage, radius, inner, outer) down to leaves of about ``leaf`` fingerprints.

    ``expected``: how many fingerprints of the whole table arrive here.
    """
    found = split(points) if expected > leaf and len(points) >= 16 and depth < 40 else None
    if found is None:
        return None
    d = distance(found[0], points)
    inner, outer = points[d <= found[1] + reach], points[d > found[1]]
    if len(inner) == len(points):
        return None
    share = expected / len(points)
    return (*found, grow(inner, share * len(inner), reach, leaf, depth + 1), grow(outer, share * len(outer), reach, leaf, depth + 1))


def shards(tree, points: np.ndarray, index: np.ndarray, reach: int = DISTANCE, name: int = 1):
    """(shard, rows): the rows of each shard they belong to.

    Two points within ``reach`` on different sides of a radius differ by ``reach`` at most in their
    distance to the vantage point. So the inner side also takes those just outside, and every pair
    meets in a shard; all other branches are out of reach.
    """
    if tree is None:
        yield name, index
        return
    vantage, radius, inner, outer = tree
    d = distance(vantage, points[index])
    yield from shards(inner, points, index[d <= radius + reach], reach, 2 * name)
    yield from shards(outer, points, index[d > radius], reach, 2 * name + 1)


def close_pairs(
    points: np.ndarray,
    reach: int = DISTANCE,
    fine: np.ndarray | None = None,
    far: int = 64,
    leaf: int = LEAF,
    cells: int = BLOCK_CELLS,
    asks: np.ndarray | None = None,
):
    """Index pairs within ``reach``, block by block, through a tree over the shard itself.

    With ``fine`` only pairs whose second fingerprints differ in ``far`` bits at most, with ``asks`` only
    those whose later point asks.
    """
    tree = grow(points, len(points), reach, leaf)
    for _, rows in shards(tree, points, np.arange(len(points)), reach):
        here = points[rows]
        block = max(1, min(256, cells // max(1, len(here))))
        later = np.arange(len(here)) if asks is None else np.flatnonzero(asks[rows])
        for at in range(0, len(later), block):
            mine = later[at : at + block]
            top = mine[-1] + 1
            near = np.bitwise_count(here[mine, None] ^ here[None, :top]) <= reach
            if fine is not None:
                near &= np.bitwise_count(fine[rows[mine], None] ^ fine[None, rows[:top]]) <= far
            i, j = np.nonzero(near)
            yield rows[mine[i]], rows[j]


def stars(table: pa.Table) -> pa.Table:
    """Links of a shard, each linked point to the smallest document of its local component."""
    points = table.column("f").to_numpy().astype(np.int64).view(np.uint64)
    docs = table.column("first").to_numpy()
    label = np.arange(len(points))
    order = np.argsort(docs, kind="stable")
    points, docs = points[order], docs[order]
    pairs = [(a[a != b], b[a != b]) for a, b in close_pairs(points)]
    a, b = (np.concatenate(x) for x in zip(*pairs)) if pairs else (label[:0], label[:0])
    while True:
        new = label.copy()
        np.minimum.at(new, a, label[b])
        np.minimum.at(new, b, label[a])
        new = new[new]
        if (new == label).all():
            break
        label = new
    own = label != np.arange(len(label))
    return pa.table({"a": docs[own], "b": docs[label[own]]})


def fitted(points: DataFrame, reach: int = DISTANCE, leaf: int = LEAF):
    """The tree of a sample of the points (f, ..)."""
    sample = points.orderBy(F.xxhash64("f"), "f").limit(SAMPLE).select("f").collect()
    total = points.count()
    return grow(np.array([r[0] for r in sample], np.int64).view(np.uint64), total, reach, leaf) if sample else None


def dealt_points(points: DataFrame, tree, reach: int = DISTANCE) -> DataFrame:
    """The points (f, ..), once for each shard of the tree they belong to, with its name in ``shard``."""

    def deal(batches):
        for batch in batches:
            f = batch.column("f").to_numpy().astype(np.int64).view(np.uint64)
            found = list(shards(tree, f, np.arange(len(f)), reach))
            rows = np.concatenate([r for _, r in found])
            shard = np.repeat(np.array([s for s, _ in found], np.int64), [len(r) for _, r in found])
            yield pa.record_batch([pa.array(shard), *batch.take(pa.array(rows)).columns], ["shard", *batch.schema.names])

    return points.mapInArrow(deal, points.select(F.lit(0).cast("long").alias("shard"), "*").schema)


def same_ids(marked: DataFrame, points: DataFrame, name: str) -> DataFrame:
    """(a, b): rows that share a doc_id are one node, so the firsts of their points are linked to it."""
    several = marked.select("doc_id", name).distinct().groupBy("doc_id").agg(F.count("*").alias("n")).where("n > 1")
    rows = marked.join(several, "doc_id", "left_semi").select("doc_id", name).distinct()
    return rows.join(points, name).where("doc_id <> first").select(F.col("doc_id").alias("a"), F.col("first").alias("b"))


def simhash_dedup(docs: DataFrame) -> DataFrame:
    """(doc_id, f, component_id) of every document.

    Takes (doc_id, text) and ignores other columns. ``component_id`` is the smallest doc_id that
    chains of links reach. Null, empty and blank texts have fingerprint 0, linked like any other;
    rows that share a doc_id are one node; a null doc_id comes back as null and counts as the largest
    id; an empty table gives no rows.

    Equal fingerprints are merged before anything else, so a group of copies of any size is one
    point. A tree fitted on a bounded sample deals all points into shards; shards search their pairs
    in trees of their own and give one link per point.
    """
    marked = fingerprints(docs).withColumn("doc_id", F.coalesce("doc_id", F.lit(NULL_ID)))
    marked = cut_lineage(marked, "fingerprints")
    points = cut_lineage(marked.groupBy("f").agg(F.min("doc_id").alias("first")), "points")
    dealt = dealt_points(points, fitted(points))
    links = dealt.groupBy("shard").applyInArrow(lambda t: stars(t), "a long, b long")
    reached = components(links.union(same_ids(marked, points, "f")))
    named = points.join(reached, points["first"] == reached["node"], "left").select(
        F.col("f").alias("g"), F.coalesce("component", "first").alias("component_id")
    )
    joined = marked.join(named, marked["f"] == named["g"])
    none = F.lit(NULL_ID)
    return joined.select(F.nullif("doc_id", none).alias("doc_id"), "f", F.nullif("component_id", none).alias("component_id"))


# --- near copies by the share of common shingles ------------------------------------------

NEAR_SHINGLE, NEAR_PERCENT = 5, 80
WORD_DISTANCE = 2
WORD_MIXES = 5
"""Near copies differ little in fingerprints of their single words. One such fingerprint would have to be
searched 4 bits far, and so wide a band copies most points into most shards; of several that stand on
independent hashes of the same words one is close, and each has a tree of its own."""
NEAR_DISTANCE = 16
"""Pairs that differ more than this in the fingerprint of their shingles are not looked at again."""
NEAR_LEAF = 32_768
"""Larger shards hold more of the band around a radius, so points are copied less often."""
NEAR_CELLS = 1 << 18
NEAREST, NEAREST_LATER = 4, 1_024
"""Candidates that a document asks for in the first round, and in a later one at most."""
ASKS_NOT, NO_PAIR = 65, -1
PAIR_BLOCK = 1 << 18


def shingle_set(hashes: np.ndarray) -> np.ndarray:
    """The different shingles, ascending; a text without words has one, that of nothing."""
    return np.unique(hashes) if len(hashes) else np.zeros(1, np.uint64)


def several(hashes: np.ndarray) -> np.ndarray:
    """WORD_MIXES fingerprints of one text's words, each of the hashes mixed once more, as signed numbers."""
    found = []
    for _ in range(WORD_MIXES):
        found.append(majority(hashes))
        hashes = mixed(hashes)
    return np.array(found, np.uint64).view(np.int64)


def marks(docs: DataFrame, size: int) -> DataFrame:
    """(doc_id, words, fine, key): fingerprints of words and of shingles, and a hash of the shingle set."""

    def run(batches):
        for batch in batches:
            for rows in slices(pa.table(batch)):
                texts = rows.column("text").to_pylist()
                found = [hashed(shingled(t, size)) for t in texts]
                words = [several(hashed(shingled(t, 1))) for t in texts]
                fine = np.array(list(map(majority, found)), np.uint64)
                keys = np.array([xxhash.xxh64_intdigest(shingle_set(h).tobytes()) for h in found], np.uint64)
                yield pa.record_batch(
                    {
                        "doc_id": rows.column("doc_id").combine_chunks(),
                        "words": pa.array(words, pa.list_(pa.int64())),
                        "fine": pa.array(fine.view(np.int64)),
                        "key": pa.array(keys.view(np.int64)),
                    }
                )

    return docs.mapInArrow(run, "doc_id long, words array<long>, fine long, key long")


def first_of_each(pairs: np.ndarray, most: int) -> np.ndarray:
    """The ``most`` closest rows of each document, from rows (document, bits, earlier document)."""
    pairs = pairs[:, np.lexsort(pairs[::-1])]
    pairs = pairs[:, heads(*pairs)]
    first = heads(pairs[0])
    place = np.arange(pairs.shape[1]) - np.flatnonzero(first)[runs_of(first)] if pairs.shape[1] else pairs[0]
    return pairs[:, place < most]


def nearest_earlier(table: pa.Table, reach: int, far: int, most: int, named: bool = False) -> pa.Table:
    """(a, bits, b): each document of a shard with the closest earlier ones by ``fine``.

    If the table has ``label``, ``bits`` and ``past``, a document asks behind that place of its
    candidates and only for those of another label; ``bits`` beyond ``far`` do not ask. With ``named``
    every document that is a candidate of a later one has a row too, with NO_PAIR for ``bits``.
    """
    words, fine, docs = (table.column(name).to_numpy().astype(np.int64) for name in ("f", "fine", "first"))
    order = np.argsort(docs, kind="stable")
    words, fine, docs = words[order].view(np.uint64), fine[order].view(np.uint64), docs[order]
    label = asks = None
    if "label" in table.column_names:
        label, behind, past = (table.column(name).to_numpy().astype(np.int64)[order] for name in ("label", "bits", "past"))
        asks = behind <= far
    met = np.zeros(len(docs), bool)
    found, size = [np.zeros((3, 0), np.int64)], 0
    for i, j in close_pairs(words, reach, fine, far, NEAR_LEAF, NEAR_CELLS, asks):
        low, high = np.minimum(i, j), np.maximum(i, j)
        bits = np.bitwise_count(fine[low] ^ fine[high]).astype(np.int64)
        good = low < high
        if label is not None:
            good &= (label[low] != label[high]) & ((bits > behind[high]) | (bits == behind[high]) & (docs[low] > past[high]))
        found.append(np.stack((high[good], bits[good], low[good])))
        met[low[good]] = named
        size += found[-1].shape[1]
        if size > PAIR_BLOCK:
            found = [first_of_each(np.concatenate(found, axis=1), most)]
            size = 0
    a, bits, b = first_of_each(np.concatenate(found, axis=1), most)
    met[a] = False
    rest = docs[met]
    pairs = {"a": np.append(docs[a], rest), "bits": np.append(bits, np.full(len(rest), NO_PAIR)), "b": np.append(docs[b], rest)}
    del found
    give_back()
    return pa.table(pairs)


def nearest_of(most: int):
    return lambda table: nearest_earlier(table, WORD_DISTANCE, NEAR_DISTANCE, most, named=True)


def near_links(docs: DataFrame, pairs: DataFrame, size: int, percent: int) -> DataFrame:
    """The pairs (a, b) whose exact share of common shingles is ``percent`` or more."""

    def sets(batches):
        for batch in batches:
            for rows in slices(pa.table(batch)):
                found = [shingle_set(hashed(shingled(t, size))).view(np.int64) for t in rows.column("text").to_pylist()]
                yield pa.record_batch({"doc_id": rows.column("doc_id").combine_chunks(), "members": pa.array(found, pa.list_(pa.int64()))})

    asked = cut_lineage(pairs.select(F.col("a").alias("doc_id")).union(pairs.select("b")).distinct(), "near-ids")
    members = docs.join(asked, "doc_id", "left_semi").mapInArrow(sets, "doc_id long, members array<long>")
    members = cut_lineage(members.dropDuplicates(["doc_id"]), "near-members")
    both = pairs.join(members.select(F.col("doc_id").alias("a"), F.col("members").alias("ma")), "a")
    both = both.join(members.select(F.col("doc_id").alias("b"), F.col("members").alias("mb")), "b")
    both = both.withColumn("common", F.size(F.array_intersect("ma", "mb")))
    close = both.where(F.col("common") * 100 >= (F.size("ma") + F.size("mb") - F.col("common")) * percent)
    return close.select("a", "b")


def simhash_near_dedup(docs: DataFrame, size: int = NEAR_SHINGLE, percent: int = NEAR_PERCENT) -> DataFrame:
    """(doc_id, component_id) of every document: near copies share ``percent`` of their shingles.

    Fingerprints of shingles of ``size`` words lie too far apart for near copies to be searched by
    them, those of single words lie close. So WORD_MIXES vantage-point trees stand on fingerprints of
    words, each by another hash of them. Two documents are candidates if one of these differs in
    WORD_DISTANCE bits at most and that of their shingles in NEAR_DISTANCE, and are linked if the exact
    share of common shingles is ``percent`` or more; no link of candidates is lost.

    A document asks for its NEAREST earlier candidates first. Those with more ask on, behind the last one
    asked, for candidates that are not in their component yet, round by round until nobody has one left.
    So every link is right, and a group of near copies is not paired out. A pair that a later round may
    ask for was a pair of the round before, so only documents of such pairs go on to the next round.

    Equal shingle sets are merged first. ``component_id`` is the smallest doc_id that chains of links
    reach. Texts without words are equal; rows that share a doc_id are one node; a null doc_id comes
    back as null and counts as the largest id; other columns are ignored; an empty table gives none.
    """
    docs = columns_of(docs, "doc_id", "text").select(
        F.coalesce(F.col("doc_id").cast("long"), F.lit(NULL_ID)).alias("doc_id"), F.col("text").cast("string").alias("text")
    )
    marked = cut_lineage(marks(docs, size), "marks")
    points = cut_lineage(
        marked.groupBy("key").agg(F.min("doc_id").alias("first"), F.min_by("words", "doc_id").alias("words"), F.min_by("fine", "doc_id").alias("fine")),
        "points",
    )
    trees = [fitted(points.select(F.col("words")[k].alias("f")), WORD_DISTANCE, NEAR_LEAF) for k in range(WORD_MIXES)]
    asking, extra, most, links = points, (), NEAREST, same_ids(marked, points, "key")
    while True:
        found, search = None, nearest_of(most)
        for k, tree in enumerate(trees):
            dealt = dealt_points(asking.select(F.col("words")[k].alias("f"), "fine", "first", *extra), tree, WORD_DISTANCE)
            near = dealt.groupBy("shard").applyInArrow(search, "a long, bits long, b long")
            found = near if found is None else found.unionByName(near)
        # The closest of all shards are the closest of all: each shard gave as many as are taken.
        pair = F.when(F.col("bits") != NO_PAIR, F.struct("bits", "b"))
        closest = F.slice(F.array_sort(F.collect_set(pair)), 1, most)
        near = cut_lineage(found.groupBy("a").agg(closest.alias("near")), "near-pairs")
        pairs = near.select("a", F.explode("near").alias("x")).select("a", "x.b")
        links = cut_lineage(links.unionByName(near_links(docs, pairs, size, percent)), "near-links")
        reached = components(links)
        if near.where(F.size("near") == most).isEmpty():
            break
        labels = reached.select(F.col("node").alias("a"), "component")
        last = near.select("a", F.get("near", F.lit(most - 1)).alias("x"))
        asking = last.join(points, last["a"] == points["first"]).join(labels, "a", "left")
        asking = cut_lineage(
            asking.select(
                "first",
                "words",
                "fine",
                F.coalesce("component", "first").alias("label"),
                F.coalesce("x.bits", F.lit(ASKS_NOT)).cast("long").alias("bits"),
                F.coalesce("x.b", F.lit(0)).cast("long").alias("past"),
            ),
            "near-asking",
        )
        extra, most = ("label", "bits", "past"), min(4 * most, NEAREST_LATER)
    named = points.join(reached, points["first"] == reached["node"], "left").select("key", F.coalesce("component", "first").alias("component_id"))
    none = F.lit(NULL_ID)
    return marked.join(named, "key").select(F.nullif("doc_id", none).alias("doc_id"), F.nullif("component_id", none).alias("component_id"))


def hex_fingerprint(f):
    return F.lpad(F.lower(F.hex(f)), 16, "0")
