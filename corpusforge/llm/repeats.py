"""Parts of one document that also stand in a document with a smaller id.

The dedup operators on repeated bytes, words and lines stand on these steps; they differ in their
symbols, in how anchors are chosen and in how contexts are compared. In terms of windows:

1. Documents are dealt into groups of a few MB. A group winnows its documents: every window of
   ``window`` symbols holds at least one anchor, a ``k``-gram chosen by the window's content alone.
   An anchor's context is everything that windows with this anchor can reach.
2. A group asks once for each distinct (anchor, context) it holds, with its smallest document:
   copies inside a group never leave it, so a passage in a third of all documents costs one row
   per group, not one per document.
3. Questions meet by anchor hash. An equal context in a smaller document settles every window
   around the anchor. Where an anchor has several contexts, only the smallest document of each
   context is compared further; an anchor with very many contexts is dealt out window by window.
4. Those contexts are sent as text and compared, and the matched windows go back to the groups.
5. Groups cut their documents.

The exchange of texts by group is used three times and written once. Nothing is broadcast. A null
doc_id counts as the largest one and comes back as null.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import StructType

from corpusforge.llm.batches import (
    Hashes,
    give_back,
    group_count,
    group_of,
    heads,
    mixed,
    packed,
    runs_of,
    slices,
    unpacked,
    winnowed,
)

ANCHOR_BYTES = CONTEXT_BYTES = 5
HOT_CONTEXTS = 512
"""An anchor with more contexts than this is compared window by window, spread over all tasks."""

NOTHING, SETTLED, COMPARE, COMPARE_HOT = 0, 1, 2, 3


@dataclass(frozen=True)
class Units:
    """The symbols of a slice of documents."""

    values: np.ndarray  # bytes, or one 64-bit hash per word
    hashes: Hashes
    bounds: np.ndarray  # first symbol of each document, and the end


@dataclass(frozen=True)
class Setup:
    read: Callable[[pa.Table], Units]
    anchors: Callable[[Units], tuple]  # (anchor hash, context hash, document, start, end) of each anchor
    earlier: Callable  # finds the parts of a route's contexts that stand in a smaller document
    dtype: str  # of ``values``
    buckets: int
    window: int = 0  # length of the windows that contexts of hot anchors are cut into; 0: never
    within: bool = False  # parts that stand earlier in the same document count too
    tidy: bool = False  # after a group all unused memory goes back, not Arrow's alone


def window_anchors(units: Units, window: int, k: int) -> tuple:
    """Winnowed anchors with everything that a window around them can reach."""
    at = winnowed(units.hashes, units.bounds, window, k)
    own = np.searchsorted(units.bounds, at, "right") - 1
    start = np.maximum(units.bounds[own], at - (window - k))
    end = np.minimum(units.bounds[own + 1], at + window)
    context = mixed(units.hashes.of(start, end) + (at - start).astype(np.uint64))
    return units.hashes.of(at, at + k), context, own, start, end


@dataclass(frozen=True)
class Anchors:
    """Anchors of a group, in the order of its questions."""

    bucket: np.ndarray
    anchor: np.ndarray
    context: np.ndarray
    doc: np.ndarray  # doc_id
    piece: np.ndarray  # slice, and the reach of the context inside it
    start: np.ndarray
    end: np.ndarray
    question: np.ndarray  # number of the distinct (anchor, context)
    asked: np.ndarray  # index of each question's first anchor, which has the smallest doc


def by_document(table: pa.Table) -> pa.Table:
    return table.sort_by("doc_id")


def anchors_of(table: pa.Table, setup: Setup) -> tuple[Anchors, list[tuple[np.ndarray, Units]]]:
    parts, pieces = [], []
    for piece in slices(table):
        units = setup.read(piece)
        docs = piece.column("doc_id").to_numpy()
        anchor, context, own, start, end = setup.anchors(units)
        parts.append((anchor, context, docs[own], np.full(len(own), len(pieces)), start, end))
        pieces.append((docs, units))
    anchor, context, doc, piece, start, end = (np.concatenate(x) for x in zip(*parts))
    bucket = (anchor % np.uint64(setup.buckets)).astype(np.int64)
    anchor = mixed(anchor) >> np.uint64(64 - 8 * ANCHOR_BYTES)
    # Rows stand by document and buckets are few, so two stable keys give all four.
    order = np.lexsort((context, bucket.astype(np.uint64) << np.uint64(8 * ANCHOR_BYTES) | anchor))
    columns = [x[order] for x in (bucket, anchor, context, doc, piece, start, end)]
    first = heads(*columns[:3])
    return Anchors(*columns, runs_of(first), np.flatnonzero(first)), pieces


def questions(table: pa.Table, setup: Setup) -> pa.Table:
    table = by_document(table)
    found, _ = anchors_of(table, setup)
    bucket, anchor, context, doc = (
        x[found.asked] for x in (found.bucket, found.anchor, found.context, found.doc)
    )
    edges = np.append(np.flatnonzero(heads(bucket)), len(bucket))
    group = table.column("g")[0].as_py()
    spans = list(zip(edges[:-1], edges[1:]))
    return pa.table(
        {
            "g": pa.array([group] * len(spans), pa.int32()),
            "bucket": pa.array([int(bucket[a]) for a, _ in spans], pa.int32()),
            "anchors": pa.array([packed(anchor[a:b], ANCHOR_BYTES) for a, b in spans], pa.binary()),
            "contexts": pa.array([packed(context[a:b], CONTEXT_BYTES) for a, b in spans], pa.binary()),
            "docs": pa.array([packed(doc[a:b]) for a, b in spans], pa.binary()),
        }
    )


def answers(table: pa.Table, hot: int, within: bool) -> pa.Table:
    """What each group has to know about each of its questions, one byte per question."""
    groups = table.column("g").to_pylist()
    blobs = [table.column(name).to_pylist() for name in ("anchors", "contexts", "docs")]
    anchors = [unpacked(x, ANCHOR_BYTES) for x in blobs[0]]
    asker = np.repeat(np.arange(len(groups)), [len(x) for x in anchors])
    anchor = np.concatenate(anchors)
    context = np.concatenate([unpacked(x, CONTEXT_BYTES) for x in blobs[1]])
    doc = np.concatenate([unpacked(x).astype(np.int64) for x in blobs[2]])
    order = np.lexsort((doc, context, anchor))
    anchor, context, doc = anchor[order], context[order], doc[order]
    same = heads(anchor, context)
    head = np.flatnonzero(same)
    least = doc[head][runs_of(same)]
    codes = np.where(doc > least, SETTLED, NOTHING).astype(np.uint8)
    # An anchor is compared further where its contexts have different smallest documents, or are several.
    outer = heads(anchor[head])
    edge = np.flatnonzero(outer)
    count = np.diff(np.append(edge, len(head)))
    lowest, highest = np.minimum.reduceat(doc[head], edge), np.maximum.reduceat(doc[head], edge)
    alone = count == 1 if within else lowest == highest
    further = np.where(alone, NOTHING, np.where(count > hot, COMPARE_HOT, COMPARE))
    codes[head] = further[runs_of(outer)].astype(np.uint8)
    placed = np.empty_like(codes)
    placed[order] = codes
    ends = np.cumsum([0] + [int(x) for x in np.bincount(asker, minlength=len(groups))])
    return pa.table(
        {
            "g": pa.array(groups, pa.int32()),
            "bucket": table.column("bucket"),
            "codes": pa.array([placed[a:b].tobytes() for a, b in zip(ends[:-1], ends[1:])], pa.binary()),
        }
    )


def codes_of(table: pa.Table) -> np.ndarray:
    """The answers in the order of the group's questions."""
    kept = table.filter(pa.compute.is_valid(table.column("codes")))
    blobs = sorted(zip(kept.column("bucket").to_pylist(), kept.column("codes").to_pylist()))
    return np.frombuffer(b"".join(blob for _, blob in blobs), np.uint8)


CONTEXTS = "route int, g int, docs binary, starts binary, sizes binary, content binary"


def contexts(table: pa.Table, replies: pa.Table, setup: Setup) -> pa.Table:
    """The contexts of this group that have to be compared, dealt by anchor or by window."""
    out = {name: [] for name in ("route", "g", "docs", "starts", "sizes", "content")}
    if len(table):
        table = by_document(table)
        found, pieces = anchors_of(table, setup)
        code = codes_of(replies)
        lead = found.doc == found.doc[found.asked][found.question]
        rows = [np.zeros(0, np.int64)] * 5
        route, piece, doc, start, end = rows
        for which in (COMPARE, COMPARE_HOT):
            at = np.flatnonzero(lead & (code[found.question] == which)) if len(code) else np.zeros(0, int)
            many = found.end[at] - found.start[at] - setup.window + 1 if which == COMPARE_HOT else np.ones(len(at), int)
            row = np.repeat(at, many)
            s = found.start[row] + np.arange(len(row)) - np.repeat(np.cumsum(many) - many, many)
            e = s + setup.window if which == COMPARE_HOT else found.end[row]
            if which == COMPARE_HOT:
                hashed = np.zeros(len(row), np.uint64)
                for p, (_, units) in enumerate(pieces):
                    own = found.piece[row] == p
                    hashed[own] = units.hashes.of(s[own], e[own])
                r = (hashed % np.uint64(setup.buckets)).astype(np.int64)
            else:
                r = found.bucket[row]
            route, piece, doc, start, end = (
                np.concatenate(x)
                for x in ((route, r), (piece, found.piece[row]), (doc, found.doc[row]), (start, s), (end, e))
            )
        order = np.lexsort((start, doc, piece, route))
        route, piece, doc, start, end = (x[order] for x in (route, piece, doc, start, end))
        # A window or context that several anchors ask for is sent once to a route.
        first = heads(route, doc, piece, start, end) if len(route) else np.zeros(0, bool)
        route, piece, doc, start, end = (x[first] for x in (route, piece, doc, start, end))
        edges = np.append(np.flatnonzero(heads(route, piece)), len(route)) if len(route) else [0]
        for a, b in zip(edges[:-1], edges[1:]):
            _, units = pieces[piece[a]]
            size = end[a:b] - start[a:b]
            index = np.repeat(start[a:b] - (np.cumsum(size) - size), size) + np.arange(size.sum())
            base = units.bounds[np.searchsorted(units.bounds, start[a:b], "right") - 1]
            out["route"].append(int(route[a]))
            out["g"].append(table.column("g")[0].as_py())
            out["docs"].append(packed(doc[a:b]))
            out["starts"].append(packed(start[a:b] - base))
            out["sizes"].append(packed(size, 4))
            out["content"].append(units.values[index].astype(setup.dtype).tobytes())
    types = {"route": pa.int32(), "g": pa.int32()}
    return pa.table({name: pa.array(x, types.get(name, pa.binary())) for name, x in out.items()})


SPANS = "g int, docs binary, starts binary, ends binary"


def matched(table: pa.Table, setup: Setup) -> pa.Table:
    """Spans of the contexts of a route that stand in a smaller document."""
    parts = []
    for i, (g, docs, starts, sizes) in enumerate(
        zip(*(table.column(name).to_pylist() for name in ("g", "docs", "starts", "sizes")))
    ):
        doc = unpacked(docs).astype(np.int64)
        parts.append((np.full(len(doc), g), doc, unpacked(starts).astype(np.int64), unpacked(sizes, 4).astype(np.int64)))
    group, doc, start, size = (np.concatenate(x) for x in zip(*parts))
    values = np.frombuffer(b"".join(table.column("content").to_pylist()), setup.dtype)
    edge = np.concatenate(([0], np.cumsum(size)))
    if setup.within:  # places in order of document and start instead of documents
        place = np.empty(len(doc), np.int64)
        place[np.lexsort((start, doc))] = np.arange(len(doc))
    row, offset, length = setup.earlier(values, edge, place if setup.within else doc, table.column("route")[0].as_py())
    g, d, s = group[row], doc[row], start[row] + offset
    e = s + length
    order = np.lexsort((e, s, d, g))
    g, d, s, e = g[order], d[order], s[order], e[order]
    fresh = heads(g, d)
    fresh[1:] |= s[1:] > e[:-1]
    first = np.flatnonzero(fresh)
    last = np.append(first[1:], len(s)) - 1 if len(s) else first
    g, d, e, s = g[first], d[first], e[last], s[first]
    edges = np.append(np.flatnonzero(heads(g)), len(g)) if len(g) else [0]
    spans = list(zip(edges[:-1], edges[1:]))
    return pa.table(
        {
            "g": pa.array([int(g[a]) for a, _ in spans], pa.int32()),
            "docs": pa.array([packed(d[a:b]) for a, b in spans], pa.binary()),
            "starts": pa.array([packed(s[a:b]) for a, b in spans], pa.binary()),
            "ends": pa.array([packed(e[a:b]) for a, b in spans], pa.binary()),
        }
    )


def removed(table: pa.Table, replies: pa.Table, setup: Setup):
    """For each slice: (rows, units, mask of the symbols to remove)."""
    table = by_document(table)
    found, pieces = anchors_of(table, setup)
    code = codes_of(replies)
    gone = found.doc > found.doc[found.asked][found.question]
    if len(code):
        gone |= code[found.question] == SETTLED
    spans = replies.filter(pa.compute.is_valid(replies.column("docs")))
    doc, start, end = (
        np.concatenate([np.zeros(0, np.int64)] + [unpacked(x).astype(np.int64) for x in spans.column(name).to_pylist()])
        for name in ("docs", "starts", "ends")
    )
    for p, (piece, (docs, units)) in enumerate(zip(slices(table), pieces)):
        own = gone & (found.piece == p)
        change = np.zeros(len(units.values) + 1, np.int64)
        np.add.at(change, found.start[own], 1)
        np.add.at(change, found.end[own], -1)
        # A document's spans belong to all rows with its id, if an id is given twice.
        by_doc = np.argsort(docs, kind="stable")
        left, right = (np.searchsorted(docs[by_doc], doc, side) for side in ("left", "right"))
        many = right - left
        row = by_doc[np.repeat(left - (np.cumsum(many) - many), many) + np.arange(many.sum())]
        base, top = units.bounds[row], units.bounds[row + 1]
        np.add.at(change, np.minimum(base + np.repeat(start, many), top), 1)
        np.add.at(change, np.minimum(base + np.repeat(end, many), top), -1)
        yield piece, units, np.cumsum(change[:-1]) > 0


def remove_repeats(
    docs: DataFrame, make_setup: Callable[[int], Setup], cut: Callable, schema: str, carry: tuple[str, ...] = (), finer: int = 1
) -> DataFrame:
    """Apply ``cut(rows, units, mask)`` to every document; see the module's text for the steps.

    Columns named in ``carry`` go through unchanged. ``finer`` divides the groups, for symbols that
    take more memory than bytes.
    """
    last = F.lit((1 << 63) - 1)
    carried = F.struct(*[docs[f"`{name}`"] for name in carry]) if carry else F.struct(F.lit(0))
    docs = docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"].cast("string").alias("text"), carried.alias("carried"))
    output = StructType.fromDDL(schema).add("carried", docs.schema["carried"].dataType)
    docs = docs.withColumn("doc_id", F.coalesce("doc_id", last))
    groups = group_count(docs) * finer
    setup = make_setup(groups)
    rows = docs.withColumn("g", group_of("doc_id", groups))
    # One plan for all three uses, so that Spark writes the exchange once.
    asked = rows.groupBy("g").applyInArrow(
        lambda table: questions(table, setup), "g int, bucket int, anchors binary, contexts binary, docs binary"
    )
    hot = HOT_CONTEXTS if setup.window else 1 << 62
    replies = asked.groupBy("bucket").applyInArrow(
        lambda table: answers(table, hot, setup.within), "g int, bucket int, codes binary"
    )
    compared = (
        rows.groupBy("g")
        .cogroup(replies.groupBy("g"))
        .applyInArrow(lambda table, codes: contexts(table, codes, setup), CONTEXTS)
        .groupBy("route")
        .applyInArrow(lambda table: matched(table, setup), SPANS)
    )
    none = F.lit(None).cast("binary")
    told = replies.select("g", "bucket", "codes", none.alias("docs"), none.alias("starts"), none.alias("ends")).unionByName(
        compared.select("g", F.lit(None).cast("int").alias("bucket"), none.alias("codes"), "docs", "starts", "ends")
    )

    def finish(table: pa.Table, told_rows: pa.Table) -> pa.Table:
        if not len(table):
            return cut(table, setup.read(table), np.zeros(0, bool)).append_column("carried", table.column("carried"))
        done = [cut(*x).append_column("carried", x[0].column("carried")) for x in removed(table, told_rows, setup)]
        give_back(setup.tidy)
        return pa.concat_tables(done)

    done = rows.groupBy("g").cogroup(told.groupBy("g")).applyInArrow(finish, output)
    kept = [F.col("carried").getField(name).alias(name) for name in carry]
    own = [name for name in done.columns if name not in ("carried", "doc_id")]
    return done.select(F.nullif(F.col("doc_id"), last).alias("doc_id"), *own, *kept)
