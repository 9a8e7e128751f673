"""Repeated byte strings by longest previous factors: later copies go, the first one stays."""

from __future__ import annotations

from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from corpusforge.llm import repeats
from corpusforge.llm.batches import byte_hashes, heads, runs_of, utf8

WINDOW = 50
ANCHOR = 20


def read_bytes(rows: pa.Table) -> repeats.Units:
    data, offsets = utf8(rows.column("text"))
    return repeats.Units(data, byte_hashes(data), offsets)


def suffix_order(values: np.ndarray, starts: np.ndarray, docs: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """(order, lcp) of the suffixes at ``starts``, compared on ``depth`` bytes and then by document.

    lcp[i] is the common prefix of suffixes i - 1 and i in that order, in bytes, ``depth`` at most.
    """
    words = -(-depth // 8)
    padded = np.concatenate((values, np.zeros(8 * words, np.uint8)))
    view = np.lib.stride_tricks.sliding_window_view(padded, depth)[starts]
    block = np.zeros((len(starts), 8 * words), np.uint8)
    block[:, :depth] = view
    keys = block.view(">u8").astype(np.uint64)
    order = np.lexsort((docs, *keys.T[::-1]))
    block = block[order]
    differs = block[1:] != block[:-1]
    lcp = np.where(differs.any(axis=1), differs.argmax(axis=1), depth)
    return order, np.concatenate(([0], np.minimum(lcp, depth)))


def smaller_before(docs: np.ndarray, lcp: np.ndarray) -> np.ndarray:
    """Common prefix of each suffix with the nearest one before it that has a smaller document, or 0.

    Every suffix looks at its predecessor and skips, with all others at once, to where a suffix of no
    smaller document looks; between the two stand none that are smaller. ``least`` keeps the smallest
    common prefix on the way.
    """
    n = len(docs)
    at, least = np.arange(n) - 1, lcp.copy()
    waiting = np.flatnonzero(at >= 0)
    while len(waiting):
        waiting = waiting[docs[at[waiting]] >= docs[waiting]]
        over = at[waiting]
        least[waiting], at[waiting] = np.minimum(least[waiting], least[over]), at[over]
        waiting = waiting[(at[waiting] >= 0) & (least[waiting] > 0)]
    return np.where((at >= 0) & (least > 0), least, 0)


def previous_factor(docs: np.ndarray, lcp: np.ndarray) -> np.ndarray:
    """Length of the longest factor that each suffix shares with a smaller document.

    The nearest suffixes of smaller documents before and after it in suffix order are the ones it
    shares most with; lcp[i] is the common prefix of suffixes i - 1 and i.
    """
    before = smaller_before(docs, lcp)
    after = smaller_before(docs[::-1], np.concatenate(([0], lcp[:0:-1])))[::-1] if len(docs) else before
    return np.maximum(before, after)


def earlier_windows(values: np.ndarray, edge: np.ndarray, docs: np.ndarray, route: int, window: int):
    """(context, offset, length) of the windows whose bytes also start in a smaller document."""
    many = np.diff(edge) - window + 1
    row = np.repeat(np.arange(len(many)), many)
    offset = np.arange(len(row)) - np.repeat(np.cumsum(many) - many, many)
    order, lcp = suffix_order(values, edge[row] + offset, docs[row], window)
    at = order[previous_factor(docs[row][order], lcp) >= window]
    return row[at], offset[at], window


SCHEMA = "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary"


def cut(rows: pa.Table, units: repeats.Units, mask: np.ndarray) -> pa.Table:
    data, bounds = units.values, units.bounds
    left, stay = data[~mask].tobytes(), np.concatenate(([0], np.cumsum(~mask)))[bounds]
    opens = mask.copy()
    opens[1:] &= ~mask[:-1]
    border = bounds[:-1][bounds[:-1] < len(mask)]
    opens[border] = mask[border]
    spans = np.concatenate(([0], np.cumsum(opens)))[bounds]
    counts = (np.diff(bounds), np.diff(bounds) - np.diff(stay), np.diff(spans))
    return pa.table(
        {
            "doc_id": rows.column("doc_id"),
            **{n: pa.array(x, pa.int64()) for n, x in zip(("n_bytes", "n_removed", "n_spans"), counts)},
            "kept": pa.array([left[a:b] for a, b in zip(stay[:-1], stay[1:])], pa.binary()),
        }
    )


def suffix_dedup(docs: DataFrame, window: int = WINDOW, anchor: int = ANCHOR) -> DataFrame:
    """Cut every byte covered by a ``window``-byte string that also starts in a smaller document.

    Takes (doc_id, text) and ignores other columns; returns (doc_id, n_bytes, n_removed, n_spans,
    kept), where ``kept`` holds the remaining bytes and may split a character. Strings are judged on
    the input. Null texts count as empty; texts under ``window`` bytes stay as they are; rows that
    share a doc_id are judged as one document against others; an empty table gives no rows.

    A suffix array is built per task over the contexts of repeated anchors, not over the corpus:
    see ``repeats`` for how every repeat reaches one.
    """

    def setup(groups: int) -> repeats.Setup:
        return repeats.Setup(
            read_bytes,
            partial(repeats.window_anchors, window=window, k=anchor),
            partial(earlier_windows, window=window),
            "<u1",
            max(1, groups // 2),
            window,
        )

    return repeats.remove_repeats(docs, setup, cut, SCHEMA)
