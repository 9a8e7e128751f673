"""Repeated word sequences by seed and extend: winnowed anchors joined and extended both ways."""

from __future__ import annotations

from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from corpusforge.llm import repeats
from corpusforge.llm.batches import Hashes, heads, runs_of, utf8, word_hashes, word_spans

WINDOW = 13
ANCHOR = 5


def read_words(rows: pa.Table) -> repeats.Units:
    data, offsets = utf8(rows.column("text"))
    starts, ends, own = word_spans(data, offsets)
    values = word_hashes(data, starts, ends)
    return repeats.Units(values, Hashes(values), np.searchsorted(own, np.arange(len(rows) + 1)))


def extended(values: np.ndarray, edge: np.ndarray, docs: np.ndarray, route: int, window: int):
    """(context, offset, length) of the windows around a seed that a smaller document holds as well.

    A seed extended by i words to the left and the rest to the right reaches the length threshold
    exactly if the window at that offset is shared. Equal windows stand together after sorting, the
    smallest document first, so each is compared with one row and never with all others. Joined
    neighbours are the maximal repeats.
    """
    many = np.diff(edge) - window + 1
    row = np.repeat(np.arange(len(many)), many)
    offset = np.arange(len(row)) - np.repeat(np.cumsum(many) - many, many)
    hashes = Hashes(values.astype(np.uint64))
    at = edge[row] + offset
    key = hashes.of(at, at + window)
    order = np.lexsort((docs[row], key))
    first = heads(key[order])
    head = np.flatnonzero(first)[runs_of(first)]
    later = docs[row][order] > docs[row][order][head]
    mine, other = at[order][later], at[order][head][later]
    same = np.ones(len(mine), bool)
    for step in range(window):  # word by word, beyond the hash of the whole window
        same &= values[mine + step] == values[other + step]
    found = order[later][same]
    return row[found], offset[found], window


SCHEMA = "doc_id long, n_words long, n_removed long, kept string"


def cut(rows: pa.Table, units: repeats.Units, mask: np.ndarray) -> pa.Table:
    data, offsets = utf8(rows.column("text"))
    starts, ends, own = word_spans(data, offsets)
    stays = ~mask
    start, size, doc = starts[stays], (ends - starts)[stays] + 1, own[stays]
    last = np.ones(len(doc), bool)
    last[:-1] = doc[1:] != doc[:-1]
    size -= last  # no blank after the last word
    out = np.cumsum(size) - size
    text = np.append(data, np.uint8(32))[np.repeat(start - out, size) + np.arange(size.sum())]
    text[(out + size - 1)[~last]] = 32
    where = np.concatenate(([0], np.cumsum(np.bincount(doc, size, len(rows)).astype(np.int64))))
    kept = pa.Array.from_buffers(
        pa.large_string(), len(rows), [None, pa.py_buffer(where.astype(np.int64)), pa.py_buffer(text.tobytes())]
    )
    n_words = np.diff(units.bounds)
    return pa.table(
        {
            "doc_id": rows.column("doc_id"),
            "n_words": pa.array(n_words, pa.int64()),
            "n_removed": pa.array(n_words - np.bincount(doc, minlength=len(rows)), pa.int64()),
            "kept": kept.cast(pa.string()),
        }
    )


def substring_dedup(docs: DataFrame, window: int = WINDOW, anchor: int = ANCHOR) -> DataFrame:
    """Cut every word covered by ``window`` words that also start in a smaller document.

    Takes (doc_id, text) and ignores other columns; returns (doc_id, n_words, n_removed, kept) with
    the kept words joined by one blank. Words are runs of characters other than blank and 09-0D,
    unchanged. Windows are judged on the input. Null texts have no words; texts under ``window``
    words stay whole; rows that share a doc_id are one document against others; an empty table gives
    no rows.
    """

    def setup(groups: int) -> repeats.Setup:
        return repeats.Setup(
            read_words,
            partial(repeats.window_anchors, window=window, k=anchor),
            partial(extended, window=window),
            "<u8",
            max(1, groups // 2),
            window,
        )

    return repeats.remove_repeats(docs, setup, cut, SCHEMA)
