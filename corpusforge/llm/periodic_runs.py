"""Periodic runs of words: a sparse dynamic program over the diagonals of a text against itself.

A diagonal is a lag; its match length at a word says how many words in a row equal the word that lag
before them. Keeping every earlier occurrence of every word active would be quadratic in a text of
few different words, so a lag is active only where it can still be the smallest period of a run:

- A run of smallest period q and at least 4 q words holds sequences of L words, q <= L < 2 q, and
  inside it such a sequence comes back after q words and never sooner (its period would be smaller).
- So for L = 1, 2, 4, .. an occurrence increments only the lag to the nearest earlier occurrence of
  the same L words, and only if L / 2 < lag <= L. At most one lag a length is active at a word.

A sequence of 2 L words can come back only where both halves do, so the longer lengths look at few
words of ordinary text. The lags that stay meet in document order in one pass: a lag that is not
incremented at a word ends there, and its run is emitted at once if it is long enough.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from corpusforge.llm.batches import BASE, Hashes, columns_of, heads, slices, utf8, word_hashes, word_spans

LEAST_WORDS = 6
LEAST_PERIODS = 4


def nearest_earlier(keys: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(lag to the nearest earlier place with the same key or 0, is the key there twice), by place."""
    order = np.argsort(keys, kind="stable")
    first = heads(keys[order])
    place = at[order]
    lag, twice = np.zeros(len(at), np.int64), np.zeros(len(at), bool)
    back = np.zeros(len(at), np.int64)
    back[1:] = place[1:] - place[:-1]
    lag[order] = np.where(first, 0, back)
    twice[order] = ~first | ~np.append(first[1:], True) if len(at) else first
    return lag, twice


def increments(symbols: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(last word, lag, length of the sequence that came back), by word and lag.

    ``symbols`` are 64-bit word hashes of several documents, ``bounds`` where each begins and the end.
    """
    hashes = Hashes(symbols)
    own = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    longest = int(np.diff(bounds).max()) if len(bounds) > 1 else 0
    at = np.arange(len(symbols))
    words, lags, lengths = [], [], []
    length = 1
    while len(at) and length // 2 < longest // LEAST_PERIODS:
        keys = hashes.of(at, at + length) + own[at].astype(np.uint64) * np.uint64(BASE)
        lag, twice = nearest_earlier(keys, at)
        fits = (lag > length // 2) & (lag <= length)
        words.append(at[fits] + length - 1)
        lags.append(lag[fits])
        lengths.append(np.full(int(fits.sum()), length))
        at = at[twice]
        whole = at + 2 * length <= bounds[own[at] + 1]
        second = np.searchsorted(at, at + length)
        second = at[np.minimum(second, len(at) - 1)] == at + length if len(at) else whole
        at = at[whole & second]
        length *= 2
    if not words:
        return (np.zeros(0, np.int64),) * 3
    word, lag, size = (np.concatenate(x) for x in (words, lags, lengths))
    order = np.lexsort((lag, word))
    return word[order], lag[order], size[order]


def emitted(word: np.ndarray, lag: np.ndarray, size: np.ndarray, owner: np.ndarray) -> Iterator[tuple[int, int, int]]:
    """(first word, number of words, period) of every run, each when its diagonal ends."""

    def ended(lag: int, matches: int, last: int):
        if matches + lag >= max(LEAST_WORDS, LEAST_PERIODS * lag):
            yield last - matches + 1 - lag, matches + lag, lag

    active: dict[int, int] = {}
    before, doc = -2, -1
    grown: dict[int, int] = {}
    for i, q, n, d in zip(word.tolist(), lag.tolist(), size.tolist(), owner.tolist()):
        if i != before:
            for other, matches in active.items():  # not incremented at the word before this one
                yield from ended(other, matches, before - 1)
            if i != before + 1 or d != doc:
                for other, matches in grown.items():
                    yield from ended(other, matches, before)
                grown = {}
            active, grown, before, doc = grown, {}, i, d
        grown[q] = active.pop(q, n - 1) + 1
    for last, diagonals in ((before - 1, active), (before, grown)):
        for other, matches in diagonals.items():
            yield from ended(other, matches, last)


def runs_in(data: np.ndarray, offsets: np.ndarray) -> tuple[list[list[tuple[int, int, int]]], np.ndarray]:
    """The runs of each text by start and period, word numbers from 0, and the words of each text."""
    starts, ends, text = word_spans(data, offsets)
    counts = np.bincount(text, minlength=len(offsets) - 1)
    bounds = np.concatenate(([0], np.cumsum(counts)))
    symbols = word_hashes(data, starts, ends)
    word, lag, size = increments(symbols, bounds)
    runs: list[list[tuple[int, int, int]]] = [[] for _ in counts]
    for start, length, period in emitted(word, lag, size, text[word]):
        own = int(text[start])
        runs[own].append((start - int(bounds[own]), length, period))
    for found in runs:
        found.sort(key=lambda run: (run[0], run[2]))
    return runs, counts


def collapsed(words: list[bytes], runs: list[tuple[int, int, int]]) -> str:
    """The words but those behind the first period of a run, joined by one blank."""
    if runs:
        gone = np.zeros(len(words), bool)
        for start, length, period in runs:
            gone[start + period : start + length] = True
        words = [word for word, drop in zip(words, gone.tolist()) if not drop]
    return b" ".join(words).decode()


RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
SCHEMA = "doc_id long, n_words long, runs array<struct<start: long, length: long, period: long>>, collapsed string"


def periodic_runs(docs: DataFrame) -> DataFrame:
    """(doc_id, n_words, runs, collapsed) of every document.

    Words are maximal runs of characters other than blank and 09-0D. A run is a stretch of words with
    smallest period q, of at least 6 and 4 q words, that no neighbouring word extends; ``runs`` holds
    (start, length, period) by start, then period, word numbers from 0. ``collapsed`` joins the words
    by one blank and leaves out those that a run contains after its first q words.

    Null, empty and blank texts have no words, no runs and an empty ``collapsed``; rows and repeated
    rows keep their doc_id (null too); other columns are ignored; an empty table gives no rows. Words
    and sequences of words are told apart by 64-bit hashes inside one document. A text of n words
    takes O(n log n) steps whatever it repeats, and no text is cut.
    """

    def run(batches):
        for batch in batches:
            for rows in slices(pa.table(batch)):
                data, offsets = utf8(rows.column("text"))
                runs, counts = runs_in(data, offsets)
                spans = zip(offsets[:-1].tolist(), offsets[1:].tolist(), runs)
                yield pa.record_batch(
                    {
                        "doc_id": rows.column("doc_id").combine_chunks(),
                        "n_words": pa.array(counts, pa.int64()),
                        "runs": pa.array(
                            [[dict(zip(("start", "length", "period"), r)) for r in found] for found in runs], pa.list_(RUN)
                        ),
                        "collapsed": pa.array([collapsed(data[a:b].tobytes().split(), found) for a, b, found in spans], pa.string()),
                    }
                )

    rows = columns_of(docs, "doc_id", "text").select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, SCHEMA)
