"""Line dedup by a segment-partition edit join."""

from __future__ import annotations

from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from corpusforge.llm import repeats
from corpusforge.llm.batches import BASE, Hashes, char_symbols, heads, mixed, runs_of

MAX_EDITS = 2
MIN_CHARS = 24
FILTER_BINS = (7, 32)
PAIR_BLOCK = 1 << 17
NEWLINE = 10


def read_chars(rows: pa.Table) -> repeats.Units:
    """Code points, with hashes of every substring."""
    texts = [t or "" for t in rows.column("text").to_pylist()]
    values = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), "<u4")
    bounds = np.concatenate(([0], np.cumsum([len(t) for t in texts], dtype=np.int64)))
    return repeats.Units(values, Hashes(char_symbols(values)), bounds)


def lines_of(units: repeats.Units) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(document, start, end) of the lines that are not empty."""
    breaks = np.flatnonzero(units.values == NEWLINE)
    starts = np.unique(np.concatenate((units.bounds[:-1], breaks + 1)))
    starts = starts[starts < len(units.values)]
    own = np.searchsorted(units.bounds, starts, "right") - 1
    breaks = np.append(breaks, len(units.values))
    ends = np.minimum(units.bounds[own + 1], breaks[np.searchsorted(breaks, starts)])
    some = ends > starts
    return own[some], starts[some], ends[some]


def segment(length: np.ndarray, number: int, parts: int) -> tuple[np.ndarray, np.ndarray]:
    """(offset, size) of a segment: the first ones are the shorter ones."""
    size, longer = length // parts, length % parts
    before = np.maximum(0, number - (parts - longer))
    return number * size + before, size + (number >= parts - longer)


def probes(hashes: Hashes, starts: np.ndarray, ends: np.ndarray, edits: int):
    """(line, key, own): the line's own segments and the substrings that may equal another line's.

    A line within ``edits`` edits and not longer keeps one of its ``edits`` + 1 segments whole. For
    each such length and segment only starts are probed that leave few enough edits on both sides.
    """
    parts, length = edits + 1, ends - starts
    rows, keys, own = [], [], []
    for shorter in range(edits + 1):
        other = length - shorter
        for number in range(parts):
            offset, size = segment(other, number, parts)
            # Edits on the left are at most ``number``, on the right at most ``parts - 1 - number``.
            low = max(-number, shorter - (parts - 1 - number))
            high = min(number, shorter + (parts - 1 - number))
            for shift in range(low, high + 1):
                if abs(shift) + abs(shorter - shift) > edits:
                    continue
                at = offset + shift
                fits = np.flatnonzero((at >= 0) & (at + size <= length) & (size > 0))
                begin = starts[fits] + at[fits]
                key = hashes.of(begin, begin + size[fits])
                # Anchors are scrambled once more where they are dealt, so a sum tells keys apart here.
                key += (other[fits] * parts + number).astype(np.uint64) * np.uint64(BASE)
                rows.append(fits)
                keys.append(key)
                own.append(np.full(len(fits), shorter == shift == 0))
    return np.concatenate(rows), np.concatenate(keys), np.concatenate(own)


def line_anchors(units: repeats.Units, edits: int, least: int) -> tuple:
    """Probes of the lines that may have near copies; shorter lines meet by their whole text."""
    own, starts, ends = lines_of(units)
    whole = units.hashes.of(starts, ends)
    long = np.flatnonzero(ends - starts >= least)
    short = np.flatnonzero(ends - starts < least)
    line, key, _ = probes(units.hashes, starts[long], ends[long], edits)
    line, key = np.concatenate((long[line], short)), np.concatenate((key, mixed(whole[short] + np.uint64(1))))
    return key, whole[line], own[line], starts[line], ends[line]


def common(hashes: Hashes, a: np.ndarray, b: np.ndarray, most: np.ndarray, step: int) -> np.ndarray:
    """Length of the common part of each pair from ``a`` and ``b`` on (step 1) or before them (step -1)."""
    low, high = np.zeros(len(a), np.int64), most.copy()
    while (open_ := np.flatnonzero(low < high)).size:
        half = (low[open_] + high[open_] + 1) // 2
        x, y = a[open_], b[open_]
        if step > 0:
            same = hashes.of(x, x + half) == hashes.of(y, y + half)
        else:
            same = hashes.of(x - half, x) == hashes.of(y - half, y)
        low[open_[same]] = half[same]
        high[open_[~same]] = half[~same] - 1
    return low


def within(values: np.ndarray, a: np.ndarray, a_end: np.ndarray, b: np.ndarray, b_end: np.ndarray, edits: int, hashes: Hashes | None = None) -> np.ndarray:
    """Is the edit distance of each pair at most ``edits``? Banded and bit-parallel.

    Equal ends are cut off first, by hashes. Then a word per number of errors holds one bit per
    diagonal of the band; a step takes one character of the first text: equal characters keep a
    diagonal, a substitution keeps it with one error more, a deletion moves one diagonal down, an
    insertion one up. A pair without a diagonal left is done.
    """
    hashes = Hashes(char_symbols(values)) if hashes is None else hashes
    head = common(hashes, a, b, np.minimum(a_end - a, b_end - b), 1)
    a, b = a + head, b + head
    tail = common(hashes, a_end, b_end, np.minimum(a_end - a, b_end - b), -1)
    band = 2 * edits + 1
    n, m = a_end - tail - a, b_end - tail - b
    mask = np.int64((1 << band) - 1)
    state = [np.full(len(a), 1 << edits, np.int64)]
    for _ in range(edits):
        state.append((state[-1] | state[-1] << 1) & mask)
    active, step = np.flatnonzero(np.abs(n - m) <= edits), 0
    while (active := active[(n[active] > step) & (state[edits][active] != 0)]).size:
        mine = values[a[active] + step]
        start, left = b[active], m[active]
        equal = np.zeros(len(active), np.int64)
        for d in range(band):
            at = step + d - edits
            there = values[np.minimum(np.maximum(start + at, 0), len(values) - 1)]
            equal |= ((there == mine) & (at >= 0) & (at < left)).astype(np.int64) << d
        before = below = None
        for errors in range(edits + 1):
            old = state[errors][active]
            new = old & equal
            if before is not None:
                new |= before | before >> 1 | (below << 1 & mask)
            state[errors][active] = below = new
            before = old
        step += 1
    shift = m - n + edits
    ok = (shift >= 0) & (shift < band)
    good = np.zeros(len(a), bool)
    good[ok] = (state[edits][ok] >> shift[ok]) & 1
    return good


def letters(values: np.ndarray, edge: np.ndarray, bins: int) -> np.ndarray:
    """Counts of each text's characters in a few bins; one edit changes two counts by one at most."""
    row = np.repeat(np.arange(len(edge) - 1), np.diff(edge))
    flat = np.bincount(row * bins + values % bins, minlength=(len(edge) - 1) * bins)
    return flat.reshape(-1, bins).astype(np.int32)


def earlier_lines(values: np.ndarray, edge: np.ndarray, docs: np.ndarray, route: int, edits: int, routes: int):
    """(line, 0, length) of the lines within ``edits`` edits of an earlier line; ``docs`` are their places.

    Only keys of this route count: lines that share another key meet there too.
    Lines with an equal key are compared from the earliest on, if it is a segment of one of
    them, and a line is done with its first match, so that a large family of near copies costs about
    one comparison a line. Bounds by length and letter counts come first.
    """
    starts, ends = edge[:-1], edge[1:]
    hashes = Hashes(char_symbols(values))
    line, key, own = probes(hashes, starts, ends, edits)
    here = key % np.uint64(routes) == np.uint64(route)
    line, key, own = line[here], key[here], own[here]
    order = np.lexsort((~own, line, docs[line], key))
    line, key, own = line[order], key[order], own[order]
    once = heads(line, key)
    line, key, own = line[once], key[once], own[once]
    some = np.add.reduceat(own, np.flatnonzero(heads(key)), dtype=np.int64)[runs_of(heads(key))] > 0 if len(key) else own
    line, key, own = line[some], key[some], own[some]
    first = heads(key)
    head = np.flatnonzero(first)
    run = runs_of(first)
    place = np.arange(len(line)) - head[run]
    counts, length = [letters(values, edge, bins) for bins in FILTER_BINS], ends - starts
    found = np.zeros(len(docs), bool)
    turn = 0
    waiting = np.flatnonzero(place > 0)
    while len(waiting):
        # The turn-th line of each key's run against all later ones that still wait.
        waiting = waiting[(place[waiting] > turn) & ~found[line[waiting]]]
        for at in range(0, len(waiting), PAIR_BLOCK):
            mine = waiting[at : at + PAIR_BLOCK]
            other = head[run[mine]] + turn
            near = own[mine] | own[other]
            mine, other = line[mine[near]], line[other[near]]
            near = (docs[other] < docs[mine]) & (np.abs(length[other] - length[mine]) <= edits)
            mine, other = mine[near], other[near]
            for bins in counts:
                near = np.abs(bins[mine] - bins[other]).sum(axis=1) <= 2 * edits
                mine, other = mine[near], other[near]
            same = within(values, starts[mine], ends[mine], starts[other], ends[other], edits, hashes)
            found[mine[same]] = True
        turn += 1
    at = np.flatnonzero(found)
    return at, np.zeros(len(at), np.int64), length[at]


SCHEMA = "doc_id long, n_lines long, n_removed long, kept string"


def cut(rows: pa.Table, units: repeats.Units, mask: np.ndarray) -> pa.Table:
    n_lines, n_removed, kept = [], [], []
    for text, base in zip(rows.column("text").to_pylist(), units.bounds):
        text, stay, at, seen = text or "", [], int(base), set()
        lines = text.split("\n") if text else []
        for line in lines:
            if not line:
                stay.append(line)
            elif not mask[at] and line not in seen:
                seen.add(line)
                stay.append(line)
            at += len(line) + 1
        n_lines.append(len(lines))
        n_removed.append(len(lines) - len(stay))
        kept.append("\n".join(stay))
    return pa.table(
        {
            "doc_id": rows.column("doc_id"),
            "n_lines": pa.array(n_lines, pa.int64()),
            "n_removed": pa.array(n_removed, pa.int64()),
            "kept": pa.array(kept, pa.string()),
        }
    )


def line_dedup(
    docs: DataFrame, edits: int = MAX_EDITS, least: int = MIN_CHARS, carry: tuple[str, ...] = ()
) -> DataFrame:
    """Remove every line that stands earlier, in a document with a smaller id or further up, within ``edits`` edits.

    Takes (doc_id, text) and ignores other columns; returns (doc_id, n_lines, n_removed, kept) and the
    columns named in ``carry``. Lines end at \\n; edits are insertions, deletions and substitutions of
    characters. Lines under ``least`` characters go only if the very same line stands earlier: two
    edits make another line of a short one. Empty lines always stay. Lines are judged on the input,
    so a chain of near copies keeps its first line only. Null texts count as empty and stay empty;
    rows that share a doc_id are one document against others; an empty table gives no rows.
    """

    def setup(groups: int) -> repeats.Setup:
        routes = max(1, groups // 2)
        return repeats.Setup(
            read_chars,
            partial(line_anchors, edits=edits, least=least),
            partial(earlier_lines, edits=edits, routes=routes),
            "<u4",
            routes,
            within=True,
            tidy=True,
        )

    return repeats.remove_repeats(docs, setup, cut, SCHEMA, carry, finer=2)
