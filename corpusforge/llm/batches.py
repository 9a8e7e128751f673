"""Arrow text columns as numpy arrays: bytes, words, substring hashes and winnowed anchors."""

from __future__ import annotations

import contextlib
import ctypes
import functools
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F

GROUP_BYTES = 2 << 20
"""Text bytes of a document group: small enough for some dozen numpy arrays of that length."""

BASE = 0x9E3779B97F4A7C15 | 3
INVERSE = pow(BASE, -1, 1 << 64)


def columns_of(docs: DataFrame, *names: str) -> DataFrame:
    """Only the named columns, so that extra or clashing names of the input do no harm."""
    return docs.select(*[docs[f"`{name}`"] for name in names])


def give_back(all_of_it: bool = True) -> None:
    """Return memory that Arrow (and the C library) hold but do not use: workers go on to other stages."""
    pa.default_memory_pool().release_unused()
    if not all_of_it:
        return
    with contextlib.suppress(OSError, AttributeError):  # other C libraries have no such call
        ctypes.CDLL("libc.so.6").malloc_trim(0)


def text_bytes(docs: DataFrame, text: str = "text") -> int:
    return docs.agg(F.sum(F.octet_length(F.col(text)).cast("long"))).first()[0] or 0


def group_count(docs: DataFrame, text: str = "text", size: int = GROUP_BYTES) -> int:
    """How many groups of about ``size`` text bytes the documents make."""
    return max(1, math.ceil(text_bytes(docs, text) / size))


def group_of(key: str, groups: int) -> Column:
    return F.pmod(F.xxhash64(F.col(key)), F.lit(groups)).cast("int")


def array_of(column) -> pa.Array:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.chunk(0) if isinstance(column, pa.ChunkedArray) else column


def utf8(column) -> tuple[np.ndarray, np.ndarray]:
    """(bytes of all texts, offsets of each text); null is empty."""
    texts = pc.fill_null(array_of(column).cast(pa.large_string()), "")
    _, where, data = texts.buffers()
    if len(texts) == 0 or where is None:
        return np.zeros(0, np.uint8), np.zeros(len(texts) + 1, np.int64)
    offsets = np.frombuffer(where, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    raw = np.zeros(0, np.uint8) if data is None else np.frombuffer(data, np.uint8)
    return raw[offsets[0] : offsets[-1]], offsets - offsets[0]


def slices(table, text: str = "text", most: int = GROUP_BYTES) -> Iterator:
    """Row slices of at most ``most`` text bytes; a longer text is a slice of its own."""
    lengths = pc.fill_null(pc.binary_length(table.column(text)), 0).to_numpy(zero_copy_only=False)
    total = np.cumsum(lengths)
    begin = 0
    while begin < len(lengths):
        before = total[begin - 1] if begin else 0
        end = max(begin + 1, int(np.searchsorted(total, before + most, "right")))
        yield table.slice(begin, end - begin)
        begin = end


def lowered(data: np.ndarray) -> np.ndarray:
    """A-Z in lower case."""
    return np.where((data >= 65) & (data <= 90), data + 32, data).astype(np.uint8)


def word_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, text) of the maximal runs of bytes other than blank and 09-0D."""
    if len(data) == 0:
        none = np.zeros(0, np.int64)
        return none, none, none
    solid = ~((data == 32) | ((data >= 9) & (data <= 13)))
    border = np.zeros(len(data) + 1, bool)
    border[offsets] = True
    first = solid.copy()
    first[1:] &= ~solid[:-1] | border[1:-1]
    last = solid.copy()
    last[:-1] &= ~solid[1:] | border[1:-1]
    starts = np.flatnonzero(first)
    return starts, np.flatnonzero(last) + 1, np.searchsorted(offsets, starts, "right") - 1


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit values (the splitmix64 finaliser)."""
    y = x >> np.uint64(30)
    y ^= x
    y *= np.uint64(0xBF58476D1CE4E5B9)
    y ^= y >> np.uint64(27)
    y *= np.uint64(0x94D049BB133111EB)
    y ^= y >> np.uint64(31)
    return y


@functools.lru_cache(1)
def byte_codes() -> np.ndarray:
    return mixed(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD1342543DE82EF95))


_powers = {BASE: np.ones(1, np.uint64), INVERSE: np.ones(1, np.uint64)}


def powers(base: int, n: int) -> np.ndarray:
    if len(_powers[base]) < n:
        row = np.full(max(n, 2 * len(_powers[base])), base, np.uint64)
        row[0] = 1
        _powers[base] = np.multiply.accumulate(row)
    return _powers[base][:n]


class Hashes:
    """64-bit hashes of any substring of a sequence of 64-bit symbols, in constant time each."""

    def __init__(self, symbols: np.ndarray):
        self.n = len(symbols)
        self.sums = np.zeros(self.n + 1, np.uint64)
        np.cumsum(symbols * powers(BASE, self.n), out=self.sums[1:])
        self.inverse = powers(INVERSE, self.n + 1)

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mixed((self.sums[end] - self.sums[start]) * self.inverse[start] + (end - start).astype(np.uint64))

    def windows(self, k: int) -> np.ndarray:
        """The hashes of all ``k`` neighbours, in order: ``of`` without look-ups."""
        return mixed((self.sums[k:] - self.sums[:-k]) * self.inverse[: self.n - k + 1] + np.uint64(k))


@functools.lru_cache(1)
def char_codes() -> np.ndarray:
    """A scrambled value for each code point of the first plane."""
    return mixed(np.arange(1, (1 << 16) + 1, dtype=np.uint64))


def char_symbols(values: np.ndarray) -> np.ndarray:
    """A 64-bit symbol for each code point."""
    if not len(values) or values.max() < 1 << 16:
        return char_codes()[values]
    return mixed(values.astype(np.uint64) + np.uint64(1))


def byte_hashes(data: np.ndarray) -> Hashes:
    return Hashes(byte_codes()[data])


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    return byte_hashes(data).of(starts, ends)


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each ``width`` neighbours, by doubling."""
    size = 1
    while size * 2 <= width:
        values = np.minimum(values[:-size], values[size:])
        size *= 2
    rest = width - size
    return np.minimum(values[: len(values) - rest], values[rest:]) if rest else values


def winnowed(hashes: Hashes, bounds: np.ndarray, window: int, k: int) -> np.ndarray:
    """Anchor positions: the rightmost smallest k-gram of every window inside one document.

    The choice depends on the window's own symbols alone, so equal windows have equal anchors.
    """
    if hashes.n < window:
        return np.zeros(0, np.int64)
    at = np.arange(hashes.n - k + 1)
    low = np.uint64((1 << max(1, int(hashes.n).bit_length())) - 1)
    keys = (hashes.windows(k) & ~low) | (low - at.astype(np.uint64))
    least = sliding_min(keys, window - k + 1)
    inside = np.ones(len(least), bool)
    crossing = (bounds[1:-1, None] - np.arange(1, window)).ravel()
    inside[crossing[(crossing >= 0) & (crossing < len(inside))]] = False
    chosen = np.zeros(hashes.n, bool)
    chosen[(low - (least[inside] & low)).astype(np.int64)] = True
    return np.flatnonzero(chosen)


def packed(values: np.ndarray, width: int = 8) -> bytes:
    """Little-endian bytes plane by plane, so that constant high bytes compress away."""
    raw = np.ascontiguousarray(values.astype("<u8")).view(np.uint8).reshape(len(values), 8)
    return raw[:, :width].T.tobytes()


def unpacked(blob: bytes, width: int = 8) -> np.ndarray:
    planes = np.frombuffer(blob, np.uint8).reshape(width, -1)
    raw = np.zeros((planes.shape[1], 8), np.uint8)
    raw[:, :width] = planes.T
    return raw.view("<u8").ravel().astype(np.uint64)


def heads(*sorted_keys: np.ndarray) -> np.ndarray:
    """True where a run of equal keys begins."""
    n = len(sorted_keys[0])
    first = np.zeros(n, bool)
    if n:
        first[0] = True
    for key in sorted_keys:
        first[1:] |= key[1:] != key[:-1]
    return first


def runs_of(first: np.ndarray) -> np.ndarray:
    """The run number of each row."""
    return np.cumsum(first) - 1
