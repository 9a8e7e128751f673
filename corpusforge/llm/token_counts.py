"""Exact token counts at every prefix, without encoding."""

from __future__ import annotations

from bisect import bisect_right
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from corpusforge.llm import bpe_tables
from corpusforge.llm.batches import columns_of, slices


class Counter:
    def __init__(self, vocabulary: str):
        self.tables = bpe_tables.tables(vocabulary)
        self.piece = bpe_tables.Memo(lambda piece: self.word_counts(self.tables.spell(piece))[-1])
        self.chunk = bpe_tables.Memo(self._chunk)

    def word_counts(self, word: str) -> list[int]:
        """Tokens of word[:i] taken as a whole word, for i from 0 on.

        ``inside`` counts the tokens of the prefix as the begin of a longer word; a token with the
        word's end that may follow such a prefix closes it.
        """
        beside, n = self.tables.beside, len(word)
        last, inside, closed = [-1] * (n + 1), [0] * (n + 1), [0] * (n + 1)
        for at, (size, token, end) in self.tables.matches.iter(word):
            i = at + 1
            before = last[i - size]
            if token >= 0 and last[i] < 0 and (i == size or (before >= 0 and beside[before << 20 | token])):
                last[i], inside[i] = token, inside[i - size] + 1
            if end >= 0 and not closed[i] and (i == size or (before >= 0 and beside[before << 20 | end])):
                closed[i] = inside[i - size] + 1
        return closed

    def _chunk(self, chunk: str) -> int:
        return sum(self.piece[p] if special is None else 1 for p, special in self.tables.parts(chunk))

    def count(self, text: str | None) -> int:
        return sum(map(self.chunk.__getitem__, bpe_tables.chunks(text))) if text else 0

    def prefix_counts(self, text: str) -> list[int]:
        """Tokens up to the end of each part between white space."""
        return list(accumulate(map(self.chunk.__getitem__, bpe_tables.chunks(text))))

    def fitting(self, text: str | None, budget: int) -> int:
        """Characters of the longest prefix within the budget that ends at a word or inside one.

        Inside a word it ends after a letter or symbol of a piece; numbers, contractions and special
        tokens are not cut, nor are parts whose normal form has another length.
        """
        text = text or ""
        counts = self.prefix_counts(text)
        whole = bisect_right(counts, budget)
        if whole == len(counts):
            return len(text)
        spans = list(_spans(text, whole + 1))
        at = spans[whole - 1][1] if whole else 0
        left = budget - (counts[whole - 1] if whole else 0)
        begin, end = spans[whole]
        chunk = text[begin:end]
        if "<|" in chunk or len(bpe_tables.normalised(chunk)) != len(chunk) or "'" in chunk:
            return at
        for piece, _ in self.tables.parts(chunk):
            closed = self.word_counts(self.tables.spell(piece))
            if closed[-1] > left:
                size = 0
                for i, letter in enumerate(piece, 1):
                    size += len(letter.encode())
                    if closed[size] <= left:
                        at = begin + i
                return at
            begin, left = begin + len(piece), left - closed[-1]
            at = begin
        return at


def _spans(text: str, most: int):
    for number, found in enumerate(bpe_tables.SPACES.finditer(text)):
        if number == most:
            return
        yield found.span()


_counters: dict[int, Counter] = {}


def counter(vocabulary: str) -> Counter:
    key = hash(vocabulary)
    if key not in _counters:
        _counters.clear()
        _counters[key] = Counter(vocabulary)
    return _counters[key]


def count_tokens(docs: DataFrame, path: str, budget: int) -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit, fitting_chars) of every document.

    ``over_limit`` says that the text has more than ``budget`` tokens, ``fitting_chars`` how many of
    its characters fit (all, if it is not over). Null and empty texts have 0 tokens and 0 bytes; rows
    and repeated rows keep their doc_id (null too); other columns are ignored.
    """
    words = bpe_tables.shipped(docs, path)

    def run(batches):
        tool = counter(words.value)
        for batch in batches:
            for rows in slices(pa.table(batch)):
                texts = rows.column("text").to_pylist()
                counts = [tool.count(text) for text in texts]
                fits = [len(t or "") if n <= budget else tool.fitting(t, budget) for t, n in zip(texts, counts)]
                yield pa.record_batch(
                    {
                        "doc_id": rows.column("doc_id").combine_chunks(),
                        "n_bytes": pa.array([len((t or "").encode()) for t in texts], pa.int64()),
                        "n_tokens": pa.array(counts, pa.int64()),
                        "over_limit": pa.array([n > budget for n in counts], pa.bool_()),
                        "fitting_chars": pa.array(fits, pa.int64()),
                    }
                )

    rows = columns_of(docs, "doc_id", "text").select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id long, n_bytes long, n_tokens long, over_limit boolean, fitting_chars long")
