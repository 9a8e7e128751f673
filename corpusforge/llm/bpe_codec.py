"""BPE encoding and decoding by prefix dynamic programming."""

from __future__ import annotations

import struct

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from corpusforge.llm import bpe_tables
from corpusforge.llm.batches import columns_of, give_back, slices

MEMO_ENTRIES = 150_000


class Codec:
    def __init__(self, vocabulary: str):
        self.tables = bpe_tables.tables(vocabulary)
        self.chunk = bpe_tables.Memo(self._chunk, MEMO_ENTRIES)
        self.piece = bpe_tables.Memo(self._piece, MEMO_ENTRIES)
        names = np.empty(max(self.tables.tokens) + 1, object)
        names[:] = None
        for i, token in self.tables.tokens.items():
            names[i] = token
        self.names = names

    def _piece(self, piece: str) -> bytes:
        """The ids of a word, back from its end over the last token of every prefix."""
        word = self.tables.spell(piece)
        beside, n = self.tables.beside, len(word)
        last, begin = [-1] * (n + 1), [0] * (n + 1)
        for at, (size, inside, end) in self.tables.matches.iter(word):
            i = at + 1
            if last[i] >= 0:
                continue
            token = end if i == n else inside
            if token < 0:
                continue
            if i == size or (last[i - size] >= 0 and beside[last[i - size] << 20 | token]):
                last[i], begin[i] = token, i - size
        found = []
        while n:
            found.append(last[n])
            n = begin[n]
        return struct.pack(f"<{len(found)}I", *found[::-1])

    def _chunk(self, chunk: str) -> bytes:
        if chunk.isascii() and "<|" not in chunk:
            form = chunk.lower()
            if form.isalpha():  # remembered as a chunk already, unless its case differs
                return self._piece(form) if form == chunk else self.piece[form]
            return b"".join(map(self.piece.__getitem__, bpe_tables.ascii_pieces(form)))
        return b"".join(self.piece[piece] if special is None else struct.pack("<I", special) for piece, special in self.tables.parts(chunk))

    def forget(self) -> None:
        """Empty the memos: the worker goes on to other stages, and what it holds is memory they lack."""
        self.chunk.forget()
        self.piece.forget()
        give_back()

    def encode(self, text: str | None) -> bytes:
        return b"".join(map(self.chunk.__getitem__, bpe_tables.chunks(text))) if text else b""

    def decode(self, ids: bytes) -> str:
        """Token strings joined by blanks; ids outside the vocabulary are passed over."""
        numbers = np.frombuffer(ids, "<u4")
        if len(numbers) and numbers.max() >= len(self.names):
            numbers = numbers[numbers < len(self.names)]
        names = self.names[numbers].tolist()
        return " ".join(names if None not in names else [x for x in names if x is not None])


_codecs: dict[int, Codec] = {}


def codec(vocabulary: str) -> Codec:
    """One per Python worker and vocabulary, with its memos."""
    key = hash(vocabulary)
    if key not in _codecs:
        _codecs.clear()
        _codecs[key] = Codec(vocabulary)
    return _codecs[key]


def encode_decode(docs: DataFrame, path: str) -> DataFrame:
    """(doc_id, n_tokens, ids, decoded) of every document.

    ``ids`` holds unsigned 32-bit integers, little end first; ``decoded`` is made from them alone.
    Special tokens inside a text keep their ids; none are added. Null and empty texts give no ids
    and an empty string, whole texts of any length are encoded, rows and repeated rows keep their
    doc_id (null too), other columns are ignored.
    """
    words = bpe_tables.shipped(docs, path)

    def run(batches):
        tool = codec(words.value)
        for batch in batches:
            for rows in slices(pa.table(batch)):
                ids = [tool.encode(text) for text in rows.column("text").to_pylist()]
                yield pa.record_batch(
                    {
                        "doc_id": rows.column("doc_id").combine_chunks(),
                        "n_tokens": pa.array([len(x) // 4 for x in ids], pa.int64()),
                        "ids": pa.array(ids, pa.binary()),
                        "decoded": pa.array([tool.decode(x) for x in ids], pa.string()),
                    }
                )
        tool.forget()

    rows = columns_of(docs, "doc_id", "text").select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id long, n_tokens long, ids binary, decoded string")


def decode(rows: DataFrame, path: str, ids: str = "ids") -> DataFrame:
    """The rows with ``decoded`` added, from a binary column of ids; null ids give a null text."""
    words = bpe_tables.shipped(rows, path)

    @F.pandas_udf("string")
    def text(column):
        tool = codec(words.value)
        return column.map(lambda x: None if x is None else tool.decode(x))

    return rows.withColumn("decoded", text(rows[ids]))
