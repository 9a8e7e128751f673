"""Tokens of a byte-level BPE (A) and of a piece BPE with byte fallback (B) aligned by their bytes.

A text is cut at single blanks between two signs that are no white space. No token of either side
reaches over such a cut, so a long text is encoded in parts, and a part that comes back is encoded
once. What follows works on whole documents: ``merge_asof``, keyed by document, finds for each token
start the covering token of the other side; the union of both directions is every overlap once, and
offsets where tokens of both sides end cut the tokens into groups.

Steps over a corpus:

1. Documents are encoded and aligned; links (id of B, id of A) go into a table, four bytes each.
2. Links are counted corpus-wide: each task counts its own, Spark sums by id pair. The table of id
   pairs is bounded by the vocabularies, not by the corpus.
3. Each link meets its pair's count. Up to ``most_pairs`` id pairs are broadcast as sorted arrays.
   More are joined by shuffle: groups of documents ask once for each of their distinct pairs.
"""

from __future__ import annotations

import itertools
import json
import math
import os
import re
from pathlib import Path

import numpy as np
import pandas as pd
import pyarrow as pa
import public_tokenizers
import sentencepiece
import tiktoken
from pyspark.sql import DataFrame, functions as F
from tokenizers import Tokenizer

from corpusforge.llm.batches import array_of, slices
from corpusforge.llm.bpe_tables import COMMON, byte_letters
from corpusforge.operators.scoring import join_in_two
from corpusforge.session import cut_lineage

# Signs that no tokenizer takes for white space; U+2581 stands for a blank in B.
SOLID = r"[!-~\u00a1-\u167f\u2070-\u2580\u2582-\u2fff\u3001-\ud7ff]"
CUT = re.compile(f"(?<={SOLID}) (?={SOLID})")
BLANK_SIGN = "\u2581"

MEMO_PARTS = 300_000
MEMO_PART_CHARS = 64
COUNTED_AT_ONCE = 1 << 21
MOST_PAIRS = 8_000_000
"""Up to this many id pairs (12 bytes each) go to every worker."""
GROUP_LINK_BYTES = 16 << 20
FREQUENT = 400_000


class Side:
    """Ids of parts in one array, with the bytes of every id."""

    def __init__(self, spelled: list[bytes]):
        self.spelled = spelled
        self.sizes = np.array([len(x) for x in spelled], np.int64)
        names = [str(i) for i in range(len(spelled))]
        self.inner, self.bar, self.semicolon = (np.array([x + sign for x in names], object) for sign in ",|;")
        self.clear()

    def clear(self):
        self.ids, self.first = np.zeros(0, np.int32), np.zeros(1, np.int64)

    def keep(self, parts: np.ndarray):
        """Only the given parts, numbered anew."""
        ids, counts = self.gather(parts)
        self.ids, self.first = ids, np.concatenate(([0], np.cumsum(counts)))

    def add(self, encoded: list[list[int]], spelled: list[bytes]) -> np.ndarray:
        """Add the parts; is each spelled byte by byte by its ids?"""
        counts = np.fromiter(map(len, encoded), np.int64, len(encoded))
        flat = list(itertools.chain.from_iterable(encoded))
        new = np.array(flat, np.int32)
        self.ids = np.concatenate((self.ids, new))
        self.first = np.concatenate((self.first, self.first[-1] + np.cumsum(counts)))
        sizes = np.add.reduceat(np.append(self.sizes[new], 0), np.cumsum(counts) - counts) * (counts > 0)
        same = sizes == np.fromiter(map(len, spelled), np.int64, len(spelled))
        if same.all() and b"".join(map(self.spelled.__getitem__, flat)) == b"".join(spelled):
            return same
        return np.array([b"".join(map(self.spelled.__getitem__, ids)) == want for ids, want in zip(encoded, spelled)], bool)

    def gather(self, parts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids of the parts one after the other, number of ids of each part)."""
        counts = self.first[parts + 1] - self.first[parts]
        at = np.repeat(self.first[parts] - (np.cumsum(counts) - counts), counts) + np.arange(counts.sum())
        return self.ids[at], counts


class Aligner:
    def __init__(self, byte_bpe: str, piece_bpe: bytes):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.a_tool = Tokenizer.from_str(byte_bpe)
        self.a_tool.no_truncation()
        self.a_tool.no_padding()
        self.a_tool.encode_special_tokens = True
        # A token's rank is its id: tokens are numbered in the order of their merges.
        value = {letter: byte for byte, letter in enumerate(byte_letters())}
        model = json.loads(byte_bpe)["model"]
        made = [model["vocab"][a + b] for a, b in model["merges"]]
        if made != sorted(made):
            raise ValueError("ids of merged tokens are not in the order of the merges")
        ranks = {bytes(map(value.__getitem__, token)): i for token, i in model["vocab"].items()}
        self.ranks = tiktoken.Encoding("a", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.b_tool = sentencepiece.SentencePieceProcessor(model_proto=piece_bpe)
        size = self.a_tool.get_vocab_size()
        special = set(self.a_tool.get_added_tokens_decoder())
        a_names = [self.a_tool.id_to_token(i) or "" for i in range(size)]
        self.a = Side([b"" if i in special else bytes(map(value.__getitem__, x)) for i, x in enumerate(a_names)])
        tool, b_names = self.b_tool, []
        for i in range(tool.get_piece_size()):
            piece = tool.id_to_piece(i)
            b_names.append(bytes([int(piece[3:-1], 16)]) if tool.is_byte(i) else piece.replace(BLANK_SIGN, " ").encode())
        self.b = Side(b_names)
        self.known: dict[str, int] = {}
        self.same, self.uses = np.zeros(0, bool), np.zeros(0, np.int64)

    def forget(self):
        """Keep the parts that came more than once since the last time, if they are the fewer."""
        often = self.uses > 1
        if 2 * int(often.sum()) > len(self.known):
            often[:] = False
        kept = [(part, i) for part, i in self.known.items() if often[i]]
        old = np.array([i for _, i in kept], np.int64)
        self.known = {part: i for i, (part, _) in enumerate(kept)}
        self.same, self.uses = self.same[old], np.zeros(len(old), np.int64)
        self.a.keep(old)
        self.b.keep(old)

    def numbers(self, parts: list[str]) -> np.ndarray:
        """A number for each part; new parts are encoded by both sides."""
        if len(self.uses) > MEMO_PARTS or len(self.a.ids) > 8 * MEMO_PARTS:
            self.forget()
        known, size = self.known, len(self.uses)
        numbers = np.fromiter(map(known.get, parts, itertools.repeat(-1)), np.int64, len(parts))
        missed = np.flatnonzero(numbers < 0)
        new: dict[str, int] = {}
        if len(missed):
            numbers[missed] = [new.setdefault(parts[i], size + len(new)) for i in missed.tolist()]
            spaced = [" " + part for part in new]
            spelled = list(map(str.encode, spaced))
            b = self.b_tool.encode(list(new), num_threads=1)
            same = self.a.add(self.encode_a(spaced), spelled) & self.b.add(b, spelled)
            self.same = np.concatenate((self.same, same))
            # A long part is encoded again when it comes back.
            known.update((part, i) for part, i in new.items() if len(part) <= MEMO_PART_CHARS)
        uses = np.bincount(numbers, minlength=size + len(new))
        uses[:size] += self.uses
        self.uses = uses
        return numbers

    def encode_a(self, texts: list[str]) -> list[list[int]]:
        """Ids of A. Of texts in common letters by ranks, which is faster; else by the tokenizer file."""
        rare = [text for text in texts if not (text.isascii() or COMMON.fullmatch(text))]
        if not rare:
            return list(map(self.ranks.encode_ordinary, texts))
        found = dict(zip(rare, (x.ids for x in self.a_tool.encode_batch_fast(rare, add_special_tokens=False))))
        return [found[text] if text in found else self.ranks.encode_ordinary(text) for text in texts]

    def align(self, texts: list[str | None]) -> dict[str, list]:
        """The columns of ``SCHEMA`` but doc_id for a batch of texts."""
        parts, counts = [], []
        for text in texts:
            found = CUT.split(text) if text else []
            parts.extend(found)
            counts.append(len(found))
        number = self.numbers(parts)
        owner = np.repeat(np.arange(len(texts)), counts)
        broken = np.bincount(owner[~self.same[number]], minlength=len(texts)) > 0
        alive = ~broken[owner]
        number, owner = number[alive], owner[alive]
        a_ids, a_many = self.a.gather(number)
        b_ids, b_many = self.b.gather(number)
        a_doc, b_doc = np.repeat(owner, a_many), np.repeat(owner, b_many)
        # The texts left have equal bytes on both sides, so offsets of the batch serve both.
        a_end, b_end = np.cumsum(self.a.sizes[a_ids]), np.cumsum(self.b.sizes[b_ids])
        a_at, b_at = overlaps(a_end - self.a.sizes[a_ids], a_doc, b_end - self.b.sizes[b_ids], b_doc)
        links = (b_ids[b_at].astype(np.uint32) << np.uint32(16)) | a_ids[a_at].astype(np.uint32)
        # A group ends where tokens of both sides end.
        a_last, b_last = among(a_end, b_end), among(b_end, a_end)
        a_group, b_group = np.cumsum(a_last) - a_last, np.cumsum(b_last) - b_last
        groups = int(a_last.sum())
        a_before = np.concatenate(([0], np.cumsum(np.bincount(a_group, minlength=groups))))
        b_before = np.concatenate(([0], np.cumsum(np.bincount(b_group, minlength=groups))))
        written = np.empty(len(a_ids) + len(b_ids), object)
        written[np.arange(len(a_ids)) + b_before[a_group]] = np.where(a_last, self.a.bar[a_ids], self.a.inner[a_ids])
        written[np.arange(len(b_ids)) + a_before[b_group + 1]] = np.where(b_last, self.b.semicolon[b_ids], self.b.inner[b_ids])

        def each(doc: np.ndarray) -> np.ndarray:
            return np.bincount(doc, minlength=len(texts))

        n_a, n_b, n_links, n_groups = each(a_doc), each(b_doc), each(a_doc[a_at]), each(a_doc[a_last])
        signs, ends = np.cumsum(n_a + n_b), np.cumsum(n_links)
        return {
            "n_a": n_a.tolist(),
            "n_b": n_b.tolist(),
            "n_groups": n_groups.tolist(),
            "n_links": n_links.tolist(),
            "groups": ["".join(written[z - n : z].tolist())[:-1] for z, n in zip(signs.tolist(), (n_a + n_b).tolist())],
            "links": [links[z - n : z].tobytes() for z, n in zip(ends.tolist(), n_links.tolist())],
        }


def among(values: np.ndarray, others: np.ndarray) -> np.ndarray:
    """Is each value among the others? Both ascend, and the last ones are equal."""
    return others[np.searchsorted(others, values)] == values if len(values) else np.zeros(0, bool)


def overlaps(a_start: np.ndarray, a_doc: np.ndarray, b_start: np.ndarray, b_doc: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(place in A, place in B) of all tokens that share bytes, in order of documents.

    Of two tokens that overlap, the one that starts later starts inside the other; tokens that start
    together are found in both directions and kept once.
    """
    a, b = np.arange(len(a_start)), np.arange(len(b_start))
    a_side = pd.DataFrame({"start": a_start, "doc": a_doc, "other": a}, copy=False)
    b_side = pd.DataFrame({"start": b_start, "doc": b_doc, "other": b}, copy=False)
    into_b = pd.merge_asof(a_side[["start", "doc"]], b_side, on="start", by="doc")["other"].to_numpy(np.int64)
    into_a = pd.merge_asof(b_side[["start", "doc"]], a_side, on="start", by="doc")["other"].to_numpy(np.int64)
    inside = a_start[into_a] != b_start
    a_at, b_at = np.concatenate((a, into_a[inside])), np.concatenate((into_b, b[inside]))
    # A step along either side raises the sum of both places, so it is a place for the link.
    where = np.full(len(a) + len(b), -1, np.int64)
    where[a_at + b_at] = np.arange(len(a_at))
    order = where[where >= 0]
    return a_at[order], b_at[order]


_aligners: dict[int, Aligner] = {}


def aligner(files: tuple[str, bytes]) -> Aligner:
    """One per Python worker and pair of vocabularies."""
    key = hash(files)
    if key not in _aligners:
        _aligners.clear()
        _aligners[key] = Aligner(*files)
    return _aligners[key]


SCHEMA = "doc_id long, n_a long, n_b long, n_groups long, n_links long, groups string, links binary"


def align(docs: DataFrame, byte_bpe: str, piece_bpe: str) -> DataFrame:
    """(doc_id, n_a, n_b, n_groups, n_links, groups, links) of every document.

    A encodes a blank and the text by the tokenizer file ``byte_bpe``, B the text by the model
    ``piece_bpe``, which adds the blank; neither adds special tokens, and their strings in a text are
    plain text. ``groups`` reads ``a1,a2|b1;a3|b2,b3``; ``links`` holds one number for each pair of
    tokens that share bytes, B's id times 65,536 plus A's, 32 bits, little end first.

    Null and empty texts, and texts that either side does not spell byte by byte (B reads U+2581 as a
    blank), have no tokens: zeros, an empty ``groups``, empty ``links``. Rows and repeated rows keep
    their doc_id (null too), other columns are ignored, whole texts of any length are encoded.
    """
    files = docs.sparkSession.sparkContext.broadcast((Path(byte_bpe).read_text(), Path(piece_bpe).read_bytes()))

    def run(batches):
        tool = aligner(files.value)
        for batch in batches:
            for rows in slices(pa.table(batch), most=1 << 20):
                done = tool.align(rows.column("text").to_pylist())
                types = {"groups": pa.large_string(), "links": pa.large_binary()}
                columns = {name: pa.array(x, types.get(name, pa.int64())) for name, x in done.items()}
                columns["groups"] = columns["groups"].cast(pa.string())
                columns["links"] = columns["links"].cast(pa.binary())
                yield pa.record_batch({"doc_id": rows.column("doc_id").combine_chunks(), **columns})

    rows = docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"].cast("string").alias("text"))
    return rows.mapInArrow(run, SCHEMA)


def codes_of(links) -> tuple[np.ndarray, np.ndarray]:
    """(all links of a binary column, where each row's begin, and the end)."""
    column = array_of(links).cast(pa.large_binary())
    _, where, data = column.buffers()
    offsets = np.frombuffer(where, np.int64)[column.offset : column.offset + len(column) + 1]
    raw = np.zeros(0, np.uint8) if data is None else np.frombuffer(data, np.uint8)
    return raw[offsets[0] : offsets[-1]].view("<u4"), (offsets - offsets[0]) // 4


def pair_counts(aligned: DataFrame) -> DataFrame:
    """(link, n): how many links of the corpus hold each id pair."""

    def counted(codes: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        code, place = np.unique(np.concatenate(codes), return_inverse=True)
        return code, np.bincount(place, np.concatenate(counts)).astype(np.int64)

    def run(batches):
        code, n, waiting, size = np.zeros(0, np.uint32), np.zeros(0, np.int64), [], 0
        for batch in batches:
            found, _ = codes_of(batch.column("links"))
            for at in range(0, len(found), COUNTED_AT_ONCE):
                waiting.append(found[at : at + COUNTED_AT_ONCE])
                size += len(waiting[-1])
                if size >= COUNTED_AT_ONCE:
                    new = np.unique(np.concatenate(waiting), return_counts=True)
                    code, n = counted([code, new[0]], [n, new[1]])
                    waiting, size = [], 0
            if len(code) > COUNTED_AT_ONCE:
                yield pa.record_batch({"link": pa.array(code, pa.int64()), "n": pa.array(n)})
                code, n = code[:0], n[:0]
        new = np.unique(np.concatenate([np.zeros(0, np.uint32), *waiting]), return_counts=True)
        code, n = counted([code, new[0]], [n, new[1]])
        yield pa.record_batch({"link": pa.array(code, pa.int64()), "n": pa.array(n)})

    rows = aligned.select("links").mapInArrow(run, "link long, n long")
    return rows.groupBy("link").agg(F.sum("n").alias("n"))


def with_best(counts: DataFrame) -> DataFrame:
    """(link, n, best): is the count the highest of its B id, ties included."""
    b = F.shiftright("link", 16)
    highest = counts.groupBy(b.alias("_b")).agg(F.max("n").alias("_most"))
    return counts.join(highest, F.shiftright(counts["link"], 16) == F.col("_b")).select("link", "n", (F.col("n") == F.col("_most")).alias("best"))


def summed(links, code: np.ndarray, n: np.ndarray, best: np.ndarray) -> tuple[pa.Array, pa.Array]:
    """(links with a best count, sum of counts) of each row; ``code`` is sorted and holds every link."""
    found, where = codes_of(links)
    place = np.searchsorted(code, found)
    sums = [np.concatenate(([0], np.cumsum(x[place], dtype=np.int64))) for x in (best, n)]
    return tuple(pa.array(x[where[1:]] - x[where[:-1]], pa.int64()) for x in sums)


KEPT = ["doc_id", "n_a", "n_b", "n_groups", "n_links"]


def link_counts(aligned: DataFrame, most_pairs: int = MOST_PAIRS) -> DataFrame:
    """The rows of ``align`` (a written table) with n_best and count_sum; ``links`` goes.

    A link's count is that of its id pair in all given rows. ``n_best`` counts the links whose count
    is the highest of their B id, ``count_sum`` adds up the counts of all links.
    """
    rest = [name for name in aligned.columns if name != "links"]
    pairs = cut_lineage(with_best(cut_lineage(pair_counts(aligned), "pair-counts")), "pairs")
    schema = aligned.select(*rest).withColumn("n_best", F.lit(0).cast("long")).withColumn("count_sum", F.lit(0).cast("long")).schema

    def finished(table, code, n, best):
        out = table.select(rest)
        for name, column in zip(("n_best", "count_sum"), summed(table.column("links"), code, n, best)):
            out = out.append_column(name, column)
        return out

    if pairs.count() <= most_pairs:
        table = pairs.toArrow().sort_by("link")
        arrays = [np.ascontiguousarray(table.column(name).to_numpy()) for name in ("link", "n", "best")]
        shared = aligned.sparkSession.sparkContext.broadcast((arrays[0].astype(np.uint32), *arrays[1:]))

        def look_up(batches):
            for batch in batches:
                for rows in slices(pa.table(batch), "links", 8 << 20):
                    yield from finished(rows, *shared.value).to_batches()

        return aligned.mapInArrow(look_up, schema)

    size = aligned.agg(F.sum(F.octet_length("links").cast("long"))).first()[0] or 0
    groups = max(1, math.ceil(size / GROUP_LINK_BYTES))
    rows = aligned.withColumn("g", F.pmod(F.xxhash64("doc_id", "n_links"), F.lit(groups)).cast("int"))

    def distinct(table: pa.Table) -> pa.Table:
        code = np.unique(codes_of(table.column("links"))[0])
        return pa.table({"g": pa.repeat(table.column("g")[0], len(code)).cast(pa.int32()), "key": pa.array(code, pa.int64())})

    def answer(table: pa.Table, told: pa.Table) -> pa.Table:
        told = told.sort_by("key")
        arrays = [told.column(name).to_numpy() for name in ("key", "n", "best")]
        if not len(table):
            return finished(table, np.zeros(0, np.uint32), *(np.zeros(0, np.int64),) * 2)
        return finished(table, arrays[0].astype(np.uint32), *arrays[1:])

    asked = rows.select("g", "links").groupBy("g").applyInArrow(distinct, "g int, key long")
    asked = cut_lineage(asked, "asked-pairs")
    uses = cut_lineage(asked.groupBy("key").agg(F.count(F.lit(1)).alias("uses")), "pair-uses")
    replies = join_in_two(asked, pairs.withColumnRenamed("link", "key"), uses, FREQUENT)
    return rows.groupBy("g").cogroup(replies.groupBy("g")).applyInArrow(answer, schema)


def cross_tokenizer_alignment(docs: DataFrame, byte_bpe: str, piece_bpe: str, most_pairs: int = MOST_PAIRS) -> DataFrame:
    """(doc_id, n_a, n_b, n_groups, n_links, groups_sha256, n_best, count_sum) of every document.

    See ``align`` and ``link_counts``. ``groups_sha256`` is the lower-case hex digest of ``groups``,
    empty for a text without tokens. An empty table gives no rows.
    """
    rows = align(docs, byte_bpe, piece_bpe)
    digest = F.when(F.col("n_a") > 0, F.sha2("groups", 256)).otherwise("")
    return link_counts(cut_lineage(rows.select(*KEPT, digest.alias("groups_sha256"), "links"), "aligned"), most_pairs)
