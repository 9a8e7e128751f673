"""Benchmark decontamination: BM25 with block-max pruning, then question and answer overlap."""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from corpusforge.llm.batches import (
    Hashes,
    columns_of,
    give_back,
    heads,
    lowered,
    slices,
    utf8,
    word_hashes,
    word_spans,
)
from corpusforge.session import cut_lineage

PASSAGE = 64
STRIDE = 32
BLOCK = 16
K1, B = 1.2, 0.75
RETRIEVE = 0.5
"""A passage is retrieved for a part of an item at this share of the part's score with itself."""
QUESTION_SHARE = 2 / 3
"""Words of an item that count as its question if no question mark divides it."""
GRAM = 5
OVERLAP = 0.5
"""Share of the question's and of the answer's word 5-grams that a contaminated document holds."""
ENTRIES = 1 << 20
"""Index entries that are looked at together, about."""
CHUNK_ITEMS = 5_000
"""Items of one index; a larger benchmark is searched chunk by chunk, so no broadcast grows with it."""
SLICE_BYTES = 1 << 19


def words_of(texts) -> tuple[np.ndarray, np.ndarray]:
    """(word hashes, first word of each text and the end); A-Z count as a-z."""
    data, offsets = utf8(texts)
    data = lowered(data)
    starts, ends, own = word_spans(data, offsets)
    return word_hashes(data, starts, ends), np.searchsorted(own, np.arange(len(offsets)))


def lookup(keys: np.ndarray, found: np.ndarray) -> np.ndarray:
    """The index of each value in the sorted keys, len(keys) if it is none of them."""
    at = np.searchsorted(keys, found)
    at[at == len(keys)] = 0
    return np.where(keys[at] == found, at, len(keys)) if len(keys) else np.zeros(len(found), np.int64)


@dataclass(frozen=True)
class Index:
    """Postings by term and part; those of a term in one block of parts are an entry with its largest impact."""

    items: list[int | None]
    terms: np.ndarray  # sorted word hashes
    entry_of: np.ndarray  # (terms + 2,): first entry of each term; the last "term" is any other word and has none
    block: np.ndarray  # block of each entry
    highest: np.ndarray  # largest impact in each entry
    posting_of: np.ndarray  # (entries + 1,): first posting of each entry
    part: np.ndarray  # part of each posting
    weight: np.ndarray  # BM25 of one occurrence in the query
    least: np.ndarray  # score at which a part is retrieved
    part_item: np.ndarray
    grams: np.ndarray  # sorted hashes of the items' word n-grams
    pairs: np.ndarray  # rows (gram, item, in answer), sorted
    sizes: np.ndarray  # (items, 2): different grams of question and answer

    @property
    def impact(self) -> np.ndarray:
        """(terms + 1, parts): the weights as a dense table, for small indexes."""
        dense = np.zeros((len(self.terms) + 1, len(self.least)), np.float32)
        dense[np.repeat(np.arange(len(self.terms) + 1), np.diff(self.posting_of[self.entry_of])), self.part] = self.weight
        return dense


def ranges(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The numbers start, start + 1, ... of each range, one range after the other."""
    return np.repeat(starts - (np.cumsum(sizes) - sizes), sizes) + np.arange(sizes.sum())


def gram_hashes(words: np.ndarray, size: int) -> np.ndarray:
    at = np.arange(max(0, len(words) - size + 1))
    return Hashes(words).of(at, at + size)


@dataclass(frozen=True)
class Statistics:
    """Counts over all items of a benchmark, those of terms for one chunk's terms."""

    parts: int
    words: int
    terms: np.ndarray  # sorted word hashes
    df: np.ndarray  # parts that hold each of them


def part_counts(batches) -> Iterator[pa.RecordBatch]:
    """(chunk, term, parts, words): the parts that hold a term; a null term counts parts and words."""
    for batch in batches:
        words, first = words_of(pa.chunked_array([batch.column("text")]))
        sizes = np.diff(first)
        parts = -(-sizes // PASSAGE)
        chunk = batch.column("chunk").to_numpy()
        of_part = np.repeat(np.cumsum(parts) - parts, sizes) + ranges(np.zeros(len(sizes), np.int64), sizes) // PASSAGE
        order = np.lexsort((of_part, words))
        at = order[heads(words[order], of_part[order])]
        of_term = np.repeat(chunk, sizes)[at]
        yield pa.record_batch(
            {
                "chunk": pa.array(np.concatenate((of_term, chunk)), pa.int32()),
                "term": pa.array([*words[at].view(np.int64).tolist(), *[None] * len(chunk)], pa.int64()),
                "parts": pa.array(np.concatenate((np.ones(len(at), np.int64), parts)), pa.int64()),
                "words": pa.array(np.concatenate((np.zeros(len(at), np.int64), sizes)), pa.int64()),
            }
        )


def build_index(ids: list[int | None], texts: list[str], whole: Statistics | None = None) -> Index:
    """The index of some items; ``whole`` has the counts of the benchmark that they are a chunk of."""
    words, first = words_of(pa.chunked_array([pa.array(texts, pa.string())]))
    parts, part_item, pairs, sizes = [], [], [], []
    for i, text in enumerate(texts):
        own = words[first[i] : first[i + 1]]
        for at in range(0, len(own), PASSAGE):
            parts.append(own[at : at + PASSAGE])
            part_item.append(i)
        cut = len(text[: text.rindex("?") + 1].split()) if "?" in text else 0
        if not 0 < cut < len(own):
            cut = math.ceil(len(own) * QUESTION_SHARE)
        size = []
        for answer, side in enumerate((own[:cut], own[cut:])):
            grams = np.unique(gram_hashes(side, min(GRAM, max(1, len(side)))))
            # Short sides are looked up by all their words; the length is part of the hash.
            pairs += [(int(g), i, answer) for g in grams]
            size.append(len(grams))
        sizes.append(size)
    terms = np.unique(words)
    length = np.array([len(own) for own in parts], np.float64)
    part_of = np.repeat(np.arange(len(parts)), length.astype(np.int64))
    keys, tf = np.unique(lookup(terms, words) * max(1, len(parts)) + part_of, return_counts=True)
    term, part = np.divmod(keys, max(1, len(parts)))
    df = np.bincount(term, minlength=len(terms))
    known = whole or Statistics(len(parts), len(words), terms, df)
    df = known.df[np.searchsorted(known.terms, terms)]
    idf = np.log(1 + (known.parts - df + 0.5) / (df + 0.5))
    norm = K1 * (1 - B + B * length * known.parts / max(known.words, known.parts, 1))
    weight = (idf[term] * tf * (K1 + 1) / (tf + norm[part])).astype(np.float32)
    least = RETRIEVE * np.bincount(part, weight * tf, len(parts))
    begin = np.flatnonzero(heads(term, part // BLOCK))
    highest = np.maximum.reduceat(weight, begin) if len(begin) else weight
    entry_of = np.searchsorted(term[begin], np.arange(len(terms) + 2))
    rows = np.array(sorted(pairs), np.uint64).reshape(-1, 3)
    return Index(
        ids, terms, entry_of, part[begin] // BLOCK, highest, np.append(begin, len(part)),
        part, weight, least, np.array(part_item, np.int64),
        np.unique(rows[:, 0]), rows, np.array(sizes, np.int64).reshape(-1, 2),
    )


def retrieved(index: Index, words: np.ndarray, first: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(document, part, score) of every passage and part at or above the part's threshold.

    A passage is two neighbouring strides of a document. Its score in a block of parts is at most the
    sum of its words' highest impacts there; only blocks whose bound reaches their lowest threshold
    are scored part by part, through the postings of that block.
    """
    if not len(index.least):
        return
    term = lookup(index.terms, words)
    strides = -(-np.diff(first) // STRIDE)
    doc = np.repeat(np.arange(len(strides)), strides)
    begin = ranges(np.zeros(len(strides), np.int64), strides) * STRIDE + first[doc]
    n = len(begin)
    # A document's last stride begins no passage, unless it is the only one.
    inner = np.append(doc[1:] == doc[:-1], False) if n else np.zeros(0, bool)
    alone = ~inner & (strides[doc] == 1)
    asked = np.flatnonzero(inner | alone)
    known = np.flatnonzero(term < len(index.terms))
    of_word = np.searchsorted(begin, known, "right") - 1
    entries = index.entry_of[term[known] + 1] - index.entry_of[term[known]]
    work = np.concatenate(([0], np.cumsum(np.bincount(of_word, entries, n))))
    blocks = -(-len(index.least) // BLOCK)
    lowest = np.minimum.reduceat(index.least, np.arange(0, len(index.least), BLOCK)) * (1 - 1e-6)
    at = 0
    while at < n:
        # Some strides at a time and the one after them, so that the entries held stay few.
        to = min(max(at + 1, int(np.searchsorted(work, work[at] + ENTRIES, "right")) - 1), at + max(1, ENTRIES // blocks), n)
        here = slice(*np.searchsorted(of_word, (at, min(to + 1, n))))
        size = entries[here]
        entry = ranges(index.entry_of[term[known[here]]], size)
        cell = np.repeat((of_word[here] - at) * blocks, size) + index.block[entry]
        bound = np.bincount(cell, index.highest[entry], (to + 1 - at) * blocks).reshape(-1, blocks)
        own = asked[slice(*np.searchsorted(asked, (at, to)))]
        second = np.where(inner[own], bound[own - at + 1].T, 0).T
        row, block = np.nonzero(bound[own - at] + second >= lowest)
        row = own[row] - at
        # Both strides of each near passage are scored in its block, each of them once.
        pair = inner[row + at]
        needed = np.zeros((to + 1 - at) * blocks, bool)
        needed[row * blocks + block] = True
        needed[(row[pair] + 1) * blocks + block[pair]] = True
        place = np.cumsum(needed) - 1
        near = needed[cell]
        entry, cell = entry[near], place[cell[near]]
        size = index.posting_of[entry + 1] - index.posting_of[entry]
        posting = ranges(index.posting_of[entry], size)
        exact = np.bincount(
            np.repeat(cell * BLOCK, size) + index.part[posting] % BLOCK, index.weight[posting], needed.sum() * BLOCK
        ).reshape(-1, BLOCK)
        for k in range(0, len(row), 65_536):
            r, b = row[k : k + 65_536], block[k : k + 65_536]
            scores = exact[place[r * blocks + b]]
            two = inner[r + at]
            scores[two] += exact[place[(r[two] + 1) * blocks + b[two]]]
            part = b[:, None] * BLOCK + np.arange(BLOCK)
            least = np.append(index.least, np.inf)[np.minimum(part, len(index.least))]
            i, p = np.nonzero(scores >= least * (1 - 1e-9))
            yield doc[r[i] + at], part[i, p], scores[i, p]
        at = to


def overlaps(index: Index, words: np.ndarray, first: np.ndarray, asked: np.ndarray) -> dict[tuple[int, int], list[int]]:
    """Different question and answer grams of each item that stand in each of the documents asked for."""
    sizes = first[asked + 1] - first[asked]
    words, first = words[ranges(first[asked], sizes)], np.concatenate(([0], np.cumsum(sizes)))
    found = []
    for size in range(1, GRAM + 1):
        grams = gram_hashes(words, size)
        own = np.searchsorted(first, np.arange(len(grams)), "right") - 1
        inside = np.arange(len(grams)) + size <= first[own + 1]
        at = np.flatnonzero(inside & (lookup(index.grams, grams) < len(index.grams)))
        found.append(np.stack((asked[own[at]], grams[at].view(np.int64)), axis=1))
    held: dict[tuple[int, int], list[int]] = {}
    for d, g in np.unique(np.concatenate(found), axis=0):
        key = np.uint64(np.int64(g).view(np.uint64))
        low, high = np.searchsorted(index.pairs[:, 0], key), np.searchsorted(index.pairs[:, 0], key, "right")
        for _, item, answer in index.pairs[low:high]:
            held.setdefault((int(d), int(item)), [0, 0])[int(answer)] += 1
    return held


def leaks(index: Index, rows: pa.Table) -> pa.RecordBatch:
    words, first = words_of(rows.column("text"))
    docs = rows.column("doc_id").to_pylist()
    best: dict[tuple[int, int], list[float]] = {}
    for doc, part, score in retrieved(index, words, first):
        item = index.part_item[part]
        order = np.lexsort((-score, item, doc))
        doc, item, score = doc[order], item[order], score[order]
        edge = np.flatnonzero(heads(doc, item))
        for d, i, s, n in zip(doc[edge], item[edge], score[edge], np.diff(np.append(edge, len(doc)))):
            kept = best.setdefault((int(d), int(i)), [0.0, 0])
            kept[0], kept[1] = max(kept[0], float(s)), kept[1] + int(n)
    held = overlaps(index, words, first, np.unique([d for d, _ in best])) if best else {}
    out = {name: [] for name in ("doc_id", "item_id", "n_passages", "score", "question_overlap", "answer_overlap")}
    for (d, i), (score, n) in sorted(best.items()):
        shares = [h / s if s else None for h, s in zip(held.get((d, i), (0, 0)), index.sizes[i])]
        if all(x is None or x >= OVERLAP for x in shares) and shares != [None, None]:
            for name, value in zip(out, (docs[d], index.items[i], n, score, *shares)):
                out[name].append(value)
    types = [pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.float64()]
    return pa.record_batch({name: pa.array(x, t) for (name, x), t in zip(out.items(), types)})


def decontaminate(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """(doc_id, item_id, n_passages, score, question_overlap, answer_overlap) of every leak.

    Every passage of 64 words (a new one each 32) of every document queries the BM25 index of the
    benchmark's items; whatever reaches half of an item's score with itself is retrieved, and counts
    as a leak if the document holds half of the 5-grams of the item's question and of its answer.
    A question mark divides an item, else two thirds of its words are the question; an empty answer
    has a null overlap and is not asked for.

    Takes (doc_id, text) and (item_id, text) and ignores other columns. Null, empty and blank texts
    leak nothing and are no items; null ids of either table come back as null; repeated documents leak
    each for itself, repeated items are one; empty tables give no rows. Word counts and idf are those
    of all items, also where the benchmark is searched in chunks.
    """
    items = columns_of(benchmark, "item_id", "text").where(F.col("text").rlike(r"[^\x20\x09-\x0D]")).distinct()
    items = items.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text"))
    chunks = max(1, math.ceil(items.count() / CHUNK_ITEMS))
    if chunks > 1:
        of_chunk = F.pmod(F.xxhash64("item_id", "text"), F.lit(chunks)).cast("int")
        items = cut_lineage(items.withColumn("chunk", of_chunk), "benchmark")
        counts = items.select("chunk", "text").mapInArrow(part_counts, "chunk int, term long, parts long, words long")
        counts = cut_lineage(counts.groupBy("chunk", "term").agg(F.sum("parts").alias("parts"), F.sum("words").alias("words")), "terms")
        n_parts, n_words = counts.where("term is null").agg(F.sum("parts"), F.sum("words")).first()
        df = counts.where("term is not null").groupBy("term").agg(F.sum("parts").alias("df"))
    rows = columns_of(docs, "doc_id", "text").select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    schema = "doc_id long, item_id long, n_passages long, score double, question_overlap double, answer_overlap double"
    result = None
    for chunk in range(chunks):
        held, whole = items, None
        if chunks > 1:
            held = items.where(F.col("chunk") == chunk)
            own = df.join(counts.where((F.col("chunk") == chunk) & F.col("term").isNotNull()).select("term"), "term", "left_semi")
            rows_of = own.select("term", "df").toArrow()
            terms = rows_of.column("term").to_numpy().view(np.uint64)
            order = np.argsort(terms)
            whole = Statistics(n_parts, n_words, terms[order], rows_of.column("df").to_numpy()[order])
        held = held.orderBy("item_id", "text").collect()
        index = build_index([r["item_id"] for r in held], [r["text"] for r in held], whole)
        shipped = docs.sparkSession.sparkContext.broadcast(index)

        def run(batches, shipped=shipped):
            if len(shipped.value.items):
                for batch in batches:
                    for part in slices(pa.table(batch), most=SLICE_BYTES):
                        yield leaks(shipped.value, part)
                    give_back()

        found = rows.mapInArrow(run, schema)
        result = found if result is None else result.unionByName(found)
    return result
