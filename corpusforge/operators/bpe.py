"""Byte-pair merges: learned from the distinct words, loaded from a user's table, applied to documents."""

from __future__ import annotations

import heapq
from collections import defaultdict
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from corpusforge.functions import codec
from corpusforge.functions.text import GPT2_PATTERN, PRETOKEN_PATTERN, pretokens
from corpusforge.operators.tokenize import Tokenizer, pretoken_dictionary
from corpusforge.session import dealt, drop_table, scratch, scratch_table, spread

# Ids below are the bytes, unless a vocabulary numbers them otherwise.
FIRST_NEW_ID = 256

MERGES_SCHEMA = "rank long, left long, right long, new_id long, n long"

# Up to this many merges, one string replacement per merge over the whole text is cheapest (check_s: 64 of them take 2.8 times the encoder below).
FOLD_LIMIT = 16

# No id maps to this character, so it can mark the pre-token borders a merge must not cross.
BORDER = "\ue000"

# A round of learning looks at this many pairs, fewer if their surroundings hold too many ids.
LOOK = 4096
MOST_SYMBOLS = 200_000

# A task remembers this many encoded words at a time.
MEMO_WORDS = 500_000

# New words of an Arrow batch are merged, and its texts put together, this many words at a time.
WORDS_AT_ONCE = 200_000


@dataclass(frozen=True)
class Vocabulary:
    """``base`` is the id of each byte; ``pairs`` maps left << 16 | right to (rank, new id)."""

    base: tuple[int, ...]
    pairs: dict[int, tuple[int, int]] = field(repr=False)

    @property
    def top_id(self) -> int:
        return max([*self.base, *(new for _, new in self.pairs.values())])

    def spelled(self) -> dict[int, bytes]:
        """id -> bytes of base ids and merged ids."""
        known = {i: bytes([b]) for b, i in enumerate(self.base)}
        for pair, (_, new) in sorted(self.pairs.items(), key=lambda item: item[1]):
            left, right = known.get(pair >> 16), known.get(pair & 0xFFFF)
            if left is not None and right is not None:  # else another pair makes the token first
                known.setdefault(new, left + right)
        return known


def vocabulary_of(merges: list[tuple[int, int, int, int]], base: tuple[int, ...] = tuple(range(256))) -> Vocabulary:
    return Vocabulary(base, {left << 16 | right: (rank, new) for rank, (left, right, new, _) in enumerate(merges)})


# --- merging one sequence ----------------------------------------------------------------


def merge_ids(ids: list[int], pairs: dict[int, tuple[int, int]]) -> list[int]:
    """Merge the best-ranked neighbouring pair, leftmost first, until none is left.

    Candidates wait in a heap and neighbours in linked lists, so a word of any length takes
    O(n log n) steps.
    """
    n = len(ids)
    ids, after, before = list(ids), list(range(1, n + 1)), list(range(-1, n - 1))
    heap = []
    for i in range(n - 1):
        found = pairs.get(ids[i] << 16 | ids[i + 1])
        if found is not None:
            heap.append((found[0], i, ids[i], ids[i + 1], found[1]))
    heapq.heapify(heap)
    while heap:
        _, i, left, right, new = heapq.heappop(heap)
        j = after[i] if ids[i] == left else n
        if j >= n or ids[j] != right:
            continue  # one of the two has been merged since
        ids[i], ids[j] = new, -1
        after[i] = k = after[j]
        if k < n:
            before[k] = i
            found = pairs.get(new << 16 | ids[k])
            if found is not None:
                heapq.heappush(heap, (found[0], i, new, ids[k], found[1]))
        h = before[i]
        if h >= 0:
            found = pairs.get(ids[h] << 16 | new)
            if found is not None:
                heapq.heappush(heap, (found[0], h, ids[h], new, found[1]))
    return [x for x in ids if x >= 0]


# Sequences of up to this many ids are merged side by side, longer ones one by one.
SIDE_BY_SIDE = 48
NO_PAIR = np.iinfo(np.int64).max


class PairTable:
    """Rank and new id of many pairs at a time: ``rank << 16 | new id``, or ``NO_PAIR``."""

    def __init__(self, pairs: dict[int, tuple[int, int]]):
        codes = np.fromiter(pairs, np.int64, len(pairs))
        values = np.array([rank << 16 | new for rank, new in pairs.values()], np.int64)
        order = np.argsort(codes)
        self.codes = np.append(codes[order], 1 << 32).astype(np.uint64)
        self.values = np.append(values[order], NO_PAIR)
        self.pairs = pairs

    def of(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        code = left.astype(np.uint64) << np.uint64(16) | right
        at = np.searchsorted(self.codes, code)
        return np.where(self.codes[at] == code, self.values[at], NO_PAIR)


def merge_all(flat: np.ndarray, bounds: np.ndarray, table: PairTable) -> list[bytes]:
    """Token binaries of many merged sequences, ``flat[bounds[i]:bounds[i + 1]]``; each as by ``merge_ids``.

    Sequences of one length are the rows of a matrix. A step merges the best pair of every row, the
    leftmost of equals, so all rows that still have one are equally long again.
    """
    sizes = np.diff(bounds)
    out: list[bytes] = [b""] * len(sizes)
    order = np.argsort(sizes, kind="stable")
    lengths, begins = np.unique(sizes[order], return_index=True)
    for length, rows in zip(lengths.tolist(), np.split(order, begins[1:])):
        if length > SIDE_BY_SIDE:
            for i in rows.tolist():
                out[i] = packed_ids(merge_ids(flat[bounds[i] : bounds[i + 1]].tolist(), table.pairs))
            continue
        ids = flat[bounds[rows][:, None] + np.arange(length)].astype(np.uint64)
        best = table.of(ids[:, :-1], ids[:, 1:])
        while len(rows):
            every = np.arange(len(rows))
            at = best.argmin(1) if ids.shape[1] > 1 else np.zeros(len(rows), np.int64)
            first = best[every, at] if ids.shape[1] > 1 else np.full(len(rows), NO_PAIR)
            live = first < NO_PAIR
            ended = ids[~live].astype(">u2")
            raw, width = ended.tobytes(), 2 * ids.shape[1]
            for k, i in enumerate(rows[~live].tolist()):
                out[i] = raw[k * width : (k + 1) * width]
            rows, ids, best, at, first = rows[live], ids[live], best[live], at[live], first[live]
            every = np.arange(len(rows))
            ids[every, at] = first & 0xFFFF
            kept = np.ones(ids.shape, bool)
            kept[every, at + 1] = False
            ids = ids[kept].reshape(len(rows), -1) if len(rows) else ids[:, 1:]
            kept = np.ones(best.shape, bool)
            kept[every, at] = False
            best = best[kept].reshape(len(rows), -1) if len(rows) else best[:, 1:]
            for where, place in ((at > 0, at - 1), (at < best.shape[1], at)):
                row, j = every[where], place[where]
                best[row, j] = table.of(ids[row, j], ids[row, j + 1])
    return out


def packed_ids(ids: list[int]) -> bytes:
    return np.array(ids, ">u2").tobytes()


def unpacked_ids(tokens: bytes) -> list[int]:
    return np.frombuffer(tokens, ">u2").tolist()


# --- learning ----------------------------------------------------------------------------


def pair_counts(words: DataFrame, tokens: str = "tokens", n: Column | None = None) -> DataFrame:
    """(pair, n) of neighbouring ids, weighted by word counts; a pair is a two-id binary.

    Pairs sort by left id, then right id. ``words`` has (tokens, n).
    """
    at = words.select((F.col("n") if n is None else n).alias("n"), F.col(tokens).alias("t")).withColumn(
        "p", F.explode(codec.target_positions(F.col("t"), F.lit(1)))
    )
    pair = F.substring("t", F.col("p") * 2 - 1, F.lit(4))
    return at.select(pair.alias("pair"), "n").groupBy("pair").agg(F.sum("n").alias("n"))


def _flat(tokens: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(ids of all sequences, where each begins, and the end)."""
    column = tokens.cast(pa.large_binary())
    _, where, data = column.buffers()
    offsets = np.frombuffer(where, np.int64)[column.offset : column.offset + len(column) + 1]
    raw = np.zeros(0, np.uint8) if data is None else np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]]
    return raw.view(">u2").astype(np.uint32), (offsets - offsets[0]) // 2


def _held(flat: np.ndarray, bounds: np.ndarray, pairs: np.ndarray) -> np.ndarray:
    """Does a pair of ``pairs`` (ascending) begin at each id, inside one sequence?"""
    code = np.zeros(len(flat), np.uint32)
    code[:-1] = flat[:-1] << np.uint32(16) | flat[1:]
    held = pairs[np.minimum(np.searchsorted(pairs, code), len(pairs) - 1)] == code
    ends = bounds[1:][np.diff(bounds) > 0] - 1
    held[ends] = False
    return held


def segment_counts(words: DataFrame, hot: list[int], at_once: int = 200_000) -> DataFrame:
    """(segment, n): the stretches of words whose neighbouring ids are all pairs of ``hot``.

    A task adds equal stretches up before they move.
    """
    pairs = np.array(sorted(hot), np.uint32)

    def run(batches):
        seen: dict[bytes, int] = defaultdict(int)

        def rows():
            return pa.record_batch({"segment": pa.array(list(seen), pa.binary()), "n": pa.array(list(seen.values()), pa.int64())})

        for batch in batches:
            flat, bounds = _flat(batch.column("tokens"))
            if not len(flat):
                continue
            held = _held(flat, bounds, pairs)
            first = np.flatnonzero(held & ~np.append(False, held[:-1]))
            last = np.flatnonzero(held & ~np.append(held[1:], False)) + 1
            raw, many = flat.astype(">u2").tobytes(), batch.column("n").to_numpy()
            weights = many[np.searchsorted(bounds, first, "right") - 1].tolist()
            for a, b, n in zip((2 * first).tolist(), (2 * last + 2).tolist(), weights):
                seen[raw[a:b]] += n
            if len(seen) > at_once:
                yield rows()
                seen.clear()
        yield rows()

    found = words.select("tokens", "n").mapInArrow(run, "segment binary, n long")
    return found.groupBy("segment").agg(F.sum("n").alias("n"))


def replay(segments: list[tuple[bytes, int]], floor: int, room: int, first_id: int) -> list[tuple[int, int, int, int]]:
    """The next merges, most frequent pair first, ties smallest ids, while they occur over ``floor`` times.

    An index from pairs to the segments that hold them keeps the counts up to date: a merge touches
    only its own segments.
    """
    words, weights = [unpacked_ids(s) for s, _ in segments], [n for _, n in segments]
    counts: dict[tuple[int, int], int] = defaultdict(int)
    where: dict[tuple[int, int], set[int]] = defaultdict(set)
    for w, ids in enumerate(words):
        for pair in zip(ids, ids[1:]):
            counts[pair] += weights[w]
            where[pair].add(w)
    heap = [(-n, pair) for pair, n in counts.items()]
    heapq.heapify(heap)
    done: list[tuple[int, int, int, int]] = []
    while heap and len(done) < room:
        negative, pair = heapq.heappop(heap)
        if counts[pair] != -negative:
            continue  # an entry with the present count waits too
        if -negative <= floor:
            break
        new = first_id + len(done)
        done.append((*pair, new, -negative))
        left, right = pair
        touched = set()
        for w in where.pop(pair):
            old, ids, i = words[w], [], 0
            while i < len(old):
                if old[i] == left and i + 1 < len(old) and old[i + 1] == right:
                    ids.append(new)
                    i += 2
                else:
                    ids.append(old[i])
                    i += 1
            for gone in zip(old, old[1:]):
                counts[gone] -= weights[w]
                touched.add(gone)
            for made in zip(ids, ids[1:]):
                counts[made] += weights[w]
                touched.add(made)
                if made != pair:
                    where[made].add(w)
            words[w] = ids
        for changed in touched:
            if counts[changed] > 0:
                heapq.heappush(heap, (-counts[changed], changed))
    return done


def merged_words(words: DataFrame, merges: list[tuple[int, int, int, int]]) -> DataFrame:
    """(tokens, n, before): words with the merges applied; ``before`` is null where nothing changed."""
    pairs = vocabulary_of(merges).pairs
    starts = np.array(sorted(pairs), np.uint32)

    def run(batches):
        table = PairTable(pairs)
        for batch in batches:
            flat, bounds = _flat(batch.column("tokens"))
            if not len(flat):
                continue
            held = np.append(0, np.cumsum(_held(flat, bounds, starts)))
            some = held[bounds[1:]] > held[bounds[:-1]]
            old = batch.column("tokens").to_pylist()
            inside = flat[np.repeat(some, np.diff(bounds))]
            new = iter(merge_all(inside, np.append(0, np.cumsum(np.diff(bounds)[some])), table))
            yield pa.record_batch(
                {
                    "tokens": pa.array([next(new) if hit else t for t, hit in zip(old, some.tolist())], pa.binary()),
                    "n": batch.column("n"),
                    "before": pa.array([t if hit else None for t, hit in zip(old, some.tolist())], pa.binary()),
                }
            )

    return words.select("tokens", "n").mapInArrow(run, "tokens binary, n long, before binary")


def _next_merges(words: DataFrame, pairs: DataFrame, look: int, most: int, room: int, first_id: int):
    """(merges, number of pairs looked at) of one round."""
    spark = words.sparkSession
    rows = pairs.orderBy(F.desc("n"), "pair").limit(look + 1).collect()
    top = [(int.from_bytes(row["pair"]), row["n"]) for row in rows]
    while top:
        floor = top[look][1] if len(top) > look else 0
        hot = [pair for pair, n in top[:look] if n > floor]
        if look > 1 and hot:
            name = scratch_table(segment_counts(words, hot), "segments")
            segments = spark.table(name)
            size = segments.agg(F.sum(F.octet_length("segment").cast("long"))).first()[0] or 0
            found = [tuple(r) for r in segments.collect()] if size <= 2 * most else None
            drop_table(spark, name)
            if found is not None:
                return replay([(bytes(s), n) for s, n in found], floor, room, first_id), look
            look = max(1, look // 4)
        else:  # the first pair is next in any case
            pair, n = top[0]
            return [(pair >> 16, pair & 0xFFFF, first_id, n)], look
    return [], look


def longer_words(docs: DataFrame, pattern: str = PRETOKEN_PATTERN) -> DataFrame:
    """(tokens, n) of the distinct pre-tokens of two bytes and more.

    Spark tests their size at every occurrence, before it counts, so the test is on the bare word.
    """
    distinct = pretoken_dictionary(docs, pattern).where("octet_length(word) > 1")
    return distinct.select(codec.byte_tokens(F.col("word")).alias("tokens"), "n")


def learn_merges(
    docs: DataFrame,
    n_merges: int,
    pattern: str = PRETOKEN_PATTERN,
    look: int = LOOK,
    most_symbols: int = MOST_SYMBOLS,
) -> list[tuple[int, int, int, int]]:
    """[(left, right, new_id, n), ..] in rank order: most frequent pair first, ties smallest ids.

    Distinct words and pair counts are written once. A round takes the ``look`` most frequent pairs
    and cuts the words into stretches of neighbours that are all among them. A merge outside these
    stretches cannot become more frequent than the best pair that was left out: a merge only makes
    pairs of new ids, each at most as frequent as a pair it came from. So the merges above that
    count follow exactly from the distinct stretches and their numbers, which the driver replays. It
    holds ``most_symbols`` ids of them at most; where they are more, fewer pairs are looked at, down
    to the one pair that is next in any case. So rounds are few, and what the driver holds does not
    grow with the corpus.

    Then the round's merges are applied to the words that hold one, and only those words change the
    pair counts: their old pairs are taken off, their new ones added. Replaced tables are dropped.
    """
    spark = docs.sparkSession
    done: list[tuple[int, int, int, int]] = []
    with scratch(spark):
        words = scratch_table(dealt(longer_words(spread(docs), pattern)), "words")
        pairs = scratch_table(pair_counts(spark.table(words)), "pairs")
        width = look
        while len(done) < n_merges:
            found, width = _next_merges(
                spark.table(words), spark.table(pairs), width, most_symbols, n_merges - len(done), FIRST_NEW_ID + len(done)
            )
            done.extend(found)
            if not found or len(done) == n_merges:
                break
            width = min(look, 2 * width)
            rewritten = scratch_table(merged_words(spark.table(words).where("octet_length(tokens) > 2"), found), "words")
            changed = spark.table(rewritten).where("before is not null")
            delta = pair_counts(changed).unionByName(pair_counts(changed, "before", -F.col("n")))
            summed = spark.table(pairs).unionByName(delta).groupBy("pair").agg(F.sum("n").alias("n")).where("n > 0")
            counted = scratch_table(summed, "pairs")
            for old in (words, pairs):
                drop_table(spark, old)
            words, pairs = rewritten, counted
    return done


def merges_table(spark: SparkSession, merges: list[tuple[int, int, int, int]]) -> DataFrame:
    """(rank, left, right, new_id, n): at most a vocabulary's rows."""
    rows = [(rank, *merge) for rank, merge in enumerate(merges)]
    return spark.createDataFrame(rows, MERGES_SCHEMA)


def vocabulary(merges: list[tuple[int, int, int, int]]) -> dict[int, bytes]:
    """id -> bytes for byte ids and merged ids."""
    return vocabulary_of(merges).spelled()


def load_merges(table: DataFrame) -> list[tuple[int, int, int, int]]:
    """A stored merges table back as a list in rank order; its size is bounded by the id range."""
    rows = table.orderBy("rank").limit(codec.MAX_VOCAB + 1).collect()
    if len(rows) > codec.MAX_VOCAB - FIRST_NEW_ID - 1:
        raise ValueError(f"a vocabulary holds at most {codec.MAX_VOCAB} ids")
    return [(r["left"], r["right"], r["new_id"], r["n"]) for r in rows]


def load_ranks(table: DataFrame) -> Vocabulary:
    """A vocabulary from a user's table (token binary, id): every token's bytes and its id.

    The ids of the 256 single bytes may stand in any order; a longer token's id is its rank, as in
    public vocabularies. Two neighbours merge if their bytes together are a token.
    """
    rows = table.select("token", "id").limit(codec.MAX_VOCAB + 1).collect()
    ids = {bytes(r["token"]): r["id"] for r in rows}
    if len(rows) > codec.MAX_VOCAB or len(ids) < len(rows) or not all(0 <= i < codec.MAX_VOCAB for i in ids.values()):
        raise ValueError(f"tokens must be distinct, with ids below {codec.MAX_VOCAB}")
    missing = [b for b in range(256) if bytes([b]) not in ids]
    if missing:
        raise ValueError(f"no token for the bytes {missing}")
    pairs = {}
    for token, i in ids.items():
        for cut in range(1, len(token)):
            left, right = ids.get(token[:cut]), ids.get(token[cut:])
            if left is not None and right is not None:
                pairs[left << 16 | right] = (i, i)
    return Vocabulary(tuple(ids[bytes([b])] for b in range(256)), pairs)


# --- encoding ----------------------------------------------------------------------------


def apply_merges(chars: Column, merges: list[tuple[int, int, int]]) -> Column:
    """Apply (left, right, new_id) merges in rank order to a string of id code points.

    ``replace`` works left to right without overlap, which is how a merge treats a run like aaa.
    """
    for left, right, new_id in merges:
        chars = F.replace(chars, F.lit(chr(left) + chr(right)), F.lit(chr(new_id)))
    return chars


def joined(lists: pa.ListArray, coded: Callable[[list[str]], list[bytes]]) -> pa.BinaryArray:
    """The codes of each row's words, one after the other, put in place ``WORDS_AT_ONCE`` words at a time."""
    words = lists.flatten().dictionary_encode()
    blobs = coded(words.dictionary.to_pylist())
    sizes = np.fromiter(map(len, blobs), np.int64, len(blobs)) // 2
    first, codes = np.cumsum(sizes) - sizes, np.frombuffer(b"".join(blobs), np.uint16)
    number = words.indices.to_numpy()
    ends = np.zeros(len(number) + 1, np.int64)
    np.cumsum(sizes[number], out=ends[1:])
    if 2 * ends[-1] >= 1 << 31:
        raise ValueError("a batch of texts has over 2 GB of ids; set spark.sql.execution.arrow.maxRecordsPerBatch lower")
    flat = np.empty(ends[-1], np.uint16)
    for a in range(0, len(number), WORDS_AT_ONCE):
        some, reach = number[a : a + WORDS_AT_ONCE], ends[a : a + WORDS_AT_ONCE + 1]
        at = np.repeat(first[some] - reach[:-1], sizes[some]) + np.arange(reach[0], reach[-1])
        flat[reach[0] : reach[-1]] = codes[at]
    offsets = lists.offsets.to_numpy().astype(np.int64)
    where = (2 * ends[offsets - offsets[0]]).astype(np.int32)
    return pa.BinaryArray.from_buffers(pa.binary(), len(lists), [None, pa.py_buffer(where), pa.py_buffer(flat)])


def encoder(vocabulary: Vocabulary):
    """An Arrow function from lists of pre-tokens to token binaries.

    Arrow's dictionary encoding finds the distinct words of a batch. New ones are merged side by side
    and remembered; the documents are then put together by array look-ups, without a step per word.
    """

    @F.arrow_udf("binary")
    def encode(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        base, table = np.array(vocabulary.base, np.uint32), PairTable(vocabulary.pairs)
        known: dict[str, bytes] = {}

        def coded(words: list[str]) -> list[bytes]:
            new = [word for word in words if word not in known]
            for a in range(0, len(new), WORDS_AT_ONCE):
                some = new[a : a + WORDS_AT_ONCE]
                raw = [word.encode() for word in some]
                bounds = np.append(0, np.cumsum(np.fromiter(map(len, raw), np.int64, len(raw))))
                known.update(zip(some, merge_all(base[np.frombuffer(b"".join(raw), np.uint8)], bounds, table)))
            return [known[word] for word in words]

        for batch in batches:
            yield joined(batch, coded)
            if len(known) > MEMO_WORDS:
                known.clear()

    return encode


def vocabulary_tokenizer(vocabulary: Vocabulary, eot: int, pattern: str = GPT2_PATTERN) -> Tokenizer:
    """A tokenizer with a user's ids; ``eot`` is the id of the document mark."""
    if not 0 <= eot < codec.MAX_VOCAB:
        raise ValueError(f"ids must be below {codec.MAX_VOCAB}")
    encode = encoder(vocabulary)
    return Tokenizer(lambda text: encode(pretokens(text, pattern)), eot, max(vocabulary.top_id, eot) + 1)


def bpe_tokenizer(
    merges: list[tuple[int, int, int, int]], pattern: str = PRETOKEN_PATTERN
) -> Tokenizer:
    """A tokenizer for learned or loaded merges; the document mark gets the last id.

    Encoding is a map over documents and needs no shuffle. With few merges a text is encoded by
    string replacements in the JVM, pre-tokens kept apart by a border sign. With many, the distinct
    words of Arrow batches are merged in Python.
    """
    eot = FIRST_NEW_ID + len(merges)
    if len(merges) > FOLD_LIMIT:
        return vocabulary_tokenizer(vocabulary_of(merges), eot, pattern)
    plain = [(left, right, new_id) for left, right, new_id, _ in merges]

    def encode_by_fold(text: Column) -> Column:
        marked = F.array_join(F.transform(pretokens(text, pattern), codec.byte_string), BORDER)
        return codec.pack(F.replace(apply_merges(marked, plain), F.lit(BORDER), F.lit("")))

    return Tokenizer(encode=encode_by_fold, eot=eot, vocab_size=eot + 1)


def decode_tokens(tokens: Column, vocabulary: Vocabulary, eot: int) -> Column:
    """The text of a token binary, document marks dropped."""

    @F.arrow_udf("string")
    def decode(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        spelled = {**vocabulary.spelled(), eot: b""}
        for batch in batches:
            texts = [b"".join(map(spelled.__getitem__, unpacked_ids(t or b""))) for t in batch.to_pylist()]
            yield pa.array([t.decode("utf-8", "replace") for t in texts], pa.string())

    return decode(tokens)


def decode_text(tokens: Column, merges: list[tuple[int, int, int, int]], eot: int) -> Column:
    """The text of a token binary, document marks dropped."""
    return decode_tokens(tokens, vocabulary_of(merges), eot)
