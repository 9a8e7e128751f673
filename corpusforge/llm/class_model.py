"""Brown class-based bigrams: exchange clustering of words, class transitions and word emissions.

P(word | previous) = P(class of word | class of previous) * P(word | class of word). Words seen once,
words whose neighbours are all such words and unknown words share one class, the end of a text is
another, all others are assigned by exchange.
"""

from __future__ import annotations

from functools import partial

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F

from corpusforge.llm.batches import (
    columns_of,
    give_back,
    group_count,
    heads,
    lowered,
    packed,
    slices,
    unpacked,
    utf8,
    word_hashes,
    word_spans,
)
from corpusforge.session import cut_lineage, drop_table, scratch, scratch_table, tidy_shuffles

FOLDS, HELD_OUT = 5, 1
CLASSES = 32
FREQUENT = 1_000
"""Words that are exchanged one by one before the rounds over all words begin."""
LEAST_GAIN = 0.01
"""Rounds go on while each adds this share to the likelihood that classes decide."""
HASHED_AT_ONCE = 1 << 18
SWEEPS = 8
SMOOTHING = 20.0
RARE, END = CLASSES, CLASSES + 1
CODES = 2 * (END + 1)
"""The classes on the left of a word, then those on its right."""
PART_TYPES = (pa.int32(), *[pa.binary()] * 4)
END_TOKEN = np.uint64(0x454E44)
NULL_ID = (1 << 63) - 1


def in_fold(doc_id: Column) -> Column:
    """Held out: crc32(doc_id as text) mod 5 is 1; a null doc_id never is."""
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(FOLDS)) == HELD_OUT, F.lit(False))


def tokens_of(rows: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """(token hashes, first token of each text and the end); each text ends with END_TOKEN.

    Words are told apart by 64-bit hashes of their lower-case bytes. Hashing takes some dozen times the
    bytes of the text meanwhile, so it sees HASHED_AT_ONCE of them at a time.
    """
    found = [hashed_tokens(part) for part in slices(rows, most=HASHED_AT_ONCE)]
    if not found:
        return np.zeros(0, np.uint64), np.zeros(1, np.int64)
    sizes = np.concatenate([np.diff(first) for _, first in found])
    return np.concatenate([tokens for tokens, _ in found]), np.append(0, np.cumsum(sizes))


def hashed_tokens(rows: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    data, offsets = utf8(rows.column("text"))
    data = lowered(data)
    starts, ends, own = word_spans(data, offsets)
    n = len(offsets) - 1
    first = np.searchsorted(own, np.arange(n + 1)) + np.arange(n + 1)
    tokens = np.full(len(own) + n, END_TOKEN, np.uint64)
    tokens[np.arange(len(own)) + own] = word_hashes(data, starts, ends)
    return tokens, first


def by_bucket(words: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """(order by bucket and word, bucket of each)."""
    bucket = (words % np.uint64(buckets)).astype(np.int64)
    order = np.lexsort((words, bucket))
    return order, bucket[order]


def spans(bucket: np.ndarray):
    if not len(bucket):
        return []
    edges = np.append(np.flatnonzero(heads(bucket)), len(bucket))
    return [(int(bucket[a]), int(a), int(b)) for a, b in zip(edges[:-1], edges[1:])]


def gathered(batches):
    """The texts of each slice as numbers: one row of words, places of all tokens and sizes of the texts.

    ``g`` names the slice: the rows are written once, so a slice keeps its name.
    """
    at = TaskContext.get().partitionId() << 32
    for batch in batches:
        for rows in slices(pa.table(batch)):
            tokens, first = tokens_of(rows)
            words, places = np.unique(tokens, return_inverse=True)
            yield pa.record_batch(
                {
                    "g": pa.array([at], pa.int64()),
                    "doc_ids": pa.array([packed(rows.column("doc_id").to_numpy())], pa.binary()),
                    "held": pa.array([packed(rows.column("held_out").to_numpy(), 1)], pa.binary()),
                    "sizes": pa.array([packed(np.diff(first), 5)], pa.binary()),
                    "words": pa.array([packed(words)], pa.binary()),
                    "tokens": pa.array([packed(places, 2 if len(words) <= 1 << 16 else 4)], pa.binary()),
                }
            )
            at += 1
        give_back()


def places_of(row: dict) -> tuple[np.ndarray, np.ndarray]:
    """(tokens in each text, places of all tokens among the words) of a slice."""
    sizes = unpacked(row["sizes"], 5).astype(np.int64)
    return sizes, unpacked(row["tokens"], len(row["tokens"]) // int(sizes.sum())).astype(np.int64)


def trained(row: dict) -> tuple[np.ndarray, np.ndarray]:
    """(words, places among them of the tokens of all texts to learn from) of a slice."""
    sizes, tokens = places_of(row)
    return unpacked(row["words"]), tokens[np.repeat(unpacked(row["held"], 1) == 0, sizes)]


def rows_of(batches):
    """The rows of a task, one at a time."""
    for batch in batches:
        for i in range(len(batch)):
            yield batch.slice(i, 1).to_pylist()[0]
        give_back()


def counted(batches, buckets: int):
    """Words and counts of each slice, dealt into buckets."""
    for row in rows_of(batches):
        words, tokens = trained(row)
        counts = np.bincount(tokens, minlength=len(words))
        words, counts = words[counts > 0], counts[counts > 0]
        order, bucket = by_bucket(words, buckets)
        parts = spans(bucket)
        yield pa.record_batch(
            {
                "bucket": pa.array([b for b, _, _ in parts], pa.int32()),
                "words": pa.array([packed(words[order[x:y]]) for _, x, y in parts], pa.binary()),
                "counts": pa.array([packed(counts[order[x:y]], 5) for _, x, y in parts], pa.binary()),
            }
        )


def summed(table: pa.Table) -> pa.Table:
    words = np.concatenate([unpacked(x) for x in table.column("words").to_pylist()])
    counts = np.concatenate([unpacked(x, 5) for x in table.column("counts").to_pylist()]).astype(np.int64)
    words, index = np.unique(words, return_inverse=True)
    counts = np.bincount(index, counts).astype(np.int64)
    top = np.lexsort((words, -counts))[:FREQUENT]
    return pa.table(
        {
            "bucket": pa.array([table.column("bucket")[0].as_py()], pa.int32()),
            "words": pa.array([packed(words)], pa.binary()),
            "counts": pa.array([packed(counts)], pa.binary()),
            "distinct": [len(words)],
            "total": [int(counts.sum())],
            "top": pa.array([[{"word": int(words[i].view(np.int64)), "n": int(counts[i])} for i in top]], pa.list_(pa.struct([("word", pa.int64()), ("n", pa.int64())]))),
        }
    )


def place(words: np.ndarray, sorted_keys: np.ndarray, missing: int) -> np.ndarray:
    if not len(sorted_keys):
        return np.full(len(words), missing, np.int64)
    at = np.minimum(np.searchsorted(sorted_keys, words), len(sorted_keys) - 1)
    return np.where(sorted_keys[at] == words, at, missing)


def frequent_pairs(batches, top: np.ndarray):
    """Counts of neighbouring frequent words; number len(top) stands for all others."""
    width = len(top) + 1
    total: dict[int, int] = {}
    for row in rows_of(batches):
        words, tokens = trained(row)
        number = place(words, top, width - 1)[tokens]
        before = np.concatenate((place(np.array([END_TOKEN]), top, width - 1), number[:-1]))[: len(number)]
        pairs, n = np.unique(before * width + number, return_counts=True)
        for p, k in zip(pairs.tolist(), n.tolist()):
            total[p] = total.get(p, 0) + k
    yield pa.record_batch({"pair": pa.array(list(total), pa.int64()), "n": pa.array(list(total.values()), pa.int64())})


def exchange(table: np.ndarray, classes: int, fixed: np.ndarray) -> np.ndarray:
    """Classes of the words of a bigram count table, by moves that raise the class bigram likelihood.

    Starts from classes dealt by rank and moves one word at a time to its best class, sweep by sweep,
    until nothing moves. ``fixed`` words keep classes of their own after the others.
    """
    n = len(table)
    free = np.flatnonzero(~fixed)
    label = np.zeros(n, np.int64)
    label[free] = np.arange(len(free)) % classes
    label[fixed] = classes + np.arange(fixed.sum())
    k = classes + int(fixed.sum())
    member = np.zeros((n, k))
    member[np.arange(n), label] = 1
    pair = member.T @ table @ member

    def f(x):
        return x * np.log(np.maximum(x, 1))

    for _ in range(SWEEPS):
        moved = 0
        for w in free:
            old = label[w]
            out = np.bincount(label, table[w], k)
            into = np.bincount(label, table[:, w], k)
            loop = table[w, w]
            out[old] -= loop
            into[old] -= loop
            pair[old] -= out
            pair[:, old] -= into
            pair[old, old] -= loop
            left, right = pair.sum(axis=1) + into, pair.sum(axis=0) + out
            gain = (f(pair + out) - f(pair)).sum(axis=1) + (f(pair + into[:, None]) - f(pair)).sum(axis=0)
            diagonal = np.diagonal(pair)
            gain += f(diagonal + out + into + loop) - f(diagonal + out) - f(diagonal + into) + f(diagonal)
            gain -= f(left + out.sum() + loop) - f(left) + f(right + into.sum() + loop) - f(right)
            best = int(np.argmax(gain[:classes]))
            if gain[best] <= gain[old] + 1e-9:
                best = old
            pair[best] += out
            pair[:, best] += into
            pair[best, best] += loop
            label[w] = best
            moved += best != old
        if not moved:
            break
    return label


def neighbour_codes(words: np.ndarray, tokens: np.ndarray, classes: np.ndarray, buckets: int) -> pa.Table:
    """For each word of a slice: how often each class stands to its left and to its right.

    ``classes``: those of ``words``; neighbours with -1 have none and are left out.
    """
    if not len(tokens):
        return pa.table({"bucket": pa.array([], pa.int32()), **{x: pa.array([], pa.binary()) for x in ("words", "sizes", "codes", "ns")}})
    here = classes[tokens]
    left, right = np.concatenate(([END], here[:-1])), np.append(here[1:], -1)
    cells = np.concatenate(((tokens * CODES + left)[left >= 0], (tokens * CODES + (END + 1) + right)[right >= 0]))
    counts = np.bincount(cells, minlength=len(words) * CODES)
    order, bucket = by_bucket(words, buckets)
    used = np.flatnonzero(counts)
    word, code = np.divmod(used, CODES)
    rank = np.empty(len(words), np.int64)
    rank[order] = np.arange(len(words))
    by_rank = np.argsort(rank[word], kind="stable")
    code, n = code[by_rank], counts[used][by_rank]
    sizes = np.bincount(rank[word], minlength=len(words))
    edge = np.concatenate(([0], np.cumsum(sizes)))
    said = sizes > 0
    words, parts = words[order], []
    for b, x, y in spans(bucket):
        own = x + np.flatnonzero(said[x:y])
        if len(own):
            parts.append((b, packed(words[own]), packed(sizes[own], 2), packed(code[edge[x] : edge[y]], 1), packed(n[edge[x] : edge[y]], 5)))
    return pa.table(dict(zip(("bucket", "words", "sizes", "codes", "ns"), (pa.array(x, t) for x, t in zip(zip(*parts), PART_TYPES)))))


def added(words: np.ndarray, seen: pa.Table, codes: int) -> np.ndarray:
    """Counts of each word of a bucket by the code of its neighbours' classes."""
    total = np.zeros(len(words) * codes)
    for w, sizes, code, ns in zip(*(seen.column(x).to_pylist() for x in ("words", "sizes", "codes", "ns"))):
        at = np.repeat(np.searchsorted(words, unpacked(w)), unpacked(sizes, 2).astype(np.int64))
        total[at * codes + unpacked(code, 1).astype(np.int64)] += unpacked(ns, 5)
    return total.reshape(len(words), codes)


def favoured(words: np.ndarray, counts: np.ndarray, near: np.ndarray, scores: np.ndarray) -> np.ndarray:
    """The class that the neighbours of each word favour.

    Words seen once and words whose neighbours are all rare join the rare class.
    """
    solid = (np.arange(len(scores)) % (len(scores) // 2) != RARE).astype(np.float64)
    classes = np.where((counts == 1) | (near @ solid == 0), RARE, (near @ scores).argmax(axis=1))
    classes[words == END_TOKEN] = END
    return classes


def assigned(known: pa.Table, seen: pa.Table, top: np.ndarray, label: np.ndarray, scores: np.ndarray) -> pa.Table:
    """First classes of a bucket: frequent words have theirs, each other takes the one its neighbours favour."""
    if not len(known):
        return pa.table({"bucket": pa.array([], pa.int32()), **{x: pa.array([], pa.binary()) for x in ("words", "counts", "classes")}})
    words = unpacked(known.column("words")[0].as_py())
    counts = unpacked(known.column("counts")[0].as_py()).astype(np.int64)
    classes = favoured(words, counts, added(words, seen, len(scores)), scores)
    frequent = place(words, top, -1)
    classes = np.where(frequent >= 0, np.append(label, 0)[frequent], classes)
    return pa.table(
        {
            "bucket": known.column("bucket"),
            "words": known.column("words"),
            "counts": known.column("counts"),
            "classes": pa.array([packed(classes, 1)], pa.binary()),
        }
    )


def evidence(classed: pa.Table, seen: pa.Table) -> pa.Table:
    """A bucket with the classes of all neighbours of its words, and how often each class follows each.

    ``alone`` and ``members`` are of its rare words: their counts times the logs of these, and how many they are.
    """
    names = ("bucket", "words", "counts", "classes", "sizes", "codes", "ns", "moves", "alone", "members")
    if not len(classed):
        kinds = (pa.int32(), *[pa.binary()] * 7, pa.float64(), pa.int64())
        return pa.table({x: pa.array([], t) for x, t in zip(names, kinds)})
    words, classes = unpacked(classed.column("words")[0].as_py()), unpacked(classed.column("classes")[0].as_py(), 1).astype(np.int64)
    near = added(words, seen, CODES)
    word, code = np.nonzero(near)
    n, left = near[word, code], code <= END
    moves = np.bincount(code[left] * (END + 1) + classes[word[left]], n[left], (END + 1) ** 2)
    blobs = (packed(np.bincount(word, minlength=len(words)), 2), packed(code, 1), packed(n, 5), packed(moves))
    del near, word, code, n, left
    give_back()
    rare = unpacked(classed.column("counts")[0].as_py())[classes == RARE].astype(np.float64)
    told = (*(pa.array([x], pa.binary()) for x in blobs), [float((rare * np.log(rare)).sum())], [len(rare)])
    return pa.table(dict(zip(names, (*(classed.column(x) for x in names[:4]), *told))))


def exchanged(batches, scores: np.ndarray):
    """One exchange step for all words of a bucket, from the classes of all their neighbours."""
    for row in rows_of(batches):
        words, counts = unpacked(row["words"]), unpacked(row["counts"]).astype(np.int64)
        near = np.zeros((len(words), CODES))
        word = np.repeat(np.arange(len(words)), unpacked(row["sizes"], 2).astype(np.int64))
        near[word, unpacked(row["codes"], 1).astype(np.int64)] = unpacked(row["ns"], 5)
        classes = favoured(words, counts, near, scores)
        yield pa.record_batch(
            {
                "bucket": pa.array([row["bucket"]], pa.int32()),
                "words": pa.array([row["words"]], pa.binary()),
                "counts": pa.array([row["counts"]], pa.binary()),
                "classes": pa.array([packed(classes, 1)], pa.binary()),
            }
        )


def pulls(moves: np.ndarray) -> np.ndarray:
    """How much a neighbour of each class speaks for each class: those on the left, then those on the right."""
    table = moves + 0.5
    pull = np.log(table / table.sum(axis=1)[:, None] / table.sum(axis=0)[None, :])
    return np.concatenate((pull[:, :CLASSES], pull[:CLASSES].T))


def information(moves: np.ndarray, alone: float, members: int) -> float:
    """The log likelihood of the tokens learnt from, less what is the same under any classes.

    Classes tell of their neighbours; rare words lose what their own counts would tell, as all weigh the same.
    """

    def f(x):
        return float((x * np.log(np.maximum(x, 1))).sum())

    rare = moves.sum(axis=0)[RARE]
    lost = alone - f(rare) + rare * np.log(max(1, members))
    return f(moves) - f(moves.sum(axis=0)) - f(moves.sum(axis=1)) + f(moves.sum()) - lost


def asked(batches, buckets: int):
    """The words of each slice, dealt into buckets."""
    for row in rows_of(batches):
        words = unpacked(row["words"])
        order, bucket = by_bucket(words, buckets)
        parts = spans(bucket)
        yield pa.record_batch(
            {
                "g": pa.array([row["g"]] * len(parts), pa.int64()),
                "bucket": pa.array([b for b, _, _ in parts], pa.int32()),
                "words": pa.array([packed(words[order[x:y]]) for _, x, y in parts], pa.binary()),
            }
        )


def answers(words: np.ndarray, replies: pa.Table, name: str, width: int, buckets: int) -> np.ndarray:
    """What the buckets told of each word of a slice."""
    blobs = sorted(zip(replies.column("bucket").to_pylist(), replies.column(name).to_pylist()))
    out = np.empty(len(words), np.int64)
    out[by_bucket(words, buckets)[0]] = np.concatenate([unpacked(x, width) for _, x in blobs]).astype(np.int64)
    return out


def seen_by(table: pa.Table, replies: pa.Table, buckets: int) -> pa.Table:
    """The classes around each word of a slice, from the classes that the buckets told."""
    give_back()
    words, tokens = trained(table.to_pylist()[0])
    return neighbour_codes(words, tokens, answers(words, replies, "classes", 1, buckets), buckets)


def told(questions: pa.Table, known: pa.Table) -> pa.Table:
    """Count and class of each word that a group asks for, in the order of its questions."""
    words, counts, classes = np.zeros(0, np.uint64), np.zeros(1, np.int64), np.full(1, RARE)
    if len(known):
        words = unpacked(known.column("words")[0].as_py())
        counts = np.append(unpacked(known.column("counts")[0].as_py()).astype(np.int64), 0)
        classes = np.append(unpacked(known.column("classes")[0].as_py(), 1).astype(np.int64), RARE)
    at = [place(unpacked(x), words, len(words)) for x in questions.column("words").to_pylist()]
    return pa.table(
        {
            "g": questions.column("g"),
            "bucket": questions.column("bucket"),
            "counts": pa.array([packed(counts[x], 5) for x in at], pa.binary()),
            "classes": pa.array([packed(classes[x], 1) for x in at], pa.binary()),
        }
    )


def shares(counts: np.ndarray, classes: np.ndarray, size: np.ndarray, members: np.ndarray) -> np.ndarray:
    """P(word | its class). In the rare class all words weigh the same; the end is alone in its class."""
    share = (counts + 0.5) / (size[classes] + 0.5 * members[classes])
    return np.where(classes == RARE, 1 / members[RARE], np.where(classes == END, 1.0, share))


def looked_up(
    table: pa.Table, replies: pa.Table, buckets: int, train: int, kinds: int, size: np.ndarray, members: np.ndarray, logs: np.ndarray
) -> pa.Table:
    """Unigram score and score of each text of a slice."""
    row = table.to_pylist()[0]
    words, (sizes, tokens) = unpacked(row["words"]), places_of(row)
    counts, classes = answers(words, replies, "counts", 5, buckets), answers(words, replies, "classes", 1, buckets)
    base = np.log10((counts + 0.5) / (train + 0.5 * (kinds + 1)))
    emission = np.log10(shares(counts, classes, size, members))
    here = classes[tokens]
    # Each text ends with an end, so the one before a text's first token is the last of the text before.
    path = logs[np.concatenate(([END], here[:-1])), here]
    first = np.cumsum(sizes) - sizes
    n_known, base_score, score = (np.add.reduceat(x.astype(np.float64), first) for x in ((counts > 0)[tokens], base[tokens], emission[tokens] + path))
    give_back()
    return pa.table(
        {
            "doc_id": unpacked(row["doc_ids"]).view(np.int64),
            "n_tokens": sizes,
            "n_known": n_known.astype(np.int64),
            "base_score": base_score,
            "score": score,
        }
    )


def chances(moves: np.ndarray, members: np.ndarray) -> np.ndarray:
    """P(class | previous class), smoothed by how often each class follows any.

    Classes without a word take no probability; a class nobody was seen in keeps a little.
    """
    open_class = np.where(members > 0, 1.0, 0.0)
    open_class[END] = 1.0
    prior = (moves.sum(axis=0) + 0.5) * open_class
    prior /= prior.sum()
    return (moves + SMOOTHING * prior) / (moves.sum(axis=1, keepdims=True) + SMOOTHING)


def class_model_scores(docs: DataFrame) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) of every document.

    Learns from all documents whose crc32(doc_id as text) mod 5 is not 1. ``score`` is the log10
    probability of the text and its end under the class bigram model, which sums to 1 over all
    training words, the end and one unknown word. Null and empty texts are an end alone; a null
    doc_id is learnt from and comes back as null; repeated rows count and score each; an empty table
    gives no rows, and without training documents all probabilities are those of smoothing. Other
    columns are ignored.

    The frequent words are exchanged one by one on their full bigram table; that is where the rounds
    begin. In a round every word, frequent or not, takes the class that all its neighbours favour by
    theirs. Rounds end when one adds less than the share LEAST_GAIN to the likelihood; the best classes stay.

    Texts become numbers once. Words meet in buckets by hash: each slice of documents asks once for
    each of its words, so a frequent word costs a row per slice. Only the table of the frequent words
    and the class counts reach the driver; both have fixed sizes.
    """
    spark = docs.sparkSession
    docs = columns_of(docs, "doc_id", "text").select(
        F.coalesce(F.col("doc_id").cast("long"), F.lit(NULL_ID)).alias("doc_id"),
        F.col("text").cast("string").alias("text"),
        in_fold(F.col("doc_id")).alias("held_out"),
    )
    buckets = max(1, group_count(docs) // 4)
    with scratch(spark), tidy_shuffles(spark):
        scored, total = learnt_and_scored(docs, buckets)
    return scored.select(
        "doc_id",
        in_fold(F.col("doc_id")).alias("held_out"),
        "n_tokens",
        "n_known",
        F.lit(total).cast("long").alias("train_tokens"),
        "base_score",
        "score",
    )


def learnt_and_scored(docs: DataFrame, buckets: int) -> tuple[DataFrame, int]:
    """(doc_id, n_tokens, n_known, base_score, score) of every document, and how many tokens were learnt from."""
    spark = docs.sparkSession
    texts = cut_lineage(
        docs.mapInArrow(gathered, "g long, doc_ids binary, held binary, sizes binary, words binary, tokens binary"), "texts"
    )
    counts = texts.select("words", "tokens", "sizes", "held").mapInArrow(lambda x: counted(x, buckets), "bucket int, words binary, counts binary")
    pair = "struct<word:long,n:long>"
    known = cut_lineage(
        counts.groupBy("bucket").applyInArrow(
            summed, f"bucket int, words binary, counts binary, distinct long, total long, top array<{pair}>"
        ),
        "words",
    )
    kinds, total = known.agg(F.sum("distinct"), F.sum("total")).first()
    kinds, total = kinds or 0, total or 0
    best = known.select(F.explode("top").alias("t")).select("t.*").orderBy(F.desc("n"), "word").limit(FREQUENT).collect()
    top = np.sort(np.array([r["word"] for r in best], np.int64).view(np.uint64))

    tokens = texts.select("words", "tokens", "sizes", "held")
    near = tokens.mapInArrow(lambda x: frequent_pairs(x, top), "pair long, n long").groupBy("pair").agg(F.sum("n"))
    width = len(top) + 1
    table = np.zeros((width, width))
    for p, n in near.collect():
        table[p // width, p % width] = n
    fixed = np.append(top == END_TOKEN, True)
    label = exchange(table, CLASSES, fixed)
    # The end is always a class of its own; "all others" has no class yet.
    label = np.where(fixed, END, label)[:-1]
    member = np.zeros((width, END + 1))
    member[np.arange(width - 1), label] = 1
    scores = pulls(member.T @ table @ member)

    def around_frequent(batches):
        for row in rows_of(batches):
            words, places = trained(row)
            classes = np.append(label, -1)[place(words, top, -1)]
            yield from neighbour_codes(words, places, classes, buckets).to_batches()

    parts = "bucket int, words binary, sizes binary, codes binary, ns binary"
    bucket = "bucket int, words binary, counts binary, classes binary"
    first = known.select("bucket", "words", "counts").groupBy("bucket").cogroup(tokens.mapInArrow(around_frequent, parts).groupBy("bucket"))
    here = scratch_table(first.applyInArrow(lambda a, b: assigned(a, b, top, label, scores), bucket), "classes")

    def replies(classed: DataFrame) -> DataFrame:
        questions = texts.select("g", "words").mapInArrow(lambda x: asked(x, buckets), "g long, bucket int, words binary")
        return questions.groupBy("bucket").cogroup(classed.groupBy("bucket")).applyInArrow(
            told, "g long, bucket int, counts binary, classes binary"
        )

    own = texts.select("g", "words", "tokens", "sizes", "held")
    kept = before = None
    while True:
        classed = spark.table(here)
        seen = own.groupBy("g").cogroup(replies(classed).select("g", "bucket", "classes").groupBy("g")).applyInArrow(
            lambda a, b: seen_by(a, b, buckets), parts
        )
        around = scratch_table(
            classed.groupBy("bucket").cogroup(seen.groupBy("bucket")).applyInArrow(
                lambda a, b: evidence(a, b), f"{bucket}, sizes binary, codes binary, ns binary, moves binary, alone double, members long"
            ),
            "evidence",
        )
        found = spark.table(around)
        moves = moves_of(found)
        alone, rare = found.agg(F.sum("alone"), F.sum("members")).first()
        now = information(moves, alone or 0.0, rare or 0)
        if kept is None or now > kept[0]:
            if kept is not None:
                drop_table(spark, kept[1])
            kept = now, here, moves
        if before is not None and now <= before + LEAST_GAIN * abs(before):
            break
        if here != kept[1]:
            drop_table(spark, here)
        before, step = now, partial(exchanged, scores=pulls(moves))
        here = scratch_table(found.drop("moves", "alone", "members").mapInArrow(step, bucket), "classes")
        drop_table(spark, around)
    classed, moves = spark.table(kept[1]), kept[2]

    def sizes(batches):
        size, members = np.zeros(END + 1, np.int64), np.zeros(END + 1, np.int64)
        for row in rows_of(batches):
            c = unpacked(row["classes"], 1).astype(np.int64)
            size += np.bincount(c, unpacked(row["counts"]).astype(np.float64), END + 1).astype(np.int64)
            members += np.bincount(c, minlength=END + 1)
        yield pa.record_batch({"c": pa.array(np.arange(END + 1), pa.int64()), "size": size, "members": members})

    size, members = np.zeros(END + 1), np.zeros(END + 1)
    for c, n, m in classed.mapInArrow(sizes, "c long, size long, members long").groupBy("c").agg(F.sum("size"), F.sum("members")).collect():
        size[c], members[c] = n, m
    members[RARE] += 1  # the unknown word
    logs = np.log10(np.maximum(chances(moves, members), 1e-300))

    find = partial(looked_up, buckets=buckets, train=total, kinds=kinds, size=size, members=members, logs=logs)
    scored = texts.drop("held").groupBy("g").cogroup(replies(classed).groupBy("g")).applyInArrow(
        lambda a, b: find(a, b), "doc_id long, n_tokens long, n_known long, base_score double, score double"
    )
    return cut_lineage(scored.withColumn("doc_id", F.nullif("doc_id", F.lit(NULL_ID))), "scores", outlasts=True), total


def moves_of(found: DataFrame) -> np.ndarray:
    """How often each class follows each, over all buckets."""

    def run(batches):
        total = np.zeros((END + 1) ** 2, np.int64)
        for row in rows_of(batches):
            total += unpacked(row["moves"]).astype(np.int64)
        at = np.flatnonzero(total)
        yield pa.record_batch({"pair": pa.array(at, pa.int64()), "n": pa.array(total[at], pa.int64())})

    moves = np.zeros((END + 1) ** 2)
    for p, n in found.select("moves").mapInArrow(run, "pair long, n long").groupBy("pair").agg(F.sum("n")).collect():
        moves[p] = n
    return moves.reshape(END + 1, END + 1)
