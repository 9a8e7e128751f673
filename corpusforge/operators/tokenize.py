"""Documents to token sequences, in the task that reads them: no shuffle."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from corpusforge.functions import codec
from corpusforge.functions.text import GPT2_PATTERN, PRETOKEN_PATTERN, pretokens, safe_cut


@dataclass(frozen=True)
class Tokenizer:
    """``encode`` turns a text column into a token binary; ``eot`` is the document mark's id.

    ``count`` may give the number of ids straight from the text, where that is cheaper.
    """

    encode: Callable[[Column], Column]
    eot: int
    vocab_size: int
    count: Callable[[Column], Column] | None = None


BYTES = Tokenizer(
    encode=codec.byte_tokens,
    eot=codec.BYTE_EOT,
    vocab_size=codec.BYTE_VOCAB,
    count=lambda text: F.octet_length(F.coalesce(text, F.lit(""))),
)


def tokenize(docs: DataFrame, tokenizer: Tokenizer = BYTES) -> DataFrame:
    """(doc_id, n_tokens, tokens): the document mark first, then the text's ids.

    An empty text still yields the mark, and text that looks like a special token is plain text.
    With byte tokens ``n_tokens`` comes from the text's length, so plans that need only counts
    never expand it.
    """
    text = F.col("text")
    tokens = F.concat(codec.const_tokens(tokenizer.eot), tokenizer.encode(text))
    if tokenizer.count is not None:
        n = tokenizer.count(text) + 1
        return docs.select("doc_id", n.cast("long").alias("n_tokens"), tokens.alias("tokens"))
    encoded = docs.select("doc_id", tokens.alias("tokens"))
    return encoded.select(
        "doc_id", codec.n_ids(F.col("tokens")).cast("long").alias("n_tokens"), "tokens"
    )


def text_parts(docs: DataFrame, safe: bool = True, part: int = codec.PART) -> DataFrame:
    """(doc_id, part, raw): long texts in parts of about ``part`` UTF-8 bytes, numbered in order.

    Parts of a text make it up again. ``safe`` cuts where a pre-token begins, so that the pre-tokens
    of the parts are those of the text; else anywhere. Whatever is taken apart below holds a part at
    a time and never a whole long text.
    """
    raw, size = F.col("_raw"), F.octet_length(F.col("_raw")).cast("long")
    # The bytes are made below the explode, once a text, and the explode stays in generated code.
    whole = docs.select("doc_id", F.coalesce(F.col("text"), F.lit("")).cast("binary").alias("_raw"))
    each = whole.select("doc_id", "_raw", F.explode(codec.part_numbers(size, part)).alias("part"))
    i = F.col("part")
    if safe:
        begin, end = safe_cut(raw, size, i, part), safe_cut(raw, size, i + 1, part)
    else:
        begin, end = i * part, F.least((i + 1) * part, size)
    cut = F.substring(raw, (begin + 1).cast("int"), (end - begin).cast("int"))
    rows = each.select("doc_id", "part", cut.alias("raw"))
    return rows.where((i == 0) | (F.octet_length("raw") > 0))


def tokenize_parts(docs: DataFrame, tokenizer: Tokenizer = BYTES, part: int = codec.PART) -> DataFrame:
    """(doc_id, part, n_tokens, tokens): like ``tokenize``, a long text as several rows in order.

    The mark stands before part 0. Joined by part, the tokens of a document are those of ``tokenize``.
    """
    mark = F.when(F.col("part") == 0, codec.const_tokens(tokenizer.eot)).otherwise(F.lit(b""))
    if tokenizer is BYTES:
        coded = codec.pack(F.decode(F.col("raw"), "ISO-8859-1"))
    else:
        coded = tokenizer.encode(F.decode(F.col("raw"), "UTF-8"))
    rows = text_parts(docs, tokenizer is not BYTES, part).select("doc_id", "part", F.concat(mark, coded).alias("tokens"))
    return rows.select("doc_id", "part", codec.n_ids(F.col("tokens")).cast("long").alias("n_tokens"), "tokens")


def token_unigrams(tokenized: DataFrame) -> DataFrame:
    """(token_id, n) over the whole corpus; partial counts keep the shuffle at vocabulary size."""
    return (
        tokenized.select(F.explode(codec.hex_ids(F.col("tokens"))).alias("c"))
        .groupBy("c")
        .agg(F.count(F.lit(1)).alias("n"))
        .select(codec.of_hex(F.col("c")).cast("long").alias("token_id"), "n")
    )


def pretoken_dictionary(docs: DataFrame, pattern: str = PRETOKEN_PATTERN) -> DataFrame:
    """(word, n): every distinct pre-token of the corpus with its count.

    With the library's own patterns long texts are cut first. Another pattern may look further
    around itself, so its texts are split whole.
    """
    text = F.col("text")
    if pattern in (PRETOKEN_PATTERN, GPT2_PATTERN):
        docs, text = text_parts(docs.select(F.lit(None).alias("doc_id"), "text")), F.decode(F.col("raw"), "UTF-8")
    return (
        docs.select(F.explode(pretokens(text, pattern)).alias("word"))
        .groupBy("word")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def check_ids(tokenized: DataFrame, vocab_size: int) -> DataFrame:
    """Fail the job on an id outside the vocabulary; otherwise pass the rows on."""
    if vocab_size > codec.MAX_VOCAB:
        raise ValueError(f"token ids must be below {codec.MAX_VOCAB}")
    if vocab_size == codec.MAX_VOCAB:
        return tokenized  # every two bytes are an id
    bad = F.raise_error(
        F.concat(F.lit("token id outside the vocabulary in doc_id "), F.col("doc_id").cast("string"))
    )
    tokens = F.col("tokens")
    return tokenized.withColumn(
        "tokens", F.when(codec.max_id(tokens) < vocab_size, tokens).otherwise(bad.cast("binary"))
    )
