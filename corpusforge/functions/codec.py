"""Token sequences as binary columns, two bytes per id, high byte first.

That keeps the two bytes per token of the usual on-disk format and every 16-bit id, makes every cut
an O(1) ``substring`` on a binary, joins sequences with ``concat``/``listagg``, sorts like the ids,
and unpacks to ``ARRAY<INT>`` without any Python.
"""

from __future__ import annotations

import struct

from pyspark.sql import Column, functions as F

# Ids are 16-bit numbers.
MAX_VOCAB = 1 << 16

# Byte tokens: ids 0..255 are the byte values, 256 marks the start of a document.
BYTE_EOT = 256
BYTE_VOCAB = 257

# A longer text or sequence is cut into parts of this many bytes or ids before it is taken apart.
PART = 1 << 20


def idiv(a: Column, b) -> Column:
    """Exact integer division, truncating."""
    return F.call_function("div", a, b if isinstance(b, Column) else F.lit(b))


def byte_string(text: Column) -> Column:
    """The UTF-8 bytes of ``text`` as a string with one code point (0..255) per byte."""
    return F.decode(F.encode(F.coalesce(text, F.lit("")), "UTF-8"), "ISO-8859-1")


def pack(chars: Column) -> Column:
    """String of id code points -> token binary; for ids below 55,296, where surrogates begin."""
    return F.encode(chars, "UTF-16BE")


def byte_tokens(text: Column) -> Column:
    """Byte ids of ``text``, without a document mark."""
    return pack(byte_string(text))


def const_tokens(*ids: int) -> Column:
    return F.lit(struct.pack(f">{len(ids)}H", *ids))


def n_ids(tokens: Column) -> Column:
    return idiv(F.octet_length(tokens), 2)


def cut(tokens: Column, start: Column, count: Column) -> Column:
    """``count`` ids from 0-based position ``start``."""
    return F.substring(tokens, (start * 2 + 1).cast("int"), (count * 2).cast("int"))


def last_ids(tokens: Column, count: int) -> Column:
    """The last ``count`` ids; all of them where there are fewer."""
    return F.substring(
        tokens, F.greatest(F.lit(1), F.octet_length(tokens) - (2 * count - 1)), F.lit(2 * count)
    )


def hex_ids(tokens: Column) -> Column:
    """The ids as four hex digits each, which sort like the ids."""
    return F.regexp_extract_all(F.hex(tokens), F.lit("(....)"), F.lit(1))


def of_hex(digits: Column) -> Column:
    return F.conv(digits, 16, 10).cast("int")


def ids(tokens: Column) -> Column:
    """Token binary -> ``ARRAY<INT>``."""
    return F.transform(hex_ids(tokens), of_hex)


def max_id(tokens: Column) -> Column:
    """Largest id of a sequence, -1 when it is empty."""
    return F.coalesce(of_hex(F.array_max(hex_ids(tokens))), F.lit(-1))


def part_numbers(size: Column, part: int = PART) -> Column:
    """0, 1, .. for the parts of something of ``size`` bytes or ids; one part where it is empty."""
    return F.sequence(F.lit(0).cast("long"), idiv(F.greatest(size - 1, F.lit(0)).cast("long"), F.lit(part).cast("long")))


def id_of(two_bytes: Column) -> Column:
    """The id held by a one-id binary."""
    return F.conv(F.hex(two_bytes), 16, 10).cast("long")


def one_id(value: Column) -> Column:
    """An id as a one-id binary."""
    return F.unhex(F.lpad(F.hex(value), 4, "0"))


def ngrams(tokens: Column, position: Column) -> Column:
    """The id at 0-based ``position`` (>= 1) with the up to two ids before it: 4 or 6 bytes.

    One ``substring`` per target keeps n-gram extraction inside generated code.
    """
    start = F.greatest(F.lit(1), position * 2 - 3)
    return F.substring(tokens, start, F.when(position >= 2, 6).otherwise(4))


def target_positions(tokens: Column, first: Column) -> Column:
    """0-based positions ``max(first, 1)`` .. end of a sequence; null when there is none."""
    start = F.greatest(first, F.lit(1)).cast("int")
    last = (n_ids(tokens) - 1).cast("int")
    return F.when(start <= last, F.sequence(start, last))
