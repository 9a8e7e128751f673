"""String expressions: whitespace strip, pre-token split, question contexts."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from corpusforge.functions.codec import PART

# What Python's str.strip removes, as a regular-expression class that Java and
# RE2 read alike.
STRIP_CLASS = (
    r"[\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]+"
)

# The pre-token classes. A word, a number or a run of other signs takes one blank
# before it; remaining whitespace stands alone. Pre-tokens of a text concatenate to the text.
PRETOKEN_PATTERN = r" ?\p{L}+| ?\p{N}+| ?[^ \t\n\r\f\p{L}\p{N}]+|[ \t\n\r\f]+"

# Fixed value: the public pre-token pattern of 50,257-id byte vocabularies, Unicode classes switched on.
GPT2_PATTERN = r"(?U)'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

# Fixed values, in bytes of UTF-8 read one by one: an ASCII blank, tab or line end behind a sign that
# is neither a control sign nor any other Unicode white space.
CUT_PATTERN = (
    r"(?<=[^\x00-\x20])(?<!\xc2[\x85\xa0])(?<!\xe1\x9a\x80)(?<!\xe2\x80[\x80-\xaf])(?<!\xe2\x81\x9f)(?<!\xe3\x80\x80)"
    r"[ \t\n\r\f]"
)


def strip(text: Column) -> Column:
    """Both ends freed of Unicode whitespace; null counts as empty."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), f"^{STRIP_CLASS}|{STRIP_CLASS}$", "")


def pretokens(text: Column, pattern: str = PRETOKEN_PATTERN) -> Column:
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(pattern), F.lit(0))


def safe_cut(raw: Column, size: Column, i: Column, part: int = PART) -> Column:
    """The first byte place from ``i * part`` on where UTF-8 text may be cut; its end if there is none.

    A cut lies before an ASCII blank, tab or line end that follows another sign: there a pre-token
    begins by either pattern, whatever stands around it. A cut needs up to three bytes before it, so
    none is sought in the first three bytes of a part. Most texts show one nearby, so a little is looked at first.
    """
    at = i * part

    def found(reach: Column) -> Column:
        near = F.decode(F.substring(raw, at.cast("int"), reach.cast("int")), "ISO-8859-1")
        return F.nullif(F.regexp_instr(near, F.lit(CUT_PATTERN)), F.lit(0))

    place = F.coalesce(*[found(F.lit(reach)) for reach in (4096, part + 1, 16 * part)], found(size))
    return F.when(i == 0, F.lit(0).cast("long")).when(at >= size, size).otherwise(F.coalesce(at + place - 2, size))


def question_context(support: Column, question: Column) -> Column:
    """``support + " " + question``, or the bare question where there is no support."""
    s, q = strip(support), strip(question)
    return F.when(s != "", F.concat(s, F.lit(" "), q)).otherwise(q)


def answer_text(answer: Column) -> Column:
    """An answer is tokenised apart from its context, with one blank in front."""
    return F.concat(F.lit(" "), strip(answer))
