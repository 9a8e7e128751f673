"""A word-end BPE vocabulary as tables for prefix dynamic programming.

Every prefix of a word has one BPE encoding, so it has one last token. A token that ends at a prefix
is that last token exactly if it may follow the last token of the prefix before it, and two tokens
may stand side by side exactly if undoing their merges, latest first, never meets a merge across
the border that would have come earlier. One pass over the word therefore finds all encodings.
"""

from __future__ import annotations

import functools
import json
import re
import unicodedata
from pathlib import Path

import ahocorasick
import regex
from pyspark.sql import DataFrame
from tokenizers import Regex, normalizers, pre_tokenizers

# Fixed values of the vocabulary's format: pre-token pattern, word end, special tokens.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
WORD_END = "</w>"
SPECIAL = ("<|startoftext|>", "<|endoftext|>")

PIECES = regex.compile(PATTERN)
# The same for lower-case ASCII without white space.
ascii_pieces = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-z]+|[0-9]|[^a-z0-9]+").findall
SPECIALS = regex.compile("(" + "|".join(map(regex.escape, SPECIAL)) + ")")
# Python's split() also cuts at these four, which are ordinary symbols for the pattern.
SEPARATORS = regex.compile("[\x1c-\x1f]")
SPACES = regex.compile(r"[^\s]+")

# Letters up to here are the same in every Unicode version; rarer scripts are normalised and split
# by the tokenizer library, whose tables decide what counts as a letter.
COMMON = regex.compile("[\\x00-\\u024f\\u0370-\\u0373\\u0388-\\u04ff]*")
RARE_PIECES = pre_tokenizers.Split(Regex(PATTERN), "removed", invert=True)
RARE_FORM = normalizers.Sequence([normalizers.NFC(), normalizers.Lowercase()])

MEMO_ENTRIES = 300_000
MEMO_KEY_CHARS = 64


def byte_letters() -> list[str]:
    """The letter that stands for each byte: itself if printable, else the next one from 256 on."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in set(printable)]
    letters = {b: chr(b) for b in printable} | {b: chr(256 + i) for i, b in enumerate(others)}
    return [letters[b] for b in range(256)]


class Memo(dict):
    """Values by key in two generations of bounded size; frequent keys survive a change."""

    def __init__(self, make, most: int = MEMO_ENTRIES):
        super().__init__()
        self.make, self.most, self.old = make, most, {}

    def __missing__(self, key):
        value = self.old.get(key)
        if value is None:
            value = self.make(key)
        if isinstance(key, str) and len(key) > MEMO_KEY_CHARS:
            return value
        if len(self) >= self.most:
            self.old = dict(self)
            self.clear()
        self[key] = value
        return value

    def forget(self) -> None:
        self.clear()
        self.old = {}


def chunks(text: str) -> list[str]:
    """Parts between white space; no token reaches over white space."""
    return SPACES.findall(text) if SEPARATORS.search(text) else text.split()


def normalised(chunk: str) -> str:
    if chunk.isascii():
        return chunk.lower()
    if not COMMON.fullmatch(chunk):
        return RARE_FORM.normalize_str(chunk)
    chunk = unicodedata.normalize("NFC", chunk)
    return chunk.lower() if "Σ" not in chunk else "".join(map(str.lower, chunk))


def pieces(form: str) -> list[str]:
    if COMMON.fullmatch(form):
        return PIECES.findall(form)
    return [piece for piece, _ in RARE_PIECES.pre_tokenize_str(form)]


class Tables:
    def __init__(self, vocabulary: str):
        model = json.loads(vocabulary)["model"]
        added = {t["content"]: t["id"] for t in json.loads(vocabulary)["added_tokens"]}
        ids = model["vocab"]
        self.special = {name: added[name] for name in SPECIAL if name in added}
        self.tokens = {i: token for token, i in (ids | added).items()}
        self.letters = byte_letters()
        self.left, self.right, self.joined, rank = {}, {}, {}, {}
        for order, (a, b) in enumerate(model["merges"]):
            new = ids[a + b]
            self.left[new], self.right[new], self.joined[ids[a], ids[b]] = ids[a], ids[b], new
            rank[new] = order
        self.rank = rank
        self.beside = Memo(lambda pair: self.compatible(*divmod(pair, 1 << 20)))
        self.matches = self._automaton(ids)

    def compatible(self, a: int, b: int, limit: float = float("inf")) -> bool:
        """May ``b`` follow ``a``? Merges across the border count if they come before ``limit``."""
        rank, joined = self.rank, self.joined
        first = limit != float("inf")  # the pair itself is the merge under test
        while True:
            across = joined.get((a, b))
            if across is not None and not first and rank[across] < limit:
                return False
            first = False
            ra, rb = rank.get(a, -1), rank.get(b, -1)
            if ra < 0 and rb < 0:
                return True
            if ra > rb:
                limit, a = ra, self.right[a]
            else:  # of equal merges the left one comes first, so an equal one across would win
                limit, b = rb + 1, self.left[b]

    def _automaton(self, ids: dict[str, int]) -> ahocorasick.Automaton:
        """All tokens that BPE can produce, as matches (length, inside a word, at its end)."""
        real = set(ids.values()) - set(self.rank)
        for token in sorted(self.rank, key=self.rank.get):
            a, b = self.left[token], self.right[token]
            if a in real and b in real and self.compatible(a, b, self.rank[token]):
                real.add(token)
        spelled: dict[str, list[int]] = {}
        for token, i in ids.items():
            if i in real:
                end = token.endswith(WORD_END) and len(token) > len(WORD_END)
                name = token.removesuffix(WORD_END) if end else token
                spelled.setdefault(name, [-1, -1])[end] = i
        automaton = ahocorasick.Automaton()
        for name, (inside, end) in spelled.items():
            automaton.add_word(name, (len(name), inside, end))
        automaton.make_automaton()
        return automaton

    def spell(self, piece: str) -> str:
        if piece.isascii() and piece.isprintable() and " " not in piece:
            return piece  # such bytes stand for themselves
        return "".join(map(self.letters.__getitem__, piece.encode()))

    def parts(self, chunk: str):
        """(piece, special id or None) of a chunk, normalised."""
        for part in SPECIALS.split(chunk) if "<|" in chunk else (chunk,):
            if part in self.special:
                yield part, self.special[part]
            elif part:
                for piece in pieces(normalised(part)):
                    yield piece, None


@functools.lru_cache(2)
def tables(vocabulary: str) -> Tables:
    """Built once per Python worker."""
    return Tables(vocabulary)


def shipped(docs: DataFrame, path: str):
    """The vocabulary file's text, read on the driver and broadcast; its size does not grow with data."""
    return docs.sparkSession.sparkContext.broadcast(Path(path).read_text())
