"""Split texts at white space and encode each different word once per worker."""

from __future__ import annotations

import re
import sys
import unicodedata
from collections.abc import Callable, Sequence
from functools import lru_cache
from itertools import chain

import numpy as np

#: Fixed values of the tokenizer files: Unicode white space without the four separators that
#: Python's ``split`` adds, and the pre-tokenizer's contractions.
SEPARATORS = re.compile(r"[\x1c-\x1f]")
WHITE_SPACE = r"\t-\r\x20\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
CONTRACTIONS = "'s|'t|'re|'ve|'m|'ll|'d"
UNICODE_SPACE = re.compile(f"[{WHITE_SPACE}]+")
ASCII_PIECES = re.compile(rf"{CONTRACTIONS}|[A-Za-z]+|[0-9]|[^A-Za-z0-9\s]+", re.ASCII)


@lru_cache(maxsize=1)
def _unicode_pieces() -> re.Pattern:
    """Contractions, runs of letters, single numbers, runs of the rest, by Unicode category."""

    def ranges(kind: str) -> str:
        inside = [unicodedata.category(chr(c))[0] == kind for c in range(sys.maxunicode + 1)]
        edges = [c for c in range(len(inside) + 1) if (c < len(inside) and inside[c]) != (c > 0 and inside[c - 1])]
        return "".join(f"\\U{a:08x}-\\U{b - 1:08x}" for a, b in zip(edges[::2], edges[1::2]))

    letter, number = ranges("L"), ranges("N")
    return re.compile(f"{CONTRACTIONS}|[{letter}]+|[{number}]|[^{WHITE_SPACE}{letter}{number}]+")


def pieces(word: str, tokenizer: str) -> list[str]:
    """The pre-tokens of a word as it stands in the text.

    A word with a character that this Python's Unicode tables do not know yet is given to the
    library of the file, whose tables may be newer.
    """
    if word.isascii() and not SEPARATORS.search(word):
        return ASCII_PIECES.findall(word.lower())
    if any(unicodedata.category(c) == "Cn" for c in word):
        library = _library(tokenizer)
        found = library.pre_tokenizer.pre_tokenize_str(library.normalizer.normalize_str(word))
        as_byte = {letter: b for b, letter in enumerate(byte_letters())}
        return [bytes(as_byte[x] for x in piece).decode() for piece, _ in found]
    return _unicode_pieces().findall(normalise(word))


@lru_cache(maxsize=4)
def _library(tokenizer: str):
    from tokenizers import Tokenizer

    return Tokenizer.from_file(tokenizer)


def split_words(text: str) -> list[str]:
    """The runs without Unicode white space."""
    if SEPARATORS.search(text):
        return [w for w in UNICODE_SPACE.split(text) if w]
    return text.split()


def normalise(word: str) -> str:
    """Canonical composition, then lower case character by character (no final-sigma rule)."""
    word = unicodedata.normalize("NFC", word)
    return "".join(map(str.lower, word)) if "Σ" in word else word.lower()


def byte_letters() -> list[str]:
    """The printable letter that byte-level vocabularies use for each byte."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    letters, spare = [""] * 256, 256
    for b in range(256):
        if b in plain:
            letters[b] = chr(b)
        else:
            letters[b], spare = chr(spare), spare + 1
    return letters


class _Codes(dict):
    """Numbers words as they are first asked for, and notes those words."""

    def __init__(self) -> None:
        self.new: list[str] = []

    def __missing__(self, word: str) -> int:
        code = self[word] = len(self)
        self.new.append(word)
        return code


class WordStore:
    """Codes for words, and for each code an array of numbers.

    ``encode`` gets only words that the store does not hold. Beyond ``most`` words the store
    starts afresh, so a worker's memory stays bounded whatever the vocabulary; results do not
    depend on it.
    """

    def __init__(self, encode: Callable[[list[str]], Sequence[Sequence[int]]], most: int = 600_000):
        self.encode, self.most = encode, most
        self._reset()

    def _reset(self) -> None:
        self.codes = _Codes()
        self.values = np.empty(1 << 16, np.uint32)
        self.ends = np.zeros(1 << 14, np.int64)
        self.used = 0

    def look_up(self, texts: list[list[str]]) -> tuple[np.ndarray, np.ndarray]:
        """Codes of all words one after the other, and the number of words of each text."""
        if len(self.codes) > self.most:
            self._reset()
        get = self.codes.__getitem__
        counts = np.fromiter(map(len, texts), np.int64, len(texts))
        codes = np.fromiter(map(get, chain.from_iterable(texts)), np.int64, int(counts.sum()))
        if self.codes.new:
            self._add(self.codes.new)
            self.codes.new = []
        return codes, counts

    def _add(self, new: list[str]) -> None:
        arrays = self.encode(new)
        lengths = np.fromiter(map(len, arrays), np.int64, len(arrays))
        total, first = int(lengths.sum()), len(self.codes) - len(new)
        while self.used + total > len(self.values):
            self.values = np.concatenate([self.values, np.empty_like(self.values)])
        while first + len(new) + 1 > len(self.ends):
            self.ends = np.concatenate([self.ends, np.zeros_like(self.ends)])
        if total:
            self.values[self.used : self.used + total] = np.fromiter(chain.from_iterable(arrays), np.uint32, total)
        self.ends[first + 1 : first + len(new) + 1] = self.used + np.cumsum(lengths)
        self.used += total

    def lengths(self, codes: np.ndarray) -> np.ndarray:
        return self.ends[codes + 1] - self.ends[codes]

    def flatten(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The values of all codes one after the other, and how many each code has."""
        return ragged(self.values, self.ends[codes], self.lengths(codes))


def ragged(values: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``values[start : start + length]`` for all pairs, one after the other."""
    ends = np.cumsum(lengths)
    total = int(ends[-1]) if len(ends) else 0
    places = np.arange(total) + np.repeat(starts - (ends - lengths), lengths)
    return values[places], lengths


def sums(values: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Sums over consecutive groups of ``counts`` values."""
    upto = np.concatenate([[0], np.cumsum(values)])
    ends = np.cumsum(counts)
    return upto[ends] - upto[ends - counts]
