"""Byte-pair encoding and decoding with a deterministic tokenization automaton.

The automaton reads tokens. It starts with one state in which every byte symbol loops. Each merge
(u, v) in turn applies one gadget: the state behind u is copied, the copy loses its arc v, all
arcs u now lead to the copy, and wherever u can be read the new token uv can be read too and leads
where v led. What the finished automaton accepts are exactly the sequences that byte-pair
encoding produces, so of all ways to cut a word there is one accepted path.

Tokens are numbered so that a gadget takes one run of numbers away: a state that loses v can never
read the tokens that later merges build onto v, and these stand right behind v when the later ones
come first. A row of the transition table holds the borders of the runs that its state lost, as a
sorted array; tokens share the row of the same state, and a gadget copies it before it changes it.
The table is whole after the last merge. All that is left to do for a word is to look borders up.

A start of an encoding is the encoding of a start of the word, so each position of a word has one
state. Going from left to right, every token that begins at a position is spelled by the letter
table and tried on the row of that position's state; if the row has it, it names the state of the
position behind it. The path is read off at the end. Nothing is tried twice or taken back.
"""

from __future__ import annotations

import hashlib
import json
import re
from array import array
from bisect import bisect_left, bisect_right
from functools import lru_cache

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgermap.llm.common import arrow_rows
from ledgermap.llm.words import WordStore, byte_letters, pieces, ragged, split_words


class Automaton:
    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            content = json.load(file)
        self.path, model = path, content["model"]
        self.vocab: dict[str, int] = dict(model["vocab"])
        self.suffix = model["end_of_word_suffix"] or ""
        self.letters = byte_letters()
        added = {x["content"]: x["id"] for x in content["added_tokens"]}
        self.added = added
        self.specials = re.compile("(" + "|".join(map(re.escape, added)) + ")") if added else None
        size = max([*self.vocab.values(), *added.values()]) + 1
        merges = []
        for pair in model["merges"]:
            left, right = pair.split(" ") if isinstance(pair, str) else pair
            merges.append((self.vocab[left], self.vocab[right], self.vocab[left + right]))
        self._number(merges, size)
        #: Row of the state behind a token, and whether any text leads to the token.
        self.rows, self.made = [array("i")] * size, [False] * size
        for token, i in self.vocab.items():
            self.made[i] = len(self._letters(token)) == 1
        for rank, (u, v, merged) in enumerate(merges):
            self._gadget(rank, u, v, merged)
        self._spell()
        names = {i: t for t, i in [*self.vocab.items(), *added.items()]}
        labels = [names.get(i, "").encode() for i in range(size)]
        self.label_sizes = np.array([len(x) for x in labels], np.int64)
        self.label_starts = np.cumsum(self.label_sizes) - self.label_sizes
        self.label_bytes = np.frombuffer(b"".join(labels), np.uint8)

    def _number(self, merges: list[tuple[int, int, int]], size: int) -> None:
        """Number the tokens: behind each token those that merges build onto it, later ones first."""
        #: Number of a token, merge that made it, and what merges built onto it in descending order,
        #: as (-merge, number) with the end of the run of numbers last.
        self.number, self.born = [0] * size, [-1] * size
        onto: list[list[int]] = [[] for _ in range(size)]
        for rank, (u, _, merged) in enumerate(merges):
            if self.born[merged] >= 0:
                raise ValueError("two merges make the same token")
            self.born[merged] = rank
            onto[u].append(merged)
        stack, order = [t for t in range(size) if self.born[t] < 0], []
        while stack:
            token = stack.pop()
            self.number[token] = len(order)
            order.append(token)
            stack += onto[token]
        count = [1] * size
        for token in reversed(order):
            for child in onto[token]:
                count[token] += count[child]
        self.end = [self.number[t] + count[t] for t in range(size)]
        self.onto = onto

    def _run(self, token: int, rank: int) -> tuple[int, int]:
        """The numbers of a token and of all that merge ``rank`` and later ones build onto it."""
        built = self.onto[token]
        older = bisect_left(built, rank, key=self.born.__getitem__)
        return self.number[token], self.number[built[older - 1]] if older else self.end[token]

    def _gadget(self, rank: int, u: int, v: int, merged: int) -> None:
        if not (self.made[u] and self.made[v] and self.step(u, v)):
            return  # the two never meet
        led_to, row, (first, end) = self.rows[v], self.rows[u], self._run(v, rank)
        i, j = bisect_left(row, first), bisect_right(row, end)
        borders = ([] if i % 2 else [first]) + ([] if j % 2 else [end])
        self.rows[u] = row[:i] + array("i", borders) + row[j:]
        self.rows[merged], self.made[merged] = led_to, True

    def step(self, before: int, token: int) -> bool:
        """Whether the state behind ``before`` has an arc ``token``."""
        return not bisect_right(self.rows[before], self.number[token]) & 1

    def _letters(self, token: str) -> str:
        return token.removesuffix(self.suffix) or token

    def _spell(self) -> None:
        """The letter table: from a node and a letter to a node, and the token that ends in a node."""
        self.letter_table: dict[tuple[int, str], int] = {}
        self.token_at, self.last_token_at = [-1], [-1]
        for token, i in self.vocab.items():
            if not self.made[i]:
                continue
            last, node = bool(self.suffix) and token.endswith(self.suffix), 0
            for letter in self._letters(token):
                key = (node, letter)
                node = self.letter_table.get(key, 0)
                if not node:
                    node = self.letter_table[key] = len(self.token_at)
                    self.token_at.append(-1)
                    self.last_token_at.append(-1)
            if last:
                self.last_token_at[node] = i
            else:
                self.token_at[node] = i
        if not self.suffix:
            self.last_token_at = self.token_at

    def encode_piece(self, piece: str) -> list[int]:
        """Tokens of one pre-token, given in byte letters."""
        size, table = len(piece), self.letter_table.get
        rows, number = self.rows, self.number
        #: Token before a position, by which the state there is known, and where it begins.
        before, begins = [-1] * (size + 1), [0] * (size + 1)
        for at in range(size):
            row = rows[before[at]] if at else ()
            node, names = 0, self.token_at
            for end in range(at + 1, size + 1):
                node = table((node, piece[end - 1]))
                if node is None:
                    break
                if end == size:
                    names = self.last_token_at
                token = names[node]
                if token >= 0 and before[end] < 0 and not bisect_right(row, number[token]) & 1:
                    before[end], begins[end] = token, at
        path, at = [], size
        while at:
            if before[at] < 0:
                raise ValueError("no path through the automaton")
            path.append(before[at])
            at = begins[at]
        return path[::-1]

    def encode_word(self, word: str) -> list[int]:
        """Tokens of a run without white space."""
        parts = self.specials.split(word) if self.specials and "<|" in word else [word]
        out: list[int] = []
        for i, part in enumerate(parts):
            if i % 2:
                out.append(self.added[part])
                continue
            for piece in pieces(part, self.path):
                if piece.isascii() and piece.isprintable():
                    out += self.encode_piece(piece)
                else:
                    out += self.encode_piece("".join([self.letters[b] for b in piece.encode()]))
        return out

    def encode(self, text: str) -> list[int]:
        return [t for word in split_words(text) for t in self.encode_word(word)]

    def decode(self, ids: np.ndarray) -> bytes:
        """Labels of the arcs, joined by blanks as the file (which names no decoder) has it."""
        if not len(ids):
            return b""
        data, sizes = ragged(self.label_bytes, self.label_starts[ids], self.label_sizes[ids])
        out = np.full(len(data) + len(ids), 32, np.uint8)
        out[np.arange(len(data)) + np.repeat(np.arange(len(ids)), sizes)] = data
        return out[:-1].tobytes()


@lru_cache(maxsize=4)
def automaton(path: str) -> Automaton:
    return Automaton(path)


@lru_cache(maxsize=4)
def _store(path: str) -> WordStore:
    compiled = automaton(path)
    return WordStore(lambda words: [compiled.encode_word(w) for w in words])


def _token_arrays(texts: list[str], tokenizer: str) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all texts one after the other, and the first and last position of each text's."""
    store = _store(tokenizer)
    codes, counts = store.look_up([split_words(t) for t in texts])
    ids, sizes = store.flatten(codes)
    upto = np.concatenate([[0], np.cumsum(sizes)])
    bounds = upto[np.concatenate([[0], np.cumsum(counts)])]
    return ids, bounds


def encode(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, ids`` (array of int) of every row.

    A null text counts as empty and has no ids. Repeated rows, null document ids, texts of any
    length and further columns of any name are allowed.
    """

    def work(columns: list, part: int) -> dict:
        ids, bounds = _token_arrays(columns[1], tokenizer)
        ids = ids.astype(np.int32)
        return {"doc_id": columns[0], "ids": [ids[a:b] for a, b in zip(bounds, bounds[1:])]}

    return arrow_rows(_rows(docs, id_col, text_col), work, "doc_id long, ids array<int>")


def decode(encoded: DataFrame, tokenizer: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """``doc_id, text`` from arrays of ids; a null or empty array gives an empty text."""
    rows = encoded.select(
        F.col(id_col).cast("long").alias("doc_id"),
        F.coalesce(F.col(ids_col), F.array().cast("array<int>")).alias("ids"),
        F.lpad(F.lit(""), 1, " ").alias("size"),
    )

    def work(columns: list, part: int) -> dict:
        compiled = automaton(tokenizer)
        texts = [compiled.decode(np.array(x, np.int64)).decode("utf-8", "replace") for x in columns[1]]
        return {"doc_id": columns[0], "text": texts}

    return arrow_rows(rows, work, "doc_id long, text string", max_chars=500)


def round_trip(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256``: encode and decode in one pass over the texts.

    Only digests leave the tasks. Nulls and odd rows are treated as in ``encode``.
    """

    def work(columns: list, part: int) -> dict:
        compiled = automaton(tokenizer)
        ids, bounds = _token_arrays(columns[1], tokenizer)
        own = [ids[a:b] for a, b in zip(bounds, bounds[1:])]
        return {
            "doc_id": columns[0],
            "n_tokens": np.diff(bounds),
            "ids_sha256": [hashlib.sha256(x.astype("<u4").tobytes()).hexdigest() for x in own],
            "decoded_sha256": [hashlib.sha256(compiled.decode(x)).hexdigest() for x in own],
        }

    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    return arrow_rows(_rows(docs, id_col, text_col), work, schema)


def _rows(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(
        F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text")
    )
