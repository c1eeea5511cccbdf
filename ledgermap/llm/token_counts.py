"""Token counts by rank-synchronous merging of ragged arrays.

All pre-tokens of a batch lie one after the other in one array of symbols. In each round every
pre-token finds its pair of lowest rank, and all those pairs merge at the same time; what cannot
merge any more leaves the arrays. A count is the number of symbols that survive. Merging a pair
everywhere at once equals merging it place by place, because no merge of the file makes a symbol
that an earlier merge uses (``Merges`` checks this).
"""

from __future__ import annotations

import json
import re
from functools import lru_cache

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgermap.llm.common import arrow_rows
from ledgermap.llm.words import WordStore, byte_letters, pieces, split_words, sums

NONE = np.int64(1 << 40)


class Merges:
    """Merge ranks of a byte-level vocabulary file with an end-of-word suffix, as sorted arrays."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            content = json.load(file)
        self.path, model = path, content["model"]
        vocab, suffix = model["vocab"], model["end_of_word_suffix"]
        pairs = [p.split(" ") if isinstance(p, str) else p for p in model["merges"]]
        left = np.array([vocab[a] for a, _ in pairs])
        right = np.array([vocab[b] for _, b in pairs])
        made = np.array([vocab[a + b] for a, b in pairs])
        self.base = np.array([vocab[x] for x in byte_letters()])
        self.last = np.array([vocab[x + suffix] for x in byte_letters()])
        self.width = int(max(vocab.values())) + 1
        keys = left * self.width + right
        self.order = np.argsort(keys)
        self.keys, self.made = keys[self.order], made
        born = np.full(self.width, -1)
        born[made] = np.arange(len(pairs))
        in_order = np.maximum(born[left], born[right]) < np.arange(len(pairs))
        if len(set(made.tolist())) < len(made) or not in_order.all():
            raise ValueError("a merge uses a symbol that a later merge makes")
        self.specials = re.compile("|".join(re.escape(x["content"]) for x in content["added_tokens"]))

    def ranks(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        keys = a * self.width + b
        places = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return np.where(self.keys[places] == keys, self.order[places], NONE)


@lru_cache(maxsize=4)
def merges(path: str) -> Merges:
    return Merges(path)


def survivors(parts: list[bytes], table: Merges) -> np.ndarray:
    """Number of symbols left of each (not empty) piece when no pair can merge any more."""
    counts = np.fromiter(map(len, parts), np.int64, len(parts))
    data = np.frombuffer(b"".join(parts), np.uint8)
    symbols, ends = table.base[data], np.cumsum(counts)
    symbols[ends - 1] = table.last[data[ends - 1]]
    owner = np.repeat(np.arange(len(parts)), counts)
    result = counts.copy()
    rank = np.full(len(symbols), NONE)

    def look_up(places: np.ndarray) -> None:
        inside = places[(places >= 0) & (places + 1 < len(symbols))]
        inside_next = inside + 1
        found = table.ranks(symbols[inside], symbols[inside_next])
        rank[inside] = np.where(owner[inside] == owner[inside_next], found, NONE)

    look_up(np.arange(len(symbols) - 1))
    while len(symbols):
        starts = np.flatnonzero(np.concatenate([[True], owner[1:] != owner[:-1]]))
        sizes = np.diff(np.concatenate([starts, [len(symbols)]]))
        best = np.minimum.reduceat(rank, starts)
        result[owner[starts]] = sizes
        chosen = np.flatnonzero((rank == np.repeat(best, sizes)) & (rank < NONE))
        if not len(chosen):
            break
        # of overlapping pairs (a run of one symbol) every other one merges, from the left
        new_run = np.concatenate([[True], chosen[1:] != chosen[:-1] + 1])
        run_start = chosen[new_run][np.cumsum(new_run) - 1]
        chosen = chosen[(chosen - run_start) % 2 == 0]
        symbols[chosen] = table.made[rank[chosen]]
        keep = np.repeat(best < NONE, sizes)
        keep[chosen + 1] = False
        moved = np.cumsum(keep) - 1
        symbols, owner, rank = symbols[keep], owner[keep], rank[keep]
        if len(symbols):
            rank[-1] = NONE
        changed = moved[chosen]
        look_up(changed)
        look_up(changed - 1)
    return result


def count_words(words: list[str], table: Merges) -> np.ndarray:
    """Tokens of each word (a run without white space)."""
    found: list[bytes] = []
    owners: list[int] = []
    whole = np.zeros(len(words), np.int64)
    for i, word in enumerate(words):
        parts = [word]
        if "<|" in word:
            parts = table.specials.split(word)
            whole[i] = len(parts) - 1
        for part in parts:
            for piece in pieces(part, table.path):
                found.append(piece.encode())
                owners.append(i)
    if found:
        np.add.at(whole, owners, survivors(found, table))
    return whole


@lru_cache(maxsize=4)
def _store(path: str) -> WordStore:
    return WordStore(lambda words: count_words(words, merges(path)).reshape(-1, 1))


def token_counts(
    docs: DataFrame, tokenizer: str, limit: int = 2048, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``doc_id, n_bytes, n_tokens, over_limit`` of every row.

    ``tokenizer`` is the path of a vocabulary file on every machine. A null text counts as empty:
    no bytes, no tokens. Repeated rows, null ids and further columns of any name are allowed; a
    text of any length is read whole. Each worker keeps a bounded store of words already counted.
    """
    rows = docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        F.coalesce(F.octet_length(text_col), F.lit(0)).cast("long").alias("n_bytes"),
        F.coalesce(F.col(text_col), F.lit("")).alias("text"),
    )

    def work(columns: list, part: int) -> dict:
        ids, sizes, texts = columns
        store = _store(tokenizer)
        codes, counts = store.look_up([split_words(t) for t in texts])
        tokens = sums(store.flatten(codes)[0].astype(np.int64), counts)
        return {"doc_id": ids, "n_bytes": sizes, "n_tokens": tokens, "over_limit": tokens > limit}

    return arrow_rows(rows, work, "doc_id long, n_bytes long, n_tokens long, over_limit boolean")
