"""Online packing of documents into windows by the sum-of-squares rule.

A document's ids, with the end id behind them, are cut at multiples of the window; the full pieces
are windows of their own. The rest is placed into an open window (or a new one) such that the sum
of squares of the level array, which counts the open windows at each fill, becomes smallest. Each
task packs the documents of its partition, without a shuffle. When the partition ends, the windows
still open are closed by cutting pieces of the emptiest into the gaps of the fullest; the last
one is cut into sequences whose lengths are powers of two, which need no padding.
"""

from __future__ import annotations

import json
import os
import re
import zlib
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgermap.llm.common import CHUNK_CHARS, _arrow, ship, slices
from ledgermap.llm.words import byte_letters

#: Open windows of a task; at this number they are closed as at the end of the partition.
MOST_OPEN = 4096

Piece = tuple[int | None, int, np.ndarray, int]  # document, start, ids, tokens of the document


class Packer:
    """The level array of one task. ``closed`` holds (sequence number, pieces in their order)."""

    def __init__(self, window: int):
        self.window = window
        self.levels = np.zeros(window + 1, np.int64)
        self.open: list[list[tuple[int, list[Piece]]]] = [[] for _ in range(window + 1)]
        self.closed: list[tuple[int, list[Piece]]] = []
        self.sequences = self.opened = 0

    def _number(self) -> int:
        self.sequences += 1
        return self.sequences - 1

    def add(self, doc: int | None, ids: np.ndarray) -> None:
        size, window = len(ids), self.window
        whole = size - size % window
        for start in range(0, whole, window):
            self.closed.append((self._number(), [(doc, start, ids[start : start + window], size)]))
        if whole < size:
            self._place((doc, whole, ids[whole:], size))
            if self.opened >= MOST_OPEN:
                self.finish()

    def _place(self, piece: Piece) -> None:
        size, levels = len(piece[2]), self.levels
        # change of the sum for every level h that leaves room; h = 0 opens a window, and what
        # becomes full or empty is not counted at its new level
        change = 2 * (levels[size:] - levels[: len(levels) - size] + 1)
        change[0] = 2 * levels[size] + 1
        change[-1] -= 1
        change[1:][levels[1 : len(levels) - size] == 0] = np.iinfo(np.int64).max
        level = len(change) - 1 - int(np.argmin(change[::-1]))
        if level:
            number, pieces = self.open[level].pop()
            levels[level] -= 1
            self.opened -= 1
        else:
            number, pieces = self._number(), []
        pieces.append(piece)
        filled = level + size
        if filled == self.window:
            self.closed.append((number, pieces))
        else:
            self.open[filled].append((number, pieces))
            levels[filled] += 1
            self.opened += 1

    def finish(self) -> None:
        """Close all open windows without padding."""
        left = [(fill, *w) for fill in range(self.window, 0, -1) for w in self.open[fill]]
        low = len(left) - 1
        for at, (fill, number, pieces) in enumerate(left):
            if at > low:
                break
            while fill < self.window and low > at:
                rest, low_number, source = left[low]
                doc, start, ids, size = source.pop()
                part = min(len(ids), self.window - fill)
                if part < len(ids):
                    source.append((doc, start, ids[:-part], size))
                pieces.append((doc, start + len(ids) - part, ids[len(ids) - part :], size))
                fill += part
                left[low] = (rest - part, low_number, source)
                if rest == part:
                    low -= 1
            if fill == self.window:
                self.closed.append((number, pieces))
            else:
                self._powers_of_two(number, pieces, fill)
        self.levels[:] = 0
        self.open = [[] for _ in range(self.window + 1)]
        self.opened = 0

    def _powers_of_two(self, number: int, pieces: list[Piece], fill: int) -> None:
        while fill:
            room, sequence = 1 << (fill.bit_length() - 1), []
            fill -= room
            while room:
                doc, start, ids, size = pieces.pop(0)
                if len(ids) > room:
                    pieces.insert(0, (doc, start + room, ids[room:], size))
                    ids = ids[:room]
                sequence.append((doc, start, ids, size))
                room -= len(ids)
            self.closed.append((number, sequence))
            number = self._number() if fill else number


# Fixed value: the pattern of byte-level pre-tokenization.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: The faster library cannot match longer runs of white space.
LONG_SPACE = re.compile(r"\s{2048}")


class Encoder:
    """Ids of texts as the tokenizers library gives them for a file, with its added tokens split off first.

    Where the file is plain byte-level BPE whose ids rise with the merges, a faster library with the
    same vocabulary encodes the text between added tokens.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        with open(path, encoding="utf-8") as file:
            self.fast = _fast(json.load(file))
        added = {t.content: i for i, t in self.library.get_added_tokens_decoder().items()}
        self.added = {text: np.array([i], np.uint32) for text, i in added.items()}
        # of tokens that start at the same place the longest counts
        either = "|".join(map(re.escape, sorted(added, key=len, reverse=True)))
        self.border = re.compile(f"({either})") if added else None

    def __call__(self, text: str) -> np.ndarray:
        if self.fast is None:
            return self._slow(text)
        if self.border and self.border.search(text):
            parts = [self.added.get(p) if i % 2 else self._plain(p) for i, p in enumerate(self.border.split(text))]
            return np.concatenate(parts)
        return self._plain(text)

    def _plain(self, text: str) -> np.ndarray:
        if LONG_SPACE.search(text):
            return self._slow(text)
        return np.array(self.fast(text), np.uint32)

    def _slow(self, text: str) -> np.ndarray:
        return np.array(self.library.encode(text, add_special_tokens=False).ids, np.uint32)


def _fast(file: dict) -> Callable[[str], list[int]] | None:
    model, added = file["model"], file["added_tokens"]
    before = file["pre_tokenizer"] or {}
    plain = (
        model["type"] == "BPE"
        and before.get("type") == "ByteLevel"
        and before.get("use_regex")
        and not before.get("add_prefix_space")
        and not file["normalizer"]
        and not any(t["lstrip"] or t["rstrip"] or t["single_word"] for t in added)
        and not any(model.get(k) for k in ("continuing_subword_prefix", "end_of_word_suffix", "dropout", "ignore_merges"))
    )
    if not plain:
        return None
    import tiktoken

    as_byte = {letter: b for b, letter in enumerate(byte_letters())}
    names = {t["content"] for t in added}
    ranks = {bytes(as_byte[c] for c in token): i for token, i in model["vocab"].items() if token not in names}
    pairs = [pair.split(" ") if isinstance(pair, str) else pair for pair in model["merges"]]
    merged = [model["vocab"][a + b] for a, b in pairs]
    if merged != sorted(merged) or len(ranks) != 256 + len(merged):
        return None
    return tiktoken.Encoding("plain", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary


@lru_cache(maxsize=4)
def _encoder(path: str) -> Encoder:
    return Encoder(path)


def pack(
    docs: DataFrame,
    tokenizer: str,
    window: int = 1024,
    end_id: int = 0,
    id_col: str = "doc_id",
    text_col: str = "text",
    digest: bool = False,
) -> DataFrame:
    """One row per piece: ``doc_id, start, length, doc_tokens, sequence_id, offset`` and its ``ids``.

    With ``digest`` the column ``ids_crc32`` (of the ids as little-endian 32-bit integers) takes
    the place of ``ids``. A null or empty text is its end id alone; an empty table gives no
    sequences. Repeated rows and null ids are packed like any others, texts of any length are cut,
    further columns are ignored whatever their names. ``sequence_id`` is unique over all tasks;
    a retried task makes the same sequences from the same rows.
    """
    ship(docs.sparkSession)
    rows = docs.select(
        F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text")
    )
    last = "ids_crc32 long" if digest else "ids array<int>"
    schema = f"doc_id long, start long, length long, doc_tokens long, sequence_id long, offset long, {last}"
    arrow_schema = _arrow(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        first = TaskContext.get().partitionId() << 32
        packer, encode = Packer(window), _encoder(tokenizer)

        def closed() -> pa.RecordBatch:
            out: list[list] = [[] for _ in arrow_schema]
            for number, pieces in packer.closed:
                offset = 0
                for doc, start, ids, size in pieces:
                    content = zlib.crc32(ids.astype("<u4").tobytes()) if digest else ids.astype(np.int32)
                    for column, value in zip(out, (doc, start, len(ids), size, first + number, offset, content)):
                        column.append(value)
                    offset += len(ids)
            packer.closed = []
            columns = [pa.array(c, type=f.type) for c, f in zip(out, arrow_schema)]
            return pa.RecordBatch.from_arrays(columns, schema=arrow_schema)

        for batch in batches:
            for piece in slices(batch, CHUNK_CHARS):
                for doc, text in zip(piece.column(0).to_pylist(), piece.column(1).to_pylist()):
                    packer.add(doc, np.append(encode(text), np.uint32(end_id)))
                yield closed()
        packer.finish()
        yield closed()

    return rows.mapInArrow(run, schema)
