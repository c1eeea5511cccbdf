"""Exact duplicates by deterministic block naming.

A normalised text is cut into blocks of fixed size. Equal blocks, and only those, get the same
integer name: the blocks are sorted and numbered. Then adjacent names are paired and the pairs are
sorted and numbered the same way, until each document has one name. Two documents with equally
many blocks and the same name are equal character by character; no hash decides.

A task names its own blocks first, so a block that fills many documents is sorted once per task.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgermap.llm.common import ASCII_SPACE, CHUNK_CHARS, _arrow, drop_stored, ship, slices, stored, text_key

BLOCK_BYTES = 4096
#: Bytes of blocks that a task keeps in order to name them once; then it starts anew.
KEPT_BYTES = 48_000_000

_ROWS = "row long, doc_id long, key binary, points long, text_sha256 string, names array<long>, local long, block binary"


def _cut(docs: DataFrame, id_col: str, text_col: str, block_bytes: int, keys: bool) -> DataFrame:
    """Rows of documents with the task's own names of their blocks, and rows of named blocks."""
    schema = _arrow(_ROWS)
    rows = docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        (text_key(F.col(text_col)) if keys else F.lit(None).cast("binary")).alias("key"),
        F.coalesce(F.col(text_col), F.lit("")).alias("text"),
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        row = local = TaskContext.get().partitionId() << 40
        named: dict[bytes, int] = {}
        held = 0
        for batch in batches:
            for piece in slices(batch, CHUNK_CHARS):
                out: list[tuple] = []
                for doc, key, text in zip(*(c.to_pylist() for c in piece.columns)):
                    data = text.encode().translate(None, ASCII_SPACE)
                    names = []
                    for start in range(0, max(len(data), 1), block_bytes):
                        block = data[start : start + block_bytes]
                        name = named.get(block)
                        if name is None:
                            if held > KEPT_BYTES:
                                named.clear()
                                held = 0
                            name = named[block] = local
                            held += len(block) + 100
                            out.append((None, None, None, None, None, None, local, block))
                            local += 1
                        names.append(name)
                    out.append((row, doc, key, len(text), hashlib.sha256(data).hexdigest(), names, None, None))
                    row += 1
                columns = [pa.array(c, type=f.type) for c, f in zip(zip(*out), schema)]
                yield pa.RecordBatch.from_arrays(columns, schema=schema)

    return rows.mapInArrow(run, _ROWS)


def _name_blocks(blocks: DataFrame) -> DataFrame:
    """``local, name``: position of the block among the different blocks in sorted order.

    Equal blocks meet in one partition; the partition's number precedes the position.
    """
    schema = _arrow("local long, name long")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        name, before = (TaskContext.get().partitionId() << 40) - 1, None
        for batch in batches:
            names = []
            for block in batch.column(1):
                block = block.as_py()
                if block != before:
                    name, before = name + 1, block
                names.append(name)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(names, pa.int64())], schema=schema)

    return blocks.repartition("block").sortWithinPartitions("block").mapInArrow(run, "local long, name long")


def _identities(docs: DataFrame, parts: DataFrame) -> DataFrame:
    """``row, blocks, name`` with one name for each document."""
    made = [stored(_name_blocks(parts.filter("local IS NOT NULL").select("local", "block")))]
    level = stored(
        docs.select("row", F.size("names").alias("blocks"), F.posexplode("names").alias("place", "local"))
        .join(made[0], "local")
        .select("row", "blocks", "place", F.col("blocks").alias("left"), "name")
    )
    made.append(level)
    done = [level.filter("left = 1")]
    most = level.agg(F.max("left")).first()[0] or 1
    while most > 1:
        pairs = stored(
            level.filter("left > 1")
            .groupBy("row", "blocks", "left", F.expr("place DIV 2").cast("int").alias("pair"))
            .agg(
                F.max(F.when(F.col("place") % 2 == 0, F.col("name"))).alias("first"),
                F.coalesce(F.max(F.when(F.col("place") % 2 == 1, F.col("name"))), F.lit(-1)).alias("second"),
            )
        )
        names = stored(
            pairs.select("first", "second")
            .distinct()
            .sortWithinPartitions("first", "second")
            .withColumn("name", F.monotonically_increasing_id())
        )
        level = stored(
            pairs.join(names, ["first", "second"]).select(
                "row", "blocks", F.col("pair").alias("place"), F.expr("(left + 1) DIV 2").cast("int").alias("left"), "name"
            )
        )
        made += [pairs, names, level]
        done.append(level.filter("left = 1"))
        most = (most + 1) // 2
    result = done[0]
    for more in done[1:]:
        result = result.unionByName(more)
    result = stored(result.select("row", "blocks", "name"))
    drop_stored(*made)
    return result


def exact_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", block_bytes: int = BLOCK_BYTES
) -> DataFrame:
    """``doc_id, keep_id, group_size, kept, text_sha256``, one row per row of ``docs``.

    Texts are equal when identical without ``[\\x20\\x09-\\x0D]``; null counts as empty. Of equal
    texts the row with the most code points stays, then the smallest id, then the first row; so of
    repeated rows one is kept. Null ids come last. Further columns are ignored; an empty table
    gives an empty result.
    """
    return _decided(docs, id_col, text_col, block_bytes).drop("key")


def _decided(docs: DataFrame, id_col: str, text_col: str, block_bytes: int = BLOCK_BYTES, keys: bool = False) -> DataFrame:
    """The result of ``exact_duplicates`` and ``key``, which is null unless asked for."""
    ship(docs.sparkSession)
    parts = stored(_cut(docs, id_col, text_col, block_bytes, keys))
    rows = parts.filter("local IS NULL").drop("local", "block")
    named = rows.drop("names").join(_identities(rows, parts), "row")
    groups = named.groupBy("blocks", "name").agg(
        F.count("*").alias("group_size"),
        F.max(F.struct("points", -F.col("doc_id"), -F.col("row"))).alias("best"),
    )
    return named.join(groups, ["blocks", "name"]).select(
        "doc_id",
        "key",
        (-F.col("best")["col2"]).alias("keep_id"),
        "group_size",
        (F.col("row") == -F.col("best")["col3"]).alias("kept"),
        "text_sha256",
    )


def drop_exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` without the rows that ``exact_duplicates`` does not keep; all columns stay."""
    return keep_rows(docs, stored(_decided(docs, id_col, text_col, keys=True)), id_col, text_col)


def keep_rows(docs: DataFrame, decided: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Rows of ``docs`` whose id and text have a row ``kept`` in ``decided``.

    The ids and keys that go are joined, not the texts that stay. Of rows with one id and the same
    text one stays.
    """
    pairs = decided.groupBy("doc_id", "key").agg(F.max("kept").alias("kept"), F.count("*").alias("rows"))
    names = F.col("doc_id").alias("_llm_id"), F.col("key").alias("_llm_key")
    gone, again = pairs.filter("NOT kept").select(*names), pairs.filter("kept AND rows > 1").select(*names)
    same = docs[id_col].cast("long").eqNullSafe(F.col("_llm_id")) & (text_key(docs[text_col]) == F.col("_llm_key"))
    repeated = docs.join(again, same, "left_semi").withColumn("_llm_text", F.coalesce(F.col(text_col), F.lit("")))
    repeated = repeated.dropDuplicates([id_col, "_llm_text"]).drop("_llm_text")
    return docs.join(gone.unionByName(again), same, "left_anti").unionByName(repeated)
