"""Helpers that the operators of this subpackage share."""

from __future__ import annotations

import os
import tempfile
import zipfile
from collections.abc import Callable, Iterable, Iterator
from pathlib import Path
from uuid import uuid4

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

import ledgermap

#: Characters of text that a Python task holds as words or numpy arrays at a time.
CHUNK_CHARS = 1_000_000
#: White space of the contracts: ``[\x20\x09-\x0D]``.
ASCII_SPACE = b" \t\n\x0b\x0c\r"

_shipped: set[str] = set()


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def ship(spark: SparkSession) -> None:
    """Give Python workers this package when neither their path nor working folder holds it."""
    root = Path(ledgermap.__file__).resolve().parents[1]
    known = {os.path.realpath(p) for p in os.environ.get("PYTHONPATH", "").split(os.pathsep) if p}
    application = spark.sparkContext.applicationId
    if str(root) in known or os.path.realpath(os.getcwd()) == str(root) or application in _shipped:
        return
    target = Path(tempfile.mkdtemp(prefix="package-")) / "ledgermap.zip"
    with zipfile.ZipFile(target, "w") as archive:
        for file in (root / "ledgermap").rglob("*.py"):
            archive.write(file, file.relative_to(root))
    spark.sparkContext.addPyFile(str(target))
    _shipped.add(application)


def shared_folder(spark: SparkSession) -> str:
    """A new folder below ``spark.checkpoint.dir``, which driver and executors share.

    Only a session without that setting (as in tests) gets a temporary folder.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = tempfile.mkdtemp(prefix="shared-")
        spark.conf.set("spark.checkpoint.dir", root)
    return f"{root.rstrip('/')}/llm-{spark.sparkContext.applicationId}/{uuid4().hex}"


def stored(df: DataFrame) -> DataFrame:
    """``df`` written once as a table in the shared folder; cuts the lineage and freezes the rows."""
    path = shared_folder(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def drop_stored(*frames: DataFrame) -> None:
    """Delete tables that ``stored`` wrote and that nothing reads any more."""
    for df in frames:
        spark = df.sparkSession
        for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
            path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def text_key(text: Column) -> Column:
    """Tells rows with one id and different texts apart; a null text counts as empty."""
    return F.unhex(F.sha2(F.coalesce(text, F.lit("")), 256))


def training_part(doc_id: Column) -> Column:
    """True for rows whose label may be learned from; the others are held out."""
    return F.crc32(doc_id.cast("string")) % 3 != 1


def arrow_rows(
    df: DataFrame,
    work: Callable[[list, int], dict[str, Iterable]],
    schema: str,
    max_chars: int = CHUNK_CHARS,
    text: int = -1,
) -> DataFrame:
    """Apply ``work`` to slices of rows whose texts together hold about ``max_chars`` characters.

    ``work`` gets the columns of ``df`` as Python lists and the partition's number, and returns
    columns of the new schema. ``text`` is the position of the column that sizes the slices; a
    single longer text is a slice of its own.
    """
    ship(df.sparkSession)
    arrow_schema = _arrow(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        for batch in batches:
            for piece in slices(batch, max_chars, text):
                out = work([c.to_pylist() for c in piece.columns], part)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(out[f.name], type=f.type) for f in arrow_schema], schema=arrow_schema
                )

    return df.mapInArrow(run, schema)


def slices(batch: pa.RecordBatch, max_chars: int, text: int = -1) -> Iterator[pa.RecordBatch]:
    import pyarrow.compute as pc

    sizes = pc.fill_null(pc.binary_length(batch.columns[text]), 0).to_pylist()
    start = held = 0
    for i, size in enumerate(sizes):
        if held and held + size > max_chars:
            yield batch.slice(start, i - start)
            start, held = i, 0
        held += size
    if start < len(sizes):
        yield batch.slice(start)


def _arrow(schema: str) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(T._parse_datatype_string(schema))
