"""Tables kept as versions: data files that never change, and a manifest for each version.

A version is one manifest that names, for every data folder, the folder of its files. Writing a
version puts new data beside the old, then the manifest under a passing name, and last renames that
manifest to the next version number, which fails if the number is taken. The rename is the only
step that readers notice: before it they find the version before, after it the new one, and a writer
that stops anywhere leaves the table as it was. Rewriting some folders keeps the others' files.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import dataclass
from uuid import uuid4

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

PART = "_part"
#: The part of rows without a folder, and the only part of a table without such a column.
NONE, WHOLE = "none", "whole"


@dataclass(frozen=True)
class Version:
    """``parts`` maps a part to the path of its files, relative to the table's root."""

    number: int
    schema: str
    parts: dict[str, str]
    rows: int


def part_name(folder: str | None) -> str:
    """A folder's part; hexadecimal, so that any text makes a path."""
    return NONE if folder is None else f"x{folder.encode().hex()}"


class Versions:
    """The versioned tables below ``root``, a folder that driver and executors share."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self._jvm = spark.sparkContext._jvm
        self._conf = spark.sparkContext._jsc.hadoopConfiguration()

    def _path(self, *names: str):
        return self._jvm.org.apache.hadoop.fs.Path("/".join([self.root, *names]))

    def _files(self):
        return self._path().getFileSystem(self._conf)

    def _numbers(self, name: str) -> list[int]:
        path = self._path(name, "versions")
        if not self._files().exists(path):
            return []
        found = [status.getPath().getName() for status in self._files().listStatus(path)]
        return sorted(int(f.removesuffix(".json")) for f in found if f.endswith(".json") and f[0] != ".")

    def exists(self, name: str) -> bool:
        return bool(self._numbers(name))

    def version(self, name: str, number: int | None = None) -> Version:
        """The newest version, or the one with that number."""
        numbers = self._numbers(name)
        if not numbers or (number is not None and number not in numbers):
            raise LookupError(f"{self.root} has no version {number or ''} of {name}")
        file = self._files().open(self._path(name, "versions", f"{number or numbers[-1]:08d}.json"))
        try:
            text = self._jvm.org.apache.commons.io.IOUtils.toString(file, "UTF-8")
        finally:
            file.close()
        return Version(**json.loads(text))

    def read(self, name: str, number: int | None = None, folders: Sequence[str | None] | None = None) -> DataFrame:
        """The table, or only its rows of some folders, as that version holds it."""
        found = self.version(name, number)
        wanted = set(found.parts) if folders is None else {part_name(f) for f in folders}
        schema = StructType.fromJson(json.loads(found.schema))
        paths = [f"{self.root}/{name}/{path}" for part, path in sorted(found.parts.items()) if part in wanted]
        if not paths:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*paths)

    def write(self, name: str, df: DataFrame, folder: str | None = None) -> Version:
        """A new version with the rows of ``df``, split by the column ``folder`` if one is given."""
        before = self.version(name).number if self.exists(name) else 0
        parts, rows = self._write_data(name, df, folder)
        return self._commit(name, Version(before + 1, df.schema.json(), parts, rows))

    def rewrite(self, name: str, df: DataFrame, folder: str, folders: Sequence[str | None]) -> Version:
        """A new version in which ``df`` holds all rows of ``folders``; other folders keep their files."""
        old = self.version(name)
        touched = {part_name(f) for f in folders}
        parts, rows = self._write_data(name, df, folder)
        if strange := set(parts) - touched:
            raise ValueError(f"rows of other folders: {sorted(strange)}")
        kept = {part: path for part, path in old.parts.items() if part not in touched}
        schema = StructType.fromJson(json.loads(old.schema))
        left = self.spark.read.schema(schema).parquet(*[f"{self.root}/{name}/{p}" for p in kept.values()]).count() if kept else 0
        return self._commit(name, Version(old.number + 1, df.schema.json(), kept | parts, rows + left))

    def _write_data(self, name: str, df: DataFrame, folder: str | None) -> tuple[dict[str, str], int]:
        target, seen = f"data/{uuid4().hex}", Observation()
        key = F.col(folder).cast("string") if folder else F.lit(None).cast("string")
        # hexadecimal digits of the text's bytes, in lower case
        named = F.coalesce(F.concat(F.lit("x"), F.lower(F.hex(F.encode(key, "UTF-8")))), F.lit(NONE if folder else WHOLE))
        rows = df.observe(seen, F.count(F.lit(1)).alias("rows")).withColumn(PART, named)
        rows.write.partitionBy(PART).parquet(f"{self.root}/{name}/{target}")
        path = self._path(name, target)
        found = [status.getPath().getName() for status in self._files().listStatus(path)]
        parts = {f.removeprefix(f"{PART}="): f"{target}/{f}" for f in found if f.startswith(f"{PART}=")}
        return parts, seen.get["rows"]

    def _commit(self, name: str, version: Version) -> Version:
        folder = self._path(name, "versions")
        self._files().mkdirs(folder)
        passing = self._path(name, "versions", f".{uuid4().hex}")
        self._write_manifest(passing, version)
        self._publish(passing, self._path(name, "versions", f"{version.number:08d}.json"))
        return version

    def _write_manifest(self, path, version: Version) -> None:
        file = self._files().create(path, False)
        try:
            file.write(bytearray(json.dumps(version.__dict__), "utf-8"))
        finally:
            file.close()

    def _publish(self, passing, final) -> None:
        hadoop = self._jvm.org.apache.hadoop.fs
        files = hadoop.FileContext.getFileContext(final.toUri(), self._conf)
        no_options = self.spark.sparkContext._gateway.new_array(getattr(hadoop, "Options$Rename"), 0)
        try:
            files.rename(passing, final, no_options)
        except Exception as problem:
            raise RuntimeError(f"another writer was first: {final}") from problem

    def drop(self, name: str) -> None:
        self._files().delete(self._path(name), True)

    def tidy(self, name: str, keep: int = 2) -> int:
        """Delete all versions but the last ``keep`` and the data that none of those names; tells how many folders went."""
        numbers = self._numbers(name)
        for number in numbers[:-keep]:
            self._files().delete(self._path(name, "versions", f"{number:08d}.json"), False)
        used = {path.split("/")[1] for n in numbers[-keep:] for path in self.version(name, n).parts.values()}
        data, gone = self._path(name, "data"), 0
        for status in self._files().listStatus(data):
            if status.getPath().getName() not in used:
                self._files().delete(status.getPath(), True)
                gone += 1
        return gone


def tables_of(spark: SparkSession, database: str) -> Versions:
    """The versioned translation tables of a database, in its own folder."""
    return Versions(spark, f"{spark.catalog.getDatabase(database).locationUri}/versioned")
