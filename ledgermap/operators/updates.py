"""Keyed updates of translation tables and the seeding and dropping of stored ones."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ledgermap.sources.versions import part_name, tables_of

ROW = "_row"


def last_per_key(sheet: DataFrame, keys: Sequence[str], cols: Sequence[str]) -> DataFrame:
    """One sheet row per key: the last one."""
    top = F.max(F.struct(ROW, *cols)).alias("_top")
    return sheet.groupBy(*keys).agg(top).select(*keys, *[F.col(f"_top.{c}").alias(c) for c in cols])


def _matched(target: DataFrame, sheet: DataFrame, keys: Sequence[str], cols: Sequence[str]) -> DataFrame:
    side = last_per_key(sheet, keys, cols).select(
        *[F.col(k).alias(f"_key_{k}") for k in keys], *[F.col(c).alias(f"_new_{c}") for c in cols]
    )
    same = reduce(and_, [F.col(k) == F.col(f"_key_{k}") for k in keys])
    return target.join(side, same, "left").withColumn("_hit", F.col(f"_key_{keys[0]}").isNotNull())


def apply_update(
    target: DataFrame, sheet: DataFrame, keys: Sequence[str], cols: Sequence[str], seen: Observation | None = None
) -> DataFrame:
    """Write the sheet's ``cols`` into the rows of ``target`` with equal keys.

    Rows are never added. Blank cells overwrite. A key that is NULL matches nothing. ``seen`` counts
    the rows reached, as ``updated``, while the result is computed.
    """
    kind = {f.name: f.dataType for f in target.schema.fields}
    joined = _matched(target, sheet, keys, cols)
    if seen is not None:
        joined = joined.observe(seen, F.count_if("_hit").alias("updated"))
    return joined.select(
        *[
            F.when(F.col("_hit"), F.col(f"_new_{c}").cast(kind[c])).otherwise(F.col(c)).alias(c) if c in cols else c
            for c in target.columns
        ]
    )


def updated_rows(target: DataFrame, sheet: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of ``target`` that the sheet reaches."""
    return _matched(target, sheet, keys, []).filter("_hit").select(*target.columns)


FOLDER = "data_folder_id"


def _folder(df: DataFrame) -> str | None:
    return FOLDER if FOLDER in df.columns else None


def replace_table(spark: SparkSession, database: str, name: str, df: DataFrame) -> int:
    """Store a new version of a table and return its row count, counted during the write.

    Readers find the version before until the new one is whole; see ``sources.versions``.
    """
    return tables_of(spark, database).write(name, df, _folder(df)).rows


def update_table(
    spark: SparkSession, database: str, name: str, sheet: DataFrame, keys: Sequence[str], cols: Sequence[str]
) -> int:
    """Apply a cleaned sheet to a stored table; returns the number of rows it reached.

    Only the data folders that the sheet names are read and written again. There is one entry per
    folder in the table's manifest, so their list is as short as that.
    """
    store, seen = tables_of(spark, database), Observation()
    if FOLDER not in keys:
        target = store.read(name)
        store.write(name, apply_update(target, sheet, keys, cols, seen), _folder(target))
        return seen.get["updated"]
    there = set(store.version(name).parts)
    named = [r[0] for r in sheet.select(FOLDER).distinct().collect()]
    folders = [f for f in named if f is not None and part_name(f) in there]
    if not folders:
        return 0
    target = store.read(name, folders=folders)
    store.rewrite(name, apply_update(target, sheet, keys, cols, seen), FOLDER, folders)
    return seen.get["updated"]


def seed(spark: SparkSession, database: str, name: str, build: Callable[[], DataFrame]) -> bool:
    """Store the first version of a translation table unless there is one; tells whether it was written."""
    if tables_of(spark, database).exists(name) or spark.catalog.tableExists(f"{database}.{name}"):
        return False
    replace_table(spark, database, name, build())
    return True


def seed_all(spark: SparkSession, database: str, builders: Mapping[str, Callable[[], DataFrame]]) -> list[str]:
    """Create the database and store every translation table; refuses to run a second time."""
    if spark.catalog.databaseExists(database):
        raise RuntimeError(f"{database} exists already; tear it down first")
    spark.sql(f"CREATE DATABASE {database}")
    return [name for name, build in builders.items() if seed(spark, database, name, build)]


def teardown(spark: SparkSession, database: str, tables: Sequence[str], confirm: str) -> bool:
    """Drop the translation tables, and the database if nothing else is left in it.

    ``confirm`` must repeat the database name. Returns whether the database went too.
    """
    if confirm != database:
        raise ValueError("confirm must repeat the database name")
    for name in tables:
        tables_of(spark, database).drop(name)
        spark.sql(f"DROP TABLE IF EXISTS {database}.{name}")
    if any(not table.isTemporary for table in spark.catalog.listTables(database)):
        return False
    spark.sql(f"DROP DATABASE {database}")
    return True


def set_all(df: DataFrame, column: str, value: Column | int) -> DataFrame:
    """Update without a condition."""
    fill = value if isinstance(value, Column) else F.lit(value)
    return df.withColumn(column, fill.cast(df.schema[column].dataType))
