"""Mapping sheets out of the translation tables, and edited sheets back into them."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ledgermap.functions.semantics import flag_text
from ledgermap.operators.lookup import translate
from ledgermap.operators.updates import apply_update, replace_table, set_all, update_table, updated_rows
from ledgermap.plans.common import Tables
from ledgermap.sources.sheets import ERROR, KIND, READ, SHEETS, SKIPPED, Sheet, checked_rows, error_rows, usable_rows
from ledgermap.sources.sink import write_import
from ledgermap.sources.tables import mapping
from ledgermap.sources.workspace import stage

c = F.col


def export_sheet(maps: Tables, name: str) -> DataFrame:
    """Sheet of one translation table, unsorted; columns the table lacks are blank."""
    sheet, df = SHEETS[name], maps[name]
    if name == "entity":
        folder = {"legacy_data_folder_name": "legacy_data_folder_name"}
        df = translate(df, maps["data_folder"], {"data_folder_id": "legacy_data_folder_id"}, folder)
        df = df.withColumns({p: flag_text(c(p)) for p in sheet.cells})
    if name == "job":
        df = df.withColumn("include_job", F.when(c("include_job") == 1, "Yes").otherwise("No"))
    have = set(df.columns)
    return df.select(*[c(n) if n in have else F.lit("").alias(n) for n in sheet.columns])


def export_order(name: str) -> Sequence[str]:
    return SHEETS[name].keys


def export_mappings(maps: Tables) -> dict[str, DataFrame]:
    """All sheets by title."""
    return {sheet.title: export_sheet(maps, name) for name, sheet in SHEETS.items()}


def write_sheet(maps: Tables, name: str, path: str) -> int:
    return write_import(export_sheet(maps, name), SHEETS[name].header, path, export_order(name))


def apply_sheet(target: DataFrame, cleaned: DataFrame, sheet: Sheet) -> DataFrame:
    """New version of the table; columns in ``sheet.reset`` go to 0 in every row first."""
    for column in sheet.reset:
        target = set_all(target, column, 0)
    return apply_update(target, cleaned, sheet.keys, sheet.updates)


def apply_raw(target: DataFrame, raw: DataFrame, name: str, last: str | None = None) -> DataFrame:
    """New version of the table; rows of the sheet that it cannot take are left out, see ``sheet_errors``."""
    sheet = SHEETS[name]
    return apply_sheet(target, usable_rows(checked_rows(raw, sheet, last), sheet), sheet)


def sheet_errors(raw: DataFrame, sheet: Sheet, last: str | None = None) -> DataFrame:
    """Rows of a sheet that cannot be applied: key columns and the reason."""
    return error_rows(checked_rows(raw, sheet, last), sheet)


def _counts() -> list[Column]:
    kinds = {"rows_read": READ, "rows_skipped": SKIPPED, "rows_errors": ERROR}
    return [F.count_if(c(KIND) == kind).alias(name) for name, kind in kinds.items()]


def apply_audit(target: DataFrame, raw: DataFrame, sheet: Sheet, last: str | None = None) -> DataFrame:
    """One row: sheet rows read, skipped and in error, table rows updated."""
    checked = checked_rows(raw, sheet, last)
    none = F.lit(0).cast("bigint")
    of_sheet = checked.agg(*_counts()).withColumn("rows_updated", none)
    reached = updated_rows(target, usable_rows(checked, sheet), sheet.keys)
    of_table = reached.agg(F.count("*").alias("rows_updated")).withColumns(
        {n: none for n in ("rows_read", "rows_skipped", "rows_errors")}
    )
    both = of_sheet.unionByName(of_table)
    return both.agg(*[F.sum(n).alias(n) for n in ("rows_read", "rows_skipped", "rows_updated", "rows_errors")])


@dataclass(frozen=True)
class Audit:
    read: int
    skipped: int
    errors: int
    updated: int


def errors_table(name: str) -> str:
    return f"{name}_errors"


def apply_to_table(spark: SparkSession, database: str, name: str, raw: DataFrame, last: str | None = None) -> Audit:
    """Apply a sheet to a stored table and count, going on after rows that the table cannot take.

    The sheet is checked in one pass, which counts its rows too. Rows in error become a version of
    the table's error table, with their reasons; then the others are applied in a new version.
    """
    sheet, seen = SHEETS[name], Observation()
    checked = stage(checked_rows(raw, sheet, last).observe(seen, *_counts()), "sheet")
    replace_table(spark, database, errors_table(name), error_rows(checked, sheet))
    if sheet.reset:
        # every row changes, whatever the sheet names
        counted = Observation()
        target = mapping(spark, name, database)
        for column in sheet.reset:
            target = set_all(target, column, 0)
        replace_table(spark, database, name, apply_update(target, usable_rows(checked, sheet), sheet.keys, sheet.updates, counted))
        updated = counted.get["updated"]
    else:
        updated = update_table(spark, database, name, usable_rows(checked, sheet), sheet.keys, sheet.updates)
    found = seen.get
    return Audit(found["rows_read"], found["rows_skipped"], found["rows_errors"], updated)
