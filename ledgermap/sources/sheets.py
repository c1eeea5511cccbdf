"""Mapping sheets: their columns, and reading an edited one back.

A sheet lists legacy columns for reference and new columns to fill in. Inside Spark its columns
carry the names of the translation table; the printed headers may repeat.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgermap.functions.semantics import flag_from_text
from ledgermap.operators.updates import ROW

HIDE = "hide"
#: Kinds of a sheet's rows, and the column that tells why a row cannot be applied.
EMPTY, SKIPPED, READ, ERROR = "empty", "skipped", "read", "error"
KIND, REASON = "_kind", "_reason"
# The widest text that a column of a translation table takes.
WIDTH = 50
WIDTHS = {"category": 75, "field_value": 100}
EXTRA = "_extra_column"
Cell = Callable[[Column], Column]


def yes_no(cell: Column) -> Column:
    return F.when(F.lower(cell) == "yes", "1").otherwise("0")


@dataclass(frozen=True)
class Sheet:
    """``fields`` maps column name to printed header, in order; ``keys`` and ``updates`` are column names."""

    title: str
    table: str
    fields: Mapping[str, str]
    keys: tuple[str, ...]
    updates: tuple[str, ...]
    cells: Mapping[str, Cell] = field(default_factory=dict)
    reset: tuple[str, ...] = ()

    @property
    def columns(self) -> list[str]:
        return list(self.fields)

    @property
    def header(self) -> list[str]:
        return list(self.fields.values())


def _plain(title: str, name: str, header: str, **more: str) -> Sheet:
    """A sheet with folder, legacy id and description before the new id."""
    old, new = f"legacy_{name}_id", f"new_{name}_id"
    fields = {"data_folder_id": "Data Folder ID", old: header, "description": f"{header} Description", new: header}
    return Sheet(title, name, {**fields, **more}, ("data_folder_id", old), (new,))


_PACKAGES = ("pkg_base", "pkg_constr_sum", "pkg_constr_det", "pkg_npc_commit", "pkg_pc_commit")

# Sheet titles, headers and column order.
SHEETS: dict[str, Sheet] = {
    s.table: s
    for s in (
        Sheet(
            "Controls",
            "useful_fields",
            {"field_name": "Field", "field_value": "Value"},
            ("field_name",),
            ("field_value",),
        ),
        Sheet(
            "Entity",
            "entity",
            {
                "data_folder_id": "Data Folder",
                "legacy_data_folder_name": "Data Folder Description",
                "new_entity_id": "Entity ID",
                "pkg_base": "PKG_BASE",
                "pkg_constr_sum": "PKG_CONSTR_SUM",
                "pkg_constr_det": "PKG_CONSTR_DET",
                "pkg_payroll": "PKG_PAYROLL",
                "pkg_npc_commit": "PKG_NPC_COMMIT",
                "pkg_pc_commit": "PKG_PC_COMMIT",
            },
            ("data_folder_id",),
            ("new_entity_id", *_PACKAGES),
            {p: flag_from_text for p in _PACKAGES},
        ),
        Sheet(
            "Job ID",
            "job",
            {
                "data_folder_id": "Data Folder ID",
                "legacy_job_id": "Job",
                "legacy_extra_id": "Job Extra",
                "legacy_job_name": "Job Description",
                "include_job": "Include?",
                "new_job_id": "Job",
                "new_entity_id": "Entity/Loc ID",
                "new_department_id": "Department ID",
                "new_class_id": "Class ID",
                "new_customer_id": "Customer ID",
                "new_pm_id": "PM ID",
            },
            ("data_folder_id", "legacy_job_id", "legacy_extra_id"),
            (
                "include_job",
                "new_job_id",
                "new_entity_id",
                "new_department_id",
                "new_class_id",
                "new_customer_id",
                "new_pm_id",
            ),
            {"include_job": yes_no},
            ("include_job",),
        ),
        Sheet(
            "GL Account",
            "base_account",
            {
                "data_folder_id": "Data Folder ID",
                "legacy_base_account": "GL Account",
                "note": "GL Account Description",
                "fin_stmt": "Statement",
                "balance": "Balance",
                "closeable": "Closeable",
                "acct_type": "Acct Type",
                "acct_match_type": "Map Type",
                "required": "Required",
                "new_base_account": "GL Account",
                "cmo": "Create/Merge",
                "category": "QS Category",
            },
            ("data_folder_id", "legacy_base_account"),
            ("new_base_account", "cmo", "category"),
        ),
        _plain("Location ID", "location", "Location"),
        _plain("Department ID", "department", "Department"),
        _plain("Class ID", "class", "Class"),
        Sheet(
            "Vendor ID",
            "vendor",
            {
                "data_folder_id": "Data Folder ID",
                "legacy_vendor_id": "Vendor",
                "legacy_vendor_name": "Vendor Description",
                "legacy_vendor_status": "Status",
                "new_vendor_id": "Vendor",
            },
            ("data_folder_id", "legacy_vendor_id"),
            ("new_vendor_id",),
        ),
        Sheet(
            "Customer ID",
            "customer",
            {
                "data_folder_id": "Data Folder ID",
                "legacy_customer_id": "Customer",
                "legacy_customer_name": "Customer Description",
                "legacy_customer_status": "Status",
                "new_customer_id": "Customer",
            },
            ("data_folder_id", "legacy_customer_id"),
            ("new_customer_id",),
        ),
        Sheet(
            "Cost Code ID",
            "cost_code",
            {
                "data_folder_id": "Data Folder ID",
                "legacy_cost_code_id": "Cost Code",
                "legacy_cost_code_name": "Cost Code Description",
                "new_cost_code_id": "Cost Code",
                "new_item_id": "Item ID",
            },
            ("data_folder_id", "legacy_cost_code_id"),
            ("new_cost_code_id", "new_item_id"),
        ),
        Sheet(
            "Cost Type ID",
            "cost_type",
            {
                "data_folder_id": "Data Folder ID",
                "legacy_cost_type_id": "Cost Type",
                "legacy_cost_type_name": "Cost Type Description",
                "new_cost_type_id": "Cost Type",
                "new_item_id": "Item ID",
                "new_gl_account": "GL Account",
            },
            ("data_folder_id", "legacy_cost_type_id"),
            ("new_cost_type_id", "new_item_id", "new_gl_account"),
        ),
        Sheet(
            "Employee ID",
            "employee",
            {
                "data_folder_id": "Data Folder ID",
                "legacy_employee_id": "Employee",
                "legacy_employee_name": "Employee Description",
                "new_employee_id": "Employee",
            },
            ("data_folder_id", "legacy_employee_id"),
            ("new_employee_id",),
        ),
        _plain("Inventory Item ID", "item", "Inventory Item"),
        _plain("Warehouse ID", "warehouse", "Warehouse", location_id="Location ID"),
    )
}


def load_sheet(spark: SparkSession, path: str, sheet: Sheet) -> DataFrame:
    """The cells of a sheet saved as CSV, as text, with their position; no row is left out.

    Columns beyond the printed ones are where rows get marked. All of them are read: the last one
    with a filled cell, however far right, becomes ``EXTRA``. Cells may hold line breaks, so a file
    is one task; sheets are edited by hand and small.
    """
    options = {"multiLine": True, "escape": '"', "mode": "PERMISSIVE"}
    # a row that notes were written beside may be wider than the header
    lines = spark.read.text(path).select(F.size(F.split("value", ",")).alias("n"))
    width = max(lines.agg(F.max("n")).first()[0] or 0, len(sheet.columns) + 1)
    beyond = [f"_right{i}" for i in range(width - len(sheet.columns))]
    cells = (
        spark.read.schema(", ".join(f"`{n}` string" for n in [*sheet.columns, *beyond]))
        .options(header=True, enforceSchema=True, **options)
        .csv(path)
    )
    filled = cells.agg(*[F.max(F.trim(n) != "").alias(n) for n in beyond]).first()
    marked = [n for n in beyond if filled[n]]
    extra = F.col(marked[-1]) if marked else F.lit(None).cast("string")
    raw = cells.select(*[f"`{n}`" for n in sheet.columns], extra.alias(EXTRA), "_metadata")
    place = F.struct(
        F.col("_metadata.file_path"), F.col("_metadata.file_block_start"), F.monotonically_increasing_id()
    )
    return raw.select("*", place.alias(ROW)).drop("_metadata")


def last_used_column(raw: DataFrame, sheet: Sheet) -> str:
    """The extra column if any of its cells is filled, else the last printed one."""
    if EXTRA in raw.columns and not raw.filter(F.trim(EXTRA) != "").isEmpty():
        return EXTRA
    return sheet.columns[-1]


def _first(reasons: list[Column]) -> Column:
    return F.coalesce(*reasons, F.lit(None).cast("string"))


def _too_long(names: Sequence[str]) -> list[Column]:
    return [F.when(F.length(n) > WIDTHS.get(n, WIDTH), F.lit(f"too long: {n}")) for n in names]


def row_kind(raw: DataFrame, sheet: Sheet, last: str, cells: Mapping[str, Cell] | None = None) -> DataFrame:
    """Trim all cells and tell each row's kind: ``empty``, ``skipped``, ``error`` or ``read``.

    A row is skipped when its last used cell says Hide, or when its first key is blank. A row whose
    cells its table cannot take is an error, with the first such cell as its reason.
    """
    names = [n for n in (*sheet.columns, EXTRA) if n in raw.columns]
    trimmed = raw.withColumns({n: F.trim(F.coalesce(n, F.lit(""))) for n in names})
    change = sheet.cells if cells is None else cells
    reasons = _too_long([n for n in (*sheet.keys, *sheet.updates) if n not in change])
    reasons += [F.when(change[n](F.col(n)).isNull(), F.lit(f"not readable: {n}")) for n in sheet.updates if n in change]
    empty = F.concat(*names) == ""
    skipped = (F.lower(last) == HIDE) | (F.col(sheet.keys[0]) == "")
    usable = ~empty & ~skipped
    out = trimmed.withColumn(REASON, F.when(usable, _first(reasons)))
    kind = F.when(empty, EMPTY).when(skipped, SKIPPED).when(F.col(REASON).isNotNull(), ERROR).otherwise(READ)
    return out.withColumn(KIND, kind)


def clean_sheet(
    raw: DataFrame, sheet: Sheet, last: str | None = None, cells: Mapping[str, Cell] | None = None
) -> DataFrame:
    """The usable rows: key and new columns, each new cell after its transform."""
    rows = row_kind(raw, sheet, last or last_used_column(raw, sheet), cells).filter(F.col(KIND) == READ)
    return _new_cells(rows, sheet, cells)


def _new_cells(rows: DataFrame, sheet: Sheet, cells: Mapping[str, Cell] | None = None) -> DataFrame:
    change = sheet.cells if cells is None else cells
    new = [change[n](F.col(n)).alias(n) if n in change else F.col(n) for n in sheet.updates]
    return rows.select(*sheet.keys, *new, ROW)


def read_sheet(
    spark: SparkSession, path: str, sheet: Sheet, cells: Mapping[str, Cell] | None = None
) -> DataFrame:
    return clean_sheet(load_sheet(spark, path, sheet), sheet, cells=cells)


# Parameter names holding these parts are dates; spreadsheets count days from here, and
# can show the days between these numbers.
DATE_PARTS = ("_END", "_START", "_STOP")
DAY_ZERO = "1899-12-30"
FIRST_SERIAL, LAST_SERIAL = -657435.0, 2958466.0
NUMBER = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"


def _serial(name: Column, value: Column) -> Column:
    """The day number that a date parameter is given as; NULL for all else."""
    is_date = F.lit(False)
    for part in DATE_PARTS:
        is_date = is_date | F.contains(F.upper(name), F.lit(part))
    return F.when(is_date & F.rlike(value, F.lit(NUMBER)), value.try_cast("double"))


def control_value(name: Column, value: Column) -> Column:
    """A date parameter given as a serial day number becomes ``yyyy-MM-dd``, or NULL if there is no such day."""
    serial = _serial(name, value)
    shown = (serial > FIRST_SERIAL) & (serial < LAST_SERIAL)
    # the time of day counts from zero on either side
    whole = F.when(serial < 0, F.ceil(serial)).otherwise(F.floor(serial)).try_cast("int")
    day = F.when(shown, F.date_add(F.to_date(F.lit(DAY_ZERO)), whole)).cast("string")
    return F.when(serial.isNotNull(), day).otherwise(value)


def control_kind(raw: DataFrame) -> DataFrame:
    """Trimmed names and values of the controls with each row's kind and reason, as ``row_kind`` gives them."""
    trimmed = raw.withColumns({n: F.trim(F.coalesce(n, F.lit(""))) for n in ("field_name", "field_value")})
    name, value = F.col("field_name"), F.col("field_value")
    no_day = F.when(control_value(name, value).isNull(), F.lit("not readable: field_value"))
    empty = F.concat(name, value) == ""
    out = trimmed.withColumn(REASON, F.when(name != "", _first([*_too_long(["field_name", "field_value"]), no_day])))
    kind = F.when(empty, EMPTY).when(name == "", SKIPPED).when(F.col(REASON).isNotNull(), ERROR).otherwise(READ)
    return out.withColumn(KIND, kind)


def checked_rows(raw: DataFrame, sheet: Sheet, last: str | None = None) -> DataFrame:
    """Every row of a sheet with its kind, and the reason of those that are errors."""
    if sheet.table == "useful_fields":
        return control_kind(raw)
    return row_kind(raw, sheet, last or last_used_column(raw, sheet))


def usable_rows(checked: DataFrame, sheet: Sheet) -> DataFrame:
    """Of ``checked_rows`` those to apply: key and new columns, and the place in the sheet."""
    rows = checked.filter(F.col(KIND) == READ)
    if sheet.table == "useful_fields":
        return rows.select("field_name", control_value(F.col("field_name"), F.col("field_value")).alias("field_value"), ROW)
    return _new_cells(rows, sheet)


def error_rows(checked: DataFrame, sheet: Sheet) -> DataFrame:
    """Of ``checked_rows`` those that cannot be applied: key columns and reason."""
    return checked.filter(F.col(KIND) == ERROR).select(*sheet.keys, F.col(REASON).alias("reason"))


def clean_controls(raw: DataFrame) -> DataFrame:
    return usable_rows(control_kind(raw), SHEETS["useful_fields"])
