from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from ledgermap.operators.updates import apply_update, replace_table, seed_all, teardown
from ledgermap.plans import mappings
from ledgermap.plans.seeds import seed_builders
from ledgermap.sources.schemas import MAPPINGS, mapping_schema
from ledgermap.sources.sheets import EXTRA, SHEETS, clean_controls, load_sheet, read_sheet
from ledgermap.sources.tables import Params, empty_mapping, mapping, read_params, useful_fields


def sheet_rows(spark, name, *rows):
    columns = [*SHEETS[name].columns, EXTRA]
    data = [tuple(r.get(n) for n in columns) + (i,) for i, r in enumerate(rows)]
    return spark.createDataFrame(data, ", ".join(f"{n} string" for n in columns) + ", _row int")


def test_update_rules(spark, mapped):
    target = mapped(
        "vendor",
        {"legacy_vendor_id": "A", "new_vendor_id": "old"},
        {"legacy_vendor_id": "B", "new_vendor_id": "old"},
        {"legacy_vendor_id": "C", "new_vendor_id": "old"},
        {"legacy_vendor_id": "D", "new_vendor_id": "old"},
        {"legacy_vendor_id": None, "new_vendor_id": "old"},
    )

    def row(vendor, new, folder=" F1 ", mark=None):
        return {"data_folder_id": folder, "legacy_vendor_id": vendor, "new_vendor_id": new, EXTRA: mark}

    raw = sheet_rows(
        spark,
        "vendor",
        row("A", "first"),
        row(" A ", " last "),
        row("B", ""),
        row("C", "hidden", mark=" hIdE"),
        row("D", "no folder", folder=" "),
        row("E", "unknown"),
        {},
    )
    done = mappings.apply_raw(target, raw, "vendor")
    assert {r.legacy_vendor_id: r.new_vendor_id for r in done.collect()} == {
        "A": "last",
        "B": "",
        "C": "old",
        "D": "old",
        None: "old",
    }
    assert tuple(mappings.apply_audit(target, raw, SHEETS["vendor"]).first()) == (4, 2, 2, 0)
    again = mappings.apply_raw(done, raw, "vendor")
    assert sorted(map(str, again.collect())) == sorted(map(str, done.collect()))


def test_hide_in_the_last_printed_column(spark, mapped):
    target = mapped("vendor", {"legacy_vendor_id": "A", "new_vendor_id": "old"})
    raw = sheet_rows(spark, "vendor", {"data_folder_id": "F1", "legacy_vendor_id": "A", "new_vendor_id": "HIDE"})
    assert mappings.apply_raw(target, raw, "vendor").first().new_vendor_id == "old"


def test_job_sheet_resets_first(spark, mapped):
    target = mapped(
        "job",
        *[{"legacy_job_id": j, "legacy_extra_id": x, "include_job": 1} for j, x in (("1", ""), ("2", ""), ("3", ""), ("1", None))],
    )
    raw = sheet_rows(
        spark,
        "job",
        {"data_folder_id": "F1", "legacy_job_id": "1", "legacy_extra_id": "", "include_job": "yEs", "new_job_id": "N"},
        {"data_folder_id": "F1", "legacy_job_id": "2", "legacy_extra_id": "", "include_job": "y"},
    )
    got = {(r.legacy_job_id, r.legacy_extra_id): r.include_job for r in mappings.apply_raw(target, raw, "job").collect()}
    assert got == {("1", ""): 1, ("2", ""): 0, ("3", ""): 0, ("1", None): 0}


def test_entity_flags(spark, mapped):
    target = mapped("entity", *[{"legacy_entity_id": e, "new_entity_id": e, "pkg_base": 0} for e in ("01", "02")])
    raw = sheet_rows(spark, "entity", {"data_folder_id": "F1", "new_entity_id": "9", "pkg_base": "True", "pkg_npc_commit": "1"})
    rows = mappings.apply_raw(target, raw, "entity").collect()
    assert {(r.new_entity_id, r.pkg_base, r.pkg_npc_commit, r.pkg_pc_commit) for r in rows} == {("9", 1, 1, 0)}


@pytest.mark.parametrize(
    "name, cell, want",
    [
        ("GL03_DETAIL_STOP", "45657", "2024-12-31"),
        ("gl01_balance_end", "2024-12-31", "2024-12-31"),
        ("COMPANY_ID", "45657", "45657"),
        ("GL02_MONTHLY_START", " 45292.5 ", "2024-01-01"),
    ],
)
def test_controls(spark, name, cell, want):
    raw = spark.createDataFrame([(name, cell, 1), (" ", "x", 2)], "field_name string, field_value string, _row int")
    assert [(r.field_name, r.field_value) for r in clean_controls(raw).collect()] == [(name, want)]


@pytest.mark.parametrize(
    "as_of, want",
    [
        ("2026-01-15", ("2024-12-31", "2025-01-01", "2025-12-31", "2026-01-01", "2025-12-31")),
        ("2024-03-31", ("2022-12-31", "2023-01-01", "2023-12-31", "2024-01-01", "2024-02-29")),
    ],
)
def test_period_limits(spark, as_of, want):
    params = read_params(useful_fields(spark, dt.date.fromisoformat(as_of)))
    names = "GL01_BALANCE_END GL02_MONTHLY_START GL02_MONTHLY_STOP GL03_DETAIL_START GL03_DETAIL_STOP".split()
    assert tuple(params.date(n).isoformat() for n in names) == want


def test_sheet_survives_the_round_trip(spark, mapped, tmp_path):
    table = mapped(
        "cost_code",
        {"legacy_cost_code_id": "1-000", "legacy_cost_code_name": 'Say "hi", twice\nthen stop', "new_cost_code_id": "A", "new_item_id": None},
        {"legacy_cost_code_id": "2-000", "legacy_cost_code_name": " padded ", "new_cost_code_id": "B", "new_item_id": "i"},
    )
    path = str(tmp_path / "sheet")
    assert mappings.write_sheet({"cost_code": table}, "cost_code", path) == 2
    raw = load_sheet(spark, path, SHEETS["cost_code"])
    assert {r.legacy_cost_code_name for r in raw.collect()} == {'Say "hi", twice\nthen stop', " padded "}
    cleaned = read_sheet(spark, path, SHEETS["cost_code"])
    got = {r.legacy_cost_code_id: (r.new_cost_code_id, r.new_item_id) for r in cleaned.collect()}
    assert got == {"1-000": ("A", ""), "2-000": ("B", "i")}


def test_last_row_of_a_file_wins(spark, mapped, tmp_path):
    path = tmp_path / "vendor.csv"
    lines = ["Data Folder ID,Vendor,Vendor Description,Status,Vendor"]
    lines += [f"F1,V{i % 3},x,y,n{i}" for i in range(30)]
    path.write_text("\n".join(lines) + "\n")
    target = mapped("vendor", *[{"legacy_vendor_id": f"V{i}"} for i in range(3)])
    done = mappings.apply_sheet(target, read_sheet(spark, str(path), SHEETS["vendor"]), SHEETS["vendor"])
    assert {r.legacy_vendor_id: r.new_vendor_id for r in done.collect()} == {"V0": "n27", "V1": "n28", "V2": "n29"}


def test_every_sheet_matches_its_table(tables):
    frames = mappings.export_mappings(tables.maps)
    assert len(frames) == 14
    for sheet in SHEETS.values():
        assert frames[sheet.title].columns == sheet.columns
        fields = mapping_schema(sheet.table).names
        assert set(sheet.keys) | set(sheet.updates) <= set(fields)


def test_empty_tables_have_a_schema(spark):
    for name in ("class", "item", "warehouse"):
        assert empty_mapping(spark, name).schema == mapping_schema(name)
        assert empty_mapping(spark, name).count() == 0


def test_table_lifecycle(spark, tables):
    params = Params(tables.params.values, combine_from="1999-01-01", combine_to="1999-11-30")
    builders = seed_builders(spark, tables.src, params, dt.date(2000, 12, 15))
    assert set(builders) == set(MAPPINGS)
    names = seed_all(spark, "lm_test", builders)
    try:
        assert set(names) == set(MAPPINGS)
        with pytest.raises(RuntimeError):
            seed_all(spark, "lm_test", builders)
        target = mapping(spark, "vendor", "lm_test")
        edited = mappings.export_sheet({"vendor": target}, "vendor").withColumns(
            {"new_vendor_id": F.lit("N"), "_row": F.lit(1)}
        )
        rows = replace_table(spark, "lm_test", "vendor", mappings.apply_raw(target, edited, "vendor", "new_vendor_id"))
        stored = mapping(spark, "vendor", "lm_test")
        assert rows == stored.count() == tables.maps["vendor"].count()
        assert {r.new_vendor_id for r in stored.select("new_vendor_id").distinct().collect()} == {"N"}
        with pytest.raises(ValueError):
            teardown(spark, "lm_test", names, "wrong")
        spark.sql("CREATE TABLE lm_test.other (x int) USING parquet")
        assert teardown(spark, "lm_test", names, "lm_test") is False
        spark.sql("DROP TABLE lm_test.other")
    finally:
        assert teardown(spark, "lm_test", names, "lm_test") is True
    assert not spark.catalog.databaseExists("lm_test")


def test_late_columns_are_added(spark):
    spark.sql("CREATE DATABASE lm_late")
    try:
        spark.range(1).select(F.lit("F1").alias("data_folder_id"), F.lit("1").alias("legacy_base_account")).write.saveAsTable(
            "lm_late.base_account"
        )
        df = mapping(spark, "base_account", "lm_late")
        assert set(df.columns) == set(mapping_schema("base_account").names) and df.first().cmo is None
    finally:
        spark.sql("DROP DATABASE lm_late CASCADE")


def test_update_keeps_rows_unique(spark):
    target = spark.createDataFrame([("a", "1"), ("b", "2")], "k string, v string")
    sheet = spark.createDataFrame([("a", "x", 1), ("a", "y", 2)], "k string, v string, _row int")
    assert sorted(tuple(r) for r in apply_update(target, sheet, ["k"], ["v"]).collect()) == [("a", "y"), ("b", "2")]
