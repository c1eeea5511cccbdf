"""Versioned tables, and sheets with rows that their table cannot take."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from ledgermap.plans import mappings
from ledgermap.sources.sheets import EXTRA, SHEETS, checked_rows, clean_controls, error_rows
from ledgermap.sources.tables import mapping
from ledgermap.sources.versions import Versions, part_name, tables_of
from ledgermap.operators.updates import replace_table, seed_all, teardown, update_table
from tests.test_mappings import sheet_rows

KIND = "data_folder_id string, k string, v string"


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=repr)


@pytest.fixture
def store(spark, tmp_path):
    return Versions(spark, f"file://{tmp_path}/store")


def test_versions_read_back(spark, store):
    rows = [("F1", "a", "1"), ("F/ 2=ü", "b", "2"), (None, "c", "3"), ("", "d", "4")]
    first = store.write("t", spark.createDataFrame(rows, KIND), "data_folder_id")
    assert (first.number, first.rows, set(first.parts)) == (1, 4, {part_name(r[0]) for r in rows})
    assert rows_of(store.read("t")) == sorted(rows, key=repr)
    assert rows_of(store.read("t", folders=["F/ 2=ü", None, "unknown"])) == sorted([rows[1], rows[2]], key=repr)
    second = store.write("t", spark.createDataFrame(rows[:1], KIND), "data_folder_id")
    assert second.number == 2 and rows_of(store.read("t")) == rows[:1]
    assert rows_of(store.read("t", 1)) == sorted(rows, key=repr)
    empty = store.write("e", spark.createDataFrame([], KIND), "data_folder_id")
    assert empty.rows == 0 and store.read("e").count() == 0 and store.read("e").columns == ["data_folder_id", "k", "v"]
    whole = store.write("w", spark.createDataFrame([("x", "1")], "a string, b string"))
    assert set(whole.parts) == {"whole"} and rows_of(store.read("w")) == [("x", "1")]
    with pytest.raises(LookupError):
        store.read("nothing")


def test_rewriting_touches_its_folders_only(spark, store):
    rows = [(f"F{i % 3}", str(i), "old") for i in range(9)]
    first = store.write("t", spark.createDataFrame(rows, KIND), "data_folder_id")
    target = store.read("t", folders=["F1"])
    second = store.rewrite("t", target.withColumn("v", F.lit("new")), "data_folder_id", ["F1"])
    assert second.rows == 9
    same = [p for p in first.parts if first.parts[p] == second.parts[p]]
    assert sorted(same) == sorted([part_name("F0"), part_name("F2")])
    assert {(r.data_folder_id, r.v) for r in store.read("t").collect()} == {("F0", "old"), ("F1", "new"), ("F2", "old")}
    with pytest.raises(ValueError):
        store.rewrite("t", store.read("t"), "data_folder_id", ["F1"])
    assert store.version("t").number == 2
    # a folder that loses all its rows is gone
    third = store.rewrite("t", target.limit(0), "data_folder_id", ["F1"])
    assert third.rows == 6 and part_name("F1") not in third.parts and store.read("t").count() == 6


@pytest.mark.parametrize("step", ["_write_data", "_write_manifest", "_publish"])
@pytest.mark.parametrize("when", ["before", "after"])
def test_a_writer_that_stops_leaves_one_version(spark, store, monkeypatch, step, when):
    old, new = [("F1", "a", "old"), ("F2", "b", "old")], [("F1", "a", "new"), ("F2", "b", "new")]
    store.write("t", spark.createDataFrame(old, KIND), "data_folder_id")
    real = getattr(store, step)

    def stops(*args):
        if when == "after":
            real(*args)
        raise KeyboardInterrupt

    monkeypatch.setattr(store, step, stops)
    with pytest.raises(KeyboardInterrupt):
        store.write("t", spark.createDataFrame(new, KIND), "data_folder_id")
    monkeypatch.undo()
    published = step == "_publish" and when == "after"
    fresh = Versions(spark, store.root)
    assert rows_of(fresh.read("t")) == (new if published else old)
    # the next writer goes on from there
    assert fresh.write("t", spark.createDataFrame(new, KIND), "data_folder_id").number == (3 if published else 2)
    assert rows_of(fresh.read("t")) == new


def test_two_writers_cannot_take_one_number(spark, store, monkeypatch):
    df = spark.createDataFrame([("F1", "a", "1")], KIND)
    store.write("t", df, "data_folder_id")
    monkeypatch.setattr(store, "version", lambda name, number=None, v=store.version("t"): v)
    store.write("t", df.withColumn("v", F.lit("first")), "data_folder_id")
    with pytest.raises(RuntimeError):
        store.write("t", df.withColumn("v", F.lit("second")), "data_folder_id")
    monkeypatch.undo()
    assert store.read("t").first().v == "first"


def test_tidying_keeps_what_versions_name(spark, store):
    rows = [("F1", "a", "0"), ("F2", "b", "0")]
    store.write("t", spark.createDataFrame(rows, KIND), "data_folder_id")
    for i in range(1, 4):
        target = store.read("t", folders=["F1"])
        store.rewrite("t", target.withColumn("v", F.lit(str(i))), "data_folder_id", ["F1"])
    # the first data folder still holds F2, only the two rewrites in between go
    assert store.tidy("t") == 1
    assert rows_of(store.read("t")) == [("F1", "a", "3"), ("F2", "b", "0")]
    assert rows_of(store.read("t", 3)) == [("F1", "a", "2"), ("F2", "b", "0")]
    with pytest.raises(LookupError):
        store.read("t", 1)


@pytest.fixture
def database(spark, mapped):
    tables = {
        "vendor": mapped("vendor", *[{"data_folder_id": f, "legacy_vendor_id": v, "new_vendor_id": "old"} for f in ("F1", "F2") for v in "ABC"]),
        "job": mapped("job", *[{"legacy_job_id": j, "legacy_extra_id": "", "include_job": 1} for j in "12"]),
        "useful_fields": mapped("useful_fields", {"field_name": "COMPANY_ID", "field_value": "X"}, {"field_name": "GL_STOP", "field_value": "x"}),
    }
    seed_all(spark, "lm_versions", {n: lambda df=df: df for n, df in tables.items()})
    yield "lm_versions"
    teardown(spark, "lm_versions", [*tables, *map(mappings.errors_table, tables)], "lm_versions")


def test_sheet_goes_on_after_errors(spark, database):
    def row(vendor, new, mark=None):
        return {"data_folder_id": "F1", "legacy_vendor_id": vendor, "new_vendor_id": new, EXTRA: mark}

    raw = sheet_rows(spark, "vendor", row("A", "n" * 51), row("B", "n" * 50), row("C", "x", "hide"), row("v" * 51, "x"), row("Q", "x"), {})
    before = tables_of(spark, database).version("vendor")
    audit = mappings.apply_to_table(spark, database, "vendor", raw)
    assert audit == mappings.Audit(read=2, skipped=1, errors=2, updated=1)
    got = {(r.data_folder_id, r.legacy_vendor_id): r.new_vendor_id for r in mapping(spark, "vendor", database).collect()}
    assert got[("F1", "A")] == "old" and got[("F1", "B")] == "n" * 50 and got[("F2", "B")] == "old"
    after = tables_of(spark, database).version("vendor")
    assert after.parts[part_name("F2")] == before.parts[part_name("F2")]
    errors = tables_of(spark, database).read(mappings.errors_table("vendor")).collect()
    assert {(r.legacy_vendor_id, r.reason) for r in errors} == {("A", "too long: new_vendor_id"), ("v" * 51, "too long: legacy_vendor_id")}


def test_bad_controls_row_does_not_stop_the_others(spark, database):
    raw = spark.createDataFrame(
        [("GL_STOP", "99999999999", 1), ("COMPANY_ID", "Y", 2), ("", "z", 3), ("", "", 4), ("COMPANY_ID", "v" * 101, 5)],
        "field_name string, field_value string, _row int",
    )
    audit = mappings.apply_to_table(spark, database, "useful_fields", raw)
    assert audit == mappings.Audit(read=1, skipped=1, errors=2, updated=1)
    got = {r.field_name: r.field_value for r in mapping(spark, "useful_fields", database).collect()}
    assert got == {"COMPANY_ID": "Y", "GL_STOP": "x"}
    counted = mappings.apply_audit(mapping(spark, "useful_fields", database), raw, SHEETS["useful_fields"])
    assert tuple(counted.first()) == (1, 1, 1, 2)


def test_reset_reaches_every_row(spark, database):
    raw = sheet_rows(spark, "job", {"data_folder_id": "F1", "legacy_job_id": "1", "legacy_extra_id": "", "include_job": "Yes"})
    assert mappings.apply_to_table(spark, database, "job", raw).updated == 1
    assert {r.legacy_job_id: r.include_job for r in mapping(spark, "job", database).collect()} == {"1": 1, "2": 0}


def test_sheet_of_unknown_folders_changes_nothing(spark, database):
    sheet = spark.createDataFrame([("F9", "A", "x", 1), (None, "A", "x", 2)], "data_folder_id string, legacy_vendor_id string, new_vendor_id string, _row int")
    assert update_table(spark, database, "vendor", sheet, ["data_folder_id", "legacy_vendor_id"], ["new_vendor_id"]) == 0
    assert tables_of(spark, database).version("vendor").number == 1
    assert replace_table(spark, database, "vendor", mapping(spark, "vendor", database)) == 6


@pytest.mark.parametrize(
    "cell, want",
    [("-1.25", "1899-12-29"), ("2958465.9", "9999-12-31"), ("2958466", None), ("-657435", None), ("1e3", "1902-09-26"), ("1e400", None), ("NaN", "NaN"), ("12abc", "12abc")],
)
def test_serial_days(spark, cell, want):
    raw = spark.createDataFrame([("A_STOP", cell, 1)], "field_name string, field_value string, _row int")
    sheet = SHEETS["useful_fields"]
    assert [r.field_value for r in clean_controls(raw).collect()] == ([want] if want else [])
    reasons = [r.reason for r in error_rows(checked_rows(raw, sheet), sheet).collect()]
    assert reasons == ([] if want else ["not readable: field_value"])


def test_flag_that_is_no_flag(spark, mapped):
    target = mapped("entity", {"legacy_entity_id": "01", "pkg_base": 0})
    raw = sheet_rows(spark, "entity", {"data_folder_id": "F1", "new_entity_id": "9", "pkg_base": "perhaps"})
    assert mappings.apply_raw(target, raw, "entity").first().pkg_base == 0
    assert mappings.sheet_errors(raw, SHEETS["entity"]).first().reason == "not readable: pkg_base"
