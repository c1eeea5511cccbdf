from __future__ import annotations

from pyspark.sql import functions as F

from ledgermap.operators.lookup import (
    existing_keys,
    fanout_audit,
    latest_per,
    missing_translation,
    translate,
    translate_account,
    unused_keys,
)

CHART = "data_folder_id string, account string, baseaccount string"


def base_rows(mapped, *rows):
    return mapped(
        "base_account",
        *[{"legacy_base_account": a, "acct_match_type": kind, "new_base_account": new} for a, kind, new in rows],
    )


def accounts_found(spark, mapped, *rows):
    chart = spark.createDataFrame([("F1", "01-100", "100")], CHART)
    used = spark.createDataFrame([("F1", "01-100"), ("F1", "nowhere")], "Data_Folder_Id string, acct string")
    out = translate_account(used, chart, base_rows(mapped, *rows), "acct").collect()
    assert [r.acct_no for r in out if r.acct == "nowhere"] == ["(MISSING)"]
    return sorted(r.acct_no for r in out if r.acct == "01-100")


def test_full_account_wins(spark, mapped):
    assert accounts_found(spark, mapped, ("01-100", "FULL", "f"), ("100", "BASE", "b")) == ["f"]


def test_base_account_is_second(spark, mapped):
    assert accounts_found(spark, mapped, ("100", "BASE", "b"), ("01-100", "BASE", "x")) == ["b"]


def test_no_account(spark, mapped):
    assert accounts_found(spark, mapped, ("999", "BASE", "b")) == ["(MISSING)"]


def test_base_rows_multiply(spark, mapped):
    assert accounts_found(spark, mapped, ("100", "BASE", "b"), ("100", "BASE", "b"), ("100", "BASE", "c")) == list("bbc")


def test_translate_keeps_rows_and_defaults(spark):
    df = spark.createDataFrame([("a",), ("q",), (None,)], "k string")
    table = spark.createDataFrame([("a", "1"), ("z", "2")], "old string, new string")
    rows = translate(df, table, {"k": "old"}, {"new": "new"}, {"new": F.col("k")}).collect()
    assert {r.k: r.new for r in rows} == {"a": "1", "q": "q", None: None}


def test_latest_per(spark):
    rows = [("b1", 3, "AP"), ("b1", 5, "AR"), ("b1", 5, "GL"), ("b2", None, "X"), (None, 1, "N")]
    df = spark.createDataFrame(rows, "batch string, day int, origin string")
    got = {r.batch: (r.day, r.origin) for r in latest_per(df, ["batch"], ["day", "origin"]).collect()}
    assert got == {"b1": (5, "GL"), "b2": (None, "X"), None: (1, "N")}


def test_partners(spark):
    left = spark.createDataFrame([("a",), ("b",), (None,)], "k string")
    right = spark.createDataFrame([("a",), ("a",), ("c",)], "r string")
    assert [r.k for r in existing_keys(left, right, {"k": "r"}).collect()] == ["a"]
    assert {r.k for r in unused_keys(left, right, {"k": "r"}).collect()} == {"b", None}


def test_audits(spark, mapped):
    table = base_rows(mapped, ("1", "BASE", "x"), ("1", "FULL", "y"), ("2", "BASE", "z"))
    assert [tuple(r) for r in fanout_audit(table, ["legacy_base_account"]).collect()] == [("1", 2)]
    df = spark.createDataFrame([("(MISSING)",), ("5",), (None,)], "a string")
    assert {r.a for r in missing_translation(df, "a").collect()} == {"(MISSING)", None}
