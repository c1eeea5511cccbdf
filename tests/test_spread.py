"""Uneven keys, forecasts, missing keys, the shared ledger summary, totals in one pass, split reads."""

from __future__ import annotations

import random
from collections import Counter
from statistics import median

import pytest
from pyspark.sql import functions as F

from ledgermap.operators.documents import pack_batches, with_total
from ledgermap.operators.lookup import translate
from ledgermap.operators.spread import forecast, heavy_keys, missing_keys
from ledgermap.plans import ledger, payables, receivables, summary
from ledgermap.plans.registry import DATASETS
from ledgermap.plans.seeds import SEEDS
from ledgermap.sources.tables import split_predicates


@pytest.fixture
def shuffled(spark):
    """Joins by shuffle only, without run-time changes."""
    names = ["spark.sql.adaptive.enabled", "spark.sql.autoBroadcastJoinThreshold", "spark.sql.shuffle.partitions"]
    before = {n: spark.conf.get(n) for n in names}
    for name, value in zip(names, ("false", "-1", "16")):
        spark.conf.set(name, value)
    yield
    for name, value in before.items():
        spark.conf.set(name, value)


@pytest.mark.parametrize("hot", ["H", "", None])
def test_half_the_rows_on_one_key_load_no_task_twice(spark, shuffled, hot):
    rows = 40_000
    df = spark.range(rows, numPartitions=8).select(
        F.when(F.col("id") % 2 == 0, F.lit(hot)).otherwise((F.col("id") % 5000).cast("string")).alias("k"), "id"
    )
    table = spark.range(5000).select(F.col("id").cast("string").alias("old"), F.col("id").alias("new"))
    table = table.unionByName(spark.createDataFrame([("H", -1), ("", -2), (None, -3)], "old string, new long"))

    def sizes(spread):
        out = translate(df, table, {"k": "old"}, {"new": "new"}, spread=spread)
        per_task = out.groupBy(F.spark_partition_id().alias("p")).count().collect()
        return sorted(r["count"] for r in per_task), out

    plain, out = sizes(False)
    even, spread = sizes(True)
    assert max(plain) > 5 * median(plain)
    assert sum(even) == rows and max(even) < 2 * median(even) and len(even) == 16
    assert out.exceptAll(spread).isEmpty() and spread.exceptAll(out).isEmpty()


@pytest.mark.parametrize("how", ["left", "inner"])
def test_spread_join_gives_what_the_plain_one_gives(spark, how):
    pick = random.Random(3)
    keys = ["a"] * 30 + ["b"] * 10 + [None] * 10 + ["", "c", "d", "e"]
    left = [(pick.choice(keys), pick.choice(["x", "y", None]), i % 7) for i in range(600)]
    right = [(k, g, n) for n, (k, g) in enumerate([("a", "x"), ("a", "x"), ("a", "y"), ("b", "y"), ("", "x"), (None, "x"), ("q", None)])]
    df = spark.createDataFrame(left, "k string, g string, n int")
    table = spark.createDataFrame(right, "old string, grp string, v int")
    on, cols = {"k": "old", "g": "grp"}, {"v": "v"}
    want = Counter(map(tuple, translate(df, table, on, cols, how=how).collect()))
    assert Counter(map(tuple, translate(df, table, on, cols, how=how, spread=True).collect())) == want
    assert translate(df.limit(0), table, on, cols, how=how, spread=True).count() == 0
    none = translate(df, table.limit(0), on, cols, how=how, spread=True)
    assert none.count() == (len(left) if how == "left" else 0)


def test_spread_refuses_joins_that_would_repeat_rows(spark):
    df = spark.createDataFrame([("a",)], "k string")
    with pytest.raises(ValueError):
        translate(df, df.toDF("o"), {"k": "o"}, {}, how="full", spread=True)


def test_heavy_keys_are_exact(spark):
    pick = random.Random(5)
    rows = [(f"k{min(int(pick.paretovariate(0.7)), 3000)}",) for _ in range(20_000)] + [(None,)] * 700
    df = spark.createDataFrame(rows, "k string")
    for share in (0.2, 0.03, 0.005):
        want = {k: n for (k,), n in Counter(rows).items() if n >= share * len(rows)}
        assert {r.k: r["rows"] for r in heavy_keys(df, ["k"], share).collect()} == want
    assert heavy_keys(df.limit(0), ["k"], 0.1).count() == 0


def test_forecast_equals_the_join(spark, tables):
    df = spark.createDataFrame([("a", 1), ("a", 2), ("b", 1), ("c", None), (None, 1)], "k string, g int")
    one = spark.createDataFrame([("a",), ("a",), ("c",), (None,)], "old string")
    two = spark.createDataFrame([(1,), (1,), (1,), (2,)], "grp int")
    for how in ("left", "inner"):
        joined = translate(translate(df, one, {"k": "old"}, {}, how="left"), two, {"g": "grp"}, {}, how=how)
        found = forecast(df, [(one, {"k": "old"}, "left"), (two, {"g": "grp"}, how)]).first()
        assert tuple(found) == (5, joined.count())
    assert tuple(forecast(df.limit(0), [(one, {"k": "old"}, "left")]).first()) == (0, 0)
    rows = DATASETS["import_open_ap"].build(tables.src, tables.maps, tables.params).count()
    assert payables.open_ap_forecast(tables.src, tables.maps).first().rows_out == rows
    rows = DATASETS["import_open_ar"].build(tables.src, tables.maps, tables.params).count()
    assert receivables.open_ar_forecast(tables.src, tables.maps, tables.params).first().rows_out == rows


def test_forecast_counts_copies(spark):
    df = spark.createDataFrame([("a",), ("a",), ("b",), (None,)], "k string")
    table = spark.createDataFrame([("a", 2), ("a", 3), ("c", 7), (None, 9)], "old string, n int")
    assert tuple(forecast(df, [(table, {"k": "old"}, "left", "n")]).first()) == (4, 12)
    assert tuple(forecast(df, [(table, {"k": "old"}, "inner", "n")]).first()) == (4, 10)


def test_missing_keys_of_all_lookups(spark):
    df = spark.createDataFrame([("a", "x", 1.0), ("a", "y", 2.0), ("b", "x", 4.0), (None, "x", 8.0)], "k string, g string, amount double")
    df = df.withColumn("amount", F.col("amount").cast("decimal(18,2)"))
    one = spark.createDataFrame([("a",), (None,)], "old string")
    both = spark.createDataFrame([("a", "x"), ("b", "z")], "old string, grp string")
    found = missing_keys(df, {"one": (one, {"k": "old"}), "both": (both, {"k": "old", "g": "grp"})}, "amount")
    got = {(r.lookup, r.legacy_key): (r["rows"], float(r.amount)) for r in found.collect()}
    assert got == {("one", "b"): (1, 4.0), ("one", ""): (1, 8.0), ("both", "a | y"): (1, 2.0), ("both", "b | x"): (1, 4.0), ("both", " | x"): (1, 8.0)}


def test_shared_summary_replaces_scans_of_the_ledger(spark, tables, tmp_path):
    path = f"file://{tmp_path}/ledger"
    tables.src["gl_transaction"].write.parquet(path)
    src = {**{n: tables.src[n] for n in tables.src}, "gl_transaction": spark.read.parquet(path)}
    shared = summary.with_summary(src, tables.params)
    builds = {
        n: lambda s, n=n: DATASETS[n].build(s, tables.maps, tables.params)
        for n in ("import_gl_opening", "import_gl_monthly", "report_gl_batch_outage")
    }
    builds["seed_batch_combine"] = lambda s: SEEDS["batch_combine"](s, tables.params)
    builds["labels"] = lambda s: ledger.batch_labels(s, tables.maps, False)
    for name, build in builds.items():
        once = build({k: v for k, v in shared.items() if k != "gl_transaction"})
        plain = build(src)
        assert once.schema == plain.schema, name
        assert Counter(map(tuple, once.collect())) == Counter(map(tuple, plain.collect())), name
    assert shared[summary.SUMMARY].count() <= src["gl_transaction"].count()


def test_summary_keeps_windows_and_missing_amounts_apart(spark, source, tables):
    params = tables.params
    rows = [
        {"Account": "01", "Batch": "B", "Accounting_Date": d, "Accrual_or_Cash": "Accrual", "Application_of_Origin": "GL", "Debit": a, "Credit": b}
        for d, a, b in (("1999-11-30", 5, 0), ("1999-12-01", 7, 0), ("1999-11-02", None, -3), ("1999-11-03", 2, None), (None, 1, 1))
    ]
    ledger_rows = source("gl_transaction", *rows)
    found = summary.ledger_summary(ledger_rows, params)
    both = F.sum(F.col("Debit") + F.col("Credit")).alias("v")
    assert found.agg(both).first().v == ledger_rows.agg(both).first().v
    assert found.agg(F.sum("entries")).first()[0] == len(rows)
    november = found.filter("Accounting_Date <= DATE'1999-11-30'").agg(F.sum("Debit")).first()[0]
    assert november == 7


def test_totals_of_equal_rows_and_of_none(spark):
    df = spark.createDataFrame([("a", 1, None), ("a", 1, None), ("b", None, "x"), (None, 5, "x")], "k string, n long, t string")
    got = Counter(map(tuple, with_total(df, ["n"], {"k": "SUM"}).collect()))
    assert got == Counter([("a", 1, None, 0), ("a", 1, None, 0), ("b", None, "x", 0), (None, 5, "x", 0), ("SUM", 7, "", 1)])
    assert [tuple(r) for r in with_total(df.limit(0), ["n"], {"k": "SUM"}).collect()] == [("SUM", None, "", 1)]


def test_report_and_total_are_computed_once(tables):
    report = DATASETS["report_open_ar_aging"].build(tables.src, tables.maps, tables.params)
    scans = report._jdf.queryExecution().optimizedPlan().toString().count("Retainage_Billed")
    assert report.filter("is_total = 1").count() == 1
    assert "Union" in report._jdf.queryExecution().optimizedPlan().toString() and scans > 0
    assert "work/report" not in str(report.inputFiles())


def test_rows_without_a_group_are_packed(spark):
    df = spark.createDataFrame([(None, 1), (None, 2), (None, 3), ("a", 4), ("b", 5)], "g string, n int")
    got = {r.n: r.batch_num for r in pack_batches(df, "g", 2).collect()}
    assert got == {1: 1, 2: 1, 3: 1, 4: 2, 5: 3}


@pytest.mark.parametrize("kind", ["int", "date", "decimal(18,2)"])
def test_split_predicates_meet_every_value_once(spark, tmp_path, kind):
    pick = random.Random(2)
    value = F.date_add(F.lit("2000-01-01").cast("date"), F.col("v")) if kind == "date" else F.col("v").cast(kind)
    numbers = [pick.randrange(1000) for _ in range(3000)] + [7] * 2000 + [None] * 500
    spark.createDataFrame([(n,) for n in numbers], "v int").select(value.alias("v")).write.parquet(f"file://{tmp_path}/t")
    df = spark.read.parquet(f"file://{tmp_path}/t")
    parts = split_predicates(df, "v", 8)
    assert 2 <= len(parts) <= 8
    sizes = [df.filter(p).count() for p in parts]
    assert sum(sizes) == len(numbers)
    # values beyond those the borders came from meet one condition too
    later = spark.createDataFrame([(-5000,), (5000,), (None,)], "v int").select(value.alias("v"))
    assert sum(later.filter(p).count() for p in parts) == 3
    assert split_predicates(df.limit(0), "v", 8) == ["1 = 1"] == split_predicates(df, "v", 1)


def test_shared_summary_builds_no_other_table(spark, source, tables):
    class OneTable(dict):
        def __getitem__(self, name):
            assert name == "gl_transaction", name
            return super().__getitem__(name)

    ledger_row = source("gl_transaction", {"Account": "01-1", "Batch": "B", "Accounting_Date": "1999-01-05", "Accrual_or_Cash": "Accrual", "Debit": 5, "Credit": 0})
    shared = summary.with_summary(OneTable(gl_transaction=ledger_row, gl_account=None, job_category=None), tables.params)
    assert set(shared) == {"gl_transaction", "gl_account", "job_category", summary.SUMMARY}
    got = DATASETS["report_gl_batch_outage"].build(shared, {}, tables.params).collect()
    assert [(r.Batch, str(r.NET_AMT)) for r in got] == [("B", "5.00")]
