"""Lines landed once, large tables dealt over many tasks, estimates numbered before they repeat."""

from __future__ import annotations

import datetime as dt
from collections import Counter
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from checks.fixtures import ADAPTERS
from checks.landed import Landed
from ledgermap.operators.documents import double_entry
from ledgermap.operators.lookup import existing_keys, gather
from ledgermap.operators.numbering import Dealing, dealing, number_lines, number_repeated_lines
from ledgermap.plans import contracts, payables, receivables
from ledgermap.plans.common import folder_entities
from ledgermap.plans.registry import ARCHIVED, DATASETS
from ledgermap.sources import workspace
from ledgermap.sources.tables import Params
from ledgermap.sources.workspace import LANDED, WORK, shared_root
from tests.conftest import SF

DERIVED = "gl_account base_account bank_account std_category std_cost_code job_cost_code job_category contract_derived".split()
TRANSACTIONS = "gl_transaction jc_transaction ap_distribution ar_activity".split()


def rows(df):
    return Counter(tuple(r) for r in df.collect())


def folders(spark, area, label):
    return {p.name for p in Path(shared_root(spark).removeprefix("file:"), area).glob(f"{label}-*")}


def test_lines_are_joined_once(spark):
    before = folders(spark, LANDED, "lines")
    fresh = Landed(spark, SF)
    for name in DERIVED + TRANSACTIONS:
        fresh.src[name]
    assert len(folders(spark, LANDED, "lines") - before) == 1
    for name in TRANSACTIONS:
        assert "Join" not in fresh.src[name]._jdf.queryExecution().executedPlan().toString()


def test_landed_lines_equal_the_adapter(spark, tmp_path):
    """Orders without customer or key, and an order that comes twice, as the adapter's own join has them."""
    def write(name, schema, *values):
        spark.createDataFrame(values, schema).write.parquet(f"{tmp_path}/{name}.parquet")

    write("region", "r_regionkey int, r_name string", (0, "A"))
    write("nation", "n_nationkey int, n_name string, n_regionkey int", (1, "N", 0), (2, "M", None))
    write("customer", "c_custkey long, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string", (1, "c", 1, 1.0, "B"), (2, "d", 2, 1.0, "B"), (None, "e", 1, 1.0, "B"))
    day = "timestamp '1999-01-02 03:00:00'"
    orders = spark.sql(f"SELECT * FROM VALUES (1L, 1L, 'O', {day}), (1L, 1L, 'F', {day}), (2L, 2L, 'O', NULL), (3L, NULL, 'O', {day}), (NULL, 1L, 'O', {day}) AS o(o_orderkey, o_custkey, o_orderstatus, o_orderdate)")
    orders.write.parquet(f"{tmp_path}/orders.parquet")
    lines = spark.sql(f"SELECT k AS l_orderkey, 41L AS l_partkey, 3L AS l_suppkey, 6 AS l_linenumber, 10.5D AS l_extendedprice, 'R' AS l_returnflag, 'O' AS l_linestatus, {day} AS l_shipdate FROM VALUES (1L), (1L), (2L), (3L), (9L), (NULL) AS v(k)")
    lines.write.parquet(f"{tmp_path}/lineitem.parquet")
    write("supplier", "s_suppkey long", (1,))
    write("part", "p_partkey long", (1,))
    write("events", "event_id long", (1,))
    small = Landed(spark, str(tmp_path))
    got = small.table("fx_line")
    want = small._named(ADAPTERS["fx_line"]).replace(f"{small._prefix}fx_line", "fx_line")
    want = spark.sql(want).select(*[c for c in got.columns if c != "l_shipdate"])
    assert rows(got.drop("l_shipdate")) == rows(want) and got.count() == 5


@pytest.mark.parametrize("name", ["job_cost_code", "job_category"])
def test_large_masters_are_dealt_over_more_tasks(spark, monkeypatch, name):
    plain = rows(Landed(spark, SF).src[name])
    monkeypatch.setattr(workspace, "ROWS_PER_TASK", 100)
    dealt = Landed(spark, SF)
    view = dealt.table(f"fx_{name}")
    plan = view._jdf.queryExecution().executedPlan().toString()
    # one shuffle, the one that deals; the number of shuffle partitions plays no part in it
    assert plan.count("Exchange") == 1 and "REPARTITION_BY_NUM" in plan
    assert rows(dealt.src[name]) == plain


def test_partners_are_looked_for_in_as_many_tasks_as_asked(spark):
    df = spark.createDataFrame([("a", 1), ("a", 2), ("b", 3), (None, 4)], "k string, v int")
    other = spark.createDataFrame([("a",), ("a",), (None,), ("c",)], "old string")
    found = existing_keys(df, other, {"k": "old"}, 40)
    assert rows(found) == rows(existing_keys(df, other, {"k": "old"}))
    assert found._jdf.queryExecution().executedPlan().toString().count(", 40), REPARTITION_BY_NUM") == 2


def test_stored_entries_are_made_once(spark):
    before = folders(spark, WORK, "entries")
    df = spark.createDataFrame([("a", "x", 5), ("a", "y", -2), ("b", None, 3)], "k string, g string, v int")
    amount = F.col("v").cast("decimal(18,2)")
    stored = double_entry(df, ["k", "g"], ["k"], amount, store=True)
    assert len(folders(spark, WORK, "entries") - before) == 1
    assert rows(stored) == rows(double_entry(df, ["k", "g"], ["k"], amount))


def test_tasks_grow_with_a_table_only_beyond_the_shuffle(spark, tmp_path, monkeypatch):
    spark.range(1000).write.parquet(f"{tmp_path}/t")
    table = spark.read.parquet(f"{tmp_path}/t")
    assert workspace.tasks_for(table) is None
    monkeypatch.setattr(workspace, "ROWS_PER_TASK", 50)
    assert workspace.tasks_for(table) == 20


def test_estimates_are_numbered_before_they_repeat(spark, mapped):
    """Also where two folders share a new job, entities repeat or are missing, and a job has no new number."""
    maps = {
        "entity": mapped(
            "entity",
            *[{"data_folder_id": f, "legacy_entity_id": str(i), "new_entity_id": e} for i, (f, e) in enumerate([("F1", "02"), ("F1", "01"), ("F2", "03"), ("F2", "00"), ("F3", "07"), ("F3", "07"), ("F3", None)])],
        ),
        "job": mapped(
            "job",
            *[{"data_folder_id": f, "legacy_job_id": j, "new_job_id": n, "include_job": 1} for f, j, n in [("F1", "A", "one"), ("F1", "B", "both"), ("F2", "B", "both"), ("F3", "C", "three"), ("F4", "D", "four"), ("F2", "E", None)]],
        ),
    }
    lines = [(f, j, n, b, code, v) for f, j, n in [("F1", "A", "one"), ("F1", "B", "both"), ("F2", "B", "both"), ("F3", "C", "three"), ("F4", "D", "four"), ("F2", "E", None)] for b in "AB" for code in ("1", "2", None) for v in (1, 2)]
    df = spark.createDataFrame(lines, "Data_Folder_Id string, Job string, _job string, _branch string, Cost_Code string, _amount int")
    empty = {n: F.lit("") for n in "_task _type Extra Category _qty _production Cost_Account".split()}
    df = df.withColumns(empty)
    order = [*contracts.ESTIMATE_ORDER[0], "_entity", *contracts.ESTIMATE_ORDER[1]]
    for strict in (False, True):
        want = number_lines(folder_entities(df, maps, {"_entity": "new_entity_id"}, strict), ["_job"], order, "_line")
        before = folders(spark, WORK, "cells")
        got = contracts._numbered_per_job(df, maps, strict)
        columns = [*df.columns, "_entity", "_line"]
        assert rows(got.select(columns)) == rows(want.select(columns))
        if strict:
            continue
        (cells,) = folders(spark, WORK, "cells") - before
        stored = spark.read.parquet(f"{shared_root(spark)}/{WORK}/{cells}").groupBy("_job").count().collect()
        assert {r["_job"]: r["count"] for r in stored}["one"] == 12


def shuffles(df):
    plan = df._jdf.queryExecution().executedPlan().toString()
    return [line for line in plan.splitlines() if "Exchange " in line and "Broadcast" not in line and "Reused" not in line]


def test_lines_of_ordinary_documents_are_shuffled_once_and_not_stored(spark, monkeypatch):
    monkeypatch.setattr(workspace, "ROWS_PER_TASK", 80)
    lines = [(f"d{i % 40}", i % 3, i) for i in range(400)] + [("hot", i % 3, i) for i in range(200)] + [(None, 1, 7)]
    df = spark.createDataFrame(lines, "doc string, a int, id int").withColumn("items", F.array(F.lit("x"), F.lit("y")))
    want = number_lines(df.withColumn("item", F.explode("items")), ["doc"], ["a", "item", "id"], "line")
    columns = ["doc", "a", "id", "item", "line"]
    before = folders(spark, WORK, "cells")
    by = dealing(df, ["doc"], 20)
    got = number_repeated_lines(df, ["doc"], ["a"], ["id"], "items", "item", "line", dealt=by)
    (cells,) = folders(spark, WORK, "cells") - before
    assert by.heavy is not None and {r[0] for r in spark.read.parquet(f"{shared_root(spark)}/{WORK}/{cells}").select("doc").distinct().collect()} == {"hot"}
    assert rows(got.select(columns)) == rows(want.select(columns))
    before = folders(spark, WORK, "cells")
    plain = number_repeated_lines(df.filter("doc != 'hot'"), ["doc"], ["a"], ["id"], "items", "item", "line", dealt=Dealing(["doc"], 20, None))
    assert folders(spark, WORK, "cells") == before and len(shuffles(plain)) == 1


@pytest.mark.parametrize("name", ["import_open_ap", "open_ap_spread", "ar_activity_by_basis", "import_jtd_cost"])
def test_large_tables_give_the_same_rows_over_more_tasks(spark, monkeypatch, name):
    def build(tables):
        if name == "open_ap_spread":
            return DATASETS["import_open_ap"].build(tables.src, tables.maps, tables.params, spread_keys=True)
        return {**DATASETS, **ARCHIVED}[name].build(tables.src, tables.maps, tables.params)

    want = rows(build(Landed(spark, SF)))
    monkeypatch.setattr(workspace, "ROWS_PER_TASK", 600)
    assert rows(build(Landed(spark, SF))) == want


def test_invoices_meet_distributions_after_one_shuffle_each(spark, monkeypatch):
    monkeypatch.setattr(workspace, "ROWS_PER_TASK", 600)
    fresh = Landed(spark, SF)
    df = payables.open_distributions(fresh.src, workspace.tasks_for(fresh.src["ap_distribution"]))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert len(shuffles(df)) == 2
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_rows_gather_what_rows_of_their_keys_hold(spark):
    data = [("a", None), ("a", (1, "x")), ("a", (1, "x")), ("a", (2, None)), ("a", None), ("b", None), (None, (3, "z")), (None, None), ("c", (4, "w"))]
    df = spark.createDataFrame(data, "k string, it struct<n:int,t:string>").repartition(7, "k")
    got = gather(df, "it", ["k"], [], "copies")
    assert len(shuffles(got)) == 1
    found = sorted(((r.k, sorted(tuple(i) for i in r.it)) for r in got.collect()), key=str)
    assert found == sorted([("a", [(1, "x", 2), (2, None, 1)])] * 2 + [("b", []), (None, [(3, "z", 1)])], key=str)


def test_activity_of_one_customer_with_most_rows(spark, monkeypatch, source, mapped):
    """Customers, documents and statuses that repeat or are NULL, over many tasks and over few."""
    def line(i):
        return {
            "Customer": "big" if i % 3 else (None if i % 2 else "small"), "Status_Type": "Invoice", "Status_Seq": i % 40, "Actvty_Seq": i % 2,
            "Status_Date": dt.date(1999, 1, 2), "Accounting_Date": dt.date(1999, 1, 2), "Amount": i, "Retainage": 0, "Amount_Type": "Amount",
            "Transaction_Type": "Invoice" if i % 5 else "Cash receipt", "Job": None if i % 7 == 0 else f"J{i % 4}", "Description": f"t{i % 6}", "Invoice": f"I{i % 9}",
        }

    seen = [{**{k: line(i)[k] for k in ("Customer", "Status_Type", "Status_Seq", "Actvty_Seq", "Status_Date")}, "Activity_Type": f"A{i % 2}", "Due_Date": None if i % 4 else dt.date(1999, 2, 1)} for i in range(0, 90, 2)]
    src = {
        "ar_transaction": source("ar_transaction", *[line(i) for i in range(300)]),
        "ar_activity": source("ar_activity", *seen, *seen[:20]),
        "customer": source("customer", {"Customer": "big", "Name": "Big"}, {"Customer": "big", "Name": "Twice"}),
        "job": source("job", {"Job": "J1", "Description": "one"}, {"Job": "J2", "Description": None}),
    }
    maps = {
        "job": mapped("job", *[{"legacy_job_id": j, "legacy_extra_id": e, "new_job_id": n, "include_job": 1} for j, e, n in (("J1", "", "P1"), ("J1", "X", "P1"), ("J1", "Y", "P2"), ("J3", "", None))]),
        "customer": mapped("customer", {"legacy_customer_id": "big", "new_customer_id": "B"}, {"legacy_customer_id": "small", "new_customer_id": None}),
        "entity": mapped("entity", {"legacy_entity_id": "1", "new_entity_id": "E1"}, {"legacy_entity_id": "2", "new_entity_id": "E2"}),
    }
    params = Params({"GL03_DETAIL_STOP": "2000-01-01"})
    want = rows(receivables.ar_activity_by_basis(src, maps, params))
    monkeypatch.setattr(workspace, "ROWS_PER_TASK", 20)
    assert rows(receivables.ar_activity_by_basis(src, maps, params)) == want and len(want) > 100
