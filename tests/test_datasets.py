from __future__ import annotations

import re
from decimal import Decimal
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from checks.compare import compare, duck
from checks.expected import EXPECTED
from checks.queries import QUERIES
from ledgermap.operators.numbering import number_lines
from ledgermap.plans import jobcost, ledger, masters, payables, receivables
from ledgermap.plans.common import verbatim_header
from ledgermap.plans.registry import ARCHIVED, DATASETS, run_all
from ledgermap.plans.seeds import accounts
from ledgermap.sources.schemas import conform
from ledgermap.sources.sink import ImportJob, generate_imports
from ledgermap.sources.tables import Params, land, source as read_source
from ledgermap.sources.workspace import shared_root
from tests.conftest import SF

# Number of columns in each dataset's contract.
WIDTHS = {
    "import_gl_base_account": 11,
    "import_employees": 36,
    "import_bank_accounts": 22,
    "import_open_cash": 13,
    "import_customers": 26,
    "import_vendors": 39,
    "import_vendors_ach": 10,
    "import_vendor_1099": 10,
    "import_projects": 24,
    "import_standard_cost_types": 13,
    "import_standard_cost_codes": 17,
    "import_cost_types": 8,
    "import_cost_codes": 13,
    "import_open_ap": 38,
    "import_open_ar": 30,
    "import_contract_header": 26,
    "import_contract_lines": 46,
    "import_project_estimates": 33,
    "import_gl_opening": 22,
    "import_gl_monthly": 22,
    "import_gl_detail": 22,
    "import_jtd_cost": 29,
    "api_jtd_cost": 29,
    "report_gl_batch_outage": 7,
    "report_open_ar_aging": 14,
    "report_job_summary": 23,
    "ar_activity_by_basis": 38,
    "open_ar_flat": 30,
    "open_ar_project": 30,
    "gl_detail_flat": 22,
}
HOT = "import_open_ap import_open_ar import_project_estimates import_gl_detail import_jtd_cost".split()


@pytest.fixture(scope="module")
def contract():
    """Output columns per dataset; the oracle test proves that Spark has the same ones."""
    con = duck(SF)
    yield {n: con.sql(EXPECTED[n]).columns for n in WIDTHS}
    con.close()


def test_widths(contract):
    assert set(WIDTHS) == set(DATASETS) | set(ARCHIVED)
    assert {n: len(columns) for n, columns in contract.items()} == WIDTHS


@pytest.mark.parametrize("name", HOT)
def test_documents_over_many_cells_change_nothing(spark, name):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        assert compare(spark, duck(SF), SF, QUERIES[name], EXPECTED[name]) == []
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_debit_minus_credit_is_net(tables):
    for df, net in (
        (ledger.import_gl_detail(tables.src, tables.maps, tables.params), "DONOTIMPORT_02"),
        (ledger.import_gl_opening(tables.src, tables.maps, tables.params), "DONOTIMPORT_08"),
        (jobcost.import_jtd_cost(tables.src, tables.maps, tables.params), "DONOTIMPORT_03"),
    ):
        def number(n):
            return F.coalesce(F.nullif(F.col(n), F.lit("")).cast("decimal(38,2)"), F.lit(0))

        assert df.filter((number("DEBIT") - number("CREDIT")) != F.col(net)).isEmpty()
        assert df.filter("DEBIT != '' and CREDIT != ''").isEmpty()


def test_job_cost_documents_balance(tables):
    entries = jobcost.job_cost_entries(tables.src, tables.maps, tables.params)
    net = entries.groupBy("_title").agg(F.sum(F.col("debit") - F.col("credit")).alias("net"))
    assert net.filter("net != 0").isEmpty() and not net.isEmpty()


def test_small_batches_keep_documents_whole(tables):
    df = jobcost.import_jtd_cost(tables.src, tables.maps, tables.params, batch_rows=10)
    per = df.groupBy("DONOTIMPORT_09").agg(F.countDistinct("DONOTIMPORT_01").alias("n"))
    assert per.filter("n > 1").isEmpty() and df.select("DONOTIMPORT_01").distinct().count() > 3


def test_receivables_tie_to_the_aging_report(tables):
    flat = receivables.import_open_ar(tables.src, tables.maps, tables.params, strict_keys=True)
    mine = flat.agg(F.sum("PRICE").alias("p"), F.sum("SODOCUMENTENTRY_AMOUNTRETAINED").alias("r")).first()
    total = receivables.report_open_ar_aging(tables.src, tables.maps, tables.params).filter("is_total = 1").first()
    assert (mine.p, mine.r) == (total.Amount, -total.Ret_Net)


def test_strict_keys_do_not_multiply(tables):
    src, maps, params = tables.src, tables.maps, tables.params
    window = ledger._window(src, params.date("GL03_DETAIL_START"), params.date("GL03_DETAIL_STOP"))
    want = window.agg(F.sum(F.col("Debit") + F.col("Credit")).alias("v")).first().v
    got = ledger.import_gl_detail(src, maps, params, strict_keys=True)
    assert got.agg(F.sum("DONOTIMPORT_02").alias("v")).first().v == want
    stop = params.date("GL01_BALANCE_END")
    want = ledger._window(src, ledger.FIRST_DAY, stop).agg(F.sum(F.col("Debit") + F.col("Credit")).alias("v")).first().v
    got = ledger.import_gl_opening(src, maps, params, strict_keys=True)
    assert got.agg(F.sum("DONOTIMPORT_08").alias("v")).first().v == want


def test_paid_invoice_with_retainage_is_kept(source):
    dist = source(
        "ap_distribution",
        *[
            {"Vendor": "V", "Invoice": i, "Amount": a, "Amount_Paid": p, "Retainage": r, "Retainage_Paid": 0}
            for i, a, p, r in (("paid", 10, 10, 5), ("open", 10, 4, 0), ("even", 10, 10, 0), ("late", 10, 2, 0))
        ],
    )
    invoices = source(
        "ap_invoice",
        *[{"Vendor": "V", "Invoice": i, "Status": s} for i, s in (("paid", "Paid"), ("open", "Open"), ("even", "Open"), ("late", "Paid"))],
    )
    kept = payables.open_distributions({"ap_distribution": dist, "ap_invoice": invoices})
    assert {r.Invoice for r in kept.collect()} == {"paid", "open"}


def test_customer_terms_and_vendor_terms(source, mapped):
    customers = source(
        "customer", {"Customer": "A", "Days_Before_Due": 0}, {"Customer": "B", "Days_Before_Due": 30}, {"Customer": "C"}
    )
    maps = {
        "customer": mapped("customer", *[{"legacy_customer_id": k, "include_customer": i} for k, i in (("A", 1), ("B", 1), ("C", 0))])
    }
    rows = masters.import_customers({"customer": customers}, maps, Params()).collect()
    assert {r.LEGACY_CUSTOMER: r.TERM_NAME for r in rows} == {"A | F1": "", "B | F1": "Net 30"}
    terms = {"a": (5, 2, 30), "b": (0, 0, 0), "c": (0, 0, 45)}
    vendors = source(
        "vendor",
        *[
            {"Vendor": v, "Discount_Days": d, "Discount_Percent": p, "Payment_Days": n, "Default_Payment_Type": "Wire"}
            for v, (d, p, n) in terms.items()
        ],
    )
    maps = {"vendor": mapped("vendor", *[{"legacy_vendor_id": v, "new_vendor_id": v, "include_vendor": 1} for v in terms])}
    rows = masters.import_vendors({"vendor": vendors}, maps, Params()).collect()
    assert {r.VENDOR_ID: r.TERM_NAME for r in rows} == {"a": "2.00/5 net 30", "b": "Due Upon Receipt", "c": "net 45"}
    assert {r.PAYMENT_METHOD for r in rows} == {"Unknown Type"}


def test_cost_code_rows(source):
    slots = [("01-000", "", None), ("01-010", "L", " "), ("0110", "M", ""), ("00-000", "L", "")]
    codes = source("std_cost_code", *[{"Cost_Code": k, "Category_1": a, "Category_2": b} for k, a, b in slots])
    got = {(r.Cost_Code, r._category) for r in masters.code_categories(codes).collect()}
    assert got == {("01-000", ""), ("01-010", "L"), ("0110", "M"), ("00-000", "")}


def test_missing_dates_are_blank_on_the_aging_report(source, mapped):
    key = {"Customer": "C", "Status_Type": "I", "Status_Date": "2000-01-05", "Status_Seq": 1}
    src = {
        "ar_transaction": source(
            "ar_transaction",
            {**key, "Amount_Type": "Amount", "Amount": 10, "Retainage": 0},
            {**key, "Amount_Type": "Amount", "Amount": 5, "Retainage": -1, "Due_Date": "2000-02-01"},
            {**key, "Amount_Type": "Retainage released", "Amount": 99, "Retainage": 0},
            {**key, "Amount_Type": "Amount", "Amount": 7, "Retainage": 0, "Accounting_Date": "2001-01-01"},
        ),
        "ar_status": source("ar_status", {**key, "Invoice": "I1", "Status": "Open"}),
        "ar_activity": source("ar_activity", {**key, "Activity_Type": "Invoice", "Retainage_Held": -1, "Retainage_Billed": 0}),
        "customer": source("customer", {"Customer": "C", "Name": "Cee"}),
    }
    rows = receivables.report_open_ar_aging(src, {"customer": mapped("customer")}, Params({"GL03_DETAIL_STOP": "2000-11-30"})).collect()
    detail = next(r for r in rows if not r.is_total)
    assert (detail.Amount, detail.Due_Date, detail.New_Customer_ID) == (Decimal("14.00"), None, "")
    total = next(r for r in rows if r.is_total)
    assert (total.Customer, total.Amount, total.Total_Outstanding) == ("~~~~ TOTALS ~~~~", Decimal("14.00"), Decimal("13.00"))


def test_activity_options(source, mapped):
    key = {"Customer": "C", "Status_Type": "I", "Status_Date": "2000-01-05", "Status_Seq": 1}
    base = {**key, "Amount_Type": "Amount", "Retainage": -10, "Amount": 100, "Transaction_Type": "Invoice", "Invoice": "I1", "Draw": "D1"}
    src = {
        "ar_transaction": source(
            "ar_transaction",
            {**base, "Actvty_Seq": 1, "Accounting_Date": "2000-01-10", "Due_Date": "2001-05-01"},
            {**base, "Actvty_Seq": 2, "Accounting_Date": "2000-01-10", "Amount_Type": "Retainage released", "Related_Status_Date": "2001-02-02"},
            {**base, "Actvty_Seq": 3, "Accounting_Date": "2000-01-10", "Amount_Type": "FC", "Amount": 3, "Retainage": 0},
            {**base, "Actvty_Seq": 4, "Amount_Type": "NSF Bank charge"},
        ),
        "ar_activity": source("ar_activity", {**key, "Actvty_Seq": 1, "Due_Date": "1900-01-01"}, {**key, "Actvty_Seq": 3, "Due_Date": "2000-03-03"}),
        "customer": source("customer"),
        "job": source("job"),
    }
    maps = {n: mapped(n) for n in ("job", "customer", "entity")}
    params = Params({"GL03_DETAIL_STOP": "2000-11-30"})

    def run(**options):
        df = receivables.ar_activity_by_basis(src, maps, params, receivables.ActivityOptions(**options))
        return {(r.DOCUMENTNO, r.PRICE) for r in df.collect()}

    documents = run()
    assert {p for _, p in documents} == {Decimal("100.00"), Decimal("3.00"), Decimal("10.00")}
    assert {d for d, _ in documents} <= {"I1", "RetBill: I1", ""}
    assert {p for _, p in run(include_finance_charges=False)} == {Decimal("100.00"), Decimal("10.00")}
    assert {p for _, p in run(include_retainage=False)} == {Decimal("90.00"), Decimal("3.00"), Decimal("0.00")}
    assert {p for _, p in run(aging_basis="Due date")} == {Decimal("3.00")}
    assert {p for _, p in run(aging_basis="Invoice date")} == {Decimal("100.00"), Decimal("3.00")}
    assert {d for d, _ in run(primary_id="Draw")} <= {"D1", "RetBill: D1", ""}


def test_all_files_are_written(tables, contract, tmp_path):
    done = run_all(tables.src, tables.maps, tables.params, str(tmp_path))
    assert [o.name for o in done] == sorted(DATASETS)
    assert [o for o in done if o.error] == []
    for outcome in done:
        files = sorted((tmp_path / outcome.name).glob("part-*.csv"))
        header = files[0].read_text().splitlines()[0].split(",") if files else None
        if files and outcome.rows:
            assert sorted(header) == sorted(n for n in verbatim_header(contract[outcome.name]) if n != "is_total")
    lines = [line for f in sorted((tmp_path / "report_open_ar_aging").glob("part-*.csv")) for line in f.read_text().splitlines()[1:]]
    assert lines[-1].startswith("~~~~ TOTALS ~~~~") and sum("TOTALS" in line for line in lines) == 1


def test_documents_stay_together_in_files(spark, tables, tmp_path):
    run = DATASETS["import_open_ap"]
    job = ImportJob(lambda: run.build(tables.src, tables.maps, tables.params, sort_columns=True), verbatim_header)
    generate_imports({"ap": job}, str(tmp_path))
    rows = [re.split(r",(?=(?:[^\"]*\"[^\"]*\")*[^\"]*$)", line) for f in sorted((tmp_path / "ap").glob("part-*.csv")) for line in f.read_text().splitlines()[1:]]
    numbers = [int(r[12]) for r in rows]
    assert all(b == 1 or b == a + 1 for a, b in zip(numbers, numbers[1:]))


def test_one_failure_does_not_stop_the_rest(spark, tmp_path):
    def broken():
        raise RuntimeError("no such table")

    good = ImportJob(lambda: spark.createDataFrame([(None, 1)], "a string, b int"), lambda n: ["X", "X"])
    done = generate_imports({"b_bad": ImportJob(broken, list), "a": good, "c": good}, str(tmp_path))
    assert [(o.name, o.rows, bool(o.error)) for o in done] == [("a", 1, False), ("b_bad", None, True), ("c", 1, False)]
    # a part without rows may stand beside the one with the row
    texts = {f.read_text() for f in (tmp_path / "a").glob("part-*.csv")}
    assert texts - {"X,X\n"} == {"X,X\n,1\n"}


def test_no_work_is_left_behind(spark, tmp_path):
    def failing():
        return number_lines(spark.range(5).selectExpr("1 AS doc", "id"), ["doc"], ["id"]).filter(
            F.raise_error(F.lit("no such row")).isNull()
        )

    done = generate_imports({"bad": ImportJob(failing, list)}, str(tmp_path))
    assert done[0].error and not Path(shared_root(spark), "work").exists()


def test_a_table_without_a_key_is_refused(spark):
    with pytest.raises(ValueError, match="Commitment"):
        conform(spark.createDataFrame([("F1", "J")], "Data_Folder_Id string, Job string"), "jc_transaction")
    exact = conform(
        spark.createDataFrame([("F1", "V", "I", 0.1, 0.2, 0.3)], "Data_Folder_Id string, Vendor string, Invoice string, Amount double, Amount_Paid double, Retainage double"),
        "ap_distribution",
    )
    assert dict(exact.dtypes)["Amount"] == "decimal(18,2)" and "Job" in exact.columns


def test_an_unsplit_database_read_is_refused(spark):
    with pytest.raises(ValueError, match="partitionColumn"):
        read_source(spark, "job", "jdbc:none")


def test_filters_and_columns_reach_a_landed_table(spark, tables, tmp_path):
    land(tables.src["gl_transaction"], "gl_transaction", str(tmp_path))
    rows = read_source(spark, "gl_transaction", str(tmp_path))
    params = tables.params
    df = ledger._window({"gl_transaction": rows}, params.date("GL03_DETAIL_START"), params.date("GL03_DETAIL_STOP"))
    plan = df.filter("Data_Folder_Id = 'F1'").select("Debit")._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(Accounting_Date" in plan and "EqualTo(Accrual_or_Cash,Accrual)" in plan
    assert re.search(r"PartitionFilters: \[[^\]]*Data_Folder_Id", plan)
    assert re.search(r"PartitionFilters: \[[^\]]*posting_month", plan)
    months = {int(f.split("posting_month=")[1].split("/")[0]) for f in df.select("_metadata.file_path").distinct().toPandas()["file_path"]}
    assert months <= set(range(200001, 200012)) and months
    assert "Reference_1" not in plan.split("ReadSchema")[1]


def test_two_targets_of_a_prefix_count_each_cost_twice(tables):
    def copies(maps):
        found = ledger.segment_targets(tables.src, maps).filter("prefixabc <> ''").groupBy("data_folder_id", "account")
        return {(r[0], r[1]): r[2] for r in found.agg(F.sum("copies")).collect()}

    maps = {name: tables.maps[name] for name in tables.maps}
    prefixes = accounts(tables.src).select("data_folder_id", "prefixabc").distinct()
    two = maps | {
        "location": prefixes.select(
            "data_folder_id",
            F.col("prefixabc").alias("legacy_location_id"),
            F.explode(F.array(F.lit("L1"), F.lit("L2"))).alias("new_location_id"),
        )
    }
    once = copies(maps)
    assert once and copies(two) == {account: 2 * n for account, n in once.items()}

    def total(maps):
        entries = jobcost.job_cost_entries(tables.src, maps, tables.params)
        return entries.agg(F.sum(F.col("debit") + F.col("credit")).alias("v")).first().v

    assert total(two) > total(maps) > 0
