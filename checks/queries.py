"""The registered queries: every dataset, seed, sheet and operator over the driver's whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks.landed import Landed, landed
from ledgermap.functions.parse import account_segments, employee_names, parent_code, rebase_contract
from ledgermap.functions.semantics import MONEY
from ledgermap.operators.documents import (
    double_entry,
    header_detail,
    month_end_bucket,
    net_sides,
    pack_batches,
    retainage_balance,
    status_balance,
    unpivot_columns,
    with_total,
)
from ledgermap.operators.lookup import (
    existing_keys,
    fanout_audit,
    missing_translation,
    translate,
    translate_account,
    unused_keys,
)
from ledgermap.operators.spread import heavy_keys
from ledgermap.plans import contracts, jobcost, ledger, mappings, payables, receivables, summary
from ledgermap.plans.common import included_jobs, look_up
from ledgermap.plans.registry import ARCHIVED, DATASETS
from ledgermap.plans.seeds import SEEDS
from ledgermap.sources.sheets import EXTRA, SHEETS, checked_rows, clean_sheet, error_rows, usable_rows
from ledgermap.sources.sink import text_form
from ledgermap.sources.tables import lookup_1099, lookup_acct_type, lookup_state, split_predicates
from ledgermap.sources.workspace import tasks_for

c = F.col
Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(build: Callable[[Landed], DataFrame]) -> Callable[[Landed], DataFrame]:
    QUERIES[build.__name__] = lambda spark, sf_dir: build(landed(spark, sf_dir))
    return build


def _register(name: str, build: Callable[[Landed], DataFrame]) -> None:
    QUERIES[name] = lambda spark, sf_dir: build(landed(spark, sf_dir))


for _name, _dataset in {**DATASETS, **ARCHIVED}.items():
    _register(_name, lambda t, d=_dataset: d.build(t.src, t.maps, t.params))
for _name, _seed in SEEDS.items():
    _register(f"seed_{_name}", lambda t, s=_seed: s(t.src, t.params))
for _name in (
    "entity job base_account location department vendor customer cost_code cost_type employee".split()
):
    _key = {"base_account": "gl_account"}.get(_name, _name)
    _register(f"export_{_key}", lambda t, n=_name: mappings.export_sheet(t.maps, n))


@query
def lookup_acct_type_(t: Landed) -> DataFrame:
    rows = t.src["base_account"].select("Data_Folder_Id", "Base_Account", "Base_Account_Type")
    columns = {n: n for n in ("acct_type", "normal_balance", "closeable")}
    return translate(rows, F.broadcast(lookup_acct_type(t.spark)), {"Base_Account_Type": "base_account_type"}, columns)


@query
def lookup_state_(t: Landed) -> DataFrame:
    rows = t.src["customer"].select("Data_Folder_Id", "Customer", "State")
    return translate(rows, F.broadcast(lookup_state(t.spark)), {"State": "state_id"}, {"state_name": "state_name"})


@query
def lookup_1099_(t: Landed) -> DataFrame:
    rows = t.src["vendor"].select("Data_Folder_Id", "Vendor", "Form_Type_1099")
    forms = F.broadcast(lookup_1099(t.spark))
    return translate(rows, forms, {"Form_Type_1099": "form_type_1099_desc"}, {"form_code": "form_type_1099_code"})


for _name in ("lookup_acct_type", "lookup_state", "lookup_1099"):
    QUERIES[_name] = QUERIES.pop(f"{_name}_")

DATE_PARAMETERS = (
    "GL01_BALANCE_END GL02_MONTHLY_START GL02_MONTHLY_STOP GL03_DETAIL_START GL03_DETAIL_STOP".split()
)


@query
def param_dates(t: Landed) -> DataFrame:
    """Accrual rows and their net amount up to each date parameter."""
    rows = t.src["gl_transaction"].filter(c("Accrual_or_Cash") == "Accrual")
    sums = []
    for name in DATE_PARAMETERS:
        until = c("Accounting_Date") <= F.lit(t.params.date(name))
        net = F.sum(F.when(until, c("Debit") + c("Credit"))).cast(MONEY)
        sums.append(
            F.struct(
                F.lit(name).alias("field_name"),
                F.lit(t.params.date(name)).alias("field_date"),
                F.count_if(until).alias("rows_until"),
                net.alias("net_until"),
            )
        )
    return rows.agg(F.array(*sums).alias("_sums")).select(F.inline("_sums"))


@query
def account_segments_(t: Landed) -> DataFrame:
    return account_segments(t.src["gl_account"], t.src["account_format"])


@query
def employee_names_(t: Landed) -> DataFrame:
    return employee_names(t.src["employee"]).select(
        "Data_Folder_Id",
        "Employee",
        "Employee_Name",
        "Termination_Date",
        "Hire_Date",
        "Rehire_Date",
        "last_name",
        "first_name",
        "mi",
    )


for _name in ("account_segments", "employee_names"):
    QUERIES[_name] = QUERIES.pop(f"{_name}_")

# --- edited sheets, derived from the exported ones ---------------------------------------------


def customer_edits(t: Landed) -> DataFrame:
    """The customer sheet after editing: padded cells, hidden rows, blank keys, repeated keys."""
    number = F.substring("legacy_customer_id", 2, 6).cast("int")
    sheet = mappings.export_sheet(t.maps, "customer").withColumn("_no", number)
    first = sheet.withColumns(
        {
            "data_folder_id": F.when(c("_no") % 11 == 0, " ").otherwise(F.concat(F.lit(" "), c("data_folder_id"))),
            "new_customer_id": F.when(c("_no") % 5 == 0, "").otherwise(F.concat(F.lit("N"), c("new_customer_id"))),
            EXTRA: F.when(c("_no") % 7 == 0, "HIDE "),
            "_row": F.struct(F.lit(1).alias("part"), c("_no")),
        }
    )
    again = sheet.filter(c("_no") % 3 == 0).withColumns(
        {
            "new_customer_id": F.concat(F.lit("Z"), c("new_customer_id"), F.lit(" ")),
            EXTRA: F.lit(None).cast("string"),
            "_row": F.struct(F.lit(2).alias("part"), c("_no")),
        }
    )
    return first.unionByName(again).drop("_no")


@query
def sheet_clean(t: Landed) -> DataFrame:
    return clean_sheet(customer_edits(t), SHEETS["customer"], EXTRA).drop("_row")


@query
def apply_simple_map(t: Landed) -> DataFrame:
    return mappings.apply_raw(t.maps["customer"], customer_edits(t), "customer", EXTRA)


@query
def apply_audit(t: Landed) -> DataFrame:
    return mappings.apply_audit(t.maps["customer"], customer_edits(t), SHEETS["customer"], EXTRA)


def vendor_edits(t: Landed) -> DataFrame:
    """The vendor sheet after editing, with new ids that are too wide for the table and hidden rows."""
    number = F.substring("legacy_vendor_id", 2, 5).cast("int")
    return mappings.export_sheet(t.maps, "vendor").withColumns(
        {
            "new_vendor_id": F.when(number % 13 == 0, F.repeat(c("legacy_vendor_id"), F.lit(9))).otherwise(F.concat(F.lit("W"), c("legacy_vendor_id"))),
            EXTRA: F.when(number % 7 == 0, "hide"),
            "_row": number,
        }
    )


@query
def apply_audit_errors(t: Landed) -> DataFrame:
    return mappings.apply_audit(t.maps["vendor"], vendor_edits(t), SHEETS["vendor"], EXTRA)


@query
def sheet_errors(t: Landed) -> DataFrame:
    return mappings.sheet_errors(vendor_edits(t), SHEETS["vendor"], EXTRA)


@query
def apply_beside_errors(t: Landed) -> DataFrame:
    return mappings.apply_raw(t.maps["vendor"], vendor_edits(t), "vendor", EXTRA)


def folder_controls(t: Landed) -> DataFrame:
    """A date parameter for each folder, from its newest posting; some are no day that a spreadsheet shows."""
    day = F.date_diff("Accounting_Date", F.lit("1899-12-30").cast("date"))
    last = t.src["gl_transaction"].groupBy("Data_Folder_Id").agg(F.max(day).alias("day"))
    wide = F.when(c("Data_Folder_Id").isin("F1", "F3"), c("day") * 1000).otherwise(c("day"))
    return last.select(
        F.concat(F.lit("GL_STOP_"), c("Data_Folder_Id")).alias("field_name"), wide.cast("string").alias("field_value"),
        F.lit(1).alias("_row"),
    )


@query
def controls_checked(t: Landed) -> DataFrame:
    """Parameters that can be applied with their value, the others with their reason."""
    sheet = SHEETS["useful_fields"]
    checked = checked_rows(folder_controls(t), sheet)
    good = usable_rows(checked, sheet).select("field_name", "field_value", F.lit("").alias("reason"))
    return good.unionByName(error_rows(checked, sheet).withColumn("field_value", F.lit("")))


@query
def apply_entity(t: Landed) -> DataFrame:
    raw = mappings.export_sheet(t.maps, "entity").withColumns(
        {
            "pkg_base": F.when(c("new_entity_id") < "10", "True").otherwise("1"),
            "pkg_npc_commit": F.when(c("new_entity_id") < "10", "").otherwise("False"),
            "_row": c("new_entity_id"),
        }
    )
    return mappings.apply_raw(t.maps["entity"], raw, "entity", "pkg_pc_commit")


@query
def apply_job(t: Landed) -> DataFrame:
    number = F.substring("legacy_job_id", 4, 6).cast("int")
    raw = mappings.export_sheet(t.maps, "job").withColumns(
        {
            "include_job": F.when(number % 3 == 0, "YES").when(number % 3 == 1, "no").otherwise(c("include_job")),
            "new_job_id": F.concat(F.lit("P-"), c("legacy_job_id")),
            "new_pm_id": F.when(number % 2 == 0, "hide").otherwise("PM"),
            "_row": F.struct("data_folder_id", "legacy_job_id", "legacy_extra_id"),
        }
    )
    return mappings.apply_raw(t.maps["job"], raw, "job", "new_pm_id")


@query
def apply_gl_account(t: Landed) -> DataFrame:
    raw = mappings.export_sheet(t.maps, "base_account").withColumns(
        {
            "new_base_account": F.concat(F.lit("9"), c("legacy_base_account")),
            "cmo": F.when(c("fin_stmt") == "BS", "Create").otherwise("Merge"),
            "category": c("note"),
            "_row": c("note"),
        }
    )
    return mappings.apply_raw(t.maps["base_account"], raw, "base_account", "category")


@query
def apply_controls(t: Landed) -> DataFrame:
    """Period limits taken from the ledger as spreadsheet day numbers, written into the parameters."""
    day = F.date_diff("Accounting_Date", F.lit("1899-12-30").cast("date"))
    first, last = F.min(day).cast("string"), F.max(day).cast("string")
    limits = t.src["gl_transaction"].agg(first.alias("first"), last.alias("last"))
    entry = {"COMPANY_ID": "last", "GL03_DETAIL_START": "first", "GL03_DETAIL_STOP": "last", "NEW_STOP": "last"}
    cells = F.array(
        *[F.struct(F.lit(n).alias("field_name"), c(v).alias("field_value"), F.lit(1).alias("_row")) for n, v in entry.items()]
    )
    return mappings.apply_raw(t.maps["useful_fields"], limits.select(F.inline(cells)), "useful_fields")


@query
def import_text_form(t: Landed) -> DataFrame:
    return text_form(DATASETS["import_open_cash"].build(t.src, t.maps, t.params))


# --- operators -------------------------------------------------------------------------------


@query
def translate_lookup(t: Landed) -> DataFrame:
    rows = t.src["jc_transaction"].select("Data_Folder_Id", "Job", "Cost_Code", "Category", "Amount")
    df = look_up(rows, t.maps, "cost_type", "Category", {"new_cost_type_id": "new_cost_type_id"})
    return df.withColumn("new_cost_type_id", F.coalesce("new_cost_type_id", "Category"))


@query
def two_tier_account(t: Landed) -> DataFrame:
    rows = t.src["gl_account"].select("Data_Folder_Id", "Account")
    chart = account_segments(t.src["gl_account"], t.src["account_format"])
    return translate_account(rows, chart, t.maps["base_account"], "Account")


@query
def header_detail_(t: Landed) -> DataFrame:
    rows = t.src["ap_distribution"].select(
        "Data_Folder_Id", "Vendor", "Invoice", c("Invoice").alias("document"), "Dist_Seq", "Description", "Amount",
        "Cost_Code", "Category",
    )
    order = ["Dist_Seq", "Cost_Code", "Category", "Description", "Amount"]
    return header_detail(rows, ["Data_Folder_Id", "Vendor", "Invoice"], order, ["document"])


QUERIES["header_detail"] = QUERIES.pop("header_detail_")


@query
def net_sides_(t: Landed) -> DataFrame:
    return net_sides(t.src["gl_transaction"], ["Data_Folder_Id", "Account", "Batch"], c("Debit"), c("Credit"))


QUERIES["net_sides"] = QUERIES.pop("net_sides_")


@query
def double_entry_(t: Landed) -> DataFrame:
    offset = ["Data_Folder_Id", "Job", "Batch"]
    return double_entry(t.src["jc_transaction"], [*offset, "Cost_Code", "Category"], offset, c("Amount"))


QUERIES["double_entry"] = QUERIES.pop("double_entry_")


@query
def pack_batches_(t: Landed) -> DataFrame:
    rows = t.src["jc_transaction"].select("Job", "Cost_Code", "Category", "Amount")
    return pack_batches(rows, "Job", 1000)


QUERIES["pack_batches"] = QUERIES.pop("pack_batches_")


@query
def latest_per_batch(t: Landed) -> DataFrame:
    return ledger.latest_of_batch(t.src["gl_transaction"])


@query
def anti_join_accounts(t: Landed) -> DataFrame:
    rows = t.src["gl_account"].select("Data_Folder_Id", "Account")
    on = {"Data_Folder_Id": "Data_Folder_Id", "Account": "General_Cash_Account"}
    return unused_keys(rows, t.src["bank_account"], on)


@query
def semi_join_cost_code(t: Landed) -> DataFrame:
    rows = t.src["jc_transaction"].select("Data_Folder_Id", "Job", "Extra", "Cost_Code", "Amount")
    codes = t.src["job_cost_code"]
    return existing_keys(rows, codes, {k: k for k in ("Data_Folder_Id", "Job", "Extra", "Cost_Code")}, tasks_for(codes))


@query
def unpivot_categories(t: Landed) -> DataFrame:
    slots = [f"Category_{i}" for i in range(1, 13)]
    return unpivot_columns(t.src["std_cost_code"], ["Data_Folder_Id", "Cost_Code"], slots, "slot", "category")


@query
def parent_code_(t: Landed) -> DataFrame:
    rows = t.src["job_cost_code"].select("Data_Folder_Id", "Job", "Extra", "Cost_Code")
    return rows.withColumn("parent", parent_code(c("Cost_Code")))


QUERIES["parent_code"] = QUERIES.pop("parent_code_")


@query
def with_total_(t: Landed) -> DataFrame:
    rows = t.src["gl_transaction"].groupBy("Data_Folder_Id", "Batch").agg(
        F.sum("Debit").cast(MONEY).alias("debit"), F.sum("Credit").cast(MONEY).alias("credit")
    )
    return with_total(rows, ["debit", "credit"], {"Batch": "TOTAL"})


QUERIES["with_total"] = QUERIES.pop("with_total_")


@query
def ar_status_balance(t: Landed) -> DataFrame:
    return status_balance(t.src["ar_transaction"], t.params.date("GL03_DETAIL_STOP"))


@query
def ar_retainage_balance(t: Landed) -> DataFrame:
    return retainage_balance(t.src["ar_activity"])


@query
def split_measures(t: Landed) -> DataFrame:
    rows = t.src["job_category"].withColumns({"_orig_production": F.lit(None), "_chg_production": F.lit(None)})
    return contracts.estimate_measures(rows).select(
        "Data_Folder_Id",
        "Job",
        "Extra",
        "Cost_Code",
        "Category",
        c("_branch").alias("branch"),
        c("_wf").alias("kind"),
        c("_qty").alias("qty"),
        c("_amount").alias("amount"),
    )


@query
def month_end_rollup(t: Landed) -> DataFrame:
    rows = month_end_bucket(t.src["gl_transaction"], "Accounting_Date")
    return rows.groupBy("Data_Folder_Id", "period", "month").agg(
        F.sum("Debit").cast(MONEY).alias("debit"), F.count("*").alias("entries")
    )


@query
def compose_memo(t: Landed) -> DataFrame:
    """The strict memo of ledger rows and the NULL-safe memo of cost rows."""
    strict = t.src["gl_transaction"].select("Data_Folder_Id", ledger.gl_memo().alias("memo"))
    safe = t.src["jc_transaction"].select("Data_Folder_Id", jobcost.job_cost_memo().alias("memo"))
    return strict.unionByName(safe)


@query
def fanout_audit_(t: Landed) -> DataFrame:
    return fanout_audit(t.maps["base_account"], ["data_folder_id", "legacy_base_account"])


QUERIES["fanout_audit"] = QUERIES.pop("fanout_audit_")


@query
def missing_translation_(t: Landed) -> DataFrame:
    rows = t.src["jc_transaction"].select("Data_Folder_Id", "Job", "Category", "Amount")
    df = look_up(rows, t.maps, "cost_type", "Category", {"new_cost_type_id": "new_cost_type_id"})
    return missing_translation(df, "new_cost_type_id")


QUERIES["missing_translation"] = QUERIES.pop("missing_translation_")


@query
def rebase_contract_(t: Landed) -> DataFrame:
    rows = t.src["contract"].select("Data_Folder_Id", "Contract")
    jobs = included_jobs(t.maps).withColumn("new_job_id", F.concat(F.lit("N"), c("new_job_id")))
    df = look_up(rows, {"job": jobs}, "job", "Contract", {"job_id": "new_job_id"})
    return df.withColumn("contract_id", rebase_contract(c("Contract"), c("job_id")))


QUERIES["rebase_contract"] = QUERIES.pop("rebase_contract_")


# --- uneven keys, shared work, forecasts --------------------------------------------------------


@query
def translate_spread(t: Landed) -> DataFrame:
    """The lookup of ``translate_lookup`` with heavy keys dealt over the tasks."""
    rows = t.src["jc_transaction"].select("Data_Folder_Id", "Job", "Cost_Code", "Category", "Amount")
    df = look_up(rows, t.maps, "cost_type", "Category", {"new_cost_type_id": "new_cost_type_id"}, spread=True)
    return df.withColumn("new_cost_type_id", F.coalesce("new_cost_type_id", "Category"))


@query
def translate_spread_blank(t: Landed) -> DataFrame:
    """Vendors of ledger rows, three quarters of which have none."""
    rows = t.src["gl_transaction"].select("Data_Folder_Id", "Account", "Batch", F.nullif("Vendor", F.lit("")).alias("Vendor"), "Debit")
    return look_up(rows, t.maps, "vendor", "Vendor", {"new_vendor_id": "new_vendor_id"}, spread=True)


@query
def open_ap_spread(t: Landed) -> DataFrame:
    return DATASETS["import_open_ap"].build(t.src, t.maps, t.params, spread_keys=True)


@query
def heavy_vendor_keys(t: Landed) -> DataFrame:
    return heavy_keys(t.src["gl_transaction"], ["Data_Folder_Id", "Vendor"], 0.01)


def _shared(t: Landed) -> dict[str, DataFrame]:
    return summary.with_summary(t.src, t.params)


@query
def ledger_summary(t: Landed) -> DataFrame:
    return summary.ledger_summary(t.src["gl_transaction"], t.params)


for _name in ("import_gl_opening", "import_gl_monthly", "import_gl_detail", "report_gl_batch_outage"):
    _register(f"shared_{_name}", lambda t, d=DATASETS[_name]: d.build(_shared(t), t.maps, t.params))
_register("shared_seed_batch_combine", lambda t: SEEDS["batch_combine"](_shared(t), t.params))
_register("shared_latest_per_batch", lambda t: ledger.latest_of_batch(_shared(t)[summary.SUMMARY]))


@query
def open_ap_forecast(t: Landed) -> DataFrame:
    return payables.open_ap_forecast(t.src, t.maps)


@query
def open_ar_forecast(t: Landed) -> DataFrame:
    return receivables.open_ar_forecast(t.src, t.maps, t.params)


@query
def gl_detail_forecast(t: Landed) -> DataFrame:
    return ledger.gl_detail_forecast(t.src, t.maps, t.params)


@query
def open_ap_missing(t: Landed) -> DataFrame:
    return payables.open_ap_missing(t.src, t.maps)


@query
def split_reads(t: Landed) -> DataFrame:
    """Ledger rows per folder, read piece by piece between quantiles of their date."""
    rows = t.src["gl_transaction"]
    pieces = [rows.filter(p) for p in split_predicates(rows, "Accounting_Date", 8)]
    every = pieces[0]
    for piece in pieces[1:]:
        every = every.unionByName(piece)
    return every.groupBy("Data_Folder_Id").agg(F.count("*").alias("entries"), F.sum("Debit").cast(MONEY).alias("debit"))
