"""First version of each translation table, derived from the landed tables."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgermap.functions.parse import account_segments
from ledgermap.functions.semantics import MONEY, joined, month_end, year_month
from ledgermap.operators.lookup import translate, unused_keys
from ledgermap.plans.common import Tables
from ledgermap.plans.summary import ledger_rows
from ledgermap.sources.schemas import mapping_schema
from ledgermap.sources.tables import Params, empty_mapping, lookup_acct_type, useful_fields

c = F.col
NEW_ACCOUNT_NEEDED = "(New GL Account Needed)"


def _as(df: DataFrame, name: str, **columns) -> DataFrame:
    """Columns of translation table ``name`` in order and type; those not given are NULL."""
    fields = mapping_schema(name).fields
    return df.select(*[columns.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in fields])


def accounts(src: Tables) -> DataFrame:
    return account_segments(src["gl_account"], src["account_format"])


def seed_data_folder(src: Tables, params: Params) -> DataFrame:
    folder, section = c("Data_Folder_Id"), c("Section_Id")
    seeds = _as(
        src["data_folder"],
        "data_folder",
        legacy_data_folder_id=folder,
        legacy_data_folder_name=section,
        new_id=folder,
        new_name=section,
        destination=F.lit("ENTITY"),
        include_data_folder=F.lit(1),
    )
    return seeds.distinct()


def seed_job(src: Tables, params: Params) -> DataFrame:
    folder, job, name, blank = c("Data_Folder_Id"), c("Job"), c("Description"), F.lit("")
    shared = {
        "legacy_job_id": job,
        "legacy_job_name": name,
        "new_job_name": name,
        "legacy_data_folder_id": folder,
        "data_folder_id": folder,
    }
    dimensions = {f"new_{d}_id": blank for d in ("entity", "department", "class", "customer", "pm")}
    jobs = _as(
        src["job"],
        "job",
        **shared,
        **dimensions,
        legacy_job_status=c("Status"),
        new_job_id=job,
        include_job=F.when(c("Status") != "Closed", 1).otherwise(0),
        legacy_extra_id=blank,
    )
    extras = _as(src["extra"], "job", **shared, legacy_extra_id=c("Extra"), include_job=F.lit(0))
    return jobs.unionByName(extras)


def seed_customer(src: Tables, params: Params) -> DataFrame:
    dash = F.lit("-")
    return _as(
        src["customer"],
        "customer",
        data_folder_id=c("Data_Folder_Id"),
        legacy_customer_id=c("Customer"),
        legacy_customer_name=c("Name"),
        legacy_customer_status=c("Status"),
        legacy_customer_type=c("Customer_Type"),
        new_customer_id=c("Customer"),
        new_customer_type=c("Customer_Type"),
        include_customer=F.when(c("Status") == "Active", 1).otherwise(0),
        on_open_ar=dash,
        on_open_oe=dash,
        on_open_other=dash,
    )


def seed_vendor(src: Tables, params: Params) -> DataFrame:
    inactive, off = c("Inactive") == 1, F.lit(0)
    return _as(
        src["vendor"],
        "vendor",
        data_folder_id=c("Data_Folder_Id"),
        legacy_vendor_id=c("Vendor"),
        legacy_vendor_name=c("Name"),
        legacy_vendor_status=F.when(inactive, "INACTIVE").otherwise("ACTIVE"),
        legacy_vendor_type=c("Type"),
        new_vendor_id=c("Vendor"),
        new_vendor_type=c("Type"),
        include_vendor=F.when(inactive, 0).otherwise(1),
        on_open_ap=off,
        on_open_commitment=off,
        on_open_other=off,
    )


def seed_cost_code(src: Tables, params: Params) -> DataFrame:
    code, name = c("Cost_Code"), c("Description")
    return _as(
        src["std_cost_code"],
        "cost_code",
        legacy_cost_code_id=code,
        legacy_cost_code_name=name,
        new_cost_code_id=code,
        new_cost_code_name=name,
        new_item_id=code,
        data_folder_id=c("Data_Folder_Id"),
    )


def seed_cost_type(src: Tables, params: Params) -> DataFrame:
    return _as(
        src["std_category"],
        "cost_type",
        legacy_cost_type_id=c("Category"),
        legacy_cost_type_name=c("Description"),
        new_cost_type_id=c("Category"),
        new_item_id=c("Accumulate_As"),
        new_gl_account=c("Cost_Account_A"),
        data_folder_id=c("Data_Folder_Id"),
    )


def seed_base_account(src: Tables, params: Params) -> DataFrame:
    """Base accounts that no bank uses, plus one full-account row per bank account."""
    chart, banks = accounts(src), src["bank_account"]
    used_by_bank = {"account": "General_Cash_Account", "data_folder_id": "Data_Folder_Id"}
    base = (
        unused_keys(chart, banks, used_by_bank)
        .select("data_folder_id", c("baseaccount").alias("legacy"), c("account_title").alias("note"))
        .distinct()
        .select("*", c("legacy").alias("new"), F.lit("BASE").alias("kind"), c("legacy").alias("base"))
    )
    note = joined(c("Account_Type"), " | ", c("Description"), " | ", c("Bank_Name"), " | ", c("Bank_Account"))
    full = translate(
        banks,
        chart,
        {"Data_Folder_Id": "data_folder_id", "General_Cash_Account": "account"},
        {"base": "baseaccount"},
    ).select(
        c("Data_Folder_Id").alias("data_folder_id"),
        c("General_Cash_Account").alias("legacy"),
        note.alias("note"),
        F.lit(NEW_ACCOUNT_NEEDED).alias("new"),
        F.lit("FULL").alias("kind"),
        "base",
    )
    typed = translate(
        base.unionByName(full),
        src["base_account"],
        {"data_folder_id": "Data_Folder_Id", "base": "Base_Account"},
        {"_type": "Base_Account_Type"},
    )
    types = F.broadcast(lookup_acct_type(typed.sparkSession))
    classified = typed.join(types, c("_type") == c("base_account_type"), "left")
    return _as(
        classified,
        "base_account",
        data_folder_id=c("data_folder_id"),
        legacy_base_account=c("legacy"),
        note=c("note"),
        fin_stmt=F.when(c("acct_type") == "N", "BS").otherwise("IS"),
        balance=c("normal_balance"),
        closeable=c("closeable"),
        acct_type=c("base_account_type"),
        acct_match_type=c("kind"),
        required=F.lit("1"),
        new_base_account=c("new"),
        cmo=F.lit(""),
        category=F.lit(""),
    )


def seed_entity(src: Tables, params: Params) -> DataFrame:
    flags = ("include_entity", "pkg_base", "pkg_constr_sum", "pkg_constr_det", "pkg_npc_commit", "pkg_pc_commit")
    return _as(
        src["prefix_a"],
        "entity",
        data_folder_id=c("Data_Folder_Id"),
        legacy_entity_id=c("Account_Prefix"),
        legacy_entity_name=c("Description"),
        new_entity_id=c("Account_Prefix"),
        **{flag: F.lit(0) for flag in flags},
    )


def seed_batch_combine(src: Tables, params: Params) -> DataFrame:
    """Batches that do not balance within a month, for the chosen dates and account prefixes."""
    rows = ledger_rows(src).filter(
        c("Accounting_Date").between(F.lit(params.combine_from).cast("date"), F.lit(params.combine_to).cast("date"))
        & (c("Accrual_or_Cash") == "Accrual")
        & F.left("Account", F.lit(2)).isin(*params.combine_prefixes)
    )
    net = F.sum(F.round(c("Debit") + c("Credit"), 2)).cast(MONEY)
    sums = (
        rows.groupBy(c("Batch").alias("source_batch"), month_end(c("Accounting_Date")).alias("period"))
        .agg(
            F.sum("Debit").alias("debit"),
            F.sum(-c("Credit")).alias("credit"),
            net.alias("net"),
        )
        .filter(c("net") != 0)
    )
    return _as(
        sums,
        "batch_combine",
        source_batch=c("source_batch"),
        period=c("period"),
        batch_per=joined(c("source_batch"), " | ", year_month(c("period"))),
        debit=c("debit"),
        credit=c("credit"),
        net=c("net"),
        net_abs=F.abs("net"),
        to_batch_alias=c("source_batch"),
        to_batch_id=c("source_batch"),
    )


def seed_employee(src: Tables, params: Params) -> DataFrame:
    active = c("Termination_Date").isNull()
    return _as(
        src["employee"],
        "employee",
        legacy_employee_id=c("Employee"),
        legacy_employee_name=c("Employee_Name"),
        legacy_employee_status=F.when(active, "Active").otherwise("Inactive"),
        new_employee_id=c("Employee"),
        include_employee=F.when(active, 1).otherwise(0),
        data_folder_id=c("Data_Folder_Id"),
    )


def _prefixes(src: Tables, name: str) -> DataFrame:
    columns = {f"legacy_{name}_id": c("prefixabc"), f"new_{name}_id": c("prefixabc")}
    return _as(accounts(src), name, data_folder_id=c("data_folder_id"), **columns).distinct()


def seed_location(src: Tables, params: Params) -> DataFrame:
    return _prefixes(src, "location")


def seed_department(src: Tables, params: Params) -> DataFrame:
    return _prefixes(src, "department")


SEEDS: dict[str, Callable[[Tables, Params], DataFrame]] = {
    "data_folder": seed_data_folder,
    "job": seed_job,
    "customer": seed_customer,
    "vendor": seed_vendor,
    "cost_code": seed_cost_code,
    "cost_type": seed_cost_type,
    "base_account": seed_base_account,
    "entity": seed_entity,
    "batch_combine": seed_batch_combine,
    "employee": seed_employee,
    "location": seed_location,
    "department": seed_department,
}

# Translation tables that start empty and are filled by hand.
EMPTY = ("class", "item", "warehouse")


def seed_builders(
    spark: SparkSession, src: Tables, params: Params, as_of: dt.date
) -> dict[str, Callable[[], DataFrame]]:
    """One builder per stored translation table, in creation order, for ``seed_all``."""
    derived = {name: lambda build=build: build(src, params) for name, build in SEEDS.items()}
    blank = {name: lambda name=name: empty_mapping(spark, name) for name in EMPTY}
    return {**derived, "useful_fields": lambda: useful_fields(spark, as_of), **blank}
