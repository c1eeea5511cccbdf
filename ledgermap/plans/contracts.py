"""Project contracts and estimates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgermap.functions.parse import rebase_contract
from ledgermap.functions.semantics import iso, joined, tag
from ledgermap.operators.documents import split_measures
from ledgermap.operators.lookup import translate
from ledgermap.operators.numbering import number_repeated_lines
from ledgermap.plans.common import (
    SKIP,
    Tables,
    emit,
    entities_of_folder,
    entity_lists,
    first_line,
    folder_entities,
    included_jobs,
    look_up,
)
from ledgermap.sources.tables import Params

c = F.col
FOLDER = {"Data_Folder_Id": "Data_Folder_Id"}
PROGRESS = ("Progress Billing", "Lump Sum")


def _contract_items(src: Tables, maps: Tables) -> DataFrame:
    """Items of included jobs with their contract. Lookups that are unique by key and unused are left out."""
    items = src["contract_item"]
    df = look_up(items, {"job": included_jobs(maps)}, "job", "Job", {"_job": "new_job_id"}, how="inner")
    contract = {
        "_contract": "Contract",
        "_name": "Description",
        "_contract_folder": "Data_Folder_Id",
        "_signed": "Contract_Date",
        "_stamp": "Date_Stamp",
    }
    df = translate(df, src["contract"], {**FOLDER, "Contract": "Contract"}, contract)
    df = look_up(df, maps, "customer", "Customer", {"_customer": "new_customer_id"})
    return df.withColumn("_new_contract", rebase_contract(c("_contract"), c("_job")))


def import_contract_header(src: Tables, maps: Tables, params: Params) -> DataFrame:
    """Distinct headers; they are reduced to distinct rows before the contract totals are joined."""
    heads = (
        _contract_items(src, maps)
        .select(
            "Data_Folder_Id",
            "_contract",
            "_contract_folder",
            "_new_contract",
            "_name",
            "_job",
            "_customer",
            F.coalesce("_signed", "_stamp").cast("date").alias("_date"),
            F.when(c("Billing_Type").isin(*PROGRESS), "Fixed Price").otherwise("TM").alias("_type"),
        )
        .distinct()
    )
    totals = {
        "_t1": "Revised_Contract",
        "_t2": "Total_Billed",
        "_t3": "Cash_Receipt",
        "_t4": "Receivable_Adjustment",
        "_t5": "Retainage_Held",
        "_t6": "Retainage_Billed",
    }
    derived = src["contract_derived"].select("Data_Folder_Id", "Contract", *totals.values()).distinct()
    df = translate(heads, derived, {"_contract_folder": "Data_Folder_Id", "_contract": "Contract"}, totals)
    return emit(
        df,
        [
            (SKIP, c("Data_Folder_Id")),
            (SKIP, c("_contract")),
            ("PROJECTCONTRACTID", c("_new_contract")),
            ("NAME", c("_name")),
            ("PROJECTID", c("_job")),
            ("CUSTOMERID", c("_customer")),
            ("DATE", c("_date")),
            ("DESCRIPTION", ""),
            ("PROJECTCONTRACTTYPE", c("_type")),
            ("ARCHITECT", ""),
            ("BILLABLE", "true"),
            ("STATUS", "active"),
            ("POSTED", "true"),
            ("POSTEDTO", c("_date")),
            ("ORIGINALGLBUDGETID", "Original Contract"),
            ("REVISIONGLBUDGETID", "Revision Contract"),
            ("APPROVEDGLBUDGETID", "Approved CO Contract"),
            ("PENDINGGLBUDGETID", "Pending CO Contract"),
            ("FORECASTGLBUDGETID", "Forecast Contract"),
            ("OTHERGLBUDGETID", "Other Contract"),
            *[(SKIP, c(n)) for n in totals],
        ],
    )


def contract_measures(df: DataFrame) -> DataFrame:
    """Each item as an original row and a revision row; rows without a kind or a price are dropped."""
    original, changes = c("Original_Contract_Total"), c("_changes")
    rows = split_measures(
        df,
        [
            {
                "_wf": F.when(original >= 0, "original").otherwise(""),
                "_item": F.lit("Contract Item"),
                "_price": original,
            },
            {
                "_wf": F.when(changes != 0, "revision"),
                "_item": F.when(changes != 0, "Contract CO Item"),
                "_price": changes,
            },
        ],
    )
    return rows.filter(c("_wf").isNotNull() & (c("_price") != 0))


def import_contract_lines(src: Tables, maps: Tables, params: Params, strict_keys: bool = False) -> DataFrame:
    derived = {
        "_revised": "Revised_Contract",
        "_changes": "Approved_Contract_Changes",
        "_billed": "Total_Billed",
        "_adjusted": "Receivable_Adjustment",
        "_held": "Retainage_Held",
        "_ret_billed": "Retainage_Billed",
        "_receipt": "Cash_Receipt",
    }
    on = {**FOLDER, "Contract": "Contract", "Contract_Item": "Contract_Item"}
    df = translate(_contract_items(src, maps), src["contract_item_derived"], on, derived)
    df = contract_measures(df)
    df = folder_entities(df, maps, {"_any": "new_entity_id"}, strict_keys)
    billing = c("Billing_Type")
    stamp = c("Date_Stamp").cast("date")
    day = F.coalesce(c("Approval_Date").cast("date"), stamp)
    capped = billing == "Cost Plus to Maximum"
    hourly = billing == "Time & Materials"
    return emit(
        df,
        [
            (SKIP, c("Data_Folder_Id")),
            ("PROJECTCONTRACTID", c("_new_contract")),
            ("PROJECTCONTRACTLINEID", c("Contract_Item")),
            ("NAME", c("Description")),
            ("PROJECTID", c("_job")),
            ("ITEMID", ""),
            ("DESCRIPTION", c("Description")),
            ("CONTRACTLINEDATE", day),
            ("GLACCOUNTID", c("Default_Revenue_Account")),
            ("RETAINAGEPERCENTAGE", c("Retainage_Percent")),
            ("BILLABLE", "true"),
            ("STATUS", "active"),
            (
                "BILLINGTYPE",
                F.when(billing.isNull(), "").when(billing.isin(*PROGRESS), "Progress").otherwise("TM"),
            ),
            ("MAXIMUMBILLING", F.when(capped, "Specified amount").when(hourly, "No maximum").otherwise("")),
            (
                "MAXIMUMBILLINGAMOUNT",
                F.coalesce(F.when(capped, c("_revised")), F.lit(0).cast("decimal(18,2)")),
            ),
            ("DEFAULTRATETABLEID", c("Markup_Table")),
            ("TSRATETABLEID", c("Rate_Table_Labor")),
            ("PORATETABLEID", c("Rate_Table_Subcontract")),
            ("APRATETABLEID", c("Rate_Table_Material")),
            ("GLRATETABLEID", c("Rate_Table_Equipment")),
            ("CCRATETABLEID", c("Rate_Table_Other")),
            ("DEPARTMENTID", ""),
            ("ENTRY_WFTYPE", c("_wf")),
            ("ENTRY_PROJECTID", c("_job")),
            ("ENTRY_TASKID", ""),
            ("ENTRY_COSTTYPEID", ""),
            ("ENTRY_ITEMID", c("_item")),
            ("ENTRY_PRICE", c("_price")),
            ("ENTRY_PRICEEFFECTIVEDATE", day),
            ("ENTRY_MEMO", ""),
            ("ENTRY_DEPARTMENTID", ""),
            ("TASKID", ""),
            ("COSTTYPEID", ""),
            ("ENTRY_CUSTOMERID", c("_customer")),
            (SKIP, tag("LG_PROJECT|", c("Job"))),
            (SKIP, tag("LG_CUST|", c("Customer"))),
            (SKIP, c("_revised")),
            (SKIP, c("_changes")),
            (SKIP, c("_billed")),
            (SKIP, c("_adjusted")),
            (SKIP, c("_held")),
            (SKIP, c("_ret_billed")),
            (SKIP, c("Format")),
            (SKIP, c("_receipt")),
            (SKIP, stamp),
            (SKIP, c("Row_ID")),
        ],
    )


# Account by category letter.
ESTIMATE_ACCOUNTS = {"L": "5100", "S": "5120", "M": "5110"}
OTHER_ESTIMATE_ACCOUNT = "5130"
# Line order inside an estimate: originals before changes, then the entity; the rest breaks ties.
ESTIMATE_ORDER = (
    "_branch _task _type Job Extra Cost_Code Category".split(),
    "Data_Folder_Id _amount _qty _production Cost_Account".split(),
)


def _estimate_account() -> Column:
    out = None
    for letter, account in ESTIMATE_ACCOUNTS.items():
        hit = c("Category") == letter
        out = F.when(hit, account) if out is None else out.when(hit, account)
    return out.otherwise(OTHER_ESTIMATE_ACCOUNT)


def estimate_measures(df: DataFrame) -> DataFrame:
    """Each category as an original estimate (A) and an approved change (B), where not zero."""
    rows = split_measures(
        df,
        [
            {
                "_branch": F.lit("A"),
                "_wf": F.lit("original"),
                "_qty": c("Original_Estimate_Units"),
                "_amount": c("Original_Estimate"),
                "_production": c("_orig_production"),
            },
            {
                "_branch": F.lit("B"),
                "_wf": F.lit("approved change"),
                "_qty": c("Approved_Est_Unit_Changes"),
                "_amount": c("Approved_Estimate_Changes"),
                "_production": c("_chg_production"),
            },
        ],
    )
    return rows.filter(c("_amount") != 0)


def _numbered_per_job(df: DataFrame, maps: Tables, strict_keys: bool) -> DataFrame:
    """Lines numbered per new job and repeated for each entity of their folder, as ``_entity``.

    One job must have one list of entities. Where jobs of several folders become one job, its lines
    are repeated before they are numbered: the lists then have one item. A line carries the place of
    its list, the list itself is looked up after the lines are numbered.
    """
    jobs = included_jobs(maps).select(c("new_job_id").alias("_new"), "data_folder_id").distinct()
    shared = jobs.groupBy("_new").agg(F.count("*").alias("_n")).filter(c("_n") > 1)
    whole = entity_lists(entities_of_folder(maps, strict_keys), []).withColumn("_apart", F.lit(False))
    items = whole.select("data_folder_id", F.explode("_list").alias("_e"))
    single = items.select(
        "data_folder_id", F.array("_e").alias("_list"), c("_e.new_entity_id").alias("_single"), F.lit(True).alias("_apart")
    )
    lists = whole.unionByName(single)
    places = lists.groupBy("data_folder_id", "_apart").agg(F.sort_array(F.collect_list(F.struct("_single", "_list"))).alias("_lists"))
    folder = {"Data_Folder_Id": "data_folder_id", "_apart": "_apart"}
    listed = translate(df, shared, {"_job": "_new"}, {"_folders": "_n"})
    listed = listed.withColumn("_apart", c("_folders").isNotNull() | c("_job").isNull())
    count = places.withColumn("_singles", c("_lists._single"))
    listed = translate(listed, count, folder, {"_singles": "_singles"}, {"_singles": F.array(F.lit(None).cast("string"))})
    placed = listed.select(*df.columns, "_apart", F.posexplode("_singles").alias("_place", "_single"))

    def add(rows: DataFrame) -> DataFrame:
        none = F.array(F.struct(F.lit(None).cast("string").alias("new_entity_id")))
        found = translate(rows, places, folder, {"_found": "_lists"})
        return found.withColumn("_list", F.coalesce(F.get("_found", c("_place"))["_list"], none)).drop("_found")

    before, after = ESTIMATE_ORDER
    lines = number_repeated_lines(placed, ["_job"], [*before, "_single"], after, "_list", "_item", "_line", add)
    return lines.withColumn("_entity", c("_item.new_entity_id"))


def import_project_estimates(src: Tables, maps: Tables, params: Params, strict_keys: bool = False) -> DataFrame:
    job_key = {**FOLDER, "Job": "Job"}
    jobs = {"job": included_jobs(maps)}
    df = look_up(src["job_category"], jobs, "job", "Job", {"_job": "new_job_id"}, how="inner")
    df = translate(df, src["job"], job_key, {"_prefix": "Cost_Account_Prefix", "_updated": "Last_Cost_Update"})
    production = {"_orig_production": "Orig_Production_Units_Est", "_chg_production": "Apprvd_Prodctn_Unit_Chgs"}
    df = translate(df, src["job_cost_code"], {**job_key, "Extra": "Extra", "Cost_Code": "Cost_Code"}, production)
    df = look_up(df, maps, "cost_code", "Cost_Code", {"_task": "new_cost_code_id"})
    df = look_up(df, maps, "cost_type", "Category", {"_type": "new_cost_type_id"})
    df = look_up(df, maps, "department", "_prefix", {"_department": "new_department_id"})
    kept = ["_job", "_wf", "_department", "_updated", "Cost_Unit_Description"]
    rows = estimate_measures(df).select(*ESTIMATE_ORDER[0], *ESTIMATE_ORDER[1], *kept)
    lines = _numbered_per_job(rows, maps, strict_keys)
    effective = F.lit(params.date("GL03_DETAIL_STOP"))

    return emit(
        lines,
        [
            (SKIP, c("Data_Folder_Id")),
            ("PJESTIMATEID", first_line(c("_job"))),
            ("DESCRIPTION", first_line(joined(c("_job"), " Estimate"))),
            ("STATUS", first_line("active")),
            ("ISPRIMARY", first_line("true")),
            ("PJESTIMATETYPENAME", first_line("Current Estimate")),
            ("POSTED", first_line("TRUE")),
            ("GLBUDGETID", first_line("Project Estimate")),
            ("POSTTO", first_line("Estimate date")),
            ("ESTIMATEDATE", first_line(iso(effective))),
            ("PROJECTID", first_line(c("_job"))),
            ("PJESTIMATEENTRY_LINENO", c("_line")),
            ("PJESTIMATEENTRY_WFTYPE", c("_wf")),
            ("PJESTIMATEENTRY_TASKID", c("_task")),
            ("PJESTIMATEENTRY_COSTTYPEID", c("_type")),
            ("PJESTIMATEENTRY_ITEMID", "Beginning Balance"),
            ("PJESTIMATEENRY_UNITCOST", ""),
            ("PJESTIMATEENTRY_QTY", c("_qty")),
            ("PJESTIMATEENTRY_AMOUNT", c("_amount")),
            ("PJESTIMATEENTRY_EUOM", c("Cost_Unit_Description")),
            ("PJESTIMATEENTRY_PRODUCTIONUNITS", c("_production")),
            ("PJESTIMATEENTRY_ACCOUNTNO", _estimate_account()),
            ("PJESTIMATEENTRY_EFFECTIVEDATE", effective),
            ("PJESTIMATEENTRY_LOCATIONID", c("_entity")),
            ("PJESTIMATEENTRY_PROJECTID", c("_job")),
            ("PJESTIMATEENTRY_DEPARTMENTID", c("_department")),
            ("PJESTIMATEENTRY_CLASSID", ""),
            ("DONOTIMPORT2", c("Job")),
            ("DONOTIMPORT3", c("Extra")),
            ("DONOTIMPORT4", c("Cost_Code")),
            ("DONOTIMPORT5", c("Category")),
            ("DONOTIMPORT6", c("Cost_Account")),
            ("DONOTIMPORT9", c("_updated")),
        ],
    )
