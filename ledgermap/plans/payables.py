"""Open payables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgermap.functions.semantics import blank_if_null, first_chars, iso_or_blank, tag
from ledgermap.operators.lookup import translate
from ledgermap.operators.numbering import dealing, number_repeated_lines
from ledgermap.operators.spread import forecast, missing_keys
from ledgermap.plans.common import (
    SKIP,
    Tables,
    emit,
    entities_of_folder,
    first_line,
    jobs_without_extra,
    listed_entities,
    look_up,
    project_if_included,
)
from ledgermap.sources.tables import Params
from ledgermap.sources.workspace import tasks_for

c = F.col


DOCUMENT_KEYS = ["Data_Folder_Id", "Vendor", "Invoice"]


def owed_distributions(src: Tables) -> DataFrame:
    dist = src["ap_distribution"].withColumns(
        {"_price": c("Amount") - c("Amount_Paid"), "_retained": c("Retainage") - c("Retainage_Paid")}
    )
    return dist.filter((c("_price") != 0) | (c("_retained") != 0))


def open_distributions(src: Tables, tasks: int | None = None) -> DataFrame:
    """Unpaid distributions of open invoices, and every distribution with retainage left.

    The retainage test stands beside the status test, not under it: a paid invoice that still
    holds retainage is kept. ``tasks`` deals distributions and invoices over that many.
    """
    invoice = {
        "_invoice": "Invoice",
        "_inv_folder": "Data_Folder_Id",
        "_inv_vendor": "Vendor",
        "_inv_date": "Invoice_Date",
        "_posted": "Accounting_Date",
        "_pay": "Payment_Date",
        "_status": "Status",
    }
    df = translate(owed_distributions(src), src["ap_invoice"], {n: n for n in DOCUMENT_KEYS}, invoice, tasks=tasks)
    return df.filter(((c("_status") == "Open") & (c("_price") != 0)) | (c("_retained") != 0))


def import_open_ap(
    src: Tables,
    maps: Tables,
    params: Params,
    strict_keys: bool = False,
    sort_columns: bool = False,
    spread_keys: bool = False,
) -> DataFrame:
    """``spread_keys`` deals heavy vendors and jobs (blank ones above all) over many tasks."""
    folder = {"Data_Folder_Id": "Data_Folder_Id"}
    tasks = tasks_for(src["ap_distribution"])
    owed = owed_distributions(src)
    spread = {"spread": True, "counted": owed} if spread_keys else {}
    df = open_distributions(src, tasks)
    df = translate(df, src["vendor"], {"Vendor": "Vendor", **folder}, {"_vendor_name": "Name"})
    df = look_up(df, maps, "vendor", "Vendor", {"_vendor": "new_vendor_id", "_vendor_in": "include_vendor"}, **spread)
    df = look_up(df, maps, "cost_code", "Cost_Code", {"_task": "new_cost_code_id"})
    df = look_up(df, maps, "cost_type", "Category", {"_type": "new_cost_type_id"})
    df = translate(df, src["account_format"], folder, {"_a_length": "Account_Prefix_A_Length"})
    job = {"_job": "new_job_id", "_include": "include_job"}
    df = look_up(df, {"job": jobs_without_extra(maps)}, "job", "Job", job, **spread)
    df = listed_entities(df, entities_of_folder(maps, strict_keys), {"pkg_npc_commit": F.lit(None).cast("int")})
    df = df.withColumn("_npc", c("_list")[0]["pkg_npc_commit"])

    plain = (c("_npc") == 0) | ((c("_npc") == 1) & ((c("Job") == "") | (c("_include") == 0)))
    rows = df.select(
        "Data_Folder_Id",
        "Vendor",
        "Invoice",
        "Dist_Seq",
        F.when(plain, "").otherwise("#NPC").alias("_package"),
        c("_inv_folder").alias("_folder"),
        iso_or_blank(c("_inv_date")).alias("_date"),
        iso_or_blank(c("_posted")).alias("_posting"),
        "_vendor",
        "_invoice",
        iso_or_blank(c("_pay")).alias("_due"),
        project_if_included().alias("_project"),
        "Description",
        "_price",
        "_list",
        "_single",
        "_retained",
        blank_if_null(c("_task")).alias("_task"),
        blank_if_null(c("_type")).alias("_type"),
        "_inv_vendor",
        "_vendor_name",
        "Job",
        "Extra",
        first_chars(c("Expense_Account"), c("_a_length")).alias("_account_prefix"),
        "Cost_Code",
        "Category",
        "Commitment",
        F.when(c("_vendor_in") == 1, "ok").otherwise("Missing Vendor").alias("_check"),
    )
    before, after = OPEN_AP_ORDER
    lines = number_repeated_lines(
        rows,
        DOCUMENT_KEYS,
        [*before, "_single"],
        after,
        repeats="_list",
        item="_item",
        out="_line",
        dealt=dealing(owed, DOCUMENT_KEYS, tasks),
    )
    lines = lines.withColumn("_entity", c("_item.new_entity_id"))
    return emit(
        lines,
        [
            (SKIP, c("_package")),
            (SKIP, c("_folder")),
            ("TRANSACTIONTYPE", first_line("Startup AP")),
            ("DATE", first_line(c("_date"))),
            ("GLPOSTINGDATE", first_line(c("_posting"))),
            ("VENDOR_ID", first_line(c("_vendor"))),
            ("VENDORDNOCNO", first_line(c("_invoice"))),
            ("DOCUMENTNO", first_line(c("_invoice"))),
            ("REFERENCENO", first_line(c("_invoice"))),
            ("DATEDUE", first_line(c("_due"))),
            ("PROJECTID", first_line(c("_project"))),
            ("STATE", first_line("Closed")),
            ("LINE", c("_line")),
            ("ITEMID", "Beginning Balance"),
            ("ITEMDESC", c("Description")),
            ("QUANTITY", "1"),
            ("UNIT", "Each"),
            ("CONVERSIONTYPE", "Price"),
            ("PRICE", c("_price")),
            ("LOCATIONID", c("_entity")),
            ("DEPARTMENTID", ""),
            ("PODOCUMENTENTRY_PROJECTID", c("_project")),
            ("PODOCUMENTENTRY_TRX_AMOUNTRETAINED", c("_retained")),
            ("PODOCUMENTENTRY_TASKID", c("_task")),
            ("PODOCUMENTENTRY_COSTTYPEID", c("_type")),
            ("PODOCUMENTENTRY_VENDORID", c("_vendor")),
            ("MEMO", c("Description")),
            (SKIP, c("_price")),
            (SKIP, tag("LG_VEND_ID|", c("_inv_vendor"))),
            (SKIP, tag("LG_VEND_NAME|", c("_vendor_name"))),
            (SKIP, tag("LG_JOB|", c("Job"))),
            (SKIP, tag("LG_EXTRA|", c("Extra"))),
            (SKIP, tag("GL_PREF|", c("_account_prefix"))),
            (SKIP, tag("LG_CC|", c("Cost_Code"))),
            (SKIP, tag("LG_DESC|", c("Description"))),
            (SKIP, tag("LG_CT|", c("Category"))),
            (SKIP, tag("LG_COMMIT|", c("Commitment"))),
            (SKIP, tag("VND_CHK|", c("_check"))),
        ],
        sort=["_folder", "_vendor", "_invoice", "Vendor", "_line"] if sort_columns else None,
    )


def open_ap_lookups(src: Tables, maps: Tables) -> dict[str, tuple[DataFrame, dict[str, str]]]:
    """The lookups of ``import_open_ap`` after its invoices, by name: table, and its key by column."""
    folder = {"Data_Folder_Id": "data_folder_id"}
    return {
        "vendor name": (src["vendor"], {"Vendor": "Vendor", "Data_Folder_Id": "Data_Folder_Id"}),
        "vendor": (maps["vendor"], {"Vendor": "legacy_vendor_id", **folder}),
        "cost code": (maps["cost_code"], {"Cost_Code": "legacy_cost_code_id", **folder}),
        "cost type": (maps["cost_type"], {"Category": "legacy_cost_type_id", **folder}),
        "account format": (src["account_format"], {"Data_Folder_Id": "Data_Folder_Id"}),
        "job": (jobs_without_extra(maps), {"Job": "legacy_job_id", **folder}),
        "entity": (maps["entity"], folder),
    }


def open_ap_forecast(src: Tables, maps: Tables) -> DataFrame:
    """How many rows ``import_open_ap`` will have, before it runs."""
    chain = [(table, on, "left") for table, on in open_ap_lookups(src, maps).values()]
    return forecast(open_distributions(src), chain)


def open_ap_missing(src: Tables, maps: Tables) -> DataFrame:
    """Keys of the open distributions that have no translation, with their rows and unpaid amounts."""
    lookups = open_ap_lookups(src, maps)
    wanted = {n: lookups[n] for n in ("vendor", "cost code", "cost type", "job", "entity")}
    return missing_keys(open_distributions(src), wanted, "_price")


# Line order inside an invoice: the distribution number, then the entity, then every column that can differ.
OPEN_AP_ORDER = (
    ["Dist_Seq"],
    (
        "Description _price _retained _project _task _type _package "
        "Job Extra _account_prefix Cost_Code Category Commitment _check _vendor"
    ).split(),
)
