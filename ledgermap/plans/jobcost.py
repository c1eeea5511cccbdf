"""Job-to-date cost as balanced journal documents, packed into batches of whole documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgermap.functions.parse import compose_memo
from ledgermap.functions.semantics import blank_if_null, iso, joined, joined_or_blank, money_text, tag, text
from ledgermap.operators.documents import BATCH_ROWS, double_entry, packed_documents
from ledgermap.operators.lookup import existing_keys, translate
from ledgermap.plans.common import SKIP, Tables, emit, first_line, included_jobs, look_up
from ledgermap.plans.ledger import segment_targets
from ledgermap.sources.tables import Params, in_months
from ledgermap.sources.workspace import tasks_for

c = F.col

# Cost kinds that count, and memo labels in order.
COST_KINDS = ("AP cost", "EQ cost", "JC cost", "PR cost", "IV cost", "SM cost")
MEMO_PARTS = [
    (" Vendor ID: ", "Vendor"),
    (" AP Inv ID: ", "Invoice"),
    (" Job ID: ", "Job"),
    (" Customer ID: ", "Customer"),
    (" Cust Inv ID: ", "AR_Invoice"),
]

OFFSET_KEYS = "Data_Folder_Id Accounting_Date _title _acct _entity _department _class _document _memo _job".split()
ENTRY_KEYS = OFFSET_KEYS + (
    "_task _type _vendor Job Extra Debit_Account Credit_Account Cost_Code Category Vendor".split()
)
# Line order inside a document: entries before offsets, then account; the rest breaks ties.
ORDER = ["entry_offset", "_acct", *[k for k in ENTRY_KEYS if k not in ("_title", "_acct")], "debit", "credit"]


def job_cost_memo() -> Column:
    return compose_memo(c("Description"), [(label, c(n)) for label, n in MEMO_PARTS], null_safe=True)


def cost_rows(src: Tables, params: Params) -> DataFrame:
    """Costs up to the cutoff that are no commitment and have a debit account."""
    return in_months(src["jc_transaction"], "Accounting_Date", None, params.date("GL03_DETAIL_STOP")).filter(
        (c("Commitment") == "")
        & c("Transaction_Type").isin(*COST_KINDS)
        & (c("Debit_Account") != "")
    )


def live_costs(src: Tables, params: Params) -> DataFrame:
    """Cost rows whose cost code is still on the job."""
    on = {k: k for k in ("Cost_Code", "Job", "Extra", "Data_Folder_Id")}
    codes = src["job_cost_code"]
    return existing_keys(cost_rows(src, params), codes, on, tasks_for(codes))


def _account_copies(src: Tables, maps: Tables) -> DataFrame:
    """How often an account matches the account, location and department translations together.

    Every cost row counts that often.
    """
    return (
        segment_targets(src, maps)
        .groupBy("data_folder_id", "account")
        .agg(F.sum("copies").alias("_copies"))
        .filter(c("_copies") > 1)
    )


def job_cost_entries(src: Tables, maps: Tables, params: Params, strict_keys: bool = False) -> DataFrame:
    """Entry and offset rows of all documents, before numbering."""
    job = {"_job": "new_job_id", "_entity": "new_entity_id", "_department": "new_department_id", "_class": "new_class_id"}
    df = translate(
        live_costs(src, params),
        included_jobs(maps),
        {"Job": "legacy_job_id", "Extra": "legacy_extra_id", "Data_Folder_Id": "data_folder_id"},
        job,
        how="inner",
    )
    df = look_up(df, maps, "cost_code", "Cost_Code", {"_task": "new_cost_code_id"})
    df = look_up(df, maps, "cost_type", "Category", {"_type": "new_cost_type_id", "_acct": "new_gl_account"})
    df = look_up(df, maps, "vendor", "Vendor", {"_vendor": "new_vendor_id"})
    amount = c("Amount")
    if not strict_keys:
        on = {"Debit_Account": "account", "Data_Folder_Id": "data_folder_id"}
        df = translate(df, _account_copies(src, maps), on, {"_copies": "_copies"}, {"_copies": F.lit(1)})
        amount = amount * c("_copies").cast("decimal(18,0)")
    title = joined_or_blank(
        c("_job"),
        " | Acct Date: ",
        iso(c("Accounting_Date")),
        " | Application of Origin: ",
        c("Application_of_Origin"),
        " | Batch: ",
        c("Batch"),
    )
    rows = df.withColumns(
        {
            "_title": title,
            "_document": F.when(c("Application_of_Origin") == "AP", c("Invoice")).otherwise(c("AR_Invoice")),
            "_memo": job_cost_memo(),
            "_task": F.coalesce("_task", "Cost_Code", F.lit("")),
            "_type": F.coalesce("_type", "Category", F.lit("")),
            "_amount": amount.cast("decimal(38,2)"),
            **{n: blank_if_null(c(n)) for n in ("_vendor", "_entity", "_department", "_class")},
        }
    )
    return double_entry(rows, ENTRY_KEYS, OFFSET_KEYS, c("_amount"), store=True)


def import_jtd_cost(
    src: Tables,
    maps: Tables,
    params: Params,
    batch_rows: int = BATCH_ROWS,
    strict_keys: bool = False,
    repeat_header: bool = False,
) -> DataFrame:
    """Lines are numbered and batches sized before zero-net lines are dropped."""
    entries = job_cost_entries(src, maps, params, strict_keys)
    packed = packed_documents(entries, "_title", ORDER, batch_rows, "_line", "_batch", tasks_for(src["jc_transaction"]))
    net = c("debit") - c("credit")
    is_entry = c("entry_offset") == "0"

    def header(value: Column | str) -> Column:
        return text(value) if repeat_header else first_line(value)

    def entry(value: Column) -> Column:
        return F.when(is_entry, value).otherwise("")

    return emit(
        packed.filter(net != 0).withColumn("_net", net.cast("decimal(38,2)")),
        [
            (SKIP, c("_batch")),
            (SKIP, ""),
            ("JOURNAL", header("OBJ")),
            ("DATE", header(iso(c("Accounting_Date")))),
            ("DESCRIPTION", header(joined("Cost Entry | ", c("_title")))),
            ("REFERENCE_NO", ""),
            ("LINE_NO", c("_line")),
            ("ACCT_NO", c("_acct")),
            ("LOCATION_ID", c("_entity")),
            ("DEPT_ID", c("_department")),
            ("CLASS_ID", c("_class")),
            ("DOCUMENT", entry(c("_document"))),
            ("MEMO", entry(c("_memo"))),
            ("DEBIT", F.when(c("_net") >= 0, money_text(c("_net"))).otherwise("")),
            ("CREDIT", F.when(c("_net") < 0, money_text(-c("_net"))).otherwise("")),
            (SKIP, c("_net")),
            ("STATUS", "POSTED"),
            ("GLENTRY_PROJECTID", entry(c("_job"))),
            ("GLENTRY_TASKID", entry(c("_task"))),
            ("GLENTRY_COSTTYPEID", entry(c("_type"))),
            ("GLENTRY_VENDORID", entry(c("_vendor"))),
            (SKIP, entry(c("_vendor"))),
            (SKIP, tag("PROJECT_ID | ", c("_job"))),
            (SKIP, entry(tag("LGY_JOB | ", c("Job")))),
            (SKIP, entry(tag("LGY_EXTRA | ", c("Extra")))),
            (SKIP, entry(tag("LGY_DB_ACCT | ", c("Debit_Account")))),
            (SKIP, c("_title")),
            (SKIP, entry(tag("LGY_COST_CODE | ", c("Cost_Code")))),
            (SKIP, entry(tag("LGY_COST_TYPE | ", c("Category")))),
        ],
    )


def api_jtd_cost(src: Tables, maps: Tables, params: Params) -> DataFrame:
    return import_jtd_cost(src, maps, params, repeat_header=True)
