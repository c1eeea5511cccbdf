"""Reconciliation reports."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgermap.functions.semantics import MONEY, month_end
from ledgermap.plans.common import Tables, included_jobs, look_up
from ledgermap.plans.summary import ledger_rows
from ledgermap.sources.tables import Params

c = F.col


def report_gl_batch_outage(src: Tables, maps: Tables, params: Params) -> DataFrame:
    """Accrual batches that do not balance within a month and origin."""
    rows = ledger_rows(src).filter(
        (c("Accrual_or_Cash") == "Accrual") & (c("Accounting_Date") <= F.lit(params.outage_to).cast("date"))
    )
    keys = ["Data_Folder_Id", "Batch", month_end(c("Accounting_Date")).alias("Period"), "Application_of_Origin"]
    return (
        rows.groupBy(*keys)
        .agg(
            F.sum("Debit").cast(MONEY).alias("DEBIT_AMT"),
            (-F.sum("Credit")).cast(MONEY).alias("CREDIT_AMT"),
            F.round(F.sum(c("Debit") + c("Credit")), 2).cast(MONEY).alias("NET_AMT"),
        )
        .filter(c("NET_AMT") != 0)
    )


# Job totals in report order; the last but one is printed under another name.
JOB_TOTALS = (
    "Original_Contract_Amount JTD_Aprvd_Contract_Chgs Revised_Contract_Amount JTD_Cost Extras_JTD_Cost "
    "Original_Estimate JTD_Aprvd_Estimate_Chgs Total_Estimate Extras_Total_Estimate JTD_Work_Billed "
    "Extras_JTD_Work_Billed Original_Commitment Revised_Commitment Commitment_Invoiced "
    "Extras_JTD_Aprvd_Cntrc_Chgs Extras_Orig_Contract_Amount Extras_Revised_Contract_Amt JTD_Retainage_Held"
).split()


def report_job_summary(src: Tables, maps: Tables, params: Params) -> DataFrame:
    df = look_up(src["job"], {"job": included_jobs(maps)}, "job", "Job", {"_job": "new_job_id"}, how="inner")
    printed = {"Extras_Revised_Contract_Amt": "Extra_Revised_Contract_Amt"}
    return df.select(
        c("Data_Folder_Id").alias("DATA_FOLDER_ID"),
        c("Job").alias("LEGACY_JOB_ID"),
        c("_job").alias("JOB_ID"),
        "Description",
        "Cost_Account_Prefix",
        *[c(n).alias(printed.get(n, n)) for n in JOB_TOTALS],
    )
