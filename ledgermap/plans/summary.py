"""A summary of the ledger that the coarse datasets share instead of scanning it once each.

It holds one row per folder, account, batch, origin, accrual mark, month and stretch of days between
the dates at which any window begins or ends. A whole stretch lies inside a window or outside of it,
so its newest date stands for all its days. The columns are called as in the ledger, and sums and
maxima over them are the ledger's: each dataset keeps its own filters and grain. Rows without a
debit or without a credit are kept apart, since sums of both leave them out.
"""

from __future__ import annotations

import datetime as dt
from collections import ChainMap

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgermap.functions.semantics import month_end
from ledgermap.plans.common import Tables
from ledgermap.sources.tables import Params
from ledgermap.sources.workspace import stage

SUMMARY = "gl_summary"
AREA = "shared"
KEYS = ["Data_Folder_Id", "Account", "Batch", "Application_of_Origin", "Accrual_or_Cash"]
c = F.col


def ledger_rows(src: Tables) -> DataFrame:
    """The summary where there is one, else the ledger; only for sums and maxima."""
    return src[SUMMARY] if SUMMARY in src else src["gl_transaction"]


def window_borders(params: Params) -> list[dt.date]:
    """First days of the windows, and the days after their last ones."""
    day = dt.timedelta(days=1)
    firsts = [dt.date(1980, 1, 1), params.date("GL02_MONTHLY_START"), dt.date.fromisoformat(params.combine_from)]
    lasts = [params.date("GL01_BALANCE_END"), params.date("GL02_MONTHLY_STOP")]
    lasts += [dt.date.fromisoformat(d) for d in (params.outage_to, params.combine_to)]
    return sorted({*firsts, *[d + day for d in lasts if d < dt.date.max]})


def ledger_summary(transactions: DataFrame, params: Params) -> DataFrame:
    day = c("Accounting_Date")
    stretch = sum((F.when(day >= F.lit(b), 1).otherwise(0) for b in window_borders(params)), F.lit(0))
    apart = {"_month": month_end(day), "_stretch": stretch, "_no_debit": c("Debit").isNull(), "_no_credit": c("Credit").isNull()}
    return (
        transactions.groupBy(*KEYS, *[column.alias(n) for n, column in apart.items()])
        .agg(
            F.max(day).alias("Accounting_Date"),
            F.sum("Debit").alias("Debit"),
            F.sum("Credit").alias("Credit"),
            F.count("*").alias("entries"),
        )
        .drop(*apart)
    )


def with_summary(src: Tables, params: Params) -> Tables:
    """``src`` with the summary beside it, written once to the shared folder.

    The other tables are looked up when they are used: a table that is built on first use stays unbuilt.
    """
    return ChainMap({SUMMARY: stage(ledger_summary(src["gl_transaction"], params), SUMMARY, AREA)}, src)
