"""General-ledger datasets: opening balance, prior year by month, current year in detail.

All three are one operator with a different grain. Translation joins may multiply rows (several
titles per base account, several months per batch, several entities per folder). The sums must
reflect that, but no copy is ever built: each lookup is first reduced to its distinct results with
a count of copies, and amounts are multiplied by the count. For the two coarse grains the
transactions are summed per account before any lookup, so the joins see accounts, not transactions.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgermap.functions.parse import compose_memo
from ledgermap.functions.semantics import MONEY, iso, joined, money_text, month_end, tag, text, year_month
from ledgermap.operators.documents import header_detail, sides
from ledgermap.operators.lookup import MISSING_ACCOUNT, base_account_targets, existing_keys, latest_per, translate
from ledgermap.operators.spread import forecast
from ledgermap.plans.common import SKIP, Tables, emit, first_line
from ledgermap.plans.seeds import accounts
from ledgermap.plans.summary import ledger_rows
from ledgermap.sources.tables import Params, in_months

c = F.col
FIRST_DAY = dt.date(1980, 1, 1)
COUNT = "decimal(18,0)"


def _times(amount: str, *counts: str) -> Column:
    value = c(amount)
    for n in counts:
        value = value * F.coalesce(c(n), F.lit(1)).cast(COUNT)
    return value.cast(MONEY)


def _segment_map(maps: Tables, name: str) -> DataFrame:
    """Distinct usable translations of an account prefix."""
    old, new = f"legacy_{name}_id", f"new_{name}_id"
    return maps[name].filter((c(old) != "") & (c(new) != "")).select(old, new, "data_folder_id").distinct()


def segment_targets(src: Tables, maps: Tables) -> DataFrame:
    """Ledger accounts with new account, location and department; a row for each combination of matches."""
    chart = accounts(src).select("data_folder_id", "account", "baseaccount", "prefixa", "prefixabc")
    df = base_account_targets(chart, maps["base_account"])
    for name in ("location", "department"):
        on = {"prefixabc": f"legacy_{name}_id", "data_folder_id": "data_folder_id"}
        df = translate(df, _segment_map(maps, name), on, {f"_{name}": f"new_{name}_id"}, {f"_{name}": ""})
    return df


def account_targets(src: Tables, maps: Tables) -> DataFrame:
    """Per ledger account: new account, location, department and entity, with copies counted."""
    df = segment_targets(src, maps)
    entity = {"prefixa": "legacy_entity_id", "data_folder_id": "data_folder_id"}
    df = translate(df, maps["entity"], entity, {"_entity": "new_entity_id"})
    return df.groupBy("data_folder_id", "account", "acct_no", "_location", "_department", "_entity").agg(
        F.sum("copies").alias("copies")
    )


def latest_of_batch(transactions: DataFrame) -> DataFrame:
    """Date and origin of the newest transaction per folder and batch; ties go to the later origin."""
    named = transactions.select("Data_Folder_Id", "Batch", c("Accounting_Date").alias("ad"), "Application_of_Origin")
    return latest_per(named, ["Data_Folder_Id", "Batch"], ["ad", "Application_of_Origin"])


def batch_labels(src: Tables, maps: Tables, strict_keys: bool) -> DataFrame:
    """What a combined batch is called: one row per distinct label set, with copies counted.

    Batches are matched by batch alone; with ``strict_keys`` also by folder and month.
    """
    combine = maps["batch_combine"].select("source_batch", "period", "to_batch_alias", "to_batch_id")
    newest = latest_of_batch(existing_keys(ledger_rows(src), combine, {"Batch": "to_batch_id"}))
    df = translate(
        combine,
        newest,
        {"to_batch_id": "Batch"},
        {"_cx_folder": "Data_Folder_Id", "_cx_origin": "Application_of_Origin", "_cx_ad": "ad"},
    )
    keys = ["source_batch", "to_batch_alias", "_cx_origin"]
    keys += ["period", "_cx_folder"] if strict_keys else []
    return df.groupBy(*keys, year_month(c("_cx_ad")).alias("_cx_month")).agg(F.count("*").alias("_batch_copies"))


def _label_join(df: DataFrame, labels: DataFrame, strict_keys: bool) -> DataFrame:
    cols = {
        "_alias": "to_batch_alias",
        "_cx_origin": "_cx_origin",
        "_cx_month": "_cx_month",
        "_batch_copies": "_batch_copies",
    }
    on = {"Batch": "source_batch"}
    if strict_keys:
        df = df.withColumn("_period", month_end(c("Accounting_Date")))
        on |= {"_period": "period", "Data_Folder_Id": "_cx_folder"}
    return translate(df, labels, on, cols)


def _window(src: Tables, start: dt.date, stop: dt.date, rows: DataFrame | None = None) -> DataFrame:
    """Accruals between two days, of the ledger itself unless other ``rows`` are given."""
    rows = src["gl_transaction"] if rows is None else rows
    return in_months(rows, "Accounting_Date", start, stop).filter(c("Accrual_or_Cash") == "Accrual")


def _net_per_account(
    src: Tables, maps: Tables, start: dt.date, stop: dt.date, by_month: bool, strict_keys: bool
) -> DataFrame:
    """Summed transactions of the window per account (and month), times their batch copies."""
    day = month_end(c("Accounting_Date")) if by_month else F.last_day(F.lit(stop))
    sums = (
        _window(src, start, stop, ledger_rows(src))
        .groupBy("Data_Folder_Id", "Account", "Batch", day.alias("_day"))
        .agg(F.sum("Debit").alias("debit"), F.sum("Credit").alias("credit"))
    )
    if strict_keys:
        weighted = sums.withColumn("_batch_copies", F.lit(1))
    else:
        combine = maps["batch_combine"]
        combined = existing_keys(ledger_rows(src), combine, {"Batch": "to_batch_id"})
        folders = combined.select("Data_Folder_Id", "Batch").distinct().groupBy("Batch").agg(F.count("*").alias("_n"))
        copies = (
            translate(combine, folders, {"to_batch_id": "Batch"}, {"_n": "_n"}, {"_n": F.lit(1)})
            .groupBy("source_batch")
            .agg(F.sum("_n").alias("_batch_copies"))
        )
        weighted = translate(sums, copies, {"Batch": "source_batch"}, {"_batch_copies": "_batch_copies"})
    return weighted.groupBy("Data_Folder_Id", "Account", "_day").agg(
        F.sum(_times("debit", "_batch_copies")).alias("debit"),
        F.sum(_times("credit", "_batch_copies")).alias("credit"),
    )


def _coarse(src: Tables, maps: Tables, params: Params, grain: str, strict_keys: bool) -> DataFrame:
    if grain == "opening":
        stop = params.date("GL01_BALANCE_END")
        base = _net_per_account(src, maps, FIRST_DAY, stop, False, strict_keys)
        label = " | Starting_Balance: "
    else:
        start, stop = params.date("GL02_MONTHLY_START"), params.date("GL02_MONTHLY_STOP")
        base = _net_per_account(src, maps, start, stop, True, strict_keys)
        label = " | Month_End: "
    targets = account_targets(src, maps)
    if strict_keys:
        cols = {"acct_no": "acct_no", "_entity": "_entity"}
    else:
        # Here the entity comes from the folder alone, so each account repeats per entity of it.
        targets = targets.groupBy("data_folder_id", "account", "acct_no", "_location", "_department").agg(
            F.sum("copies").alias("copies")
        )
        cols = {"acct_no": "acct_no"}
    cols |= {"_location": "_location", "_department": "_department", "copies": "copies"}
    on = {"Account": "account", "Data_Folder_Id": "data_folder_id"}
    df = translate(base, targets, on, cols)
    if strict_keys:
        df = df.withColumns({"copies": F.lit(1), "_entity_copies": F.lit(1)})
    else:
        entity = maps["entity"].groupBy("data_folder_id", "new_entity_id").agg(F.count("*").alias("_n"))
        df = translate(
            df,
            entity,
            {"Data_Folder_Id": "data_folder_id"},
            {"_entity": "new_entity_id", "_entity_copies": "_n"},
        )
    title = joined("Entity: ", c("_entity"), label, year_month(c("_day")))
    return df.select(
        c("_day").alias("_date"),
        c("_day").alias("_og_date"),
        title.alias("_description"),
        F.lit("").alias("_reference"),
        F.coalesce("acct_no", F.lit(MISSING_ACCOUNT)).alias("_acct"),
        F.coalesce("_location", F.lit("")).alias("_location"),
        F.coalesce("_department", F.lit("")).alias("_department"),
        F.lit("").alias("_document"),
        title.alias("_memo"),
        F.lit(1).alias("_memo_order"),
        c("Account").alias("_account"),
        "_entity",
        F.lit("").alias("_reference2"),
        F.lit("").alias("_origin"),
        _times("debit", "copies", "_entity_copies").alias("debit"),
        _times("credit", "copies", "_entity_copies").alias("credit"),
    )


# Memo labels in order, and the text that marks a summary line.
MEMO_PARTS = [
    (" | Vendor ID: ", "Vendor"),
    (" | AP Inv ID: ", "AP_Invoice"),
    (" | Job ID: ", "Job"),
    (" | Customer ID: ", "Customer"),
    (" | Cust Inv ID: ", "AR_Invoice"),
]
SUMMARY = "Summary Entry"


def gl_memo() -> Column:
    dated = joined(c("Transaction_Desc"), " | Actg Date: ", F.date_format("Accounting_Date", "MM-dd-yyyy"))
    return compose_memo(dated, [(label, c(n)) for label, n in MEMO_PARTS], null_safe=False)


def _detail(src: Tables, maps: Tables, params: Params, strict_keys: bool) -> DataFrame:
    df = _window(src, params.date("GL03_DETAIL_START"), params.date("GL03_DETAIL_STOP"))
    df = _label_join(df, batch_labels(src, maps, strict_keys), strict_keys)
    cols = {n: n for n in ("acct_no", "_location", "_department", "_entity", "copies")}
    targets = account_targets(src, maps)
    df = translate(df, targets, {"Account": "account", "Data_Folder_Id": "data_folder_id"}, cols)
    if strict_keys:
        df = df.withColumns({"copies": F.lit(1), "_batch_copies": F.lit(1)})
    month = F.coalesce("_cx_month", year_month(c("Accounting_Date")))
    title = joined(
        "Entity: ",
        c("_entity"),
        " | Origin: ",
        F.coalesce("_cx_origin", "Application_of_Origin"),
        " | Batch: ",
        F.coalesce("_alias", "Batch"),
        " | Batch Date: ",
        month,
        " | Acct Date: ",
        month,
    )
    plain = F.replace("Transaction_Desc", F.lit(","), F.lit(""))
    return df.select(
        month_end(c("Accounting_Date")).alias("_date"),
        c("Accounting_Date").alias("_og_date"),
        title.alias("_description"),
        c("Reference_1").alias("_reference"),
        F.coalesce("acct_no", F.lit(MISSING_ACCOUNT)).alias("_acct"),
        F.coalesce("_location", F.lit("")).alias("_location"),
        F.coalesce("_department", F.lit("")).alias("_department"),
        c("Batch").alias("_document"),
        gl_memo().alias("_memo"),
        F.when(plain == SUMMARY, 1).otherwise(2).alias("_memo_order"),
        c("Account").alias("_account"),
        "_entity",
        c("Reference_2").alias("_reference2"),
        c("Application_of_Origin").alias("_origin"),
        _times("Debit", "_batch_copies", "copies").alias("debit"),
        _times("Credit", "_batch_copies", "copies").alias("credit"),
    )


KEYS = (
    "_date _og_date _description _reference _acct _location _department _document _memo _memo_order _account "
    "_entity _reference2 _origin"
).split()
DOCUMENT = ["_entity", "_date", "_description"]
# Line order inside a document; the columns after the account only break ties.
ORDER = (
    "_location _reference _memo_order _acct _account _department _document _memo _og_date _reference2 _origin"
).split()


def gl_journal(
    src: Tables,
    maps: Tables,
    params: Params,
    grain: str,
    strict_keys: bool = False,
    repeat_header: bool = False,
    sort_columns: bool = False,
) -> DataFrame:
    """Journal lines: sum per key, drop what rounds to zero, split by sign, number per document.

    ``grain`` is ``opening``, ``month`` or ``detail``. ``strict_keys`` matches combined batches by
    folder and month as well, and takes each account's entity from its own prefix, counting no copy.
    """
    if grain == "detail":
        rows = _detail(src, maps, params, strict_keys)
    else:
        rows = _coarse(src, maps, params, grain, strict_keys)
    net = (F.sum("debit") + F.sum("credit")).cast(MONEY)
    debit, credit = sides(c("_net"))
    balanced = rows.groupBy(*KEYS).agg(net.alias("_net")).filter(c("_net") != 0)
    lines = header_detail(
        balanced.withColumns({"_debit": debit, "_credit": credit}), DOCUMENT, ORDER, [], line="_line"
    )

    def header(value: Column | str) -> Column:
        return text(value) if repeat_header else first_line(value)

    def amount(name: str) -> Column:
        return F.when(c(name) == 0, "").otherwise(money_text(c(name)))

    account = (SKIP, tag("S300_ACCT|", c("_account")))
    dated = (SKIP, tag("S300_ACCT_DATE|", iso(c("_og_date"))))
    first = (SKIP, tag("S300_REF1|", c("_reference")))
    second = (SKIP, tag("S300_REF2|", c("_reference2")))
    title = (SKIP, c("_description"))
    difference = (SKIP, c("_net"))
    posted = ("STATUS", "POSTED")
    if grain == "detail":
        tail = [difference, posted, account, dated, first, second, (SKIP, tag("S300_APP|", c("_origin"))), title]
    else:
        tail = [posted, account, dated, first, second, (SKIP, tag("SI_ENT|", c("_entity"))), title, difference]
    return emit(
        lines,
        [
            (SKIP, tag("Entity: ", c("_entity"))),
            ("JOURNAL", header("OBJ")),
            ("DATE", header(iso(c("_date")))),
            ("DESCRIPTION", header(c("_description"))),
            ("REFERENCE", c("_reference")),
            ("LINE_NO", c("_line")),
            ("ACCT_NO", c("_acct")),
            ("LOCATION_ID", c("_location")),
            ("DEPT_ID", c("_department")),
            ("CLASS_ID", ""),
            ("DOCUMENT", c("_document")),
            ("MEMO", c("_memo")),
            ("DEBIT", amount("_debit")),
            ("CREDIT", amount("_credit")),
            *tail,
        ],
        sort=[*DOCUMENT, "_line"] if sort_columns else None,
    )


def gl_detail_forecast(src: Tables, maps: Tables, params: Params) -> DataFrame:
    """How many lines the lookups of ``import_gl_detail`` make of the ledger's, before they are summed."""
    chain = [
        (batch_labels(src, maps, False), {"Batch": "source_batch"}, "left", "_batch_copies"),
        (account_targets(src, maps), {"Account": "account", "Data_Folder_Id": "data_folder_id"}, "left", "copies"),
    ]
    return forecast(_window(src, params.date("GL03_DETAIL_START"), params.date("GL03_DETAIL_STOP")), chain)


def import_gl_opening(src: Tables, maps: Tables, params: Params, **options: bool) -> DataFrame:
    return gl_journal(src, maps, params, "opening", **options)


def import_gl_monthly(src: Tables, maps: Tables, params: Params, **options: bool) -> DataFrame:
    return gl_journal(src, maps, params, "month", **options)


def import_gl_detail(src: Tables, maps: Tables, params: Params, **options: bool) -> DataFrame:
    return gl_journal(src, maps, params, "detail", **options)


def gl_detail_flat(src: Tables, maps: Tables, params: Params, **options: bool) -> DataFrame:
    return gl_journal(src, maps, params, "detail", **options, repeat_header=True)
