"""Open receivables: balances per status, the activity form by aging basis, and the aging report."""

from __future__ import annotations

from dataclasses import dataclass, replace
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgermap.functions.semantics import (
    MONEY,
    NO_DATE,
    blank_if_null,
    iso,
    iso_or_blank,
    joined,
    joined_or_blank,
    money,
    or_no_date,
    tag,
    unless_no_date,
)
from ledgermap.operators.documents import (
    RELEASED,
    STATUS_KEYS,
    header_detail,
    retainage_balance,
    status_balance,
    with_total,
)
from ledgermap.operators.lookup import gather, translate
from ledgermap.operators.numbering import dealing, number_repeated_lines
from ledgermap.operators.spread import forecast, too_large_for_a_task
from ledgermap.plans.common import (
    SKIP,
    Tables,
    emit,
    first_line,
    folder_entities,
    jobs_without_extra,
    listed_entities,
    look_up,
    project_if_included,
)
from ledgermap.sources.tables import Params
from ledgermap.sources.workspace import stage, tasks_for

c = F.col
AGING_DATE = "GL03_DETAIL_STOP"
RETAINAGE = {"_net": "ret_net", "_held": "ret_held", "_rel": "ret_rel", "_bil": "ret_bil"}


def open_statuses(src: Tables, params: Params) -> DataFrame:
    """Receivable statuses with an amount or retainage outstanding at the aging date.

    Both sides are summed to one row per status before they meet.
    """
    keys = {k: k for k in STATUS_KEYS}
    df = translate(
        status_balance(src["ar_transaction"], params.date(AGING_DATE)),
        src["ar_status"],
        keys,
        {"_invoice": "Invoice", "_status": "Status"},
        how="inner",
    )
    df = translate(df, retainage_balance(src["ar_activity"]), keys, RETAINAGE)
    df = df.withColumns({n: F.coalesce(c(n), F.lit(0).cast(MONEY)) for n in RETAINAGE})
    return df.filter((c("net_amount") != 0) | (c("_net") != 0))


def _with_customer(df: DataFrame, src: Tables, maps: Tables) -> DataFrame:
    keys = {"Customer": "Customer", "Data_Folder_Id": "Data_Folder_Id"}
    df = translate(df, src["customer"], keys, {"_name": "Name"}, {"_name": ""})
    df = look_up(df, maps, "customer", "Customer", {"_customer": "new_customer_id"})
    return df.withColumn("_customer", blank_if_null(c("_customer")))


def import_open_ar(
    src: Tables,
    maps: Tables,
    params: Params,
    with_project: bool = True,
    number_lines: bool = True,
    strict_keys: bool = False,
    sort_columns: bool = False,
) -> DataFrame:
    """Open receivables as documents; without ``number_lines`` each line is its own line 1."""
    df = _with_customer(open_statuses(src, params), src, maps)
    df = folder_entities(df, maps, {"_entity": "new_entity_id"}, strict_keys)
    if with_project:
        job = {"_job": "new_job_id", "_include": "include_job"}
        df = look_up(df, {"job": jobs_without_extra(maps)}, "job", "job", job)
        project = project_if_included()
    else:
        project = F.lit("")
    rows = df.select(
        "Data_Folder_Id",
        "Customer",
        iso(c("Status_Date")).alias("_date"),
        iso(unless_no_date(c("accounting_date"))).alias("_posting"),
        c("_invoice").alias("_document"),
        "_customer",
        iso(unless_no_date(c("due_date"))).alias("_due"),
        money(c("net_amount")).alias("_price"),
        blank_if_null(c("_entity")).alias("_entity"),
        project.alias("_project"),
        "_name",
        *[money(c(n)).alias(n) for n in RETAINAGE],
    )
    if number_lines:
        lines = header_detail(rows, DOCUMENT_KEYS, OPEN_AR_ORDER, [], line="_line")
    else:
        lines = rows.withColumn("_line", F.lit(1).cast("bigint"))
    return emit(
        lines,
        [
            (SKIP, c("Data_Folder_Id")),
            (SKIP, tag("LG_CUST | ", c("Customer"))),
            ("TRANSACTIONTYPE", first_line("Startup AR")),
            ("DATE", first_line(c("_date"))),
            ("GLPOSTINGDATE", first_line(c("_posting"))),
            ("DOCUMENTNO", first_line(c("_document"))),
            ("CUSTOMER_ID", first_line(c("_customer"))),
            ("TERMNAME", ""),
            ("DATEDUE", first_line(c("_due"))),
            ("STATE", first_line("Pending")),
            ("LINE_NO", c("_line")),
            ("ITEMID", "Revenue"),
            ("QUANTITY", F.lit(1)),
            ("UNIT", "Each"),
            ("PRICE", c("_price")),
            ("LOCATIONID", c("_entity")),
            ("DEPARTMENTID", ""),
            ("SODOCUMENTENTRY_CLASSID", ""),
            ("SODOCUMENTENTRY_PROJECTID", c("_project")),
            ("PROJECTID", c("_project")),
            ("SODOCUMENTENTRY_CUSTOMERID", c("_customer")),
            ("MEMO", c("_name")),
            ("CONVERSIONTYPE", "Price"),
            ("SODOCUMENTENTRY_RETAINAGEPERCENTAGE", ""),
            ("SODOCUMENTENTRY_AMOUNTRETAINED", money(-c("_net"))),
            (SKIP, tag("LG_RET_NET | ", c("_net").cast("string"))),
            (SKIP, tag("LG_RET_HELD | ", c("_held").cast("string"))),
            (SKIP, tag("LG_RET_REL | ", c("_rel").cast("string"))),
            (SKIP, tag("LG_RET_BIL | ", c("_bil").cast("string"))),
            (SKIP, joined("LG_CUST_NME | ", c("_name"))),
        ],
        sort=[*DOCUMENT_KEYS, "_line"] if sort_columns else None,
    )


def open_ar_forecast(src: Tables, maps: Tables, params: Params) -> DataFrame:
    """How many rows ``import_open_ar`` will have, before it runs."""
    folder = {"Data_Folder_Id": "data_folder_id"}
    chain = [
        (src["customer"], {"Customer": "Customer", "Data_Folder_Id": "Data_Folder_Id"}, "left"),
        (maps["customer"], {"Customer": "legacy_customer_id", **folder}, "left"),
        (maps["entity"], folder, "left"),
        (jobs_without_extra(maps), {"job": "legacy_job_id", **folder}, "left"),
    ]
    return forecast(open_statuses(src, params), chain)


DOCUMENT_KEYS = ["Data_Folder_Id", "_customer", "_document", "_posting"]
# Line order inside a document: every column that can differ between its lines.
OPEN_AR_ORDER = "_entity _date _due Customer _price _net _project _name _held _rel _bil".split()


def open_ar_flat(src: Tables, maps: Tables, params: Params) -> DataFrame:
    return import_open_ar(src, maps, params, with_project=False, number_lines=False)


def open_ar_project(src: Tables, maps: Tables, params: Params) -> DataFrame:
    return import_open_ar(src, maps, params, number_lines=False)


TOTALS = "~~~~ TOTALS ~~~~"
AGING_SUMS = ["Amount", "Ret_Net", "Ret_Held", "Ret_Rel", "Ret_Bil", "Total_Outstanding"]


def report_open_ar_aging(src: Tables, maps: Tables, params: Params) -> DataFrame:
    """Aging by invoice with a totals row; ``is_total`` orders the totals last at the sink."""
    df = _with_customer(open_statuses(src, params), src, maps)
    detail = df.select(
        "Customer",
        c("_name").alias("Customer_Name"),
        c("_invoice").alias("Invoice"),
        iso(c("Status_Date")).alias("Invoice_Date"),
        iso(unless_no_date(c("due_date"))).alias("Due_Date"),
        c("_status").alias("Status"),
        money(c("net_amount")).alias("Amount"),
        money(c("_net")).alias("Ret_Net"),
        money(c("_held")).alias("Ret_Held"),
        money(c("_rel")).alias("Ret_Rel"),
        money(c("_bil")).alias("Ret_Bil"),
        money(c("net_amount") + c("_net")).alias("Total_Outstanding"),
        c("_customer").alias("New_Customer_ID"),
    )
    return with_total(detail, AGING_SUMS, {"Customer": TOTALS})


@dataclass(frozen=True)
class ActivityOptions:
    """Choices of the activity form: basis 'Accounting date', 'Invoice date' or 'Due date'."""

    aging_basis: str = "Accounting date"
    include_retainage: bool = True
    include_finance_charges: bool = True
    primary_id: str = "Invoice"


# Transaction and amount kinds that the activity form tells apart.
INVOICES = ("Issued invoice", "Invoice")
RELEASES = ("Retainage released", "Tax retainage relsed")


def _basis_date(options: ActivityOptions) -> Column:
    kind, amount = c("Transaction_Type"), c("Amount_Type")
    related, status = c("Related_Status_Date"), c("_ara_status_date")
    if options.aging_basis == "Accounting date":
        return or_no_date(c("Accounting_Date"))
    if options.aging_basis == "Due date":
        return F.when(c("_ara_due") != F.to_date(F.lit(NO_DATE)), c("_ara_due")).otherwise(c("Due_Date"))
    if options.aging_basis == "Invoice date":
        unused = c("Adjustment_Type") == "Not used"
        return (
            F.when(kind.isin(*INVOICES), F.when(amount.isin(*RELEASES), related).otherwise(status))
            .when(kind.isin("Cash receipt", "Cash recpt adjustmnt"), c("Deposit_Date"))
            .when(
                kind == "Invoice adjustment",
                F.when(unused & ~amount.isin(*RELEASES), status)
                .when(unused & amount.isin(*RELEASES), related)
                .otherwise(c("Reference_Date")),
            )
            .otherwise(c("Reference_Date"))
        )
    return F.to_date(F.lit(NO_DATE))


def _document_number(options: ActivityOptions) -> Column:
    kind = c("Transaction_Type")
    primary = blank_if_null(c("Invoice") if options.primary_id == "Invoice" else c("Draw"))
    released = c("Amount_Type").isin("AT_RETR", "AT_TRR", *RELEASES)
    billed = F.when(released, joined_or_blank("RetBill: ", primary)).otherwise(primary)
    return (
        F.when(
            kind.isin("TT_IINV", "TT_MINV", *INVOICES), billed if options.include_retainage else primary
        )
        .when(
            kind.isin("TT_IADJ", "TT_PADJ", "Invoice adjustment", "Cash rcpt adjustmnt"),
            blank_if_null(F.when(c("Edit_Type") == "Edit", primary).otherwise(c("Adjustment"))),
        )
        .otherwise(blank_if_null(c("Cash_Receipt")))
    )


def _activity_label(adjustment: Column) -> Column:
    kind, amount = c("Transaction_Type"), c("Amount_Type")
    return (
        F.when(
            kind.isin(*INVOICES),
            F.when(amount == "Tax retainage relsed", "Tax Ret. Rel.")
            .when(amount == RELEASED, "Ret. Released")
            .otherwise("Invoice"),
        )
        .when(kind == "Invoice adjustment", F.when(c("Edit_Type") == "Edit", "Invoice").otherwise(adjustment))
        .when(
            kind == "Cash recpt adjustmnt",
            F.when(c("Status_Type") == "Customer cash recpt", "Cust Cash Recpt").otherwise(adjustment),
        )
        .otherwise(kind)
    )


# What stands before the reference columns.
ACTIVITY_LABELS = {
    "_legacy": "LG_CUST | ",
    "_t02": "LG_JOB_ID | ",
    "_t03": "LG_JOB_DESC | ",
    "_t04": "LG_TRANS_TYPE | ",
    "_t05": "LG_STS_TYP | ",
    "_t06": "LG_TRN_TYP | ",
    "_t07": "LG_AMT_TYP | ",
    "_t08": "LG_EDT_TYP | ",
    "_t09": "LG_ACT_TYP | ",
    "_t10": "LG_EXTRA | ",
    "_t11": "LG_CRD_ACCT | ",
    "_t12": "LG_TRAN_TYPE | ",
    "_t14": "LG_CUST_NME | ",
    "_t15": "LG_CONT | ",
}
ACTIVITY_TAGS = [f"_t{i:02d}" for i in (2, 3, 4, 5, 6, 7, 8, 9, 10, 11, 12, 14, 15)]
# Line order inside a document: what stands before and after the entity.
ACTIVITY_ORDER = [*ACTIVITY_TAGS, "_legacy", "_date", "_due", "_price", "_retained"], ["_project", "_memo"]


def _labelled(df: DataFrame, src: Tables, maps: Tables) -> DataFrame:
    on = {"Customer": "Customer", "Data_Folder_Id": "Data_Folder_Id"}
    df = translate(df, src["customer"], on, {"_name": "Name"})
    df = translate(df, src["job"], {"Job": "Job", "Data_Folder_Id": "Data_Folder_Id"}, {"_job_name": "Description"})
    df = look_up(df, maps, "job", "Job", {"_job": "new_job_id", "_include": "include_job"})
    df = look_up(df, maps, "customer", "Customer", {"_customer": "new_customer_id"})
    return df.withColumn("_project", project_if_included())


def _matched(rows: DataFrame, src: Tables, maps: Tables, keys: list[str]) -> DataFrame:
    """Rows with their activity, names, ``_project`` and ``_customer``; a row stands for ``_copies`` times ``_times`` equal ones."""
    seen = src["ar_activity"].groupBy(*keys, "Activity_Type", "Due_Date").agg(F.count("*").alias("_copies"))
    found = {"_ara_status_date": "Status_Date", "_ara_due": "Due_Date", "_activity": "Activity_Type", "_copies": "_copies"}
    df = translate(rows, seen, {k: k for k in keys}, found)
    return _labelled(df, src, maps).withColumn("_times", F.lit(1).cast("bigint"))


def _matched_where_they_lie(rows: DataFrame, src: Tables, maps: Tables, keys: list[str], tasks: int) -> DataFrame:
    """``_matched`` for large tables: activity and labels go to the rows' customers, so each table is shuffled once.

    The labels are looked up once per folder, customer and job, and each result is counted. A
    customer with too many rows for a task is dealt by status as well.
    """
    owner = ["Data_Folder_Id", "Customer"]
    heavy = too_large_for_a_task(rows, owner, tasks)
    at = [PLACE] if heavy else owner

    def placed(df: DataFrame) -> DataFrame:
        if not heavy:
            return df
        whole = F.xxhash64(*owner)
        return df.withColumn(PLACE, F.when(whole.isin(heavy), F.xxhash64(*keys)).otherwise(whole))

    names, label_keys = ["_name", "_job_name", "_project", "_customer"], [*owner, "Job"]
    rows = placed(rows)
    wanted = rows.select(*dict.fromkeys([*at, *label_keys])).distinct()
    label = _labelled(wanted, src, maps).groupBy(*wanted.columns, *names).agg(F.count("*").alias("_times"))
    label = label.select(*wanted.columns, F.struct(*names, "_times").alias("_label"))
    seen = c("Activity_Type").alias("_activity"), c("Due_Date").alias("_ara_due")
    seen = placed(src["ar_activity"]).select(*dict.fromkeys([*at, *keys]), F.struct(*seen).alias("_seen"))
    used = rows.select(*dict.fromkeys([*at, *keys, *ACTIVITY_SOURCE]))
    every = used.withColumn("_row", F.lit(True)).unionByName(seen, True).unionByName(label, True).repartition(2 * tasks, *at)
    # a label is neither looked up nor looks up here, but keeps its place among the rows
    every = gather(every, "_seen", at, keys, "_copies")
    known = reduce(and_, [c(k).isNotNull() for k in keys]) & c("_row")
    every = every.withColumn("_seen", F.explode_outer(F.when(known, c("_seen"))))
    every = gather(every, "_label", at, [k for k in label_keys if k not in at])
    found = every.withColumn("_label", F.explode("_label")).select("*", "_label.*", "_seen.*")
    return found.withColumn("_ara_status_date", F.when(c("_seen").isNotNull(), c("Status_Date"))).drop("_label", "_seen", "_row")


# Number that rows are dealt by for the sums and the numbering after them.
PLACE = "_place"


# What the rows of the activity form are made of, and what else decides their date and document.
ACTIVITY_SOURCE = (
    "Data_Folder_Id Customer Status_Type Transaction_Type Amount_Type Accounting_Date Due_Date Related_Status_Date Amount Retainage "
    "Adjustment_Type Edit_Type Job Extra Contract Credit_Account__Accrual Description"
).split()
ACTIVITY_COLUMNS = [
    *ACTIVITY_SOURCE,
    *"_document _ara_status_date _activity _copies _name _job_name _project _customer _times".split(),
]
ACTIVITY_SOURCE += "Deposit_Date Reference_Date Invoice Draw Adjustment Cash_Receipt".split()


def ar_activity_by_basis(
    src: Tables, maps: Tables, params: Params, options: ActivityOptions = ActivityOptions()
) -> DataFrame:
    """Receivable activity up to the aging date under the chosen options, summed per label set.

    Activity and entity rows that differ in nothing used here are counted once with their number
    of copies, so a key with many rows on both sides is not multiplied out before the sum.
    """
    keys = [*STATUS_KEYS, "Actvty_Seq"]
    rows = src["ar_transaction"].filter(~c("Amount_Type").isin("NSF Bank charge", "Stored materals"))
    if not options.include_finance_charges:
        rows = rows.filter(c("Amount_Type") != "FC")
    tasks = tasks_for(src["ar_transaction"])
    matched = _matched_where_they_lie(rows, src, maps, keys, tasks) if tasks else _matched(rows, src, maps, keys)
    df = matched.filter(_basis_date(options) <= F.lit(params.date(AGING_DATE))).withColumn("_document", _document_number(options))
    # Dealt by document, for the sums as for the numbering; documents too large for a task by their labels.
    document, apart = ["Data_Folder_Id", "_document"], "Customer Job Status_Type Transaction_Type Amount_Type Edit_Type Extra Due_Date"
    if tasks:
        df = stage(df.select(*ACTIVITY_COLUMNS), "activity")
    lines_of = dealing(df if tasks else rows.withColumn("_document", _document_number(options)), document, tasks)
    if tasks:
        spot = F.xxhash64(*document)
        if lines_of.heavy is not None:
            spot = F.when(lines_of.heavy, F.xxhash64(*document, *apart.split())).otherwise(spot)
        # these rows are the widest, and three steps hold them in one task
        lines_of = replace(lines_of, columns=[PLACE], tasks=2 * tasks)
        df = df.repartition(lines_of.tasks, spot).withColumn(PLACE, spot)

    kind, amount_type = c("Transaction_Type"), c("Amount_Type")
    zero = F.lit(0).cast(MONEY)
    amount, retainage = F.coalesce(c("Amount"), zero), F.coalesce(c("Retainage"), zero)
    earned = F.when(
        ~amount_type.isin("Retainage released", "Tax retainage released"), money(amount + retainage)
    ).otherwise(zero)
    withheld = F.when(
        F.lit(options.include_retainage) & ~amount_type.isin("Retainage billed", "Tax retainage billed"),
        money(-retainage),
    ).otherwise(zero)
    held = F.when(~amount_type.isin("RETG", "TRET", "ROB", "TROB"), money(-c("Retainage"))).otherwise(zero)
    invoice_like = kind.isin("Invoice", "Invoice adjustment", "Issued invoice")
    shown_date = F.when(
        invoice_like,
        F.when(amount_type.isin("Retainage billed", "Retainage released"), c("Related_Status_Date")).otherwise(
            c("_ara_status_date")
        ),
    ).otherwise(c("Accounting_Date"))

    named = df.select(
        "Data_Folder_Id",
        c("Customer").alias("_legacy"),
        shown_date.alias("_raw_date"),
        c("Accounting_Date").alias("_raw_posting"),
        "_document",
        "_customer",
        c("Due_Date").alias("_raw_due"),
        "_project",
        F.when(invoice_like, c("Description")).otherwise("").alias("_memo"),
        (earned + withheld).alias("_price"),
        held.alias("_retained"),
        (F.coalesce("_copies", F.lit(1)) * c("_times")).cast("decimal(18,0)").alias("_copies"),
        c("Job").alias("_t02"),
        c("_job_name").alias("_t03"),
        _activity_label(c("Adjustment_Type")).alias("_t04"),
        c("Status_Type").alias("_t05"),
        kind.alias("_t06"),
        amount_type.alias("_t07"),
        c("Edit_Type").alias("_t08"),
        c("_activity").alias("_t09"),
        c("Extra").alias("_t10"),
        c("Credit_Account__Accrual").alias("_t11"),
        _activity_label(blank_if_null(c("Adjustment_Type"))).alias("_t12"),
        c("_name").alias("_t14"),
        c("Contract").alias("_t15"),
        *([PLACE] if tasks else []),
    )
    totals = {"_price": F.sum(c("_price") * c("_copies")), "_retained": F.sum(c("_retained") * c("_copies"))}
    keys = [n for n in named.columns if n not in (*totals, "_copies", "_memo")]
    # Summed per label set and memo by hashing, as a maximum of text would have the rows sorted;
    # the entities of the folder then repeat the numbered sums, or multiply them.
    by_memo = named.groupBy(*keys, "_memo").agg(*[v.cast(MONEY).alias(n) for n, v in totals.items()])
    summed = by_memo.groupBy(*keys).agg(
        *[F.sum(n).cast(MONEY).alias(n) for n in totals], F.max("_memo").alias("_memo")
    )
    entities = maps["entity"].groupBy("data_folder_id", "new_entity_id").agg(F.count("*").alias("_n"))
    listed = listed_entities(summed, entities, {"_n": F.lit(1).cast("bigint")})
    times = c("_list")[0]["_n"].cast("decimal(18,0)")
    rows = listed.select(
        "*",
        iso_or_blank(F.coalesce("_raw_date", "_raw_posting")).alias("_date"),
        iso_or_blank(c("_raw_posting")).alias("_posting"),
        iso_or_blank(c("_raw_due")).alias("_due"),
    ).withColumns(
        {
            "_customer": blank_if_null(c("_customer")),
            "_price": (c("_price") * times).cast(MONEY),
            "_retained": (c("_retained") * times).cast(MONEY),
        }
    )
    # a constant in front changes no order, so the lines are numbered without the labels
    def labelled(name: str) -> Column:
        return tag(ACTIVITY_LABELS[name], c(name))

    before, after = ACTIVITY_ORDER
    lines = number_repeated_lines(
        rows.drop("_raw_date", "_raw_posting", "_raw_due"),
        DOCUMENT_KEYS,
        [*before, "_single"],
        after,
        repeats="_list",
        item="_item",
        out="_line",
        dealt=lines_of,
    ).withColumn("_entity", c("_item.new_entity_id"))
    return emit(
        lines,
        [
            (SKIP, c("Data_Folder_Id")),
            (SKIP, labelled("_legacy")),
            ("TRANSACTIONTYPE", first_line("Startup AR")),
            ("DATE", first_line(c("_date"))),
            ("GLPOSTINGDAT", first_line(c("_posting"))),
            ("DOCUMENTNO", first_line(c("_document"))),
            ("CUSTOMER_ID", first_line(c("_customer"))),
            ("TERMNAME", ""),
            ("DATEDUE", first_line(c("_due"))),
            ("STATE", first_line("Pending")),
            ("LINE_NO", c("_line")),
            ("ITEMID", "Revenue"),
            ("QUANTITY", "1"),
            ("UNIT", "Each"),
            ("PRICE", c("_price")),
            ("LOCATIONID", c("_entity")),
            ("DEPARTMENTID", ""),
            ("SODOCUMENTENTRY_CLASSID", ""),
            ("SODOCUMENTENTRY_PROJECTID", c("_project")),
            ("PROJECTID", c("_project")),
            ("SODOCUMENTENTRY_CUSTOMERID", c("_customer")),
            ("MEMO", c("_memo")),
            ("CONVERSIONTYPE", "Price"),
            ("SODOCUMENTENTRY_RETAINAGEPERCENTAGE", ""),
            ("SODOCUMENTENTRY_AMOUNTRETAINED", c("_retained")),
            *[(SKIP, blank_if_null(labelled(t))) for t in ACTIVITY_TAGS],
        ],
    )
