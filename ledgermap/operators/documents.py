"""Documents: header and detail lines, debit and credit sides, offsets, batches, totals."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgermap.functions.semantics import MONEY, month_end, or_no_date, year_month
from ledgermap.operators.numbering import number_lines, number_lines_and_rows_before, rows_before
from ledgermap.sources.workspace import stage

BATCH_ROWS = 5000


def header_detail(
    df: DataFrame,
    doc_keys: Sequence[str],
    order: Sequence[str],
    header_cols: Sequence[str],
    line: str = "line_no",
    repeat: bool = False,
) -> DataFrame:
    """Number the lines of each document and keep its header columns on line 1 only.

    ``order`` should end in enough columns to break every tie, or equal rows swap freely.
    """
    numbered = number_lines(df, doc_keys, order, line)
    if repeat:
        return numbered
    return numbered.withColumns({c: F.when(F.col(line) == 1, F.col(c)).otherwise("") for c in header_cols})


def sides(net: Column) -> tuple[Column, Column]:
    """Debit and credit amounts of a net amount; never both non-zero."""
    zero = F.lit(0).cast(MONEY)
    value = net.cast(MONEY)
    return F.when(value >= 0, value).otherwise(zero), F.when(value < 0, (-value).cast(MONEY)).otherwise(zero)


def net_sides(df: DataFrame, keys: Sequence[str], debit: Column, credit: Column) -> DataFrame:
    """Sum both sides (credits are negative), drop groups that round to zero, split by sign."""
    net = F.sum(debit) + F.sum(credit)
    grouped = df.groupBy(*keys).agg(net.cast("decimal(38,6)").alias("_net")).filter(F.round("_net", 2) != 0)
    debit_out, credit_out = sides(F.col("_net"))
    return grouped.select(*keys, debit_out.alias("debit"), credit_out.alias("credit"))


def double_entry(
    df: DataFrame, entry_keys: Sequence[str], offset_keys: Sequence[str], amount: Column, store: bool = False
) -> DataFrame:
    """Entry rows by ``entry_keys`` plus mirrored offset rows by the coarser ``offset_keys``.

    Offset sums are sums of entry sums, so only the entries are aggregated from ``df``. The columns
    that only entries have are NULL on offsets; ``entry_offset`` is '0' or '1'. ``store`` writes the
    entries once: both kinds of rows read them, and what made ``df`` would run for each.
    """
    extra = [k for k in entry_keys if k not in set(offset_keys)]
    if not extra or set(offset_keys) - set(entry_keys):
        raise ValueError("offset keys must be a proper part of the entry keys")
    zero = F.lit(0).cast("decimal(18,2)")
    entries = (
        df.withColumns(
            {
                "_up": F.when(amount > 0, amount).otherwise(zero).cast("decimal(38,2)"),
                "_down": F.when(amount < 0, -amount).otherwise(zero).cast("decimal(38,2)"),
            }
        )
        .groupBy(*entry_keys)
        .agg(F.sum("_up").cast(MONEY).alias("_up"), F.sum("_down").cast(MONEY).alias("_down"))
    )
    if store:
        entries = stage(entries, "entries")
    offsets = entries.groupBy(*offset_keys).agg(
        F.sum("_up").cast(MONEY).alias("_up"), F.sum("_down").cast(MONEY).alias("_down")
    )

    def lines(rows: DataFrame, debit: str, credit: str, mark: str) -> DataFrame:
        keys = [
            F.col(k) if k in rows.columns else F.lit(None).cast(entries.schema[k].dataType).alias(k) for k in entry_keys
        ]
        return rows.select(
            *keys, F.col(debit).alias("debit"), F.col(credit).alias("credit"), F.lit(mark).alias("entry_offset")
        )

    return lines(entries, "_up", "_down", "0").unionByName(lines(offsets, "_down", "_up", "1"))


def pack_batches(df: DataFrame, group: str, size: int = BATCH_ROWS, out: str = "batch_num") -> DataFrame:
    """Number batches of about ``size`` rows in group order without splitting a group.

    A group's batch follows from the number of rows in all earlier groups. Rows without a group are
    one group, the first.
    """
    counts = df.groupBy(F.col(group).alias("_group")).agg(F.count("*").alias("_rows"))
    batches = rows_before(counts, "_group", "_rows", "_prior").select(
        "_group", (F.floor(F.col("_prior") / size) + 1).cast("bigint").alias(out)
    )
    return df.join(batches, F.col(group).eqNullSafe(F.col("_group"))).drop("_group")


def packed_documents(
    df: DataFrame,
    group: str,
    order: Sequence[str],
    size: int = BATCH_ROWS,
    line: str = "line_no",
    out: str = "batch_num",
    tasks: int | None = None,
) -> DataFrame:
    """Number the lines of each document and its batch, as ``header_detail`` and ``pack_batches`` would.

    A document's batch follows from where it begins, which is known once its lines are numbered, so
    no line is shuffled a second time.
    """
    numbered = number_lines_and_rows_before(df, [group], order, line, "_prior", tasks)
    return numbered.withColumn(out, (F.floor(F.col("_prior") / size) + 1).cast("bigint")).drop("_prior")


def with_total(df: DataFrame, sums: Sequence[str], labels: Mapping[str, str], flag: str = "is_total") -> DataFrame:
    """Append one row of column sums; the other columns hold ``labels``, or blank.

    Rows and total come from one pass as two grouping sets: all columns, and none. Equal rows are
    counted and repeated again. A row that belongs to no group but the total makes sure of a total
    where there are no rows.
    """
    names, mark, copies = df.columns, "_no_row", "_copies"
    none = df.sparkSession.range(1).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in df.schema], F.lit(1).alias(mark))
    rows = df.withColumn(mark, F.lit(0)).unionByName(none)
    keys = [*names, mark]
    grouped = rows.groupingSets([[F.col(f"`{k}`") for k in keys], []], *[F.col(f"`{k}`") for k in keys]).agg(
        F.grouping(mark).cast("int").alias(flag),
        F.count("*").alias(copies),
        *[F.sum(f"`{n}`").cast(df.schema[n].dataType).alias(f"_sum_{n}") for n in sums],
    )
    total = F.col(flag) == 1

    def shown(name: str) -> Column:
        if name in sums:
            return F.when(total, F.col(f"_sum_{name}")).otherwise(F.col(f"`{name}`")).alias(name)
        return F.when(total, F.lit(labels.get(name, ""))).otherwise(F.col(f"`{name}`")).alias(name)

    each = F.sequence(F.lit(1).cast("bigint"), F.when(total, F.lit(1).cast("bigint")).otherwise(F.col(copies)))
    kept = grouped.filter(total | (F.col(mark) == 0)).select(*[shown(n) for n in names], flag, F.explode(each).alias(copies))
    return kept.drop(copies)


# Keys of a receivable's status and the amount kinds that the balances single out.
STATUS_KEYS = ["Customer", "Status_Type", "Status_Date", "Status_Seq", "Data_Folder_Id"]
RELEASED = "Retainage released"


def status_balance(transactions: DataFrame, aging_date) -> DataFrame:
    """Net amount, earliest dates and greatest job per receivable status, up to the aging date.

    Summed per status and job first: a maximum of text would force the transactions to be sorted.
    """
    posted = F.col("Accounting_Date")
    per_job = (
        transactions.filter(F.col("Amount_Type") != RELEASED)
        .filter(posted.isNull() | (posted <= F.lit(aging_date)))
        .groupBy(*STATUS_KEYS, F.col("Job").alias("job"))
        .agg(
            F.sum(F.col("Amount") + F.col("Retainage")).alias("net_amount"),
            F.min(or_no_date(F.col("Due_Date"))).alias("due_date"),
            F.min(or_no_date(posted)).alias("accounting_date"),
        )
    )
    return per_job.groupBy(*STATUS_KEYS).agg(
        F.sum("net_amount").cast(MONEY).alias("net_amount"),
        F.min("due_date").alias("due_date"),
        F.min("accounting_date").alias("accounting_date"),
        F.max("job").alias("job"),
    )


def retainage_balance(activity: DataFrame) -> DataFrame:
    """Retainage per receivable status: net, held, released and billed."""
    held = F.col("Retainage_Held")

    def of(kind: str) -> Column:
        return F.sum(F.when(F.col("Activity_Type") == kind, held).otherwise(F.lit(0))).cast(MONEY)

    return activity.groupBy(*STATUS_KEYS).agg(
        F.sum(held).cast(MONEY).alias("ret_net"),
        of("Invoice").alias("ret_held"),
        of(RELEASED).alias("ret_rel"),
        F.sum("Retainage_Billed").cast(MONEY).alias("ret_bil"),
    )


def split_measures(df: DataFrame, specs: Sequence[Mapping[str, Column]]) -> DataFrame:
    """Turn each row into one row per spec; a spec gives the columns that differ between them."""
    variants = F.array(*[F.struct(*[c.alias(n) for n, c in spec.items()]) for spec in specs])
    return df.select("*", F.inline(variants))


def unpivot_columns(df: DataFrame, ids: Sequence[str], cols: Sequence[str], name: str, value: str) -> DataFrame:
    """One row per id and column; NULL values are kept."""
    return df.unpivot(list(ids), list(cols), name, value)


def month_end_bucket(df: DataFrame, date: str, period: str = "period", label: str = "month") -> DataFrame:
    """Add the month end of a date and its ``yyyy-MM`` label."""
    return df.withColumn(period, month_end(F.col(date))).withColumn(label, year_month(F.col(period)))
