"""Reading landed tables, translation tables, fixed lookups and parameters."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgermap.sources.schemas import SOURCES, conform, conform_mapping, mapping_schema
from ledgermap.sources.versions import tables_of

# Account type -> statement type, normal balance, closeable.
ACCOUNT_TYPES = [
    ("Current assets", "N", "DB", "N"),
    ("Noncurrent assets", "N", "DB", "N"),
    ("Current liab", "N", "CR", "N"),
    ("Noncurrent liab", "N", "CR", "N"),
    ("Equity", "N", "CR", "N"),
    ("Retained earnings", "N", "CR", "R"),
    ("Income", "I", "CR", "C"),
    ("Cost", "I", "DB", "C"),
    ("Expense", "I", "DB", "C"),
    ("Other income", "I", "CR", "C"),
]

# State and province codes.
STATES = [
    ("AB", "Alberta"), ("AK", "Alaska"), ("AL", "Alabama"), ("AR", "Arkansas"), ("AS", "American Samoa"),
    ("AZ", "Arizona"), ("BA", "Bahamas"), ("BC", "British Columbia"), ("CA", "California"), ("CO", "Colorado"),
    ("CT", "Connecticut"), ("DC", "District of Columbia"), ("DE", "Delaware"), ("FL", "Florida"), ("GA", "Georgia"),
    ("GU", "Guam"), ("HI", "Hawaii"), ("IA", "Iowa"), ("ID", "Idaho"), ("IL", "Illinois"), ("IN", "Indiana"),
    ("KS", "Kansas"), ("KY", "Kentucky"), ("LA", "Louisiana"), ("MA", "Massachusetts"), ("MB", "Manitoba"),
    ("MD", "Maryland"), ("ME", "Maine"), ("MI", "Michigan"), ("MN", "Minnesota"), ("MO", "Missouri"),
    ("MS", "Mississippi"), ("MT", "Montana"), ("NB", "New Brunswick"), ("NC", "North Carolina"),
    ("ND", "North Dakota"), ("NE", "Nebraska"), ("NH", "New Hampshire"), ("NJ", "New Jersey"),
    ("NL", "Newfoundland"), ("NM", "New Mexico"), ("NS", "Nova Scotia"), ("NT", "Northwest Territory"),
    ("NU", "Nunavut"), ("NV", "Nevada"), ("NY", "New York"), ("OH", "Ohio"), ("OK", "Oklahoma"), ("ON", "Ontario"),
    ("OR", "Oregon"), ("PA", "Pennsylvania"), ("PE", "Prince Edward Island"), ("PR", "Puerto Rico"),
    ("QC", "Province of Quebec"), ("RI", "Rhode Island"), ("SC", "South Carolina"), ("SD", "South Dakota"),
    ("SK", "Saskatchewan"), ("TN", "Tennessee"), ("TX", "Texas"), ("UT", "Utah"), ("VA", "Virginia"),
    ("VI", "Virgin Islands"), ("VT", "Vermont"), ("WA", "Washington"), ("WI", "Wisconsin"), ("WV", "West Virginia"),
    ("WY", "Wyoming"), ("YT", "Yukon Territory"), ("", ""),
]

# Tax form description -> code.
TAX_FORMS = [("Non-employee comp", "NEC"), ("Rents", "R"), ("Interest", "INT"), ("Dividends", "DIV"), ("", "")]


def lookup_acct_type(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(
        ACCOUNT_TYPES, "base_account_type string, acct_type string, normal_balance string, closeable string"
    )


def lookup_state(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(STATES, "state_id string, state_name string")


def lookup_1099(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(TAX_FORMS, "form_type_1099_desc string, form_type_1099_code string")


def source(
    spark: SparkSession, name: str, root: str, predicates: Sequence[str] | None = None, **options: str
) -> DataFrame:
    """Scan a landed table: Parquet under ``root``, or over JDBC when ``root`` is a ``jdbc:`` address.

    A JDBC read must be split: pass ``partitionColumn``, ``lowerBound``, ``upperBound`` and
    ``numPartitions``, or ``predicates``, a condition for each part (``split_predicates`` finds even
    ones). Filters and column lists reach
    either kind of source.
    """
    physical = SOURCES[name].physical
    if root.startswith("jdbc:"):
        if predicates:
            df = spark.read.jdbc(root, physical, predicates=list(predicates), properties=options)
        elif "partitionColumn" in options:
            df = spark.read.format("jdbc").options(url=root, dbtable=physical, **options).load()
        else:
            raise ValueError("one connection would read the whole table: give partitionColumn or predicates")
    else:
        df = spark.read.options(**options).parquet(f"{root.rstrip('/')}/{physical}")
    if name == "bank_register" and "Check" in df.columns:
        df = df.withColumnRenamed("Check", "Check_No")
    return conform(df, name)


def split_predicates(rows: DataFrame, column: str, parts: int) -> list[str]:
    """Conditions that cut a table into about ``parts`` equally large pieces by a number or date column.

    Their borders are quantiles of ``rows``, the table itself or an earlier landing of it. Whatever
    the table holds later, each value and NULL meets exactly one condition. A value that fills several
    pieces is one larger piece, so there may be fewer.
    """
    shares = [i / parts for i in range(1, parts)]
    found = rows.agg(F.percentile_approx(column, shares, 10_000)).first()[0] if shares else []
    borders = sorted(set(found or []))
    texts = [f"'{b}'" if isinstance(b, dt.date) else str(b) for b in borders]
    if not texts:
        return ["1 = 1"]
    middle = [f"{column} >= {a} AND {column} < {b}" for a, b in zip(texts, texts[1:])]
    return [f"{column} < {texts[0]} OR {column} IS NULL", *middle, f"{column} >= {texts[-1]}"]


def land(df: DataFrame, name: str, root: str) -> None:
    """Write a source table split by folder, transactions also by month of their date.

    A run for some folders reads only those, and one that says which months it needs
    (``in_months``) only these.
    """
    parts = ["Data_Folder_Id"]
    if name in MONTHLY:
        df = df.withColumn(MONTH, F.year(MONTHLY[name]) * 100 + F.month(MONTHLY[name]))
        parts.append(MONTH)
    df.write.mode("overwrite").partitionBy(*parts).parquet(f"{root.rstrip('/')}/{SOURCES[name].physical}")


# Dates that transactions are split by, and the column that holds the month.
MONTHLY = {"gl_transaction": "Accounting_Date", "jc_transaction": "Accounting_Date", "bank_register": "Accounting_Date"}
MONTH = "posting_month"


def in_months(df: DataFrame, date: str, first: dt.date | None, last: dt.date) -> DataFrame:
    """Rows with ``first <= date <= last``; of a table landed by month only those months are read."""
    rows = df.filter(F.col(date) <= F.lit(last))
    if first is not None:
        rows = rows.filter(F.col(date) >= F.lit(first))
    if MONTH in df.columns:
        rows = rows.filter(F.col(MONTH) <= last.year * 100 + last.month)
        if first is not None:
            rows = rows.filter(F.col(MONTH) >= first.year * 100 + first.month)
    return rows


def mapping(spark: SparkSession, name: str, database: str) -> DataFrame:
    """The newest version of a translation table, or the catalog's table, with columns that an older one lacks."""
    store = tables_of(spark, database)
    return conform_mapping(store.read(name) if store.exists(name) else spark.table(f"{database}.{name}"), name)


# Parameter names.
PARAMETER_NAMES = [
    "COMPANY_ID",
    "DEFAULT_GL_OUTAGE_ACCOUNT",
    "GL01_BALANCE_END",
    "GL02_MONTHLY_START",
    "GL02_MONTHLY_STOP",
    "GL03_DETAIL_START",
    "GL03_DETAIL_STOP",
]


@dataclass(frozen=True)
class Params:
    """Named text values plus the options of the batch-combine seed."""

    values: Mapping[str, str] = field(default_factory=dict)
    combine_from: str = "1900-01-01"
    combine_to: str = "9999-12-31"
    combine_prefixes: tuple[str, ...] = ("01", "02")
    outage_to: str = "2023-12-31"

    def date(self, name: str) -> dt.date:
        return dt.date.fromisoformat(self.values[name])


def param_date(params: Params, name: str) -> dt.date:
    return params.date(name)


def read_params(table: DataFrame, names: Sequence[str] | None = None, **options) -> Params:
    """Bring the named parameters to the driver; by default those that the datasets use."""
    wanted = table.filter(F.col("field_name").isin(*(PARAMETER_NAMES if names is None else names)))
    rows = wanted.groupBy("field_name").agg(F.max("field_value").alias("field_value")).collect()
    return Params({r.field_name: r.field_value for r in rows}, **options)


def useful_fields(spark: SparkSession, as_of: dt.date) -> DataFrame:
    """Parameter table: placeholders and the five period limits that follow from ``as_of``."""
    day = F.lit(as_of)
    year = F.year(day)

    def on(y, month, d):
        return F.make_date(y, F.lit(month), F.lit(d)).cast("string")

    # Parameter names.
    fields = {
        "COMPANY_ID": F.lit("XXX"),
        "DEFAULT_GL_OUTAGE_ACCOUNT": F.lit("XXXX"),
        "GL01_BALANCE_END": on(year - 2, 12, 31),
        "GL02_MONTHLY_START": on(year - 1, 1, 1),
        "GL02_MONTHLY_STOP": on(year - 1, 12, 31),
        "GL03_DETAIL_START": on(year, 1, 1),
        "GL03_DETAIL_STOP": F.last_day(F.add_months(day, -1)).cast("string"),
    }
    entries = F.array(
        *[F.struct(F.lit(n).alias("field_name"), v.alias("field_value")) for n, v in fields.items()]
    )
    return spark.range(1).select(F.inline(entries))


def empty_mapping(spark: SparkSession, name: str) -> DataFrame:
    return spark.createDataFrame([], mapping_schema(name))
