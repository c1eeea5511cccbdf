"""Source and translation tables for the checks, derived from the driver's tables by Spark.

Order lines are joined with the owners of their orders once per session and written, few columns
wide; transaction tables are views of them. Master tables and seeded translation tables are written
once as well, as a migration lands them once: the planner then knows their exact size and broadcasts
only the small ones.
"""

from __future__ import annotations

import datetime as dt
import hashlib
import re
import tempfile
from collections.abc import Callable, Iterator, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks.fixtures import ADAPTERS
from ledgermap.plans.seeds import SEEDS
from ledgermap.sources.schemas import conform
from ledgermap.sources.tables import Params, empty_mapping, read_params, useful_fields
from ledgermap.sources.workspace import LANDED, SETTING, stage, tasks_for

TABLES = "region nation customer supplier part orders lineitem events".split()
AS_OF = dt.date(2000, 12, 15)
COMBINE = {"combine_from": "1999-01-01", "combine_to": "1999-11-30"}

VIEW_OF = {
    "ap_distribution": "fx_ap_distribution",
    "ap_invoice": "fx_ap_invoice",
    "vendor": "fx_vendor",
    "ar_activity": "fx_ara_activity",
    "ar_status": "fx_ara_status",
    "customer": "fx_customer",
    "ar_transaction": "fx_art",
    "bank_account": "fx_bank",
    "bank_register": "fx_bank_register",
    "contract_derived": "fx_contract_derived",
    "contract_item_derived": "fx_contract_item_derived",
    "contract": "fx_contract",
    "contract_item": "fx_contract_item",
    "gl_account": "fx_gl_account",
    "account_format": "fx_account_format",
    "prefix_a": "fx_prefix_a",
    "base_account": "fx_base_account",
    "gl_transaction": "fx_glt",
    "job_category": "fx_job_category",
    "job_cost_code": "fx_job_cost_code",
    "extra": "fx_extra",
    "job": "fx_job",
    "std_category": "fx_std_category",
    "std_cost_code": "fx_std_cost_code",
    "jc_transaction": "fx_jct",
    "employee": "fx_employee",
    "data_folder": "fx_data_folder",
}
TRANSACTIONS = {
    "ap_distribution",
    "ap_invoice",
    "ar_activity",
    "ar_status",
    "ar_transaction",
    "bank_register",
    "gl_transaction",
    "jc_transaction",
}

LINES = "fx_line"
# What the views of the lines use of a line, its order and the place of its customer.
LINE_COLUMNS = {
    "l": "l_orderkey l_partkey l_suppkey l_linenumber l_extendedprice l_returnflag l_linestatus l_shipdate".split(),
    "o": "o_custkey o_orderstatus o_orderdate".split(),
    "g": "Data_Folder_Id Prefix_A".split(),
}
# Master tables that views of other ones use: those read the landed table instead of the lines.
LANDED_FIRST = {"fx_gl_account": "gl_account", "fx_contract_item": "contract_item"}
# Tables with about as many rows as there are lines: the columns that deal their rows out.
DEALT = {
    "fx_job_cost_code": "Data_Folder_Id Job Extra Cost_Code".split(),
    "fx_job_category": "Data_Folder_Id Job Extra Cost_Code Category".split(),
    "fx_ap_invoice": "Data_Folder_Id Vendor Invoice".split(),
}
_NAMES = re.compile(r"\b(" + "|".join([*TABLES, *ADAPTERS]) + r")\b(?=\s|$|\))(?!\.)")


class _OnDemand(Mapping):
    """Tables built on first use."""

    def __init__(self, names, build: Callable[[str], DataFrame]):
        self._names, self._build, self._built = list(names), build, {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._names:
            raise KeyError(name)
        if name not in self._built:
            self._built[name] = self._build(name)
        return self._built[name]

    def __iter__(self) -> Iterator[str]:
        return iter(self._names)

    def __len__(self) -> int:
        return len(self._names)


class Landed:
    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir
        self._prefix = "lm_" + hashlib.md5(sf_dir.encode()).hexdigest()[:8] + "_"
        self._register()
        self.src = _OnDemand(VIEW_OF, self._source)
        self.maps = _OnDemand([*SEEDS, "useful_fields", "class", "item", "warehouse"], self._mapping)
        self.params: Params = read_params(useful_fields(spark, AS_OF), **COMBINE)

    def _register(self) -> None:
        for name in TABLES:
            table = self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")
            table.createOrReplaceTempView(self._prefix + name)
        self._views = set(TABLES)

    def table(self, name: str) -> DataFrame:
        """A driver table or adapter view; views are made on first use."""
        if name not in self._views:
            found = self._line_view() if name == LINES else self._view(name)
            found.createOrReplaceTempView(self._prefix + name)
            self._views.add(name)
        return self.spark.table(self._prefix + name)

    def _view(self, name: str) -> DataFrame:
        text, keys = ADAPTERS[name], DEALT.get(name)
        used = set(_NAMES.findall(text))
        for other in used:
            self.src[LANDED_FIRST[other]] if other in LANDED_FIRST else self.table(other)
        tasks = tasks_for(self.table(LINES)) if keys else None
        if tasks is None:
            return self.spark.sql(self._named(text))
        if "SELECT DISTINCT" in text:
            return self.spark.sql(self._named(text.replace("SELECT DISTINCT", "SELECT"))).repartition(tasks, *keys).distinct()
        # hardly two rows are alike, so they are dealt out as they are, and sorted and summed once
        dealt = {other: self.table(other).repartition(tasks, *keys) for other in used}
        for other, rows in dealt.items():
            rows.createOrReplaceTempView(f"{self._prefix}{other}_dealt")
        return self.spark.sql(self._named(text, "_dealt"))

    def _named(self, text: str, ending: str = "") -> str:
        return _NAMES.sub(lambda m: self._prefix + m.group(1) + ending, text)

    def _line_view(self) -> DataFrame:
        """The adapter's columns over the landed lines instead of its own join."""
        parts = [f"struct({', '.join(names)}) AS {alias}" for alias, names in LINE_COLUMNS.items()]
        self._landed_lines().selectExpr(*parts).createOrReplaceTempView(f"{self._prefix}lines")
        columns = ADAPTERS[LINES].partition("FROM lineitem l")[0]
        return self.spark.sql(f"{columns} FROM {self._prefix}lines")

    def _landed_lines(self) -> DataFrame:
        """Lines with the owner of their order, written once.

        Orders meet their customers first, so that the lines are shuffled once, by their order.
        """
        line, order, place = (LINE_COLUMNS[alias] for alias in "log")
        lines = self.table("lineitem").select(*line).withColumn("l_shipdate", F.col("l_shipdate").cast("date"))
        customer = self.table("customer").select("c_custkey", "c_nationkey")
        owners = (
            self.table("orders")
            .select("o_orderkey", *order)
            .withColumn("o_orderdate", F.col("o_orderdate").cast("date"))
            .join(customer, F.col("o_custkey") == F.col("c_custkey"))
            .join(self.table("fx_geo"), F.col("c_nationkey") == F.col("n_nationkey"))
            .select("o_orderkey", *order, *place)
        )
        tasks = tasks_for(lines)
        if tasks:
            lines, owners = lines.repartition(tasks, "l_orderkey"), owners.repartition(tasks, "o_orderkey")
        joined = lines.join(owners, F.col("l_orderkey") == F.col("o_orderkey"))
        return stage(joined.select(*line, *order, *place), "lines", LANDED)

    def _source(self, name: str) -> DataFrame:
        df = conform(self.table(VIEW_OF[name]), name)
        if name in TRANSACTIONS:
            return df
        found = stage(df, f"src-{name}", LANDED)
        if VIEW_OF[name] in LANDED_FIRST:
            found.createOrReplaceTempView(self._prefix + VIEW_OF[name])
        return found

    def _mapping(self, name: str) -> DataFrame:
        if name == "useful_fields":
            return useful_fields(self.spark, AS_OF)
        if name not in SEEDS:
            return empty_mapping(self.spark, name)
        return stage(SEEDS[name](self.src, self.params), f"map-{name}", LANDED)


_open: dict[tuple[str, str], Landed] = {}


def landed(spark: SparkSession, sf_dir: str) -> Landed:
    if not spark.conf.get(SETTING, None):
        # only a session of the checks that names no shared folder
        spark.conf.set(SETTING, tempfile.mkdtemp(prefix="ledgermap-"))
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _open:
        _open[key] = Landed(spark, sf_dir)
    return _open[key]
