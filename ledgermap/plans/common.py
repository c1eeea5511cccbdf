"""Shared pieces of the dataset builders."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Mapping, Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgermap.functions.semantics import text
from ledgermap.operators.lookup import translate

Tables = Mapping[str, DataFrame]

# Fixed value: header of a column that the target system skips. It may repeat.
SKIP = "DONOTIMPORT"


# Prefix of helper columns that only order the rows of a file; the sink drops them.
SORT = "_sort"


def emit(
    df: DataFrame, columns: Sequence[tuple[str, Column | str]], sort: Sequence[str] | None = None
) -> DataFrame:
    """Select the output columns; a plain string is a literal. Repeated skip headers get a number.

    ``sort`` appends helper columns to order by, for datasets whose output blanks its own keys.
    """
    repeats = Counter(name for name, _ in columns)[SKIP]
    taken = 0
    out = []
    for name, value in columns:
        if name == SKIP and repeats > 0:
            taken += 1
            name = f"{SKIP}_{taken:02d}"
        out.append(text(value).alias(name))
    helpers = [F.col(name).alias(f"{SORT}{i}") for i, name in enumerate(sort or ())]
    return df.select(*out, *helpers)


def first_line(value: Column | str, line: str = "_line") -> Column:
    """Header value: shown on a document's line 1, blank on the others."""
    return F.when(F.col(line) == 1, value).otherwise("")


def verbatim_header(columns: Sequence[str]) -> list[str]:
    """Header row as the target system expects it: numbered skip columns lose their number."""
    return [re.sub(rf"^{SKIP}_\d\d$", SKIP, c) for c in columns]


# Lookups that most datasets share: translation table, its key, and the folder key.
_KEYS = {
    "job": "legacy_job_id",
    "customer": "legacy_customer_id",
    "vendor": "legacy_vendor_id",
    "cost_code": "legacy_cost_code_id",
    "cost_type": "legacy_cost_type_id",
    "employee": "legacy_employee_id",
    "department": "legacy_department_id",
    "location": "legacy_location_id",
}


def look_up(
    df: DataFrame,
    maps: Tables,
    name: str,
    key: str,
    cols: Mapping[str, str],
    how: str = "left",
    folder="Data_Folder_Id",
    spread: bool = False,
    counted: DataFrame | None = None,
) -> DataFrame:
    """Translate ``key`` through the named table within the row's data folder."""
    on = {key: _KEYS[name], folder: "data_folder_id"}
    return translate(df, maps[name], on, cols, how=how, spread=spread, counted=counted)


def included_jobs(maps: Tables) -> DataFrame:
    return maps["job"].filter(F.col("include_job") == 1)


def jobs_without_extra(maps: Tables) -> DataFrame:
    return maps["job"].filter(F.col("legacy_extra_id").isNull() | (F.col("legacy_extra_id") == ""))


def entities_of_folder(maps: Tables, strict_keys: bool = False) -> DataFrame:
    """The entities; with ``strict_keys`` only the first one of each folder."""
    entity = maps["entity"]
    if strict_keys:
        rest = [c for c in entity.columns if c not in ("data_folder_id", "legacy_entity_id")]
        entity = entity.groupBy("data_folder_id").agg(F.min(F.struct("legacy_entity_id", *rest)).alias("_e"))
        entity = entity.select("data_folder_id", "_e.*")
    return entity


def folder_entities(df: DataFrame, maps: Tables, cols: Mapping[str, str], strict_keys: bool = False) -> DataFrame:
    """Join entities on the data folder alone, so a row repeats for each entity of its folder.

    With ``strict_keys`` a folder with several entities keeps its rows once, under its first one.
    """
    return translate(df, entities_of_folder(maps, strict_keys), {"Data_Folder_Id": "data_folder_id"}, cols)


def listed_entities(df: DataFrame, entity: DataFrame, same: Mapping[str, Column]) -> DataFrame:
    """Add ``_list`` and ``_single`` of ``entity_lists``; a folder without entities has one item.

    That item has no entity, and ``same`` gives its other columns.
    """
    missing = F.array(F.struct(F.lit(None).cast("string").alias("new_entity_id"), *[v.alias(n) for n, v in same.items()]))
    cols = {"_list": "_list", "_single": "_single"}
    return translate(df, entity_lists(entity, list(same)), {"Data_Folder_Id": "data_folder_id"}, cols, {"_list": missing})


def entity_lists(entity: DataFrame, same: Sequence[str]) -> DataFrame:
    """``data_folder_id, _list, _single``: the entities of a folder as one list, to repeat numbered lines by.

    An item has the entity and the columns ``same``. Where the items of a folder differ in anything but the entity, or repeat it, lines cannot be
    numbered apart from them; each item is then a list, and ``_single`` is its entity.
    """
    of_folder = entity.groupBy("data_folder_id").agg(
        F.sort_array(F.collect_list(F.struct("new_entity_id", *same))).alias("_all"),
        F.collect_set("new_entity_id").alias("_ids"),
        F.max(F.col("new_entity_id").isNull().cast("int")).alias("_none"),
    )
    first = F.col("_all")[0]
    alike = F.forall("_all", lambda e: reduce(and_, [e[n].eqNullSafe(first[n]) for n in same], F.lit(True)))
    even = alike & (F.size("_ids") + F.col("_none") == F.size("_all"))
    lists = F.when(even, F.array("_all")).otherwise(F.transform("_all", lambda e: F.array(e)))
    return of_folder.select("data_folder_id", even.alias("_even"), F.explode(lists).alias("_list")).select(
        "data_folder_id", "_list", F.when(~F.col("_even"), F.col("_list")[0]["new_entity_id"]).alias("_single")
    )


def project_if_included(job: str = "_job", include: str = "_include") -> Column:
    return F.coalesce(F.when(F.col(include) == 1, F.col(job)).otherwise(""), F.lit(""))
