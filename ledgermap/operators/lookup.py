"""Lookups against translation tables.

No side is forced into a broadcast here, except the three fixed lookups. Translation tables are
stored tables, so the planner knows their size: small ones are broadcast, large ones are joined by
a shuffle. Where keys are uneven, ``translate`` can spread the heavy ones (``operators.spread``).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ledgermap.operators.spread import spread_join

MISSING_ACCOUNT = "(MISSING)"


def _side(table: DataFrame, on: Mapping[str, str], cols: Mapping[str, str]) -> DataFrame:
    keys = [F.col(k).alias(f"_key{i}") for i, k in enumerate(on.values())]
    return table.select(*keys, *[F.col(c).alias(name) for name, c in cols.items()])


def _condition(on: Mapping[str, str]) -> Column:
    return reduce(and_, [F.col(left) == F.col(f"_key{i}") for i, left in enumerate(on)])


def translate(
    df: DataFrame,
    table: DataFrame,
    on: Mapping[str, str],
    cols: Mapping[str, str],
    default: Mapping[str, Column | str] | None = None,
    how: str = "left",
    spread: bool = False,
    tasks: int | None = None,
    counted: DataFrame | None = None,
) -> DataFrame:
    """Join ``table`` on ``{column: table column}`` and add ``{new name: table column}``.

    ``default`` gives, per new name, the value to use when the lookup found nothing. ``spread`` deals
    heavy keys of ``df`` over many tasks; it costs a pass over the key columns of ``df`` (or of
    ``counted``, what ``df`` was made of) and pays for tables too large to be broadcast. ``tasks`` deals both sides over that many.
    """
    keys = [f"_key{i}" for i in range(len(on))]
    side = _side(table, on, cols)
    if tasks:
        df, side = df.repartition(tasks, *on), side.repartition(tasks, *keys)
    out = (spread_join(df, side, list(on), keys, how, counted) if spread else df.join(side, _condition(on), how)).drop(*keys)
    for name, value in (default or {}).items():
        fallback = value if isinstance(value, Column) else F.lit(value)
        out = out.withColumn(name, F.coalesce(F.col(name), fallback))
    return out


def gather(df: DataFrame, item: str, at: Sequence[str], keys: Sequence[str], copies: str | None = None) -> DataFrame:
    """Give each row without ``item`` the list ``item`` of those that rows of the same ``keys`` hold; these rows go.

    The struct ``item`` is NULL on the rows that look up and set on those looked up, so both were shuffled
    as one table. ``at`` deals the rows and follows from the keys; where rows lie so, nothing is shuffled
    again, which a join by more keys would do. ``copies`` counts equal items as a field of one.
    """
    own = F.col(item).isNull()
    if copies:
        equal = W.partitionBy(*at, *keys, item)
        df = df.withColumns({"_copies_of": F.count("*").over(equal), "_copy": F.row_number().over(equal.orderBy(item))})
        df = df.filter(own | (F.col("_copy") == 1)).withColumn(
            item, F.when(F.col(item).isNotNull(), F.struct(F.col(f"{item}.*"), F.col("_copies_of").alias(copies)))
        ).drop("_copies_of", "_copy")
    found = F.collect_list(item).over(W.partitionBy(*at, *keys))
    return df.withColumns({"_own": own, item: found}).filter("_own").drop("_own")


def base_account_targets(accounts: DataFrame, base_map: DataFrame) -> DataFrame:
    """New account per ledger account: a match on the full account wins over one on its base.

    One row per (account, distinct new account); ``copies`` counts the translation rows behind it,
    because a base account with several titles has several of them.
    """

    def tier(kind: str, found: str) -> DataFrame:
        return (
            base_map.filter(F.col("acct_match_type") == kind)
            .filter(F.col("legacy_base_account").isNotNull() & F.col("data_folder_id").isNotNull())
            .groupBy("data_folder_id", "legacy_base_account", F.col("new_base_account").alias(found))
            .agg(F.count("*").alias(f"{found}_n"))
        )

    full = translate(
        accounts,
        tier("FULL", "_full"),
        {"account": "legacy_base_account", "data_folder_id": "data_folder_id"},
        {"_hit": "legacy_base_account", "_full": "_full", "_full_n": "_full_n"},
    )
    side = tier("BASE", "_base").select(
        F.col("legacy_base_account").alias("_key0"), F.col("data_folder_id").alias("_key1"), "_base", "_base_n"
    )
    cond = (F.col("baseaccount") == F.col("_key0")) & (F.col("data_folder_id") == F.col("_key1"))
    both = full.join(side, cond & F.col("_hit").isNull(), "left")
    return both.select(
        *accounts.columns,
        F.coalesce("_full", "_base", F.lit(MISSING_ACCOUNT)).alias("acct_no"),
        F.coalesce("_full_n", "_base_n", F.lit(1)).alias("copies"),
    )


def translate_account(df: DataFrame, accounts: DataFrame, base_map: DataFrame, account: str) -> DataFrame:
    """Add ``acct_no`` for the account column, one output row per matching translation row."""
    targets = base_account_targets(accounts.select("data_folder_id", "account", "baseaccount"), base_map)
    every = targets.withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("copies"))))
    return translate(
        df,
        every,
        {account: "account", "Data_Folder_Id": "data_folder_id"},
        {"acct_no": "acct_no"},
        {"acct_no": MISSING_ACCOUNT},
    )


def latest_per(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The row with the greatest ``order`` columns per key.

    The first order column (a date or number) is reduced per key and remaining columns by a hash
    aggregation, so the rows are neither sorted nor gathered per key; only its small result is
    compared as a whole. NULL keys form a group. ``order`` holds every result column that is no key.
    """
    newest, *rest = order
    best = df.groupBy(*keys, *rest).agg(F.max(newest).alias(newest))
    top = F.max(F.struct(*order)).alias("_top")
    return best.groupBy(*keys).agg(top).select(*keys, *[F.col(f"_top.{c}").alias(c) for c in order])


def _partner(other: DataFrame, on: Mapping[str, str]) -> DataFrame:
    return _side(other, on, {})


def unused_keys(df: DataFrame, other: DataFrame, on: Mapping[str, str]) -> DataFrame:
    """Rows of ``df`` with no partner in ``other``."""
    return df.join(_partner(other, on), _condition(on), "left_anti")


def existing_keys(df: DataFrame, other: DataFrame, on: Mapping[str, str], tasks: int | None = None) -> DataFrame:
    """Rows of ``df`` with a partner in ``other``, each once; ``tasks`` deals both sides over that many."""
    side = _partner(other, on)
    if tasks:
        df, side = df.repartition(tasks, *on), side.repartition(tasks, *side.columns)
    return df.join(side, _condition(on), "left_semi")


def fanout_audit(table: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Translation keys that match more than once, with their number of rows."""
    return table.groupBy(*keys).agg(F.count("*").alias("matches")).filter(F.col("matches") > 1)


def missing_translation(df: DataFrame, column: str, marker: str = MISSING_ACCOUNT) -> DataFrame:
    """Rows whose lookup fell back to the marker or found nothing."""
    return df.filter(F.col(column).isNull() | (F.col(column) == marker))
