"""Joins whose left keys are uneven: heavy keys are found in one pass and dealt over many tasks.

The pass keeps a bounded number of counters per task and merges them, so it never groups by key.
Rows of a heavy key get one of several numbers, and the other side's rows of that key are repeated
for each number; keys that are NULL match nothing and are spread without any repeats. One join by
key and number follows. The work of the join stays the same; only where it happens changes.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from math import ceil
from operator import and_, or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgermap.sources import workspace

#: Pieces of a heavy key per share of an average partition; more pieces even out better.
PIECES = 16
#: The most counters that one pass keeps; a key rarer than it can tell is not heavy.
COUNTERS = 1_000_000
HASH, NUMBER = "_key_hash", "_piece"


def _hash(keys: Sequence[str]) -> Column:
    return F.xxhash64(*keys)


def _no_key(keys: Sequence[str]) -> Column:
    return reduce(or_, [F.col(k).isNull() for k in keys])


def _candidates(df: DataFrame, keys: Sequence[str], share: float) -> tuple[int, dict[int, int]]:
    """Number of rows, and key hashes with estimated rows, among them all of at least ``share``.

    With 7 / share counters the sketch's error is at most half of ``share``, so no heavy key is missed,
    and at most 2 / share keys can stand in front of one.
    """
    counters = min(COUNTERS, ceil(7 / share))
    # a constant for the first place keeps the sketch from being empty
    top = F.expr(f"approx_top_k({HASH}, {min(counters, ceil(2 / share))}, {counters})")
    found = df.select(_hash(keys).alias(HASH)).agg(F.count("*").alias("rows"), top.alias("top")).first()
    return found["rows"], {r["item"]: r["count"] for r in found["top"] or [] if r["item"] is not None}


def heavy_keys(df: DataFrame, keys: Sequence[str], share: float) -> DataFrame:
    """Keys (NULL ones too) that at least ``share`` of the rows have, with their exact number of rows.

    The counters name the candidates; only their rows are then counted.
    """
    rows, found = _candidates(df, keys, share)
    wanted = [h for h, n in found.items() if n >= share * rows / 2]
    counted = df.filter(_hash(keys).isin(wanted)).groupBy(*keys).agg(F.count("*").alias("rows"))
    return counted.filter(F.col("rows") >= F.lit(share) * rows)


def too_large_for_a_task(df: DataFrame, keys: Sequence[str], parts: int) -> list[int]:
    """Hashes of keys (``xxhash64``) with at least half of the rows that each of ``parts`` tasks has, and an eighth of
    ``ROWS_PER_TASK``. The list is as long as four times ``parts`` at most.
    """
    rows, found = _candidates(df, keys, 1 / (2 * parts))
    least = max(rows / (2 * parts), workspace.ROWS_PER_TASK / 8)
    return [h for h, n in found.items() if n >= least]


def spread_join(
    df: DataFrame, side: DataFrame, left: Sequence[str], right: Sequence[str], how: str, counted: DataFrame | None = None
) -> DataFrame:
    """Left or inner join of ``df`` and ``side`` by ``left`` = ``right``, with heavy keys of ``df`` spread.

    A key is heavy from half of an average shuffle partition on. The list of heavy keys is as long
    as four times the number of partitions at most. ``counted`` holds the key columns of the rows that
    ``df`` was made of: a pass over ``df`` itself would run its joins once more.
    """
    if how not in ("left", "inner"):
        raise ValueError("only left and inner joins repeat the right side safely")
    spark = df.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    if how == "inner":
        df = df.filter(~_no_key(left))
    rows, found = _candidates(df if counted is None else counted, left, 1 / (2 * parts))
    pieces = [(h, ceil(n / rows * parts * PIECES)) for h, n in found.items() if n * 2 * parts >= rows]
    dealt = F.broadcast(spark.createDataFrame(pieces, f"{HASH} long, pieces int"))
    # the place in its task deals out equal rows as well
    place = F.monotonically_increasing_id()
    of_row = F.when(_no_key(left), F.lit(parts * PIECES)).otherwise(F.coalesce("pieces", F.lit(1)))
    numbered = (
        df.withColumn(HASH, _hash(left))
        .join(dealt, HASH, "left")
        .withColumn(NUMBER, F.pmod(F.xxhash64(place), of_row).cast("int"))
        .drop(HASH, "pieces")
    )
    repeated = (
        side.filter(~_no_key(right))
        .withColumn(HASH, _hash(right))
        .join(dealt, HASH, "left")
        .withColumn("_side_piece", F.explode(F.sequence(F.lit(0), F.coalesce("pieces", F.lit(1)) - 1)))
        .drop(HASH, "pieces")
    )
    same = reduce(and_, [F.col(a) == F.col(b) for a, b in zip(left, right)])
    return numbered.join(repeated, same & (F.col(NUMBER) == F.col("_side_piece")), how).drop(NUMBER, "_side_piece")


def forecast(df: DataFrame, lookups: Sequence[tuple]) -> DataFrame:
    """One row: how many rows ``df`` has and how many a chain of lookups makes of them, without joining them.

    A lookup is ``(table, {column: table column}, how)`` with ``how`` left or inner, by columns of
    ``df``; a fourth item names the column that says how many rows a row of the table stands for. The
    rows are counted per combination of all keys first; each table becomes a vector of matches per
    key, and the vectors are multiplied.
    """
    names = sorted({k for _, on, *_ in lookups for k in on})
    counted = df.groupBy(*names).agg(F.count("*").cast("decimal(38,0)").alias("_made")).withColumn("_rows", F.col("_made"))
    for i, (table, on, how, *copies) in enumerate(lookups):
        keys = [F.col(k).alias(f"_k{i}_{j}") for j, k in enumerate(on.values())]
        matches = table.groupBy(*keys).agg((F.sum(copies[0]) if copies else F.count("*")).alias(f"_m{i}"))
        same = reduce(and_, [F.col(k) == F.col(f"_k{i}_{j}") for j, k in enumerate(on)])
        none = 1 if how == "left" else 0
        times = F.coalesce(f"_m{i}", F.lit(none)).cast("decimal(18,0)")
        counted = counted.join(matches, same, "left").withColumn("_made", (F.col("_made") * times).cast("decimal(38,0)"))
        counted = counted.select(*names, "_rows", "_made")
    return counted.agg(
        F.coalesce(F.sum("_rows"), F.lit(0)).cast("bigint").alias("rows_in"),
        F.coalesce(F.sum("_made"), F.lit(0)).cast("bigint").alias("rows_out"),
    )


def missing_keys(
    df: DataFrame, lookups: Mapping[str, tuple[DataFrame, Mapping[str, str]]], amount: str
) -> DataFrame:
    """``lookup, legacy_key, rows, amount``: keys of ``df`` that their lookup lacks, for all lookups in one pass.

    The rows are summed per combination of all keys first and then per lookup and key; one anti join
    by both follows. The key is its columns joined by `` | ``, with NULL as an empty part; a key with
    a NULL is missing whatever its table holds.
    """
    names = sorted({k for _, on in lookups.values() for k in on})
    summed = df.groupBy(*names).agg(F.count("*").alias("rows"), F.sum(amount).cast("decimal(38,2)").alias("amount"))

    def entry(label: str, columns: Sequence[str]) -> Column:
        texts = F.array(*[F.col(k).cast("string") for k in columns])
        return F.struct(F.lit(label).alias("lookup"), texts.alias("key"))

    tagged = summed.select(
        F.inline(F.array(*[entry(label, list(on)) for label, (_, on) in lookups.items()])), "rows", "amount"
    )
    used = tagged.groupBy("lookup", "key").agg(F.sum("rows").alias("rows"), F.sum("amount").cast("decimal(38,2)").alias("amount"))
    known = None
    for label, (table, on) in lookups.items():
        own = table.filter(~_no_key(list(on.values()))).select(entry(label, list(on.values())).alias("_e")).select(
            F.col("_e.lookup").alias("_lookup"), F.col("_e.key").alias("_key")
        )
        known = own if known is None else known.unionByName(own)
    same = (F.col("lookup") == F.col("_lookup")) & (F.col("key") == F.col("_key"))
    missing = used.join(known, same, "left_anti")
    text = F.array_join(F.transform("key", lambda k: F.coalesce(k, F.lit(""))), " | ")
    return missing.select("lookup", text.alias("legacy_key"), "rows", "amount").groupBy("lookup", "legacy_key").agg(
        F.sum("rows").alias("rows"), F.sum("amount").cast("decimal(38,2)").alias("amount")
    )
