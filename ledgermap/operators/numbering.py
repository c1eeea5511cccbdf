"""Line numbers and running totals that do not depend on any group fitting into one task.

A window over a document sends the whole document to one task, and one document (say, all lines
without a document number) may hold a large part of the rows. So documents of every size are
numbered the same way: the rows are range-partitioned by group and order and stored once, together
with the number of their partition (the *cell*). Each cell is numbered on its own. A group that
lies in more than one cell is shifted by its rows in earlier cells; there are no more such groups
than cells. Equal rows are told apart by a tie-breaker that is stored with them, so even copies of
one row spread over many cells.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ledgermap.operators.spread import too_large_for_a_task
from ledgermap.sources.workspace import stage

CELL = "_cell"
TIE = "_tie"


@dataclass(frozen=True)
class Dealing:
    """How groups that fit into a task get there: by ``columns``, which follow from the group's keys, over ``tasks``.

    ``heavy`` tells the rows of groups that may not fit; these go in cells.
    """

    columns: Sequence[str]
    tasks: int | None
    heavy: Column | None


def dealing(df: DataFrame, columns: Sequence[str], tasks: int | None) -> Dealing:
    """Find the heavy values in one pass over the columns of ``df``, best a stored table."""
    parts = tasks or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    heavy = too_large_for_a_task(df, columns, parts)
    return Dealing(columns, tasks, F.xxhash64(*columns).isin(heavy) if heavy else None)


def _ascending(cols: Sequence[str]) -> list[Column]:
    return [F.col(c).asc_nulls_first() for c in cols]


def _same(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> Column:
    return reduce(and_, [left[k].eqNullSafe(right[k]) for k in keys])


def ordered_cells(df: DataFrame, cols: Sequence[str], tasks: int | None = None) -> DataFrame:
    """Freeze a range partitioning of ``df`` by ``cols``; ``_cell`` rises with the order.

    Adaptive execution joins neighbouring small partitions into one, if ``tasks`` does not say how many there are.
    """
    return stage(df.repartitionByRange(*([tasks] if tasks else []), *_ascending(cols)).withColumn(CELL, F.spark_partition_id()), "cells")


def _earlier(keys: Sequence[str], order: str):
    return W.partitionBy(*keys).orderBy(order).rowsBetween(W.unboundedPreceding, -1)


def _freeze(df: DataFrame, keys: Sequence[str], order: Sequence[str], tasks: int | None = None) -> tuple[DataFrame, DataFrame]:
    """The rows in cells, and the groups over a cell border: one row for each cell that they lie in.

    ``_before`` is how many rows such a group has in earlier cells. A cell has two such groups at
    most, so there are no more rows than twice the number of shuffle partitions.
    """
    tied = df.withColumn(TIE, F.monotonically_increasing_id())
    frozen = ordered_cells(tied, [*keys, *order, TIE], tasks)
    parts = frozen.groupBy(*keys, CELL).agg(F.count("*").alias("_n"))
    cells = parts.groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct(CELL, "_n"))).alias("_cells"))
    crossing = (
        cells.filter(F.size("_cells") > 1)
        .select(*keys, F.inline("_cells"))
        .withColumn("_before", F.coalesce(F.sum("_n").over(_earlier(keys, CELL)), F.lit(0)))
        .drop("_n")
    )
    return frozen, crossing


def _shift(numbered: DataFrame, crossing: DataFrame, keys: Sequence[str]) -> DataFrame:
    same = _same(numbered, crossing, [*keys, CELL])
    return numbered.join(F.broadcast(crossing), same, "left").select(
        numbered["*"], F.coalesce(crossing["_before"], F.lit(0)).alias("_before")
    )


def _cell_starts(frozen: DataFrame, size: Column) -> DataFrame:
    """``_c, _start``: the sum of ``size`` over all earlier cells. No more rows than shuffle partitions."""
    return (
        frozen.groupBy(CELL)
        .agg(size.alias("_n"))
        .select(F.col(CELL).alias("_c"), F.coalesce(F.sum("_n").over(_earlier([], CELL)), F.lit(0)).alias("_start"))
    )


def number_lines(df: DataFrame, keys: Sequence[str], order: Sequence[str], out: str = "line_no") -> DataFrame:
    """Number the rows of each group from 1 in the given order, as BIGINT column ``out``.

    NULL keys form a group; NULLs sort first. The rows are written once, so the joins that built
    them run only once.
    """
    frozen, crossing = _freeze(df, keys, order)
    local = F.row_number().over(W.partitionBy(CELL, *keys).orderBy(*_ascending([*order, TIE])))
    numbered = frozen.withColumn(out, local.cast("bigint"))
    return _shift(numbered, crossing, keys).withColumn(out, F.col(out) + F.col("_before")).drop(CELL, TIE, "_before")


def number_repeated_lines(
    df: DataFrame,
    keys: Sequence[str],
    before: Sequence[str],
    after: Sequence[str],
    repeats: str,
    item: str,
    out: str,
    add: Callable[[DataFrame], DataFrame] | None = None,
    dealt: Dealing | None = None,
) -> DataFrame:
    """One row for each item of the array ``repeats``, as column ``item``, numbered as ``number_lines`` would.

    The order is ``before``, the item, ``after``. All rows of a group must hold the same array, and a
    row's place among the others must not depend on the item. The rows are shuffled, written and
    sorted once each; their repeats come last, with their numbers reckoned: rows equal in ``before``
    follow all earlier rows with all their items, and come once for the first item, then for the next.
    ``add`` adds the array once the rows are placed, for one that would be long to shuffle. With ``dealt``
    the groups that fit into a task are numbered there, after one shuffle and without being written.
    """
    if dealt is None:
        placed = _runs_in_cells(df, keys, before, after)
    else:
        ordinary = df if dealt.heavy is None else df.filter(~dealt.heavy)
        if dealt.tasks:
            ordinary = ordinary.repartition(dealt.tasks, *dealt.columns)
        placed = _runs(ordinary, list(dict.fromkeys([*dealt.columns, *keys])), before, after)
        if dealt.heavy is not None:
            placed = placed.unionByName(_runs_in_cells(df.filter(dealt.heavy), keys, before, after))
    number = F.size(repeats) * F.col("_earlier") + F.col("_at") * F.col("_run") + F.col("_inside")
    repeated = (add(placed) if add else placed).select("*", F.posexplode(repeats).alias("_at", item))
    return repeated.withColumn(out, number.cast("bigint")).drop("_earlier", "_run", "_inside", "_at", repeats)


def _runs(df: DataFrame, keys: Sequence[str], before: Sequence[str], after: Sequence[str]) -> DataFrame:
    """Add the place of each row among those equal in ``keys`` and ``before``, how many these are, and the group's earlier rows.

    The columns are ``_inside``, ``_run`` and ``_earlier``. A group must fit into a task.
    """
    place = F.row_number().over(W.partitionBy(*keys).orderBy(*_ascending([*before, *after])))
    run = W.partitionBy(*keys, *before)
    return (
        df.withColumn("_inside", place.cast("bigint"))
        .withColumns({"_earlier": F.min("_inside").over(run) - 1, "_run": F.count("*").over(run)})
        .withColumn("_inside", F.col("_inside") - F.col("_earlier"))
    )


def _runs_in_cells(df: DataFrame, keys: Sequence[str], before: Sequence[str], after: Sequence[str]) -> DataFrame:
    """``_runs`` for groups of any size. The rows are shuffled twice and written and sorted once."""
    out = "_inside"
    frozen, crossing = _freeze(df, keys, [*before, *after])
    group = [*keys, *before]
    local = F.row_number().over(W.partitionBy(CELL, *keys).orderBy(*_ascending([*before, *after, TIE])))
    same = W.partitionBy(CELL, *group)
    numbered = frozen.withColumn(out, local.cast("bigint")).withColumns(
        {"_first": F.min(out).over(same), "_size": F.count("*").over(same)}
    )
    shifted = _shift(numbered, crossing, keys)
    # rows equal in ``before`` go over a cell border only where their group does
    border = crossing.select(*[F.col(k).alias(f"_b_{k}") for k in keys], F.col(CELL).alias("_b_cell"))
    at_border = reduce(and_, [F.col(k).eqNullSafe(F.col(f"_b_{k}")) for k in keys]) & (F.col(CELL) == F.col("_b_cell"))
    cells = (
        frozen.join(F.broadcast(border), at_border, "left_semi")
        .groupBy(*group, CELL)
        .agg(F.count("*").alias("_n"))
        .groupBy(*group)
        .agg(F.sort_array(F.collect_list(F.struct(CELL, "_n"))).alias("_cells"), F.sum("_n").alias("_whole"))
        .filter(F.size("_cells") > 1)
        .select(*group, "_whole", F.inline("_cells"))
        .withColumn("_ahead", F.coalesce(F.sum("_n").over(_earlier(group, CELL)), F.lit(0)))
    )
    placed = shifted.join(F.broadcast(cells), _same(shifted, cells, [*group, CELL]), "left").select(
        shifted["*"], "_whole", F.coalesce(cells["_ahead"], F.lit(0)).alias("_ahead")
    )
    return (
        placed.withColumn("_earlier", F.col("_first") - 1 + F.col("_before") - F.col("_ahead"))
        .withColumns({"_run": F.coalesce("_whole", "_size"), "_inside": F.col("_inside") + F.col("_before") - F.col("_earlier")})
        .drop(CELL, TIE, "_first", "_size", "_before", "_whole", "_ahead")
    )


def number_lines_and_rows_before(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], out: str, before: str, tasks: int | None = None
) -> DataFrame:
    """``number_lines``, and as BIGINT column ``before`` the number of rows in all earlier groups.

    Both follow from places inside the cells, so the rows are not shuffled again to learn about
    their group. A row's group begins at its place in its cell by the keys alone. ``tasks`` is the
    number of cells, each of which one task sorts, where that of shuffle partitions is too small.
    """
    frozen, crossing = _freeze(df, keys, order, tasks)
    cell = W.partitionBy(CELL)
    placed = frozen.repartition(tasks, CELL) if tasks else frozen
    numbered = placed.withColumn(out, F.row_number().over(cell.orderBy(*_ascending([*keys, *order, TIE])))).withColumn(
        before, F.rank().over(cell.orderBy(*_ascending(keys)))
    )
    shifted = _shift(numbered, crossing, keys).join(F.broadcast(_cell_starts(frozen, F.count("*"))), F.col(CELL) == F.col("_c"))
    return shifted.withColumns(
        {
            out: (F.col(out) - F.col(before) + 1 + F.col("_before")).cast("bigint"),
            before: (F.col("_start") + F.col(before) - 1 - F.col("_before")).cast("bigint"),
        }
    ).drop(CELL, TIE, "_before", "_c", "_start")


def rows_before(groups: DataFrame, key: str, size: str, out: str) -> DataFrame:
    """Add the sum of ``size`` over all rows whose ``key`` sorts earlier; ``key`` must be unique."""
    frozen = ordered_cells(groups, [key])
    inside = F.coalesce(F.sum(size).over(_earlier([CELL], key)), F.lit(0))
    return (
        frozen.join(F.broadcast(_cell_starts(frozen, F.sum(size))), F.col(CELL) == F.col("_c"))
        .withColumn(out, F.col("_start") + inside)
        .drop(CELL, "_c", "_start")
    )
