"""Exact top-k search by inner product with a pivot-distance index.

A vector gets one more coordinate such that all have the same length; then the order by inner
product with a query is the order by distance to it. Each vector is keyed by its nearest pivot and
its distance to that pivot. A bounded sample cuts each pivot's distances into rings; all rows are
sorted into them and cut into cells. By the triangle inequality a vector of a ring is no closer to a
query than the ring's inner and outer distance allow.

Each query expands its rings in order of that bound, a few at first and then more at a time. After
each turn its k-th score is a radius that only shrinks, and a query whose next ring lies beyond it
stops. The visits of a ring are grouped into blocks of queries, and its cells into chunks, so
neither a popular ring nor a large one lands in one task. Scores are integers and exact: doubles
where they hold them, else 64-bit or Python integers.
"""

from __future__ import annotations

from collections.abc import Iterator
from decimal import Decimal
from math import ceil, floor

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgermap.llm.common import _arrow, drop_stored, ship, stored

PIVOTS = 32
#: The most vectors that the choice of pivots and rings looks at, and how many of them make a ring.
SAMPLE = 16384
RING_SAMPLE = 128
#: Vectors of a cell at most, cells of a chunk, and queries of a block.
CELL_ROWS = 2048
CHUNK_CELLS = 8
QUERY_ROWS = 256
#: Rings that a query visits in its first turn, and how many times as many in each further one.
FIRST_RINGS, MORE = 2, 4
#: Components of a greater absolute value end the job.
GREATEST = 1e150


def kept_vectors(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """``id, x``: rows with an id and a vector whose components are all finite."""
    good = F.forall(
        F.col(vector_col), lambda v: v.isNotNull() & ~F.isnan(v.cast("double")) & (F.abs(v.cast("double")) < float("inf"))
    )
    has = F.col(vector_col).isNotNull() & F.col(id_col).isNotNull()
    return vectors.filter(F.when(has, good).otherwise(False)).select(
        F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("x")
    )


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    """Rows as doubles, cut to the width; shorter vectors end in zeros."""
    out = np.zeros((len(column), width))
    for i, row in enumerate(column):
        values = row.values.to_numpy(zero_copy_only=False)[:width]
        out[i, : len(values)] = values
    return out


def quantised(raw: np.ndarray, scale: int) -> np.ndarray:
    """``floor(scale * x)`` as 64-bit integers, or as Python integers where they are too large for that."""
    if not raw.size or np.abs(raw).max() < 2.0**62 / scale:
        return np.floor(scale * raw).astype(np.int64)
    whole = [[floor(scale * v) if abs(v) < 2.0**53 else scale * int(v) for v in row] for row in raw.tolist()]
    return np.array(whole, object).reshape(raw.shape)


def _length(data: np.ndarray) -> float:
    return float(np.sqrt((data.astype(np.float64) ** 2).sum(axis=1).max(initial=0)))


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products of all rows, exactly; no partial sum exceeds the product of the lengths."""
    greatest = _length(a) * _length(b) * 1.001
    if greatest < 2.0**53:
        return (a.astype(np.float64) @ b.astype(np.float64).T).astype(np.int64)
    if greatest < 2.0**63:
        return a.astype(np.int64) @ b.astype(np.int64).T
    return a.astype(object) @ b.astype(object).T


def _lifted(data: np.ndarray, longest: float) -> np.ndarray:
    rest = np.sqrt(np.maximum(longest - (data**2).sum(axis=1), 0))
    return np.concatenate([data, rest[:, None]], axis=1)


def _distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    squares = (a**2).sum(axis=1)[:, None] + (b**2).sum(axis=1)[None, :] - 2 * a @ b.T
    return np.sqrt(np.maximum(squares, 0))


def _fitted(data: DataFrame, scale: int, width: int, longest: float) -> tuple[np.ndarray, list[np.ndarray]]:
    """Pivots far from each other, and for each one the distances where its rings begin."""
    sample = data.orderBy(F.xxhash64("id"), "id", "x").limit(SAMPLE).toArrow()
    whole = quantised(_matrix(sample.column("x").combine_chunks(), width), scale).astype(np.float64)
    rows = np.unique(_lifted(whole, longest), axis=0)
    chosen = [int(np.argmin(((rows - rows.mean(axis=0)) ** 2).sum(axis=1)))]
    far = np.full(len(rows), np.inf)
    while len(chosen) < min(PIVOTS, len(rows)):
        far = np.minimum(far, ((rows - rows[chosen[-1]]) ** 2).sum(axis=1))
        chosen.append(int(np.argmax(far)))
    pivots = rows[chosen]
    distance = _distances(rows, pivots)
    nearest, distance = distance.argmin(axis=1), distance.min(axis=1)
    borders = [np.unique(np.sort(distance[nearest == p])[RING_SAMPLE::RING_SAMPLE]) for p in range(len(pivots))]
    return pivots, borders


class Rings:
    """The rings that hold rows: their pivots and the least and greatest distance in them."""

    def __init__(self, pivots: np.ndarray, longest: float, rows: list):
        self.pivots, self.longest = pivots, longest
        self.number = np.array([r["ring"] for r in rows], np.int32)
        self.pivot = np.array([r["pivot"] for r in rows], np.int32)
        self.inner = np.array([r["inner"] for r in rows])
        self.outer = np.array([r["outer"] for r in rows])

    def turn(self, q: np.ndarray, least: np.ndarray, start: int, stop: int) -> list[np.ndarray]:
        """For each query its rings from ``start`` to ``stop`` in order of their bounds, without those beyond its radius.

        ``least`` is the k-th score so far; without one nothing is ruled out.
        """
        distance = _distances(np.concatenate([q, np.zeros((len(q), 1))], axis=1), self.pivots)[:, self.pivot]
        bound = np.maximum(np.maximum(distance - self.outer, self.inner - distance), 0)
        order = np.argsort(bound, axis=1, kind="stable")[:, start:stop]
        square = (q**2).sum(axis=1)
        # squared distance of a score: |q|^2 + longest - 2 score; the slack outweighs rounding
        radius = np.sqrt(np.maximum(square + self.longest - 2 * least, 0))
        radius += 1e-6 * (1 + np.sqrt(self.longest) + np.sqrt(square))
        near = np.take_along_axis(bound, order, axis=1) <= np.where(np.isnan(radius), np.inf, radius)[:, None]
        return [self.number[o[n]] for o, n in zip(order, near)]


def build_index(
    data: DataFrame, pivots: np.ndarray, borders: list[np.ndarray], scale: int, width: int, longest: float
) -> DataFrame:
    """``ring, pivot, cell, inner, outer, ids, data``: one stored row per cell, ids and components as bytes."""
    first = np.cumsum([0] + [len(b) + 1 for b in borders])
    schema = "ring int, pivot int, distance double, id long, tie long, x array<double>"
    key_arrow = _arrow(schema)

    def key(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            whole = quantised(_matrix(batch.column(1), width), scale).astype(np.float64)
            distance = _distances(_lifted(whole, longest), pivots)
            nearest = distance.argmin(axis=1)
            distance = distance[np.arange(len(nearest)), nearest]
            ring = [first[p] + np.searchsorted(borders[p], d, side="right") for p, d in zip(nearest, distance)]
            columns = [pa.array(ring, pa.int32()), pa.array(nearest, pa.int32()), pa.array(distance), batch.column(0), batch.column(2), batch.column(1)]
            yield pa.RecordBatch.from_arrays(columns, schema=key_arrow)

    cell_schema = "ring int, pivot int, cell long, inner double, outer double, ids binary, data binary"
    cell_arrow = _arrow(cell_schema)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        cell = TaskContext.get().partitionId() << 32
        held: list[tuple] = []

        def flush() -> pa.RecordBatch:
            nonlocal cell, held
            ids = np.array([h[3] for h in held], "<i8")
            content = np.zeros((len(held), width), "<f8")
            for i, h in enumerate(held):
                content[i, : len(h[4])] = h[4]
            ring, pivot = held[0][:2]
            row = [[ring], [pivot], [cell], [held[0][2]], [held[-1][2]], [ids.tobytes()], [content.tobytes()]]
            cell, held = cell + 1, []
            return pa.RecordBatch.from_arrays(
                [pa.array(c, type=f.type) for c, f in zip(row, cell_arrow)], schema=cell_arrow
            )

        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                if held and (held[0][0] != row[0] or len(held) == CELL_ROWS):
                    yield flush()
                held.append(row)
        if held:
            yield flush()

    keyed = data.select("id", "x", F.monotonically_increasing_id().alias("tie")).mapInArrow(key, schema)
    # the tie-breaker spreads equal rows over partitions
    order = ("ring", "distance", "id", "tie")
    sorted_rows = keyed.repartitionByRange(*order).sortWithinPartitions(*order).drop("tie")
    return stored(sorted_rows.mapInArrow(cut, cell_schema))


def _search(visits: DataFrame, cells: DataFrame, asked: DataFrame, scale: int, width: int, k: int, kind: str) -> DataFrame:
    """``row, query_id, vec_id, score``: what each visited cell adds to the k best of each query."""
    schema = f"row long, query_id long, vec_id long, score {kind}"
    arrow_schema = _arrow(schema)
    blocks = (
        visits.join(asked, "row")
        .withColumn("block", F.pmod(F.xxhash64("row"), F.col("blocks")))
        .groupBy("ring", "block", "chunks")
        .agg(F.collect_list(F.struct("row", "query_id", "x", "least")).alias("queries"))
        .withColumn("chunk", F.explode(F.sequence(F.lit(0).cast("long"), F.col("chunks") - 1)))
    )
    joined = blocks.join(cells, ["ring", "chunk"]).select("ids", "data", "queries")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(batch.num_rows):
                ids = np.frombuffer(batch.column(0)[at].as_py(), "<i8")
                content = np.frombuffer(batch.column(1)[at].as_py(), "<f8").reshape(len(ids), width)
                queries = batch.column(2)[at].values
                rows, names, least = (queries.field(f).to_pylist() for f in ("row", "query_id", "least"))
                scores = products(quantised(_matrix(queries.field("x"), width), scale), quantised(content, scale))
                out: list[list] = [[], [], [], []]
                for row, name, floor_score, score in zip(rows, names, least, scores):
                    mine = ids != name
                    if floor_score is not None:
                        mine &= score >= int(floor_score)
                    mine = np.flatnonzero(mine)
                    if len(mine) > k and score.dtype != object:
                        # no score below the k-th greatest is among the best
                        mine = mine[score[mine] >= np.partition(score[mine], len(mine) - k)[len(mine) - k]]
                    best = sorted(zip((-score[mine]).tolist(), ids[mine].tolist()))[:k]
                    out[0] += [row] * len(best)
                    out[1] += [name] * len(best)
                    out[2] += [i for _, i in best]
                    out[3] += [-s if kind == "long" else Decimal(-s) for s, _ in best]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, type=f.type) for c, f in zip(out, arrow_schema)], schema=arrow_schema
                )

    return joined.mapInArrow(run, schema)


def _best(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("row").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def top_k(
    vectors: DataFrame,
    queries: DataFrame,
    k: int = 5,
    scale: int = 256,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
) -> DataFrame:
    """``query_id, rank, vec_id, score``: the k highest inner products of each query, exactly.

    Components count as the integer ``floor(scale * x)``. Rows with a null id, a null vector or a
    null or not finite component take no part; a shorter vector ends in zeros, and components of a
    query beyond all indexed vectors count nothing. Every row is indexed and every query row is a
    query, also where ids repeat; candidates are the rows of other ids. Ties go to the smaller id;
    with fewer candidates all are returned. A score beyond a long is null, in its right rank. An
    empty table gives no rows; further columns are ignored.
    """
    spark = vectors.sparkSession
    ship(spark)
    result_schema = "query_id long, rank int, vec_id long, score long"
    data = stored(kept_vectors(vectors, id_col, vector_col))
    asked = stored(
        kept_vectors(queries, id_col, vector_col).select(
            F.monotonically_increasing_id().alias("row"), F.col("id").alias("query_id"), "x"
        )
    )
    whole = F.transform("x", lambda v: F.abs(v) * scale + 1)
    square = F.aggregate(whole, F.lit(0.0), lambda s, v: s + v * v)
    greatest = F.coalesce(F.array_max(F.transform("x", lambda v: F.abs(v))), F.lit(0.0))
    facts = data.agg(F.max(square), F.max(F.size("x")), F.max(greatest)).first()
    asked_facts = asked.agg(F.max(square), F.max(greatest)).first()
    if facts[0] is None or asked_facts[0] is None:
        return spark.createDataFrame([], result_schema)
    if max(facts[2], asked_facts[1]) > GREATEST:
        raise ValueError(f"components beyond {GREATEST} cannot be scored")
    # the greatest squared length, from above
    longest, width = float(facts[0]), max(int(facts[1]), 1)
    kind = "long" if (longest * asked_facts[0]) ** 0.5 * 1.001 < 2.0**63 else "decimal(38,0)"
    pivots, borders = _fitted(data, scale, width, longest)
    cells = build_index(data, pivots, borders, scale, width, longest)
    in_rings = cells.groupBy("ring", "pivot").agg(
        F.min("inner").alias("inner"), F.max("outer").alias("outer"), F.count("*").alias("cells")
    )
    # no more rings than the sample has rows
    ring_rows = in_rings.collect()
    rings = Rings(pivots, longest, ring_rows)
    chunks = {r["ring"]: ceil(r["cells"] / CHUNK_CELLS) for r in ring_rows}
    chunk_table = F.broadcast(spark.createDataFrame(list(chunks.items()), "ring int, chunks long"))
    cells = cells.join(chunk_table, "ring").select(
        "ring", F.pmod(F.xxhash64("cell"), F.col("chunks")).alias("chunk"), "ids", "data"
    )

    def visits_of(start: int, stop: int):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for at in range(0, batch.num_rows, QUERY_ROWS):
                    rows = batch.slice(at, QUERY_ROWS)
                    q = quantised(_matrix(rows.column(1), width), scale).astype(np.float64)
                    least = np.array([np.nan if v is None else float(v) for v in rows.column(2).to_pylist()])
                    turns = rings.turn(q, least, start, stop)
                    names = np.repeat(rows.column(0).to_numpy(), [len(t) for t in turns])
                    columns = [pa.array(names, pa.int64()), pa.array(np.concatenate(turns), pa.int32())]
                    yield pa.RecordBatch.from_arrays(columns, names=["row", "ring"])

        return run

    found = None
    start, stop = 0, FIRST_RINGS
    while start < len(ring_rows):
        now = asked.withColumn("least", F.lit(None).cast(kind))
        if found is not None:
            least = found.filter(F.col("rank") == k).select("row", F.col("score").alias("least"))
            now = asked.join(least, "row", "left")
        visits = stored(now.select("row", "x", "least").mapInArrow(visits_of(start, stop), "row long, ring int"))
        often = {r["ring"]: r["count"] for r in visits.groupBy("ring").count().collect()}
        if not often:
            drop_stored(visits)
            break
        sizes = [(ring, ceil(n / QUERY_ROWS), chunks[ring]) for ring, n in often.items()]
        dealt = F.broadcast(spark.createDataFrame(sizes, "ring int, blocks long, chunks long"))
        more = _search(visits.join(dealt, "ring"), cells, now, scale, width, k, kind)
        columns = ["row", "query_id", "vec_id", "score"]
        before = found
        found = stored(_best(more if before is None else before.select(*columns).unionByName(more), k))
        drop_stored(visits, *([] if before is None else [before]))
        start, stop = stop, stop + MORE * (stop - start)
    drop_stored(data, asked)
    in_range = F.col("score").between(-(2**63), 2**63 - 1)
    score = F.col("score") if kind == "long" else F.when(in_range, F.col("score")).cast("long")
    return found.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", score.alias("score"))
