"""Centroid clustering with progressive search over Walsh-Hadamard coefficients.

Vectors and centroids go through the exact integer Walsh-Hadamard transform, which multiplies every
squared distance by the number of coefficients. The squared differences of the coefficients are
added up from the coarse ones (few changes of sign) to the fine ones. A partial sum never exceeds
the whole one, so a centroid whose partial sum is already greater than the whole distance of
another is strictly worse and drops out; those that are left go through all coefficients. Equal
distances are never told apart by a bound, so the smaller number wins among them.

Each task sums the vectors that it assigns, per centroid; Spark adds up those few rows. Only the
centroids come to the driver, and there are ``k`` of them at most.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from decimal import Decimal
from math import floor

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgermap.llm.common import _arrow, drop_stored, ship, stored

#: Vectors that a task compares at a time; their differences should stay in a core's cache.
BLOCK_ROWS = 128
#: Coefficients that the search has added up after each step; the last one is all of them.
STEPS = (4, 16, 64)
#: Integers up to this absolute value give sums below 2 ** 63; others are counted as Python integers.
EXACT = 1 << 23
LONGEST = (1 << 63) - 1


def _integer(value: float, scale: int) -> int:
    # without a fraction the product is exact as an integer, also where it is no finite double
    return floor(scale * value) if abs(value) < 2.0**53 else scale * int(value)


def quantised(raw: np.ndarray, scale: int) -> np.ndarray:
    """``floor(scale * x)`` as 64-bit integers, or as Python integers where one of them is large."""
    if not raw.size or np.abs(raw).max() < EXACT / scale:
        return np.floor(scale * raw).astype(np.int64)
    return np.array([[_integer(v, scale) for v in row] for row in raw.tolist()], object).reshape(raw.shape)


def sequency(width: int) -> np.ndarray:
    """Places of the transform's coefficients in order of their changes of sign."""
    rows = transform(np.eye(width, dtype=np.int64))
    return np.argsort((np.diff(np.sign(rows), axis=1) != 0).sum(axis=1), kind="stable")


def transform(data: np.ndarray) -> np.ndarray:
    """The Walsh-Hadamard transform of every row; the width is a power of two."""
    out, size = data, 1
    while size < data.shape[1]:
        halves = out.reshape(len(data), -1, 2, size)
        a, b = halves[:, :, 0], halves[:, :, 1]
        out = np.stack([a + b, a - b], axis=2).reshape(data.shape)
        size *= 2
    return out


class Search:
    """Finds the nearest of some centroids, given as rows of integers."""

    def __init__(self, centroids: np.ndarray):
        dims = centroids.shape[1]
        self.width = 1 << max(dims - 1, 0).bit_length()
        self.order = sequency(self.width)
        self.steps = sorted({min(s, self.width) for s in STEPS} | {self.width})
        self.small = bool(np.abs(centroids).max() <= EXACT)
        self.coefficients = self._coefficients(centroids if self.small else centroids.astype(object))

    def _coefficients(self, data: np.ndarray) -> np.ndarray:
        padded = np.zeros((len(data), self.width), data.dtype)
        padded[:, : data.shape[1]] = data
        return transform(padded)[:, self.order]

    def nearest(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Number of the nearest centroid of every vector, the smaller one of equals, and the squared distance."""
        exact = self.small and vectors.dtype != object
        numbers, distances = [], []
        for start in range(0, len(vectors), BLOCK_ROWS):
            block = vectors[start : start + BLOCK_ROWS]
            number, distance = self._block(block if exact else block.astype(object))
            numbers.append(number)
            distances.append(distance)
        return np.concatenate(numbers), np.concatenate(distances)

    def _block(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        v, c = self._coefficients(vectors), self.coefficients
        row, number = (x.ravel() for x in np.indices((len(v), len(c))))
        # pairs of vector and centroid that are left, by vector and number, and their sums so far
        partial = np.zeros(len(row), v.dtype)
        at = 0
        for step in self.steps:
            partial = partial + ((v[row, at:step] - c[number, at:step]) ** 2).sum(axis=1)
            at = step
            least = self._least(partial, row, len(v))
            if at < self.width:
                # the whole distance of the centroid that is ahead bounds the distance of the nearest
                rest = ((v[:, at:] - c[number[least], at:]) ** 2).sum(axis=1)
                left = partial <= (partial[least] + rest)[row]
                row, number, partial = row[left], number[left], partial[left]
        return number[least].astype(np.int32), partial[least] // self.width

    @staticmethod
    def _least(partial: np.ndarray, row: np.ndarray, count: int) -> np.ndarray:
        """Place of the least sum of each row, the first one of equals; pairs stand by row, then number."""
        starts = np.searchsorted(row, np.arange(count))
        lowest = np.minimum.reduceat(partial, starts)
        hits = np.flatnonzero(partial == lowest[row])
        return hits[np.searchsorted(row[hits], np.arange(count))]


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, width)


def kept_vectors(vectors: DataFrame, width: int, id_col: str, vector_col: str) -> DataFrame:
    """``vec_id, x``: vectors with exactly ``width`` components, none of them null, NaN or infinite."""
    sound = F.forall(
        F.col(vector_col), lambda v: v.isNotNull() & ~F.isnan(v.cast("double")) & (F.abs(v.cast("double")) < float("inf"))
    )
    fits = F.col(vector_col).isNotNull() & (F.size(vector_col) == width)
    return vectors.filter(F.when(fits, sound).otherwise(False)).select(
        F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).alias("x")
    )


def _first_centroids(data: DataFrame, k: int, scale: int, seed: str) -> np.ndarray:
    key = F.sha2(F.concat(F.lit(seed), F.col("vec_id").cast("string")), 256)
    chosen = data.orderBy(key.asc_nulls_last(), "x").limit(k).select("x").collect()
    return np.array([quantised(np.array([r["x"]], np.float64), scale)[0] for r in chosen])


def _sums(data: DataFrame, centroids: np.ndarray, scale: int) -> list:
    """Number of vectors and sums of their components for every centroid that is some vector's nearest."""
    width = centroids.shape[1]
    names = [f"s{i}" for i in range(width)]
    schema = T.StructType(
        [T.StructField("cluster", T.IntegerType()), T.StructField("n", T.LongType())]
        + [T.StructField(n, T.DecimalType(38, 0)) for n in names]
    )
    arrow = _arrow(schema.simpleString())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        search, totals = Search(centroids), {}
        for batch in batches:
            if not batch.num_rows:
                continue
            x = quantised(_matrix(batch.column(0), width), scale)
            number, _ = search.nearest(x)
            for cluster in np.unique(number).tolist():
                mine = x[number == cluster]
                count, total = totals.get(cluster, (0, 0))
                # a batch has too few rows for its sums to leave 63 bits
                totals[cluster] = count + len(mine), total + mine.sum(axis=0).astype(object)
        rows = [(cluster, n, *map(Decimal, map(int, total))) for cluster, (n, total) in sorted(totals.items())]
        columns = [pa.array(c, type=f.type) for c, f in zip(zip(*rows), arrow)]
        if rows:
            yield pa.RecordBatch.from_arrays(columns, schema=arrow)

    per_task = data.select("x").mapInArrow(run, schema)
    return per_task.groupBy("cluster").agg(F.sum("n").alias("n"), *[F.sum(s).alias(s) for s in names]).collect()


def _digest(centroid: np.ndarray) -> str:
    return hashlib.sha256(",".join(str(int(v)) for v in centroid).encode()).hexdigest()


def cluster(
    vectors: DataFrame,
    k: int = 40,
    rounds: int = 5,
    scale: int = 256,
    width: int = 64,
    seed: str = "2:",
    id_col: str = "vec_id",
    vector_col: str = "embedding",
) -> DataFrame:
    """``vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256`` of every vector that takes part.

    Vectors take part that have exactly ``width`` components, none of them null or not finite; a
    component counts as the integer ``floor(scale * x)``. The first centroids are the vectors whose
    ``sha256(seed + id)`` is least, ties by components; rows without an id are clustered but start
    no centroid while there are others. Repeated rows count as often as they stand there. With
    fewer than ``k`` vectors there are fewer centroids; an empty table gives no rows. Further
    columns are ignored. All arithmetic is exact; a distance or inertia beyond a long is null, and
    sums beyond 38 digits end the job.
    """
    schema = "vec_id long, cluster int, distance long"
    spark = vectors.sparkSession
    ship(spark)
    data = stored(kept_vectors(vectors, width, id_col, vector_col))
    centroids = _first_centroids(data, k, scale, seed)
    if not len(centroids):
        return spark.createDataFrame([], f"{schema}, cluster_inertia long, inertia long, centroid_sha256 string")
    for _ in range(rounds):
        centroids = centroids.astype(object)
        for row in _sums(data, centroids, scale):
            centroids[row["cluster"]] = [int(s) // row["n"] for s in row[2:]]
        if np.abs(centroids).max() <= EXACT:
            centroids = centroids.astype(np.int64)
    arrow = _arrow(schema)

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        search = Search(centroids)
        for batch in batches:
            if not batch.num_rows:
                continue
            number, distance = search.nearest(quantised(_matrix(batch.column(1), width), scale))
            fitting = [d if d <= LONGEST else None for d in distance.tolist()]
            columns = [batch.column(0), pa.array(number, pa.int32()), pa.array(fitting, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, schema=arrow)

    assigned = stored(data.mapInArrow(assign, schema))
    # null where a distance is null, or where the sum is no long
    whole = F.when(F.count("distance") == F.count("*"), F.sum(F.col("distance").cast("decimal(38,0)")))
    found = {r["cluster"]: r["total"] for r in assigned.groupBy("cluster").agg(whole.alias("total")).collect()}
    inertia = None if None in found.values() else sum(map(int, found.values()))

    def as_long(total) -> int | None:
        return None if total is None or total > LONGEST else int(total)

    rows = [(n, as_long(t), as_long(inertia), _digest(centroids[n])) for n, t in sorted(found.items())]
    facts = spark.createDataFrame(rows, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    drop_stored(data)
    return assigned.join(F.broadcast(facts), "cluster").select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"
    )


def expected_sql(k: int = 40, rounds: int = 5) -> str:
    """The same as DuckDB SQL, distances by plain sums over all components."""

    def assigned(n: int) -> str:
        return f"""
a{n} AS MATERIALIZED (
    SELECT row, vec_id, x, cluster, distance FROM (
        SELECT v.row, v.vec_id, v.x, c.cluster,
            list_sum([(v.x[i] - c.x[i]) * (v.x[i] - c.x[i]) for i in range(1, 65)])::BIGINT AS distance
        FROM vectors v, c{n} c
    ) QUALIFY row_number() OVER (PARTITION BY row ORDER BY distance, cluster) = 1
)"""

    def moved(n: int) -> str:
        return f"""
s{n} AS (
    SELECT cluster, i, sum(x[i])::BIGINT AS total, count(*) AS n FROM a{n}, range(1, 65) t(i) GROUP BY cluster, i
),
c{n + 1} AS MATERIALIZED (
    SELECT c.cluster, coalesce(m.x, c.x) AS x FROM c{n} c LEFT JOIN (
        SELECT cluster, list((total - (total % n + n) % n) // n ORDER BY i) AS x FROM s{n} GROUP BY cluster
    ) m USING (cluster)
)"""

    steps = ",".join(x for n in range(rounds) for x in (assigned(n), moved(n)))
    return f"""
WITH vectors AS MATERIALIZED (
    SELECT row_number() OVER () AS row, vec_id, [floor(256 * v::DOUBLE)::BIGINT for v in embedding] AS x
    FROM embeddings
    WHERE len(embedding) = 64 AND len([v for v in embedding if v IS NULL OR NOT isfinite(v)]) = 0
),
c0 AS MATERIALIZED (
    SELECT (row_number() OVER (ORDER BY sha256('2:' || vec_id), x) - 1)::INTEGER AS cluster, x
    FROM vectors QUALIFY cluster < {k}
),{steps},{assigned(rounds)}
SELECT vec_id, cluster, distance,
    sum(distance) OVER (PARTITION BY cluster)::BIGINT AS cluster_inertia,
    sum(distance) OVER ()::BIGINT AS inertia,
    sha256(array_to_string(c.x, ',')) AS centroid_sha256
FROM a{rounds} JOIN c{rounds} c USING (cluster)
"""
