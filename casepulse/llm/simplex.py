"""Centroid clustering of integer vectors, with centroids ruled out by n-simplex projection.

The distances of a vector to a few pivots fix a point: the apex over the simplex of the pivots,
with one coordinate for each pivot, the last of them its height. Between the apexes of a vector
and of a centroid, the Euclidean distance with heights on the same side is at most, with heights
on opposite sides at least, the distance of the two themselves. So a centroid whose lower bound
exceeds another one's upper bound is not the nearest; the ones left are compared as integers.
Pivots are the first centroids that span a simplex, and apexes are computed once for all rounds.

Only whole vectors of ``dims`` components take part: null vectors, other lengths, null and
non-finite components are left out. Ties go to the centroid of the smaller number. With fewer
vectors than centroids each vector starts one. Repeated rows keep their rows. A null id is hashed
as an empty one. Scaled components of 2^27 and more would not fit the distance and fail with
ValueError. Other columns are not looked at. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from casepulse.llm.store import cut
from casepulse.llm.vectors import integers, matrix

CENTROIDS, ROUNDS, DIMS, SCALE, SEED = 16, 3, 64, 64, 1
#: Pivots at most, and the least height over the others, as a share of the widest distance, of one.
PIVOTS, LEAST_HEIGHT = 16, 0.1
#: Share of the squared distances by which bounds may be off through rounding.
SLACK = 1e-6
ROWS = 4096


class Simplex:
    """Pivots and the coordinates that distances to them give."""

    def __init__(self, points: np.ndarray, most: int = PIVOTS) -> None:
        self.pivots = points[:1]
        self.base = np.zeros((0, 0))
        widest = squared(points, points).max(initial=0)
        for point in points[1:]:
            if len(self.pivots) == most:
                break
            apex = self.apex(squared(point[None], self.pivots))[0]
            if apex[-1] ** 2 > LEAST_HEIGHT**2 * widest:
                grown = np.zeros((len(apex), len(apex)))
                grown[:-1, :-1], grown[-1] = self.base, apex
                self.base, self.pivots = grown, np.concatenate([self.pivots, point[None]])

    def apex(self, distances: np.ndarray) -> np.ndarray:
        """Coordinates, the last one the height, for rows of squared distances to the pivots."""
        d = distances.astype(float)
        inner = (d[:, :1] + (self.base**2).sum(axis=1) - d[:, 1:]) / 2
        ground = np.linalg.solve(self.base, inner.T).T if len(self.base) else inner
        return np.column_stack([ground, np.sqrt(np.maximum(0, d[:, 0] - (ground**2).sum(axis=1)))])

    def project(self, values: np.ndarray) -> np.ndarray:
        return self.apex(squared(values, self.pivots))


def squared(values: np.ndarray, points: np.ndarray) -> np.ndarray:
    """Exact squared distances of all values to all points, a column for each point."""
    out = np.empty((len(values), len(points)), np.int64)
    for j, point in enumerate(points):
        gap = values - point
        out[:, j] = np.einsum("ij,ij->i", gap, gap)
    return out


def nearest(values: np.ndarray, apexes: np.ndarray, points: np.ndarray, centres: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """The number of the nearest point and the squared distance of each row, and how many distances were taken exactly."""
    number, distance, taken = np.zeros(len(values), np.int64), np.zeros(len(values), np.int64), 0
    for a in range(0, len(values), ROWS):
        rows, tops = values[a : a + ROWS], apexes[a : a + ROWS]
        ground = ((tops[:, None, :-1] - centres[None, :, :-1]) ** 2).sum(axis=2)
        low = ground + (tops[:, None, -1] - centres[None, :, -1]) ** 2
        high = ground + (tops[:, None, -1] + centres[None, :, -1]) ** 2
        size = (tops**2).sum(axis=1)[:, None] + (centres**2).sum(axis=1)
        open_ = low - SLACK * size - 1 <= (high + SLACK * size + 1).min(axis=1)[:, None]
        i, j = np.nonzero(open_)
        gap = rows[i] - points[j]
        found = np.full(open_.shape, np.iinfo(np.int64).max)
        found[i, j] = np.einsum("ij,ij->i", gap, gap)
        best = found.argmin(axis=1)
        number[a : a + ROWS], distance[a : a + ROWS] = best, found[np.arange(len(rows)), best]
        taken += len(i)
    return number, distance, taken


def _checked(values: np.ndarray) -> np.ndarray:
    if values.size and (values.min() <= -(1 << 27) or values.max() >= 1 << 27):
        raise ValueError("a scaled component of 2^27 or more: squared distances would not fit")
    return values


def _projected(ints: DataFrame, simplex: Simplex, dims: int) -> DataFrame:
    """The rows with their ``apex``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                apex = simplex.project(_checked(matrix(batch.column("values"), dims)))
                yield batch.append_column("apex", pa.FixedSizeListArray.from_arrays(apex.ravel(), apex.shape[1]).cast(pa.list_(pa.float64())))

    kind = ints.schema["vec_id"].dataType.simpleString()
    return ints.mapInArrow(run, f"vec_id {kind}, values array<bigint>, apex array<double>")


def _sums(rows: DataFrame, points: np.ndarray, centres: np.ndarray, dims: int) -> dict[int, tuple[int, np.ndarray]]:
    """Number and componentwise sum of the vectors of each centroid; each task adds up its own first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((len(points), dims + 1), np.int64)
        for batch in batches:
            if batch.num_rows:
                values = matrix(batch.column(0), dims)
                number, _, _ = nearest(values, matrix(batch.column(1), centres.shape[1]), points, centres)
                order = np.argsort(number, kind="stable")
                begins = np.flatnonzero(np.diff(number[order], prepend=-1))
                counted = np.column_stack([values, np.ones(len(values), np.int64)])[order]
                total[number[order][begins]] += np.add.reduceat(counted, begins, axis=0)
        some = np.flatnonzero(total[:, dims])
        cells = np.tile(np.arange(dims + 1), len(some))
        yield pa.record_batch(
            [pa.array(np.repeat(some, dims + 1)), pa.array(cells), pa.array(total[some].ravel())], ["cluster", "cell", "n"]
        )

    cells = rows.select("values", "apex").mapInArrow(run, "cluster bigint, cell bigint, n bigint")
    found: dict[int, np.ndarray] = {}
    for row in cells.groupBy("cluster", "cell").agg(F.sum("n").alias("n")).collect():  # centroids times dimensions
        found.setdefault(row.cluster, np.zeros(dims + 1, np.int64))[row.cell] = row.n
    return {cluster: (int(n[dims]), n[:dims]) for cluster, n in found.items()}


def cluster(
    vectors: DataFrame,
    vec_id: str = "vec_id",
    embedding: str = "embedding",
    centroids: int = CENTROIDS,
    rounds: int = ROUNDS,
    dims: int = DIMS,
    scale: int = SCALE,
    seed: int = SEED,
) -> DataFrame:
    """``vec_id``, ``cluster``, ``distance``, ``cluster_inertia``, ``inertia`` and ``centroid``, a row for each vector.

    The first centroids are the vectors of the smallest SHA-256 of ``seed:id``. Every round assigns
    all vectors and moves each centroid to the mean, rounded down, of its vectors, if it has any.
    """
    ints = cut(integers(vectors, scale, vec_id, embedding).where(F.size("values") == dims))
    name = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("vec_id").cast("string"), F.lit(""))), 256)
    first = ints.select(name.alias("name"), "values").orderBy("name", "values").limit(centroids).collect()
    if not first:
        empty = ints.select("vec_id", *(F.lit(0).alias(c) for c in ("cluster", "distance", "cluster_inertia", "inertia")), F.col("values").alias("centroid"))
        return empty.withColumns({c: F.col(c).cast("bigint") for c in ("distance", "cluster_inertia", "inertia")})
    points = _checked(np.array([row["values"] for row in first], np.int64))
    simplex = Simplex(points)
    rows = cut(_projected(ints, simplex, dims))
    for _ in range(rounds):
        for number, (n, total) in _sums(rows, points, simplex.project(points), dims).items():
            points[number] = total // n
    centres, width = simplex.project(points), len(simplex.pivots)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                values, apexes = matrix(batch.column("values"), dims), matrix(batch.column("apex"), width)
                number, distance, _ = nearest(values, apexes, points, centres)
                yield pa.record_batch(
                    [batch.column("vec_id"), pa.array(number, pa.int32()), pa.array(distance)], ["vec_id", "cluster", "distance"]
                )

    kind = ints.schema["vec_id"].dataType.simpleString()
    assigned = cut(rows.mapInArrow(run, f"vec_id {kind}, cluster int, distance bigint"))
    totals = {row["cluster"]: row["n"] for row in assigned.groupBy("cluster").agg(F.sum("distance").alias("n")).collect()}
    spark, inertia = vectors.sparkSession, sum(totals.values())
    about = [(number, n, inertia, points[number].tolist()) for number, n in totals.items()]
    known = spark.createDataFrame(about, "cluster int, cluster_inertia bigint, inertia bigint, centroid array<bigint>")
    return assigned.join(F.broadcast(known), "cluster").select(  # a row for each centroid
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid"
    )

