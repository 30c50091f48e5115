"""Centroid clustering in integers, with a PCA-rotated filter before the exact distances.

Every component becomes ``floor(scale * x)``.  One pass over all vectors sums
their first and second moments; the eigenvectors of the covariance rotate the
space.  A table then stores, per vector, its integers, the ``lead`` leading
rotated coordinates and the norm of what those leave out.  For any centroid the
squared distance of the leading coordinates plus the squared difference of the
residual norms is a lower bound of the squared distance, so a round first finds
the centroid of the least bound, its exact integer distance, and then verifies
in integers only those centroids whose bound (less a margin above the rounding
error of doubles) does not exceed it.  The assignment therefore equals a full
scan, ties to the smaller number.

A round is one scan of that table: tasks sum their vectors per cluster in
integers, Spark adds these sums, and k rows of them reach the driver, which
divides exactly and rounds down.  No vector is shuffled, whatever its copies.
What is broadcast is the k centroids and the rotation (width squared).

Kept are vectors with exactly ``width`` components, none null, NaN or infinite;
others and null vectors give no row.  A row without id takes part under an
empty id.  Repeated rows count as often as they occur.  Starting centroids are
the ``k`` rows with the least hashes, ties by id, then by components; with fewer
rows there are fewer centroids.  A cluster that gets no vector keeps its
centroid.  An empty table gives an empty result.  Other columns are not read.
Components of 131072 or more in absolute value raise ``ValueError``: beyond them
a squared distance of 64 components would not fit a long.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import column, cut, written

SCALE = 1024
LEAD = 16
#: Largest integer component: 64 * (2 * LIMIT) ** 2 fits a long.
LIMIT = 1 << 27
#: Doubles lose about 1e-13 of these sums; the bounds give away far more than that.
MARGIN = 1e-9


@dataclass(frozen=True)
class Rotation:
    mean: np.ndarray
    axes: np.ndarray

    def __call__(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Leading coordinates and residual norm of each row."""
        y = (x - self.mean) @ self.axes
        rest = ((x - self.mean) ** 2).sum(1) - (y ** 2).sum(1)
        return y, np.sqrt(np.maximum(rest, 0.0))


def lists(a: pa.Array, width: int) -> np.ndarray:
    return a.flatten().to_numpy(zero_copy_only=False).reshape(len(a), width)


def arrow_lists(x: np.ndarray, kind: pa.DataType) -> pa.Array:
    ends = np.arange(len(x) + 1, dtype=np.int32) * x.shape[1]
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(x.ravel(), kind))


def integers(vector: Column, scale: int = SCALE) -> Column:
    return F.transform(vector, lambda x: F.floor(x.cast("double") * F.lit(float(scale))))


def kept(df: DataFrame, vec_id: str, vector: str, width: int, scale: int) -> DataFrame:
    """``id, x`` of the vectors that take part."""
    v = column(vector)
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    big = F.exists(v, lambda x: F.abs(x) * scale >= LIMIT)
    x = F.when(big, F.raise_error(F.lit(f"a component reaches {LIMIT // scale}"))).otherwise(integers(v, scale))
    return df.where((F.size(v) == width) & ~bad).select(column(vec_id).cast("long").alias("id"), x.alias("x"))


def rotation(rows: DataFrame, width: int, lead: int) -> Rotation:
    """Principal axes of all vectors."""
    def moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(1 + width + width * width)
        for b in batches:
            x = lists(b.column(0), width).astype(np.float64)
            total += np.concatenate([[len(x)], x.sum(0), (x.T @ x).ravel()])
        yield pa.RecordBatch.from_arrays([arrow_lists(total[None], pa.float64())], ["total"])

    parts = rows.select("x").mapInArrow(moments, "total array<double>").select(F.posexplode("total").alias("at", "value"))
    sums = {r["at"]: r["value"] for r in parts.groupBy("at").agg(F.sum("value").alias("value")).collect()}
    n = max(sums.get(0, 0.0), 1.0)
    values = np.array([sums.get(i, 0.0) for i in range(1 + width + width * width)]) / n
    mean, square = values[1:width + 1], values[width + 1:].reshape(width, width)
    _, axes = np.linalg.eigh(square - np.outer(mean, mean))
    return Rotation(mean, axes[:, ::-1][:, :lead].copy())


class Nearest:
    """Exact nearest centroids of a batch; counts the distances it had to verify."""

    def __init__(self, centroids: np.ndarray, turn: Rotation):
        self.centroids, self.verified = centroids, 0
        self.lead, self.rest = turn(centroids.astype(np.float64))
        self.square = (self.lead ** 2).sum(1) + self.rest ** 2

    def bounds(self, lead: np.ndarray, rest: np.ndarray) -> np.ndarray:
        """A lower bound of the squared distance of each row to each centroid."""
        square = (lead ** 2).sum(1) + rest ** 2
        both = square[:, None] + self.square
        return both - 2 * (lead @ self.lead.T + np.outer(rest, self.rest)) - (MARGIN * both + 1e-6)

    def __call__(self, x: np.ndarray, lead: np.ndarray, rest: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        low = self.bounds(lead, rest)
        near = first = low.argmin(1)
        best = ((x - self.centroids[first]) ** 2).sum(1)
        near, self.verified = near.copy(), self.verified + len(x)
        for c in range(len(self.centroids)):
            rows = np.flatnonzero((low[:, c] <= best) & (first != c))
            exact = ((x[rows] - self.centroids[c]) ** 2).sum(1)
            better = (exact < best[rows]) | ((exact == best[rows]) & (c < near[rows]))
            near[rows[better]], best[rows[better]] = c, exact[better]
            self.verified += len(rows)
        return near, best


def cluster(df: DataFrame, k: int = 8, rounds: int = 10, vec_id: str = "vec_id", vector: str = "embedding", width: int = 64,
            scale: int = SCALE, lead: int = LEAD, seed: int = 3) -> DataFrame:
    """``vec_id, cluster, distance, cluster_inertia, inertia, centroid`` of each kept vector."""
    spark, lead = df.sparkSession, min(lead, width)
    rows = kept(df, vec_id, vector, width, scale)
    turn = rotation(rows, width, lead)

    def store(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = lists(b.column(1), width)
            y, rest = turn(x.astype(np.float64))
            yield pa.RecordBatch.from_arrays([b.column(0), arrow_lists(x, pa.int32()), arrow_lists(y, pa.float64()), pa.array(rest)],
                                             ["id", "x", "lead", "rest"])

    table = written(rows.mapInArrow(store, "id long, x array<int>, lead array<double>, rest double"))
    hashed = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("id").cast("string"), F.lit(""))), 256)
    first = table.select(hashed.alias("h"), "id", "x").orderBy("h", "id", "x").limit(k).collect()
    if not first:
        none = "vec_id long, cluster int, distance long, cluster_inertia long, inertia long, centroid array<long>"
        return spark.createDataFrame([], none)
    centroids = np.array([r["x"] for r in first], dtype=np.int64)
    for _ in range(rounds):
        centroids = _means(table, centroids, turn)

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        nearest = Nearest(centroids, turn)
        for b in batches:
            near, best = nearest(*_columns(b, width, lead))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(near.astype(np.int32)), pa.array(best)], ["vec_id", "cluster", "distance"])

    assigned = cut(table.mapInArrow(assign, "vec_id long, cluster int, distance long"))
    exact = F.sum(F.col("distance").cast("decimal(38,0)")).cast("long")
    per = assigned.groupBy("cluster").agg(exact.alias("cluster_inertia")).withColumn("inertia", assigned.agg(exact).scalar())
    means = spark.createDataFrame([(i, c.tolist()) for i, c in enumerate(centroids)], "cluster int, centroid array<long>")
    return assigned.join(F.broadcast(per.join(means, "cluster")), "cluster").select(  # k rows
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid")


def _columns(b: pa.RecordBatch, width: int, lead: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    x, y = lists(b.column("x"), width).astype(np.int64), lists(b.column("lead"), lead)
    return x, y, b.column("rest").to_numpy(zero_copy_only=False)


def _means(table: DataFrame, centroids: np.ndarray, turn: Rotation) -> np.ndarray:
    """The next centroids: exact componentwise floor of the mean."""
    k, width = centroids.shape
    lead = turn.axes.shape[1]

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        nearest, total = Nearest(centroids, turn), np.zeros((k, width + 1), np.int64)
        for b in batches:
            x, y, rest = _columns(b, width, lead)
            if len(x):
                near, _ = nearest(x, y, rest)
                order = np.argsort(near, kind="stable")
                found, at = np.unique(near[order], return_index=True)
                total[found, 1:] += np.add.reduceat(x[order], at, axis=0)
                total[found, 0] += np.diff(np.r_[at, len(x)])
        some = np.flatnonzero(total[:, 0])
        yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), arrow_lists(total[some], pa.int64())], ["cluster", "total"])

    parts = table.select("x", "lead", "rest").mapInArrow(sums, "cluster int, total array<long>")
    parts = parts.select("cluster", F.posexplode("total").alias("at", "value"))
    added = parts.groupBy("cluster", "at").agg(F.sum(F.col("value").cast("decimal(38,0)")).alias("value")).collect()
    total = {(r["cluster"], r["at"]): int(r["value"]) for r in added}
    return np.array([[total[c, i + 1] // total[c, 0] for i in range(width)] if (c, 0) in total else centroids[c].tolist()
                     for c in range(k)], dtype=np.int64)
