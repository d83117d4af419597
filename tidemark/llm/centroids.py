"""Centroid clustering of integer vectors whose dot products with all centroids are kept.

A row of the stored state holds a vector, its exact integer dot products with the centroids and
its cluster. When centroids move, a dot product changes by the moved components alone:
``x . c' = x . c + sum of x[j] * (c'[j] - c[j]) over the j that changed``; a centroid that stays
costs nothing. The squared distance is ``x . x - 2 x . c + c . c``, so the nearest centroid follows
from the row without another look at the centroids. Everything is whole numbers, hence the order
of additions is without effect, and a repeated task gives the same rows.

A round is two jobs over the state: totals per cluster and component (added up in every task
before the shuffle, so that no cluster is gathered) and the next state, written to the shared
folder; the state before it is then removed. The driver sees the centroids and their totals,
``centroids x size`` numbers, however many vectors there are.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.session import drop_stored, scratch_path

LARGEST = 1 << 27  # of a component: the sums of 64 squared differences then fit a long
COUNT = -1  # in place of a component: the number of vectors

Centroids = list[list[int]]


@dataclass
class Clustering:
    """``assigned`` has the id, ``cluster`` and ``distance`` of every kept vector."""

    assigned: DataFrame
    centroids: Centroids


def whole_vectors(rows: DataFrame, id_column: str, column: str, size: int, scale: int) -> DataFrame:
    """``(id, x)`` of the vectors with ``size`` components, none null or not finite; ``x`` is floor(scale * component).

    The job fails on a component whose whole number reaches 2**27: its distances may exceed a long.
    """
    finite = F.forall(column, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < F.lit(float("inf"))))
    return rows.where((F.size(column) == size) & finite).select(
        F.col(id_column).alias("id"), F.transform(column, lambda v: _whole(v, scale)).alias("x")
    )


def _whole(value: Column, scale: int) -> Column:
    scaled = F.floor(value.cast("double") * scale)
    too_large = F.raise_error(F.lit("a vector component is too large for exact distances"))
    return F.when(F.abs(value.cast("double") * scale) < LARGEST, scaled).otherwise(too_large).cast("int")


def starting(vectors: DataFrame, centroids: int, seed: int) -> Centroids:
    """The vectors with the smallest sha256 of ``seed:id``, in that order; equal ids by their components."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("id").cast("string"), F.lit(""))), 256)
    return [list(r.x) for r in vectors.orderBy(digest, "x").limit(centroids).select("x").collect()]


def cluster(
    rows: DataFrame,
    id_column: str = "vec_id",
    column: str = "embedding",
    size: int = 64,
    scale: int = 256,
    centroids: int = 40,
    rounds: int = 5,
    seed: int = 2,
) -> Clustering:
    """Nearest centroid (ties: the smaller number) after ``rounds`` rounds of moving every centroid.

    A centroid moves to the floor of the mean of its vectors; one without vectors stays. Vectors
    that ``whole_vectors`` leaves out get no row. Repeated rows count as often as they stand, a
    null id is hashed as an empty one, and other columns of the input are not read. With fewer
    vectors than centroids each vector is one; without any the result is empty.
    """
    spark = rows.sparkSession
    vectors = whole_vectors(rows, id_column, column, size, scale)
    now = starting(vectors, centroids, seed)
    schema = f"id {vectors.schema['id'].dataType.simpleString()}, x array<int>, dots array<long>, cluster int"
    source, moves, path = vectors, _moves([[0] * size] * len(now), now), None
    for _ in range(rounds if now else 0):
        after = scratch_path(spark, "centroids")
        source.mapInArrow(partial(_moved, now, moves, size), schema).write.parquet(after)
        if path:
            drop_stored(spark, path)
        path, source = after, spark.read.schema(schema).parquet(after)
        moved = _means(source, now, size)
        moves, now = _moves(now, moved), moved
        if not any(len(where) for where, _ in moves):
            break
    ends = f"id {vectors.schema['id'].dataType.simpleString()}, cluster int, distance long"
    after = scratch_path(spark, "clusters")
    source.mapInArrow(partial(_ended, now, moves, size), ends).write.parquet(after)
    if path:
        drop_stored(spark, path)
    return Clustering(spark.read.schema(ends).parquet(after).withColumnRenamed("id", id_column), now)


def with_inertia(found: Clustering) -> DataFrame:
    """The assigned rows with ``cluster_inertia``, ``inertia`` and ``centroid_sha256`` (components joined by commas).

    The job fails where a sum of distances exceeds a long.
    """
    spark = found.assigned.sparkSession
    sums = found.assigned.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).cast("long").alias("s"))
    inertia = {r.cluster: r.s for r in sums.collect()}  # a row per centroid
    of_cluster = [
        (c, inertia[c], sum(inertia.values()), hashlib.sha256(",".join(map(str, at)).encode()).hexdigest())
        for c, at in enumerate(found.centroids)
        if c in inertia
    ]
    schema = "cluster int, cluster_inertia long, inertia long, centroid_sha256 string"
    return found.assigned.join(F.broadcast(spark.createDataFrame(of_cluster, schema)), "cluster")


def _moves(before: Centroids, after: Centroids) -> list[tuple[np.ndarray, np.ndarray]]:
    """Of each centroid the components that changed, and by how much."""
    change = np.array(after, np.int64) - np.array(before, np.int64)
    return [(np.flatnonzero(c), c[c != 0]) for c in change]


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(len(column), width)


def _listed(matrix: np.ndarray, kind: pa.DataType) -> pa.Array:
    ends = np.arange(0, matrix.size + 1, matrix.shape[1], dtype=np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(matrix.ravel(), kind))


def _nearest(batch: pa.RecordBatch, now: Centroids, moves: list, size: int) -> tuple[np.ndarray, ...]:
    """Vectors, dot products carried on to the centroids of now, clusters and distances of a batch."""
    x = _matrix(batch.column("x"), size)
    kept = "dots" in batch.schema.names
    dots = _matrix(batch.column("dots"), len(now)) if kept else np.zeros((len(x), len(now)), np.int64)
    for c, (where, by) in enumerate(moves):
        if len(where):
            dots[:, c] += x[:, where] @ by
    at = np.array(now, np.int64)
    distances = (x * x).sum(axis=1)[:, None] - 2 * dots + (at * at).sum(axis=1)[None, :]
    clusters = distances.argmin(axis=1)
    return x, dots, clusters, distances[np.arange(len(x)), clusters]


def _moved(now: Centroids, moves: list, size: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if batch.num_rows:
            x, dots, clusters, _ = _nearest(batch, now, moves, size)
            columns = [batch.column("id"), _listed(x, pa.int32()), _listed(dots, pa.int64())]
            columns.append(pa.array(clusters, pa.int32()))
            yield pa.RecordBatch.from_arrays(columns, ["id", "x", "dots", "cluster"])


def _ended(now: Centroids, moves: list, size: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if batch.num_rows:
            _, _, clusters, distances = _nearest(batch, now, moves, size)
            columns = [batch.column("id"), pa.array(clusters, pa.int32()), pa.array(distances, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, ["id", "cluster", "distance"])


def _means(state: DataFrame, now: Centroids, size: int) -> Centroids:
    """The centroids moved to the floor of the mean of their vectors."""
    partial_totals = state.select("x", "cluster").mapInArrow(
        partial(_totals, len(now), size), "cluster int, place int, total long"
    )
    totals = partial_totals.groupBy("cluster", "place").agg(F.sum("total").alias("total")).collect()
    found = {(r.cluster, r.place): r.total for r in totals}
    return [
        [found[c, j] // found[c, COUNT] for j in range(size)] if (c, COUNT) in found else at for c, at in enumerate(now)
    ]


def _totals(count: int, size: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of the rows of a task: per cluster the number of vectors and the total of each component."""
    totals, counts = np.zeros((count, size), np.int64), np.zeros(count, np.int64)
    for batch in batches:
        if batch.num_rows:
            clusters = batch.column("cluster").to_numpy(zero_copy_only=False)
            np.add.at(totals, clusters, _matrix(batch.column("x"), size))
            counts += np.bincount(clusters, minlength=count)
    used = np.flatnonzero(counts)
    places = np.tile(np.arange(COUNT, size, dtype=np.int32), len(used))
    values = np.concatenate([counts[used][:, None], totals[used]], axis=1).ravel()
    clusters = np.repeat(used.astype(np.int32), size + 1)
    yield pa.RecordBatch.from_arrays([pa.array(clusters), pa.array(places), pa.array(values)], ["cluster", "place", "total"])
