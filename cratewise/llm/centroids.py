"""Centroid clustering of integer vectors with scalar lookup tables.

Vectors become small integers once. In every round a task tabulates, for each
dimension, the squared difference between each integer that occurs there and
each centroid; a distance is then a gather from these tables and a sum, exact
in 64-bit integers. A task sends one sum per centroid and dimension, so a
round moves centroids x dimensions x tasks short rows, whatever the number of
vectors.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cratewise.llm.stores import written

# Scaled components beyond this bound are taken as the bound: a squared distance
# over 64 dimensions then fits a long.
BOUND = 1 << 27
LONGEST = (1 << 63) - 1


def integer_vectors(embeddings: DataFrame, dims: int = 64, scale: int = 256) -> DataFrame:
    """``vec_id`` and ``vector`` (floor(scale * x) of each component) of the rows whose
    ``embedding`` has exactly ``dims`` components, none null, NaN or infinite."""
    x = F.col("embedding")
    usable = (F.size(x) == dims) & F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    near = F.transform(x, lambda c: F.greatest(F.least(c.cast("double") * scale, F.lit(float(BOUND))), F.lit(float(-BOUND))))
    whole = F.transform(near, lambda c: F.floor(c).cast("int"))
    # A null array, or one with null components, has no verdict: it is not kept.
    return embeddings.select("vec_id", "embedding").filter(F.coalesce(usable, F.lit(False))).select("vec_id", whole.alias("vector"))


def start_centroids(vectors: DataFrame, k: int, salt: int) -> np.ndarray:
    """The ``k`` vectors whose ids have the smallest hash, in its order (rows with the same
    id by their components, rows without an id last); at most k rows reach the driver."""
    key = F.sha2(F.concat(F.lit(f"{salt}:"), F.col("vec_id").cast("string")), 256)
    first = vectors.select(key.alias("key"), "vector").orderBy(F.col("key").asc_nulls_last(), "vector").limit(k).collect()
    return np.array([r["vector"] for r in first], dtype=np.int64)


def occurring(column: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct values of an integer column, ascending, and where each row's value is among them."""
    low, high = int(column.min()), int(column.max())
    if high - low > 8 * len(column):
        return np.unique(column, return_inverse=True)
    there = np.zeros(high - low + 1, dtype=bool)
    there[column - low] = True
    return np.flatnonzero(there) + low, (np.cumsum(there) - 1)[column - low]


def table_distances(vectors: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Squared distance of every vector to every centroid, by one lookup table per dimension."""
    total = np.zeros((len(vectors), len(centroids)), dtype=np.int64)
    part = np.empty_like(total)
    for d in range(centroids.shape[1]):
        values, place = occurring(vectors[:, d])
        table = np.square(values[:, None] - centroids[None, :, d])
        total += np.take(table, place, axis=0, out=part)
    return total


def nearest(vectors: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Number of the nearest centroid (the smaller of equally near ones) and the squared distance."""
    distance = table_distances(vectors, centroids)
    cluster = distance.argmin(axis=1)
    return cluster, distance[np.arange(len(vectors)), cluster]


def _matrix(column: pa.Array, dims: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(-1, dims)


def _sums(centroids: np.ndarray):
    """Count and sums of each centroid's vectors, over all batches of a task."""
    k, dims = centroids.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count, sums = np.zeros(k, dtype=np.int64), np.zeros((k, dims), dtype=np.int64)
        for batch in batches:
            if not batch.num_rows:
                continue
            vectors = _matrix(batch.column(0), dims)
            cluster, _ = nearest(vectors, centroids)
            order = np.argsort(cluster, kind="stable")
            found, first = np.unique(cluster[order], return_index=True)
            sums[found] += np.add.reduceat(vectors[order], first, axis=0)
            count += np.bincount(cluster, minlength=k)
        used = np.flatnonzero(count)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.repeat(used, dims), pa.int32()), pa.array(np.tile(np.arange(dims), len(used)), pa.int32()),
             pa.array(np.repeat(count[used], dims), pa.int64()), pa.array(sums[used].ravel(), pa.int64())],
            ["cluster", "dim", "count", "sum"],
        )

    return run


def _moved(vectors: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """Every centroid with vectors becomes their componentwise floor(sum / count)."""
    parts = vectors.select("vector").mapInArrow(_sums(centroids), "cluster int, dim int, count long, sum long")
    total = parts.groupBy("cluster", "dim").agg(F.sum("count").alias("count"), F.sum(F.col("sum").cast("decimal(20,0)")).alias("sum"))
    moved = centroids.copy()
    for row in total.collect():  # one row per centroid and dimension
        moved[row["cluster"], row["dim"]] = int(row["sum"]) // row["count"]
    return moved


def _assign(centroids: np.ndarray):
    dims = centroids.shape[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                cluster, distance = nearest(_matrix(batch.column(1), dims), centroids)
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(cluster, pa.int32()), pa.array(distance)], ["vec_id", "cluster", "distance"])

    return run


def lookup_clusters(embeddings: DataFrame, k: int = 40, rounds: int = 5, dims: int = 64, scale: int = 256, salt: int = 2) -> DataFrame:
    """K-means over integer vectors, exact and repeatable.

    ``embeddings`` has ``vec_id`` and ``embedding`` (array of float or double);
    other columns are ignored. Returns one row per kept vector: ``vec_id``,
    ``cluster``, ``distance`` (squared, to its final centroid),
    ``cluster_inertia`` and ``inertia`` (distance summed over the cluster and
    over all; a sum beyond a long is the largest long) and ``centroid_sha256``.

    Rows whose embedding is null, empty, of another length, or has a null, NaN
    or infinite component are left out. Repeated rows are vectors of their own.
    A null vec_id is kept and clustered, and names a start centroid only when
    there are fewer than ``k`` vectors with an id. Fewer than ``k`` kept vectors
    give that many centroids; an empty table gives no rows. Of equally near
    centroids the smaller number wins. Components beyond 2**27 / scale are taken
    as that bound, so that squared distances fit a long.
    """
    spark, kind = embeddings.sparkSession, embeddings.schema["vec_id"].dataType.simpleString()
    vectors = written(integer_vectors(embeddings, dims, scale), "vectors")
    centroids = start_centroids(vectors, k, salt)
    if not len(centroids):
        centroids = np.zeros((1, dims), dtype=np.int64)  # no vector either: nothing will be assigned
    for _ in range(rounds):
        centroids = _moved(vectors, centroids)
    assigned = written(vectors.mapInArrow(_assign(centroids), f"vec_id {kind}, cluster int, distance long"), "assigned")
    digest = spark.createDataFrame(
        [(i, ",".join(map(str, c))) for i, c in enumerate(centroids.tolist())], "cluster int, centroid string"
    ).select("cluster", F.sha2("centroid", 256).alias("centroid_sha256"))
    exact = F.sum(F.col("distance").cast("decimal(20,0)"))
    per_cluster = assigned.groupBy("cluster").agg(exact.alias("own")).join(F.broadcast(digest), "cluster")
    # At most k rows each: a bounded broadcast.
    sums = per_cluster.crossJoin(F.broadcast(per_cluster.agg(F.sum("own").alias("all")))).select(
        "cluster", *[F.least(F.col(c), F.lit(LONGEST)).cast("long").alias(name) for c, name in (("own", "cluster_inertia"), ("all", "inertia"))],
        "centroid_sha256",
    )
    return assigned.join(F.broadcast(sums), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
