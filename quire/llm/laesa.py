"""Centroid clustering on integer vectors with a table of pivot distances (LAESA).

Every kept vector's distance to a few fixed pivots, which are the starting
centroids, is computed once and stored beside it. Pivots never move, so in each round only the centroids' distances to
the pivots are new, and by the triangle inequality |d(x, p) - d(c, p)|, the
greatest over all pivots, bounds d(x, c) from below without touching x's
components. The centroid of lowest bound gets an exact distance first; only
centroids whose bound doesn't exceed it survive and get exact integer distances
too. Bounds are loosened by more than their rounding error, so the assignment,
ties included (the smaller number), is that of a full comparison.

Each task adds up its own vectors, so a round shuffles k x d sums a task, and
centroids, pivots and sums on the driver have k x d entries. The sums are exact
integers and a centroid is the floor of sum / count.

Defined results: a vector is kept if it has exactly ``dims`` components, none
null or non-finite, whatever its id; rows may repeat and count each time, a null
id is hashed as the empty text; equal hashes go by the vector's components; with
fewer kept vectors than ``k`` each one starts a centroid; an empty table gives an
empty result; a centroid that attracts nothing stays where it is; other columns
are not read. Components beyond +-2**21 raise an error, since squared distances
of such vectors don't fit a long.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quire.llm.common import only, saved

K, DIMS, ROUNDS, SCALE = 16, 64, 3, 64
LIMIT = 1 << 27       # largest magnitude of an integer component
PAIRS = 1 << 15       # exact distances computed at once


def kept(v: Column, dims: int) -> Column:
    """Exactly ``dims`` components, none null or non-finite."""
    return v.isNotNull() & (F.size(v) == dims) & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))


def start_key() -> Column:
    return F.sha2(F.concat(F.lit("1:"), F.coalesce(F.col("id").cast("string"), F.lit(""))), 256)


def squared(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Exact squared distances of rows of x and c, pair by pair."""
    out = np.empty(len(x), np.int64)
    for lo in range(0, len(x), PAIRS):
        diff = x[lo:lo + PAIRS].astype(np.int64) - c[lo:lo + PAIRS]
        out[lo:lo + PAIRS] = np.einsum("ij,ij->i", diff, diff)
    return out


def to_all(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Distances (not squared) of all rows of x to all rows of c."""
    return np.sqrt(np.stack([squared(x, np.broadcast_to(row, x.shape)) for row in c], axis=1).astype(np.float64))


def assign(x: np.ndarray, at_pivots: np.ndarray, centroids: np.ndarray, pivots: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Nearest centroid of each row, the exact squared distance, and how many
    centroids were compared exactly."""
    ours = to_all(centroids, pivots)
    low = np.zeros((len(x), len(centroids)))
    for p in range(len(pivots)):
        np.maximum(low, np.abs(at_pivots[:, p, None] - ours[None, :, p]), out=low)
    rows = np.arange(len(x))
    first = low.argmin(1)
    found = squared(x, centroids[first])
    slack = 1e-9 * (1 + at_pivots.max(axis=1, initial=0) + ours.max(initial=0))
    alive = low <= (np.sqrt(found.astype(np.float64)) + slack)[:, None]
    alive[rows, first] = False
    r, c = np.nonzero(alive)
    dist = np.full(low.shape, np.iinfo(np.int64).max)
    dist[rows, first] = found
    dist[r, c] = squared(x[r], centroids[c])
    cluster = dist.argmin(1)
    return cluster, dist[rows, cluster], alive.sum(1) + 1


def matrix(column: pa.Array, kind) -> np.ndarray:
    return np.asarray(column.flatten()).astype(kind, copy=False).reshape(len(column), -1)


def integers(df: DataFrame, id_col: str, vec_col: str, dims: int, scale: int) -> DataFrame:
    """(id, x): the kept vectors as integers, floor(scale * component in double precision)."""
    src = only(df, id=id_col, v=vec_col).filter(kept(F.col("v"), dims))
    fits = F.forall("v", lambda c: F.abs(c.cast("double") * scale) <= LIMIT)
    whole = F.transform("v", lambda c: F.floor(c.cast("double") * scale).cast("int"))
    return src.select("id", F.when(fits, whole).otherwise(F.raise_error(F.lit(f"a component beyond {LIMIT // scale}: squared distances don't fit a long"))).alias("x"))


def with_pivots(vectors: DataFrame, pivots: np.ndarray) -> DataFrame:
    """(id, x, p): each vector with its distances to the pivots."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                far = to_all(matrix(batch.column("x"), np.int64), pivots)
                offsets = pa.array(np.arange(0, far.size + 1, len(pivots)), pa.int32())
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.ListArray.from_arrays(offsets, pa.array(far.ravel()))], names=["id", "x", "p"])

    return vectors.mapInArrow(run, f"id {vectors.schema['id'].dataType.simpleString()}, x array<int>, p array<double>")


def sums(table: DataFrame, centroids: np.ndarray, pivots: np.ndarray) -> DataFrame:
    """(cluster, dim, total, n): exact componentwise sums of each non-empty cluster."""
    k, d = centroids.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, count = np.zeros((k, d), np.int64), np.zeros(k, np.int64)
        for batch in batches:
            if not batch.num_rows:
                continue
            x = matrix(batch.column("x"), np.int64)
            cluster, _, _ = assign(x, matrix(batch.column("p"), np.float64), centroids, pivots)
            count += np.bincount(cluster, minlength=k)
            order = np.argsort(cluster, kind="stable")
            there, begin = np.unique(cluster[order], return_index=True)
            total[there] += np.add.reduceat(x[order], begin, axis=0)
        at = np.flatnonzero(count)
        yield pa.RecordBatch.from_arrays([pa.array(np.repeat(at, d).astype(np.int32)), pa.array(np.tile(np.arange(d), len(at)).astype(np.int32)),
                                          pa.array(total[at].ravel()), pa.array(np.repeat(count[at], d))], names=["cluster", "dim", "total", "n"])

    parts = table.mapInArrow(run, "cluster int, dim int, total long, n long")
    return parts.groupBy("cluster", "dim").agg(F.sum(F.col("total").cast("decimal(19,0)")).alias("total"), F.sum(F.col("n").cast("decimal(19,0)")).alias("n"))


def assigned(table: DataFrame, centroids: np.ndarray, pivots: np.ndarray) -> DataFrame:
    """(id, cluster, distance, n_exact) of every vector."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                cluster, dist, exact = assign(matrix(batch.column("x"), np.int64), matrix(batch.column("p"), np.float64), centroids, pivots)
                yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(cluster.astype(np.int32)), pa.array(dist), pa.array(exact.astype(np.int32))],
                                                 names=["id", "cluster", "distance", "n_exact"])

    return table.mapInArrow(run, f"id {table.schema['id'].dataType.simpleString()}, cluster int, distance long, n_exact int")


def cluster(df: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", k: int = K, dims: int = DIMS,
            rounds: int = ROUNDS, scale: int = SCALE) -> tuple[DataFrame, np.ndarray]:
    """One row per kept vector (id, cluster, distance, cluster_inertia, inertia,
    centroid_sha256, n_exact) and the final centroids."""
    spark = df.sparkSession
    vectors = integers(df, id_col, vec_col, dims, scale)
    kind = vectors.schema["id"].dataType.simpleString()
    start = [r["x"] for r in vectors.orderBy(start_key(), "x").limit(k).select("x").collect()]
    if not start:
        return spark.createDataFrame([], f"`{id_col}` {kind}, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string, n_exact int"), np.zeros((0, dims), np.int64)
    centroids = np.array(start, np.int64)
    pivots = np.unique(centroids, axis=0)
    table = saved(with_pivots(vectors, pivots), "pivots")
    for _ in range(rounds):
        for r in sums(table, centroids, pivots).collect():   # k x d rows
            centroids[r["cluster"], r["dim"]] = int(r["total"]) // int(r["n"])
    out = saved(assigned(table, centroids, pivots), "assigned")
    digest = [hashlib.sha256(",".join(map(str, row.tolist())).encode()).hexdigest() for row in centroids]
    own = out.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(19,0)")).alias("s")).collect()   # k rows
    total = sum(int(r["s"]) for r in own)
    told = spark.createDataFrame([(r["cluster"], int(r["s"]), total, digest[r["cluster"]]) for r in own], "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return (out.join(F.broadcast(told), "cluster")
            .select(F.col("id").alias(id_col), "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256", "n_exact")), centroids


def oracle_sql(k: int = K, dims: int = DIMS, rounds: int = ROUNDS, scale: int = SCALE) -> str:
    """DuckDB SQL: every vector against every centroid, in exact integers."""
    steps = [f"""
WITH kept AS (SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda c: CAST(floor({scale} * CAST(c AS DOUBLE)) AS BIGINT)) AS x FROM embeddings
  WHERE len(embedding) = {dims} AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0),
cells AS (SELECT r, unnest(x) AS v, generate_subscripts(x, 1) AS dim FROM kept),
c0 AS (SELECT cluster, unnest(x) AS v, generate_subscripts(x, 1) AS dim FROM (
  SELECT row_number() OVER (ORDER BY sha256('1:' || coalesce(CAST(vec_id AS VARCHAR), '')), x) - 1 AS cluster, x FROM kept) WHERE cluster < {k})"""]
    for n in range(rounds + 1):
        steps.append(f"""
d{n} AS (SELECT r, cluster, CAST(sum((cells.v - c{n}.v) ** 2) AS BIGINT) AS distance FROM cells JOIN c{n} USING (dim) GROUP BY r, cluster),
a{n} AS (SELECT r, arg_min(cluster, distance * {k} + cluster) AS cluster, min(distance) AS distance FROM d{n} GROUP BY r)""")
        if n < rounds:
            steps.append(f"""
m{n} AS (SELECT a{n}.cluster, dim, CAST(sum(cells.v) AS BIGINT) AS s, count(*) AS n FROM cells JOIN a{n} USING (r) GROUP BY a{n}.cluster, dim),
c{n + 1} AS (SELECT cluster, coalesce((m{n}.s - ((m{n}.s % m{n}.n) + m{n}.n) % m{n}.n) // m{n}.n, c{n}.v) AS v, dim FROM c{n} LEFT JOIN m{n} USING (cluster, dim))""")
    steps.append(f"""
shas AS (SELECT cluster, sha256(string_agg(CAST(v AS VARCHAR), ',' ORDER BY dim)) AS centroid_sha256 FROM c{rounds} GROUP BY cluster)
SELECT vec_id, CAST(cluster AS INTEGER) AS cluster, distance, CAST(sum(distance) OVER (PARTITION BY cluster) AS BIGINT) AS cluster_inertia,
       CAST(sum(distance) OVER () AS BIGINT) AS inertia, centroid_sha256
FROM kept JOIN a{rounds} USING (r) JOIN shas USING (cluster)""")
    return (steps[0] + "," + ",".join(steps[1:]))
