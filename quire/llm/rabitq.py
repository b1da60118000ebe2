"""Approximate nearest neighbours by randomly rotated one-bit codes.

Vectors are dealt to cells (centroids fitted on a bounded sample, ``SAMPLE``
rows; every row is indexed). Of each vector the residual to its centroid is
rotated by a random orthogonal matrix and kept as one sign bit per dimension,
with two correction scalars: the residual's length, and the inner product of the
unit residual with its code. From those the inner product with a rotated query
is estimated without bias, with an error bound of ``EPSILON`` standard errors. In
each cell only vectors whose lower bound of the distance does not exceed the
k-th smallest upper bound are reranked by exact distances.

A query looks into its nearest cells until they hold ``PROBED_SHARE`` of all vectors,
and ``PROBED_ROWS`` at least (all, if there are fewer): vectors without much
structure have neighbours in far cells, and there the codes do the pruning. Cells are dealt into blocks of bounded
size on both sides, so neither a hot cell nor one very common vector makes a
large task; each block returns k rows for each of its queries.

Defined results: vectors that are null, zero, of another dimension than the most
common in the sample, or that hold null or non-finite components take no part;
ties go to the smaller id; repeated rows are candidates as often as they stand
there, but one query; with fewer than k candidates all are returned; an empty
table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quire.llm.common import only, saved

K = 10
SAMPLE = 20_000
ROWS_PER_CELL, MOST_CELLS, ROUNDS = 256, 1024, 10
PROBED_SHARE = 0.8
PROBED_ROWS = 2_000
EPSILON = 3.0
BLOCK_VECTORS, BLOCK_QUERIES = 16_384, 4_096
SEED = 64


@dataclass
class Coder:
    """Centroids and rotation."""

    centroids: np.ndarray
    rotation: np.ndarray

    def nearest(self, x: np.ndarray) -> np.ndarray:
        out = np.empty(len(x), np.int64)
        half = (self.centroids ** 2).sum(1) / 2
        for lo in range(0, len(x), 4096):
            out[lo:lo + 4096] = (x[lo:lo + 4096] @ self.centroids.T - half).argmax(1)
        return out

    def rotated(self, x: np.ndarray, cell: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Unit residuals, rotated, and their lengths."""
        r = x - self.centroids[cell]
        norm = np.linalg.norm(r, axis=1)
        return (r / np.maximum(norm, 1e-300)[:, None]) @ self.rotation.T, norm

    def encode(self, x: np.ndarray, cell: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Packed sign bits, residual length, inner product of residual and code."""
        o, norm = self.rotated(x, cell)
        dot = np.abs(o).sum(1) / math.sqrt(x.shape[1])
        return np.packbits(o > 0, axis=1), norm, np.where(norm > 0, dot, 1.0)


def bounds(codes: np.ndarray, norm: np.ndarray, dot: np.ndarray, q: np.ndarray, q_norm: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Lower and upper bounds of squared distances, queries x vectors, within one cell."""
    d = q.shape[1]
    signs = np.unpackbits(codes, axis=1, count=d).astype(np.float32) * 2 - 1
    est = (q.astype(np.float32) @ signs.T) / math.sqrt(d) / dot.astype(np.float32)
    err = (EPSILON * np.sqrt(np.maximum(1 - dot ** 2, 0)) / dot / math.sqrt(max(d - 1, 1))).astype(np.float32) + np.float32(1e-5)
    base = norm[None, :] ** 2 + q_norm[:, None] ** 2
    cross = 2 * norm[None, :] * q_norm[:, None]
    return base - cross * np.minimum(est + err, 1.0), base - cross * np.maximum(est - err, -1.0)


def usable(v: Column) -> Column:
    """Not null, every component finite, not all zero."""
    return v.isNotNull() & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(v, lambda x: x != 0)


def fit(vectors: DataFrame) -> Coder | None:
    """Centroids from the ``SAMPLE`` rows of smallest hash; None without rows."""
    rows = [r["v"] for r in vectors.orderBy(F.xxhash64("id"), "id").limit(SAMPLE).select("v").collect()]
    if not rows:
        return None
    d = Counter(map(len, rows)).most_common(1)[0][0]
    x = np.array([r for r in rows if len(r) == d], np.float64)
    rng = np.random.default_rng(SEED)
    k = min(MOST_CELLS, max(1, len(x) // ROWS_PER_CELL))
    rotation = np.linalg.qr(rng.standard_normal((d, d)))[0]
    coder = Coder(x[rng.choice(len(x), k, replace=False)], rotation)
    for _ in range(ROUNDS):
        cell = coder.nearest(x)
        count = np.bincount(cell, minlength=k)
        total = np.zeros((k, d))
        np.add.at(total, cell, x)
        coder.centroids = np.where(count[:, None] > 0, total / np.maximum(count, 1)[:, None], coder.centroids)
    return coder


def matrix(column: pa.Array) -> np.ndarray:
    """List vectors of equal length as rows of a float64 matrix."""
    return np.asarray(column.flatten()).astype(np.float64).reshape(len(column), -1)


def index(vectors: DataFrame, coder: Coder) -> DataFrame:
    """(cell, id, v, code, norm, dot) of every usable vector."""
    d = coder.centroids.shape[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            x = matrix(batch.column("v"))
            cell = coder.nearest(x)
            codes, norm, dot = coder.encode(x, cell)
            yield pa.RecordBatch.from_arrays([pa.array(cell), *batch.columns, pa.array([c.tobytes() for c in codes], pa.binary()), pa.array(norm), pa.array(dot)],
                                             names=["cell", "id", "v", "code", "norm", "dot"])

    kinds = {c: vectors.schema[c].dataType.simpleString() for c in ("id", "v")}
    return vectors.filter(F.size("v") == d).mapInArrow(run, f"cell long, id {kinds['id']}, v {kinds['v']}, code binary, norm double, dot double")


def route(queries: DataFrame, coder: Coder, sizes: np.ndarray) -> DataFrame:
    """(cell, query, q): each query for each cell that it looks into."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            x = matrix(batch.column("q"))
            far = ((x[:, None, :] - coder.centroids[None, :, :]) ** 2).sum(2) if x.size * len(coder.centroids) < 1 << 22 else (coder.centroids ** 2).sum(1)[None, :] - 2 * x @ coder.centroids.T
            order = np.argsort(np.where(sizes[None, :] > 0, far, np.inf), axis=1, kind="stable")
            held = np.cumsum(sizes[order], axis=1)
            take = np.argmax(held >= min(max(PROBED_ROWS, PROBED_SHARE * sizes.sum()), sizes.sum()), axis=1) + 1
            row = np.repeat(np.arange(len(x)), take)
            cells = np.concatenate([order[r, :n] for r, n in enumerate(take)])
            rows = pa.array(row)
            yield pa.RecordBatch.from_arrays([pa.array(cells), batch.column("query").take(rows), batch.column("q").take(rows)], names=["cell", "query", "q"])

    kinds = {c: queries.schema[c].dataType.simpleString() for c in ("query", "q")}
    return queries.mapInArrow(run, f"cell long, query {kinds['query']}, q {kinds['q']}")


def nearest(df: DataFrame, is_query: Column | str, id_col: str = "vec_id", vec_col: str = "embedding", k: int = K) -> DataFrame:
    """For each row for which ``is_query`` (a condition on ``id``, also as SQL) holds, its k nearest
    other rows found: query_id, rank from 1, the other's id, and the Euclidean distance."""
    spark = df.sparkSession
    vectors = only(df, id=id_col, v=vec_col).filter(F.col("id").isNotNull() & usable(F.col("v")))
    kind = vectors.schema["id"].dataType.simpleString()
    schema = f"query_id {kind}, `{id_col}` {kind}, score double"
    coder = fit(vectors)
    if coder is None:
        return spark.createDataFrame([], f"query_id {kind}, rank int, `{id_col}` {kind}, score double")
    table = saved(index(vectors, coder), "index")
    cells = len(coder.centroids)
    sizes = np.zeros(cells, np.int64)
    for r in table.groupBy("cell").count().collect():   # a row for each cell
        sizes[r["cell"]] = r["count"]
    queries = table.filter(is_query).groupBy(F.col("id").alias("query")).agg(F.min("v").alias("q"))
    routed = saved(route(queries, coder, sizes), "routed")
    asked = np.zeros(cells, np.int64)
    for r in routed.groupBy("cell").count().collect():
        asked[r["cell"]] = r["count"]
    deal = F.broadcast(spark.createDataFrame([(c, int(max(1, -(-sizes[c] // BLOCK_VECTORS))), int(max(1, -(-asked[c] // BLOCK_QUERIES)))) for c in range(cells)], "cell long, vs int, qs int"))
    each = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    left = table.join(deal, "cell").filter("qs > 0").withColumn("vb", F.pmod(F.xxhash64("id"), F.col("vs")).cast("int")).withColumn("qb", each("qs")).select("cell", "vb", "qb", "id", "v", "code", "norm", "dot")
    right = routed.join(deal, "cell").withColumn("qb", F.pmod(F.xxhash64("query"), F.col("qs")).cast("int")).withColumn("vb", each("vs")).select("cell", "vb", "qb", "query", "q")

    def block(a: pa.Table, b: pa.Table) -> pa.Table:
        none = pa.table({"query_id": pa.array([], a["id"].type), id_col: pa.array([], a["id"].type), "score": pa.array([], pa.float64())})
        if not a.num_rows or not b.num_rows:
            return none
        cell = a["cell"][0].as_py()
        x, q = matrix(a["v"].combine_chunks()), matrix(b["q"].combine_chunks())
        codes = np.frombuffer(b"".join(a["code"].to_pylist()), np.uint8).reshape(len(x), -1)
        ids, names = a["id"].combine_chunks(), b["query"].combine_chunks()
        id_list, name_list = ids.to_pylist(), names.to_pylist()
        by_id: dict = {}
        for i, v in enumerate(id_list):
            by_id.setdefault(v, []).append(i)
        norm, dot = a["norm"].to_numpy(), a["dot"].to_numpy()
        qr, q_norm = coder.rotated(q, np.full(len(q), cell))
        out_q, out_i, out_s = [], [], []
        step = max(1, (1 << 21) // len(x))
        for lo in range(0, len(q), step):
            low, high = bounds(codes, norm, dot, qr[lo:lo + step], q_norm[lo:lo + step])
            for r in range(len(low)):
                own = by_id.get(name_list[lo + r], [])
                low[r, own] = high[r, own] = np.inf
            kth = np.partition(high, k - 1, axis=1)[:, k - 1] if high.shape[1] > k else np.full(len(high), np.inf)
            for r in range(len(low)):
                at = np.flatnonzero((low[r] <= kth[r]) & np.isfinite(low[r]))
                score = np.sqrt(((x[at] - q[lo + r]) ** 2).sum(1))
                if len(at) > k:
                    cut = np.partition(score, k - 1)[k - 1]
                    at, score = at[score <= cut], score[score <= cut]
                best = sorted(zip(score.tolist(), [id_list[i] for i in at]))[:k]
                out_q += [name_list[lo + r]] * len(best)
                out_i += [i for _, i in best]
                out_s += [s for s, _ in best]
        return pa.table({"query_id": pa.array(out_q, a["id"].type), id_col: pa.array(out_i, a["id"].type), "score": pa.array(out_s, pa.float64())})

    keys = ["cell", "vb", "qb"]
    found = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(lambda a, b: block(a, b), schema)
    order = Window.partitionBy("query_id").orderBy("score", F.col(id_col))
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select("query_id", "rank", F.col(id_col), "score")
