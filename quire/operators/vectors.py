"""Vector operators.

Vectors are ``array<double>`` columns. Element-wise work is Catalyst
(higher-order functions); matrix work — every row against a bounded set of
centroids — runs as numpy matmul in ``mapInPandas`` against a broadcast
matrix whose size is checked before it leaves the driver. No row pairs are
materialised.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Largest centroid matrix (rows × dims) that may be broadcast.
MAX_BROADCAST_ELEMENTS = 1 << 25
# elements of one similarity matrix in a task (16 MB), and of partial sums held there
BATCH_ELEMENTS = 1 << 21
PARTIAL_ELEMENTS = 1 << 22


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def as_double(v) -> Column:
    return F.transform(_col(v), lambda x: x.cast("double"))


def dot(a, b) -> Column:
    return F.aggregate(F.zip_with(_col(a), _col(b), lambda x, y: x * y), F.lit(0.0), lambda acc, x: acc + x)


def norm(v) -> Column:
    return F.sqrt(dot(v, v))


def scale_by_norm(v) -> Column:
    """v / |v| with the norm evaluated once per row.

    A norm referenced inside a ``transform`` lambda would be re-evaluated for
    every element (quadratic in the dimension); pairing the vector with a
    repeated norm via ``zip_with`` keeps it linear.
    """
    v = _col(v)
    n = F.array_repeat(norm(v), F.size(v))
    return F.zip_with(v, n, lambda x, m: F.when(m > 0, x / m).otherwise(x))


def l2_normalize(v) -> Column:
    """v / |v| (a zero vector stays zero)."""
    return scale_by_norm(v)


def cosine(a, b) -> Column:
    """cosine similarity of two vector columns."""
    return dot(a, b) / (norm(a) * norm(b))


def centroids(df: DataFrame, group: str, vec: str) -> DataFrame:
    """Mean vector per group (not re-normalised) → (group, n, centroid).

    Each task adds up its own rows, so one partial sum per (task, group) is
    exploded into positions and shuffled, not every row; a hot group is
    spread over its ``d`` positions.
    """
    src = df.select(F.col(group).alias("g"), as_double(vec).alias("v")).filter(F.col("v").isNotNull())

    def add(batches):
        sums: dict = {}
        for pdf in batches:
            for g, rows in pdf.groupby("g", dropna=False)["v"]:
                x = np.vstack(rows.to_numpy())
                n, s = sums.get(g, (0, 0.0))
                sums[g] = (n + len(x), s + x.sum(axis=0))
            if sums and len(sums) * len(next(iter(sums.values()))[1]) > PARTIAL_ELEMENTS:
                yield partial(sums)
                sums = {}
        if sums:
            yield partial(sums)

    def partial(sums):
        return pd.DataFrame({"g": list(sums), "n": [n for n, _ in sums.values()], "s": [s for _, s in sums.values()]})

    parts = src.mapInPandas(add, f"g {src.schema['g'].dataType.simpleString()}, n bigint, s array<double>")
    m = parts.select("g", "n", F.posexplode("s").alias("pos", "x")).groupBy("g", "pos").agg(F.sum("x").alias("x"), F.sum("n").alias("n"))
    return m.groupBy(F.col("g").alias(group)).agg(F.max("n").alias("n"), F.array_sort(F.collect_list(F.struct("pos", (F.col("x") / F.col("n")).alias("x")))).alias("_xs")) \
        .select(group, "n", F.col("_xs.x").alias("centroid"))


def collect_bounded_matrix(df: DataFrame, id_col: str, vec_col: str,
                           max_elements: int = MAX_BROADCAST_ELEMENTS, max_rows: int = 1_000_000
                           ) -> tuple[np.ndarray, np.ndarray]:
    """Collect a small keyed matrix (e.g. k centroids) after checking its size.

    At most ``max_rows + 1`` rows are read, and the job fails if the table is
    larger than the bound, so an unbounded table can never be pulled whole.
    """
    rows = df.select(id_col, vec_col).limit(max_rows + 1).collect()
    if not rows:
        return np.zeros(0, dtype=np.int64), np.zeros((0, 0))
    d = len(rows[0][1])
    if len(rows) > max_rows or len(rows) * max(d, 1) > max_elements:
        raise ValueError(f"matrix of {len(rows)}x{d} exceeds the broadcast bound")
    rows.sort(key=lambda r: r[0])
    ids = np.array([r[0] for r in rows], dtype=np.int64)
    mat = np.array([r[1] for r in rows], dtype=np.float64)
    return ids, mat


def _stack(series: pd.Series) -> np.ndarray:
    return np.vstack([np.asarray(v, dtype=np.float64) for v in series]) if len(series) else np.zeros((0, 0))


def top_centroids(df: DataFrame, cents: DataFrame, k: int = 1, id_col: str = "id", vec_col: str = "v",
                  cid_col: str = "cluster_id", cvec_col: str = "centroid", min_sim: float | None = None
                  ) -> DataFrame:
    """The ``k`` most cosine-similar centroids of every row.

    Returns (id, rank, cluster_id, sim); ties → lower cluster id first.
    ``min_sim`` drops candidates below a threshold (M8 soft assignment).
    The centroid matrix is bounded (k clusters × d) and broadcast once.
    """
    spark = df.sparkSession
    cids, cmat = collect_bounded_matrix(cents, cid_col, cvec_col)
    cn = np.linalg.norm(cmat, axis=1) if len(cids) else np.zeros(0)
    bc = spark.sparkContext.broadcast((cids, cmat, cn))
    kk = min(k, len(cids))

    def assign(batches):
        ids_, mat_, norms_ = bc.value
        for pdf in batches:
            if len(pdf) == 0 or kk == 0:
                continue
            order = np.empty((len(pdf), kk), np.int64)
            vals = np.empty((len(pdf), kk))
            # as many rows at a time as keep the similarity matrix within its bound
            step = max(1, BATCH_ELEMENTS // len(ids_))
            for lo in range(0, len(pdf), step):
                x = _stack(pdf[vec_col].iloc[lo:lo + step])
                sims = (x @ mat_.T) / np.outer(np.linalg.norm(x, axis=1), norms_)
                near = np.where(np.isnan(sims), -np.inf, sims)
                least = np.partition(near, len(ids_) - kk, axis=1)[:, len(ids_) - kk]
                for r in range(len(x)):
                    at = np.flatnonzero(near[r] >= least[r])  # ties with the last one, too
                    order[lo + r] = at[np.lexsort((ids_[at], -near[r, at]))[:kk]]
                    vals[lo + r] = sims[r, order[lo + r]]
            rows = np.repeat(pdf[id_col].to_numpy(), kk)
            ranks = np.tile(np.arange(1, kk + 1), len(pdf))
            picked, vals = ids_[order].ravel(), vals.ravel()
            out = pd.DataFrame({id_col: rows, "rank": ranks.astype(np.int32),
                                cid_col: picked.astype(np.int32), "sim": vals})
            if min_sim is not None:
                out = out[out["sim"] >= min_sim]
            yield out

    id_type = df.schema[id_col].dataType.simpleString()
    schema = f"{id_col} {id_type}, rank int, {cid_col} int, sim double"
    return df.select(id_col, vec_col).mapInPandas(assign, schema)


def as_parallel_arrays(top: DataFrame, id_col: str = "id", cid_col: str = "cluster_id") -> DataFrame:
    """J8 output contract: (id, cluster_ids array<int>, cluster_scores array<double>) in rank
    order; one bounded group (k rows) per id."""
    g = top.groupBy(id_col).agg(F.array_sort(F.collect_list(F.struct("rank", cid_col, "sim"))).alias("_t"))
    return g.select(id_col, F.col(f"_t.{cid_col}").alias("cluster_ids"), F.col("_t.sim").alias("cluster_scores"))
