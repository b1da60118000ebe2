"""Embedding whitening by Chebyshev-filtered subspace iteration.

The leading eigenvectors of the covariance V of integer vectors x are sought in
a block Q of ``k`` + EXTRA orthonormal columns. A pass over the table gives VQ as
the sum of Xc'(Xc Q) over tasks, with Xc centred before multiplying; V itself is
never formed, and tasks return d x m sums. Each round rotates Q to its Ritz
vectors (Rayleigh-Ritz), takes the smallest Ritz value as the edge of the
unwanted spectrum, and applies a scaled Chebyshev polynomial of V that stays
small on [0, edge] and grows fast above it; its three-term recurrence costs DEGREE
passes. Then QR. GUARDS columns are drawn anew each round, so that a direction
that the block has missed can still enter.

Rounds end when the residuals |Vq - eq| of the first k Ritz pairs, from a pass
over all rows, are below TOLERANCE times the largest eigenvalue, or stop
falling below CERTAIN times it: the certificate. A last pass with the final
vectors gives the covariance of the whitened vectors and its distance from the
identity.

Integers: x = floor(scale * c) + shift, sums S are exact, and x - S/n is taken
as (x - S div n) - (S mod n) / n, so centring loses nothing to cancellation.

Defined results: rows whose vector is null, empty or holds null or non-finite entries
are dropped, also those of another dimension than the most common (of equally
common ones the larger); rows may repeat and count each time; a null id stays null; a
component whose eigenvalue is zero to double precision isn't returned, so one row,
equal rows or an empty table give an empty result; a deviation beyond a
long is null; entries beyond +-2**30 raise an error; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quire.llm.common import only, saved

K, SCALE, SHIFT = 8, 1024, 100_000
EXTRA, GUARDS, DEGREE = 24, 2, 16
TOLERANCE, CERTAIN, NOTHING = 1e-14, 1e-11, 1e-13
MOST_ROUNDS = 200
LIMIT = 1 << 40      # largest magnitude of scale * c
SEED = 12


@dataclass
class Whitening:
    """n, exact sums, eigenvalues (falling), eigenvectors as columns, trace of V, and how well they are known."""

    n: int
    sums: list[int]
    values: np.ndarray
    vectors: np.ndarray
    trace: float
    residual: float
    identity_error: float
    passes: int


def usable(v: Column) -> Column:
    return v.isNotNull() & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))


def integers(df: DataFrame, id_col: str, vec_col: str, scale: int, shift: int) -> DataFrame | None:
    """(id, x): the usable vectors of the most common dimension, as integers; None without any."""
    src = only(df, id=id_col, v=vec_col).filter(usable(F.col("v")) & (F.size("v") > 0))
    common = src.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).limit(1).collect()
    if not common:
        return None
    fits = F.forall("v", lambda c: F.abs(c.cast("double") * scale) <= LIMIT)
    whole = F.transform("v", lambda c: F.floor(c.cast("double") * scale) + F.lit(shift).cast("long"))
    return src.filter(F.size("v") == common[0]["d"]).select("id", F.when(fits, whole).otherwise(F.raise_error(F.lit(f"an entry beyond {LIMIT // scale}"))).alias("x"))


def matrix(column: pa.Array) -> np.ndarray:
    return np.asarray(column.flatten()).astype(np.int64, copy=False).reshape(len(column), -1)


def totals(table: DataFrame) -> tuple[int, list[int]]:
    """Number of rows and exact sums of each dimension."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total = 0, 0
        for batch in batches:
            if batch.num_rows:
                n, total = n + batch.num_rows, total + matrix(batch.column("x")).sum(0).astype(object)
        if n:
            yield pa.RecordBatch.from_arrays([pa.array(range(len(total)), pa.int32()), pa.array([Decimal(int(t)) for t in total], pa.decimal128(38, 0)), pa.array([n] * len(total), pa.int64())],
                                             names=["dim", "total", "n"])

    parts = table.select("x").mapInArrow(run, "dim int, total decimal(38,0), n long")
    rows = parts.groupBy("dim").agg(F.sum("total").alias("total"), F.sum("n").alias("n")).orderBy("dim").collect()   # d rows
    return (rows[0]["n"] if rows else 0), [int(r["total"]) for r in rows]


def centred(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """x - S/n in double precision."""
    return (x - np.array([s // n for s in sums], np.int64)) - np.array([s % n / n for s in sums])


def deviations(x: np.ndarray, n: int, sums: list[int]) -> list[int | None]:
    """Exact sums over dimensions of (n*x - S)**2; None where a long can't hold it."""
    y, r = x - np.array([s // n for s in sums], np.int64), [s % n for s in sums]
    most = (int(np.abs(y).max(initial=0)) + 1) * n
    if most ** 2 * x.shape[1] < 1 << 63:
        t = n * y - np.array(r, np.int64)
        return (t * t).sum(1).tolist()
    t = n * y.astype(object) - np.array(r, object)
    return [v if v < 1 << 63 else None for v in (t * t).sum(1).tolist()]


def product(table: DataFrame, n: int, sums: list[int], q: np.ndarray) -> tuple[np.ndarray, float]:
    """VQ and the trace of V, by one pass over all rows."""
    d, m = q.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = np.zeros(d * m + 1)
        for batch in batches:
            if batch.num_rows:
                x = centred(matrix(batch.column("x")), n, sums)
                out[:-1] += (x.T @ (x @ q)).ravel()
                out[-1] += np.einsum("ij,ij->", x, x)
        if out[-1]:
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(out), dtype=np.int32)), pa.array(out)], names=["cell", "part"])

    got = table.select("x").mapInArrow(run, "cell int, part double").groupBy("cell").agg(F.sum("part").alias("part")).toArrow()   # d * m + 1 rows
    out = np.zeros(d * m + 1)
    out[got["cell"].to_numpy()] = got["part"].to_numpy()
    return out[:-1].reshape(d, m) / n, float(out[-1]) / n


def chebyshev(apply: Callable[[np.ndarray], np.ndarray], q: np.ndarray, edge: float, top: float, degree: int) -> np.ndarray:
    """A polynomial of V times Q: at most about 1 on [0, edge], scaled to 1 at ``top``."""
    half = edge / 2
    first = sigma = half / (top - half)
    before, now = q, (apply(q) - half * q) * (sigma / half)
    for _ in range(degree - 1):
        after = 1 / (2 / first - sigma)
        before, now = now, (apply(now) - half * now) * (2 * after / half) - before * (sigma * after)
        sigma = after
    return now


def fit(table: DataFrame, k: int = K) -> Whitening | None:
    """The leading ``k`` components of a table (id, x); None if x has no variance."""
    n, sums = totals(table)
    if not n:
        return None
    d, rng = len(sums), np.random.default_rng(SEED)
    m, passes, trace = min(d, k + EXTRA), 0, 0.0

    def apply(q: np.ndarray) -> np.ndarray:
        nonlocal passes, trace
        passes += 1
        out, trace = product(table, n, sums, q)
        return out

    q, last = np.linalg.qr(rng.standard_normal((d, m)))[0], np.inf
    for _ in range(MOST_ROUNDS):
        w = apply(q)
        t = q.T @ w
        values, turn = np.linalg.eigh((t + t.T) / 2)
        values, turn = values[::-1], turn[:, ::-1]
        q, w = q @ turn, w @ turn
        if not trace or values[0] <= 0:
            return None
        residual = float(np.linalg.norm(w[:, :k] - q[:, :k] * values[:k], axis=0).max() / values[0])
        if residual <= TOLERANCE or last <= CERTAIN and residual > last / 2 or m == d:
            break
        last = residual
        edge = max(float(values[m - 1 - GUARDS]), 1e-8 * float(values[0]))
        q[:, m - GUARDS:] = rng.standard_normal((d, GUARDS)) / np.sqrt(d)
        q = np.linalg.qr(chebyshev(apply, q, edge, float(values[0]), DEGREE) if edge < values[0] else apply(q))[0]
    else:
        raise RuntimeError(f"not certified after {MOST_ROUNDS} rounds: residual {residual:g} of the largest eigenvalue")
    real = int((values[:k] > NOTHING * d * values[0]).sum())
    values, q = values[:real], q[:, :real]
    scaled = q / np.sqrt(values)
    error = np.abs(scaled.T @ apply(scaled) - np.eye(real)).max()
    return Whitening(n, sums, values, q, trace, residual, float(error), passes)


def project(table: DataFrame, model: Whitening) -> DataFrame:
    """(id, component, n, deviation, whitened, explained, identity_error) of every row and component."""
    scaled, explained, c = model.vectors / np.sqrt(model.values), model.values / model.trace, len(model.values)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.num_rows
            if not rows:
                continue
            x = matrix(batch.column("x"))
            each = pa.array(np.repeat(np.arange(rows), c))
            full = lambda v, kind: pa.array(np.full(rows * c, v), kind)
            yield pa.RecordBatch.from_arrays(
                [batch.column("id").take(each), pa.array(np.tile(np.arange(1, c + 1, dtype=np.int32), rows)), full(model.n, pa.int64()),
                 pa.array(deviations(x, model.n, model.sums), pa.int64()).take(each), pa.array((centred(x, model.n, model.sums) @ scaled).ravel()),
                 pa.array(np.tile(explained, rows)), full(model.identity_error, pa.float64())],
                names=["id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return table.mapInArrow(run, f"id {table.schema['id'].dataType.simpleString()}, component int, n long, deviation long, whitened double, explained double, identity_error double")


def whiten(df: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", k: int = K, scale: int = SCALE, shift: int = SHIFT) -> tuple[DataFrame, Whitening | None]:
    """Every usable row projected on the ``k`` leading components, and the fit."""
    vectors = integers(df, id_col, vec_col, scale, shift)
    if vectors is not None:
        table = saved(vectors, "integers")
        model = fit(table, k)
        if model is not None:
            return project(table, model).withColumnRenamed("id", id_col), model
    kind = only(df, id=id_col).schema["id"].dataType.simpleString()
    return df.sparkSession.createDataFrame([], f"`{id_col}` {kind}, component int, n long, deviation long, whitened double, explained double, identity_error double"), None
