import numpy as np
import pytest

from quire.llm import whitening
from quire.llm.common import table
from quire.llm.queries import QUERIES
from tests.conftest import SF_CHECK


def plain(rows, k=8):
    """Eigenvectors of the covariance, formed in full, and exact deviations in Python integers."""
    ids = [i for i, _ in rows]
    x = np.array([[int(np.floor(1024 * float(c))) + 100000 for c in v] for _, v in rows], object)
    n, s = len(x), x.sum(0)
    c = ((n * x - s) / n).astype(float)
    cov = c.T @ c / n
    values, vectors = np.linalg.eigh(cov)
    values, vectors = values[::-1], vectors[:, ::-1]
    k = int((values[:k] > 1e-12 * values[0]).sum())
    return ids, [int(d) for d in ((n * x - s) ** 2).sum(1)], c @ vectors[:, :k] / np.sqrt(values[:k]), values[:k] / np.trace(cov)


def check(got, rows, k=8):
    ids, dev, white, explained = plain(rows, k)
    assert len(got) == white.size
    table_of = {}
    for r in got:
        table_of.setdefault(r["vec_id"], {})[r["component"]] = r
    assert len(table_of) == len(set(ids))
    for c in range(white.shape[1]):
        mine = np.array([table_of[i][c + 1]["whitened"] for i in ids])
        sign = np.sign(mine @ white[:, c])
        assert np.abs(mine - sign * white[:, c]).max() < 1e-8
    for i, d in zip(ids, dev):
        for c, r in table_of[i].items():
            assert r["deviation"] == d and r["n"] == len(rows) and abs(r["explained"] / explained[c - 1] - 1) < 1e-10 and r["identity_error"] < 1e-10


def test_query_on_the_given_table(spark):
    rows = [(r["vec_id"], r["embedding"]) for r in table(spark, SF_CHECK, "embeddings").collect()]
    check(QUERIES["op12_whitening"](spark, SF_CHECK).collect(), rows)


def test_wide_vectors_and_one_very_common(spark):
    rng = np.random.default_rng(3)
    x = rng.standard_normal((600, 90)) * np.geomspace(3, 0.2, 90)
    x[100:300] = x[100]
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    df, model = whitening.whiten(spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(5))
    check(df.collect(), rows)
    assert model.residual < 1e-11 and model.passes < 150 and model.vectors.shape == (90, 8)


def test_fewer_dimensions_than_the_block_and_low_rank(spark):
    rng = np.random.default_rng(4)
    small = [(i, v.tolist()) for i, v in enumerate(rng.standard_normal((50, 3)))]
    df, model = whitening.whiten(spark.createDataFrame(small, "vec_id long, embedding array<double>"))
    check(df.collect(), small)
    assert model.passes == 2
    flat = [(i, [3.0 * a, 0.0, 5.0] + [float(b)] * 60) for i, (a, b) in enumerate(rng.integers(-9, 9, (80, 2)).tolist())]
    df, model = whitening.whiten(spark.createDataFrame(flat, "vec_id long, embedding array<double>"))
    check(df.collect(), flat)
    assert len(model.values) == 2


def test_filter_grows_only_above_the_edge():
    v = np.diag([10.0, 6.0, 3.0, 1.0, 0.5])
    out = np.abs(np.diag(whitening.chebyshev(lambda q: v @ q, np.eye(5), 3.0, 10.0, 8)))
    assert out[0] == pytest.approx(1) and (out[2:] < 1e-6).all() and out[1] > 50 * out[2:].max()


def test_deviations_beyond_a_long():
    x = np.array([[1 << 35, 0], [0, 0], [5, 0]], np.int64)
    sums = [int(v) for v in x.sum(0)]
    want = [sum((3 * int(a) - s) ** 2 for a, s in zip(row, sums)) for row in x]
    assert whitening.deviations(x, 3, sums) == [w if w < 1 << 63 else None for w in want] and None in whitening.deviations(x, 3, sums)
    assert whitening.deviations(x[1:], 2, [5, 0]) == [25, 25]


def test_awkward_rows(spark):
    nan, inf = float("nan"), float("inf")
    good = [(0, [1.0, 0.5]), (0, [1.0, 0.5]), (1, [0.0, 0.0]), (7, [1.0, 2.0]), (8, [-3.0, 0.25])]
    bad = [(2, None), (3, [nan, 1.0]), (4, [-inf, 1.0]), (5, [None, 1.0]), (8, [1.0]), (9, [])]
    make = lambda rows: spark.createDataFrame([(i, v, "x", 1, 2.0) for i, v in rows], "vec_id long, embedding array<float>, id string, n int, x double")
    got = whitening.whiten(make(good + bad))[0].collect()
    assert sorted(r["vec_id"] for r in got) == sorted(2 * [i for i, _ in good])
    check([r for r in got if r["vec_id"]] + [r for r in got if r["vec_id"] == 0], good)
    for rows in ([], bad, good[:1], good[:2]):
        assert whitening.whiten(make(rows))[0].collect() == []
    null = whitening.whiten(make([(None, [1.0, 0.0]), (1, [0.0, 0.0])]))[0].collect()
    assert {r["vec_id"] for r in null} == {None, 1}
