import numpy as np

from quire.llm import rabitq
from quire.llm.common import table
from tests.conftest import SF_CHECK

EVERY = "pmod(id, 100) = 0"


def exact(rows, k=10):
    """All distances in double precision; ties to the smaller id."""
    ok = [(i, np.array(v, float)) for i, v in rows if i is not None and v is not None and None not in v and np.isfinite(np.array(v, float)).all() and np.any(np.array(v, float))]
    ids, x = [i for i, _ in ok], np.array([v for _, v in ok])
    out = {}
    for i, v in ok:
        if i % 100 == 0:
            d = np.sqrt(((x - v) ** 2).sum(1))
            out[i] = sorted((s, j) for s, j in zip(d.tolist(), ids) if j != i)[:k]
    return out


def found(df, **kw):
    out = {}
    for r in sorted(rabitq.nearest(df, EVERY, **kw).collect(), key=lambda r: (r["query_id"], r["rank"])):
        assert r["rank"] == len(out.setdefault(r["query_id"], [])) + 1
        out[r["query_id"]].append((r["score"], r["vec_id"]))
    return out


def recall(got, want):
    return np.mean([len({j for _, j in got.get(q, [])} & {j for _, j in best}) / len(best) for q, best in want.items()])


def test_recall_and_scores(spark):
    df = table(spark, SF_CHECK, "embeddings")
    want = exact([(r["vec_id"], r["embedding"]) for r in df.collect()])
    got = found(df)
    assert recall(got, want) >= 0.9 and got.keys() == want.keys()
    truth = {(q, j): s for q, best in want.items() for s, j in best}
    assert all(abs(truth[q, j] - s) < 1e-9 for q, best in got.items() for s, j in best if (q, j) in truth)


def test_recall_with_many_cells_and_blocks(spark, monkeypatch):
    monkeypatch.setattr(rabitq, "ROWS_PER_CELL", 40)
    monkeypatch.setattr(rabitq, "BLOCK_VECTORS", 30)
    monkeypatch.setattr(rabitq, "BLOCK_QUERIES", 7)
    rng = np.random.default_rng(2)
    x = rng.standard_normal((2000, 24)) + 3 * rng.standard_normal((10, 24))[rng.integers(0, 10, 2000)]
    x[500:1200] = x[500]   # one very common vector
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    want = exact(rows)
    got = found(spark.createDataFrame(rows, "vec_id long, embedding array<double>"))
    assert recall(got, want) >= 0.9
    assert [j for _, j in got[500]] == list(range(501, 511))   # ties: the smaller ids


def test_bounds_hold():
    rng = np.random.default_rng(3)
    x, q = rng.standard_normal((500, 64)), rng.standard_normal((20, 64))
    coder = rabitq.Coder(np.zeros((1, 64)), np.linalg.qr(rng.standard_normal((64, 64)))[0])
    zero = np.zeros(500, np.int64)
    low, high = rabitq.bounds(*coder.encode(x, zero), *coder.rotated(q, zero[:20]))
    true = ((x[None] - q[:, None]) ** 2).sum(2)
    assert ((low <= true + 1e-3) & (true <= high + 1e-3)).mean() > 0.99


def test_awkward_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (0, [1.0, 0.0]), (1, [0.0, 0.0]), (2, None), (3, [nan, 1.0]), (4, [inf, 1.0]), (5, [None, 1.0]), (6, [1.0, 2.0]), (6, [1.0, 2.0]), (7, [1.0, 2.0]), (None, [1.0, 1.0]), (8, [1.0])]
    df = spark.createDataFrame([(i, v, "x", "y", 1) for i, v in rows], "vec_id long, embedding array<double>, id string, cell string, query int")
    assert found(df) == {0: [(2.0, 6), (2.0, 6), (2.0, 7)]}
    assert rabitq.nearest(df.limit(0), EVERY).collect() == []
    assert found(spark.createDataFrame([(0, [1.0, 2.0])], "vec_id long, embedding array<double>")) == {}
