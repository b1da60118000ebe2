import hashlib

import numpy as np
import pytest

from quire.llm import laesa


def plain(rows, k=16, dims=64, rounds=3, scale=64):
    """The definition in Python integers: every vector against every centroid."""
    ok = []
    for i, v in rows:
        if v is not None and len(v) == dims and None not in v and np.isfinite(np.array(v, float)).all():
            ok.append((i, [int(np.floor(scale * float(c))) for c in v]))
    start = sorted(ok, key=lambda r: (hashlib.sha256(f"1:{'' if r[0] is None else r[0]}".encode()).hexdigest(), r[1]))
    cent = [x for _, x in start[:k]]
    dist = lambda x, c: sum((a - b) ** 2 for a, b in zip(x, c))
    best = lambda x: min((dist(x, c), j) for j, c in enumerate(cent))
    for _ in range(rounds):
        held = [[] for _ in cent]
        for _, x in ok:
            held[best(x)[1]].append(x)
        cent = [[sum(c) // len(h) for c in zip(*h)] if h else c0 for h, c0 in zip(held, cent)]
    out = [(i, *best(x)[::-1]) for i, x in ok]
    inertia = {}
    for _, j, d in out:
        inertia[j] = inertia.get(j, 0) + d
    sha = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in cent]
    return sorted((repr(i), j, d, inertia[j], sum(inertia.values()), sha[j]) for i, j, d in out)


def found(df, **kw):
    out, _ = laesa.cluster(df, **kw)
    return sorted((repr(r["vec_id"]), r["cluster"], r["distance"], r["cluster_inertia"], r["inertia"], r["centroid_sha256"]) for r in out.collect())


def test_bounds_prune_and_lose_nothing():
    rng = np.random.default_rng(1)
    centres = rng.integers(-4000, 4000, (16, 8))
    x = centres[rng.integers(0, 16, 3000)] + rng.integers(-60, 60, (3000, 8))
    cent = centres + rng.integers(-20, 20, centres.shape)
    cent[7] = cent[3]   # a tie everywhere: the smaller number wins
    cluster, dist, exact = laesa.assign(x, laesa.to_all(x, centres), cent, centres)
    full = np.stack([((x - c) ** 2).sum(1) for c in cent], axis=1)
    assert (cluster == full.argmin(1)).all() and (dist == full.min(1)).all() and not (cluster == 7).any()
    assert exact.mean() < 3   # of 16
    far, _, more = laesa.assign(x, laesa.to_all(x, centres[:1]), cent, centres[:1])
    assert (far == cluster).all() and more.mean() > exact.mean()


def test_same_as_plain(spark):
    rng = np.random.default_rng(2)
    rows = [(i, v.tolist()) for i, v in enumerate((3 * rng.standard_normal((8, 64)))[rng.integers(0, 8, 400)] + rng.standard_normal((400, 64)) * .3)]
    rows += [(i, rows[5][1]) for i in range(400, 600)]   # one very common vector
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(7)
    assert found(df) == plain(rows)


def test_negative_floor(spark):
    rows = [(i, [(-1) ** i * i / 100.0, -0.001]) for i in range(40)]
    assert found(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), dims=2, k=3) == plain(rows, k=3, dims=2)


def test_awkward_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.5]), (0, [1.0, 0.5]), (0, [2.0, 0.5]), (1, [0.0, 0.0]), (2, None), (3, [nan, 1.0]), (4, [-inf, 1.0]), (5, [None, 1.0]), (None, [1.0, 2.0]), (7, [1.0, 2.0]), (8, [1.0]), (9, [])]
    df = spark.createDataFrame([(i, v, "x", 1, "y") for i, v in rows], "vec_id long, embedding array<float>, id string, cluster int, x string")
    assert found(df, dims=2) == plain(rows, dims=2)
    assert found(df, dims=2, k=2) == plain(rows, dims=2, k=2)
    assert found(df.limit(0), dims=2) == [] and found(df) == []


def test_too_large_for_a_long_says_so(spark):
    df = spark.createDataFrame([(1, [1e30, 0.0])], "vec_id long, embedding array<double>")
    with pytest.raises(Exception, match="fit a long"):
        laesa.cluster(df, dims=2)[0].collect()
