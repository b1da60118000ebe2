"""kNN, range join, density tree and linkage against brute force."""

import numpy as np
import pandas as pd
import pytest

from quire.operators import cluster as C
from quire.operators import neighbors as NB


def vec_df(spark, x, ids=None):
    ids = range(len(x)) if ids is None else ids
    return spark.createDataFrame([(int(i), [float(v) for v in row]) for i, row in zip(ids, x)], "id long, v array<double>")


def distances(x):
    d = np.sqrt(((x[:, None, :] - x[None, :, :]) ** 2).sum(-1))
    np.fill_diagonal(d, np.inf)
    return d


def brute_knn(x, k):
    d = distances(x)
    return {i: list(np.lexsort((np.arange(len(x)), d[i]))[:k]) for i in range(len(x))}


def lists(df):
    have = {}
    for r in df.collect():
        have.setdefault(r["id"], {})[r["rank"]] = r["nbr"]
    return {i: [h[k] for k in sorted(h)] for i, h in have.items()}


def clustered(n, groups, dim, seed):
    rng = np.random.default_rng(seed)
    return rng.normal(size=(groups, dim))[rng.integers(0, groups, n)] * 4 + rng.normal(size=(n, dim)) * 0.2


def test_knn_on_clusters_is_exact_and_compares_few_pairs(spark):
    x = clustered(3000, 60, 16, 1)
    want = brute_knn(x, 5)
    n = spark.sparkContext.accumulator(0)
    assert lists(NB.knn(vec_df(spark, x), 5, n_pivots=16, block_size=64, compared=n)) == want
    assert n.value < len(x) ** 2 / 10
    few = spark.sparkContext.accumulator(0)
    near = lists(NB.knn(vec_df(spark, x), 5, block_size=64, exact=False, compared=few))
    recall = np.mean([len(set(near[i]) & set(want[i])) / 5 for i in want])
    assert recall >= 0.85 and few.value < 2 * n.value and few.value < len(x) ** 2 / 10


def test_buckets_are_bounded_and_hold_every_row_once_a_tree(spark):
    x = clustered(1500, 3, 8, 2)
    rows = NB.projection_buckets(vec_df(spark, x), block_size=50, trees=2).select("id", "node").collect()
    sizes, seen = {}, {}
    for r in rows:
        sizes[r["node"]] = sizes.get(r["node"], 0) + 1
        seen[r["id"]] = seen.get(r["id"], 0) + 1
    assert max(sizes.values()) <= 50 and set(seen.values()) == {2} and len(seen) == 1500


def test_ball_tree_cells(spark):
    x = clustered(2000, 2, 8, 3)
    index = NB.ball_index(vec_df(spark, x), fan=4, block_size=40)
    cells = {}
    for r in index.rows.collect():
        cells.setdefault(r["cell"], []).append(r["id"])
    assert sum(map(len, cells.values())) == 2000 and max(map(len, cells.values())) <= 40 and len(index.levels) > 2
    for level in index.levels:
        for r in level.collect():
            inside = [i for c, ids in cells.items() if c == r["cell"] or c.startswith(r["cell"] + ".") for i in ids]
            assert len(inside) == r["n"]
            assert np.sqrt(((x[inside] - np.array(r["center"])) ** 2).sum(1)).max() <= r["radius"] + 1e-9


def test_knn_with_copies_nulls_and_few_rows(spark):
    x = clustered(200, 4, 5, 4)
    x[50:120] = x[7]                     # one very common vector
    x[130] = x[131]
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    df = spark.createDataFrame(rows + [(900, None), (None, [1.0] * 5)], "id long, v array<double>")
    assert lists(NB.knn(df, 4, n_pivots=4, block_size=16)) == brute_knn(x, 4)
    assert lists(NB.knn(vec_df(spark, x[:3]), 4)) == {i: sorted({0, 1, 2} - {i}, key=lambda j: (distances(x[:3])[i, j], j)) for i in range(3)}
    assert NB.knn(df.limit(0), 4).collect() == []


def kruskal(edges, n):
    parent = list(range(n))

    def find(a):
        while parent[a] != a:
            a = parent[a]
        return a

    out = []
    for w, a, b in sorted(edges):
        if find(a) != find(b):
            parent[find(a)] = find(b)
            out.append((a, b, w))
    return out


@pytest.mark.parametrize("seed", range(4))
def test_least_forest_is_kruskals(seed):
    rng = np.random.default_rng(seed)
    u, v = rng.integers(0, 40, 120), rng.integers(0, 40, 120)
    w = rng.integers(0, 9, 120) / 4.0       # many ties
    at = NB.least_forest(u, v, w)
    edges = [(float(c), int(min(a, b)), int(max(a, b))) for a, b, c in zip(u, v, w) if a != b]
    got = [(float(w[i]), int(min(u[i], v[i])), int(max(u[i], v[i]))) for i in at]
    assert sorted(got) == sorted((c, a, b) for a, b, c in kruskal(edges, 40))


def test_spanning_forest_by_rounds(spark):
    rng = np.random.default_rng(5)
    edges = [(int(a), int(b), float(c)) for a, b, c in zip(rng.integers(0, 80, 300), rng.integers(0, 80, 300), rng.integers(0, 20, 300))]
    edges += [(i, i + 1, 5.0) for i in range(100, 160)]     # a chain of equal weights
    want = sorted(kruskal([(c, min(a, b), max(a, b)) for a, b, c in edges if a != b], 200))
    df = spark.createDataFrame(edges, "a long, b long, w double").repartition(5)
    for one_task in (0, 40, C.ONE_TASK_EDGES):
        assert sorted((r["a"], r["b"], r["w"]) for r in C.spanning_forest(df, one_task).collect()) == want
    assert C.spanning_forest(df.limit(0)).collect() == []


@pytest.mark.parametrize("one_task", [0, 1000])
def test_components_in_one_task_and_in_rounds(spark, one_task):
    rng = np.random.default_rng(12)
    edges = [(int(a), int(b)) for a, b in rng.integers(0, 120, (70, 2))] + [(200, 200)]
    label = {n: n for e in edges for n in e}
    for _ in edges:
        for a, b in edges:
            label[a] = label[b] = min(label[a], label[b])
    got = {r["node"]: r["component"] for r in C.connected_components(spark.createDataFrame(edges, "src long, dst long"), one_task=one_task).collect()}
    assert got == label


def brute_cut(x, eps, size, samples):
    d = distances(x)
    core = np.sort(d, axis=1)[:, samples - 2]
    comp = -np.ones(len(x), dtype=int)
    for s in np.flatnonzero(core <= eps):
        if comp[s] < 0:
            stack, comp[s] = [s], s
            while stack:
                u = stack.pop()
                for v in np.flatnonzero((core <= eps) & (d[u] <= eps) & (comp < 0)):
                    comp[v] = s
                    stack.append(v)
    sizes = {c: (comp == c).sum() for c in set(comp[comp >= 0])}
    keep = sorted([c for c in sizes if sizes[c] >= size], key=lambda c: (-sizes[c], c))
    return {i: keep.index(comp[i]) if comp[i] in keep else -1 for i in range(len(x))}


def test_one_tree_answers_every_cut(spark):
    rng = np.random.default_rng(6)
    x = np.vstack([clustered(300, 6, 3, 6), rng.uniform(-8, 8, size=(60, 3))])
    x[10:30] = x[3]                      # copies
    tree = C.density_tree(vec_df(spark, x), 0.6, 4, n_pivots=4, block_size=32)
    assert tree.edges.count() <= len(x) - 1
    for eps in (0.6, 0.2):
        got = {r["id"]: r["cluster_id"] for r in C.flat_cut(tree, eps, 8).collect()}
        assert got == brute_cut(x, eps, 8, 4)
    with pytest.raises(ValueError):
        C.flat_cut(tree, 0.7, 8)


def test_radius_by_quantile(spark):
    x = clustered(200, 5, 3, 7)
    core = np.sort(np.sort(distances(x), axis=1)[:, 1])
    tree = C.density_tree(vec_df(spark, x), None, 3, 0.8, forest=False)
    assert tree.eps == pytest.approx(core[int(np.ceil(0.8 * len(x))) - 1])


@pytest.mark.parametrize("rows", [6, 1024])
def test_linkage_by_rounds_and_in_one_task_with_ties_and_zero_vectors(spark, monkeypatch, rows):
    monkeypatch.setattr(C, "GROUP_ROWS", rows)
    rng = np.random.default_rng(8)
    x = np.vstack([rng.normal(size=(16, 4)), np.zeros((1, 4))])
    x[4] = x[9]
    got = {r["id"]: r["meta_id"] for r in C.average_linkage(vec_df(spark, x), 5).collect()}
    norm = np.linalg.norm(x, axis=1, keepdims=True)
    u = np.divide(x, norm, out=np.zeros_like(x), where=norm > 0)
    groups = [[i] for i in range(len(x))]
    while len(groups) > 5:
        pairs = [(np.mean([1 - u[i] @ u[j] for i in a for j in b]), m, n) for m, a in enumerate(groups) for n, b in enumerate(groups) if m < n]
        _, m, n = min(pairs)
        groups[m] = groups[m] + groups[n]
        del groups[n]
    assert got == {i: k for k, g in enumerate(sorted(groups, key=min)) for i in g}
    if rows > len(x):
        assert [r["meta_id"] for r in C.average_linkage(vec_df(spark, x[:1]), 3).collect()] == [0]
        assert C.average_linkage(vec_df(spark, x).limit(0), 3).collect() == []


def test_gaussian_projection_keeps_distances(spark):
    rng = np.random.default_rng(9)
    x = rng.normal(size=(40, 300))
    df = vec_df(spark, x).unionByName(spark.createDataFrame([(900, None)], "id long, v array<double>"))
    got = {r["id"]: r["reduced"] for r in C.gaussian_project(df, 256).collect()}
    assert got.pop(900) is None
    y = np.array([got[i] for i in range(40)])
    upper = np.triu_indices(40, 1)
    ratio = (distances(y)[upper] / distances(x)[upper]) ** 2
    # k = 256, eps = 0.5: at most 2 exp(-256 (0.125 - 0.0208)) of the pairs, about 5e-12
    assert (np.abs(ratio - 1) < 0.5).all()


def test_cells_are_joined_by_number(spark):
    x = clustered(300, 2, 3, 5)
    index = NB.ball_index(vec_df(spark, x), fan=3, block_size=20)
    cells = [r for level in index.levels for r in level.select("no", "cell", "parent").collect()]
    above = {r["no"]: r["cell"] for r in cells} | {NB.ROOT: NB.ROOT_NAME}
    assert len(index.levels) > 1 and len(above) == len(cells) + 1
    assert all(r["cell"].rsplit(".", 1)[0] == above[r["parent"]] for r in cells)
    assert all(above[r["no"]] == r["cell"] for r in index.rows.collect())
    queries = index.rows.selectExpr("id AS q", "v", "0.1D AS theta")
    assert dict(NB.candidate_cells(index, queries).dtypes)["no"] == "bigint"


def test_rows_meet_by_pairs_of_blocks(spark, monkeypatch):
    monkeypatch.setattr(NB, "BLOCK_ROWS", 150)
    x = np.vstack([clustered(700, 4, 6, 13), np.full((1, 6), np.nan)])
    df = vec_df(spark, x)
    index = NB.ball_index(df, fan=6, block_size=40)
    sizes = {}
    for r in index.rows.select("id", "block").collect():
        sizes[r["block"]] = sizes.get(r["block"], 0) + 1
    assert sum(sizes.values()) == 700 and 4 <= len(sizes) <= 7 and max(sizes.values()) <= 190
    assert lists(NB.knn(df, 4, n_pivots=6, block_size=40)) == brute_knn(x[:700], 4)
    some = C.density_cluster(df, 0.35, 8, 4, n_pivots=6, block_size=40).collect()
    assert {r["id"]: r["cluster_id"] for r in some if r["id"] < 700} == brute_cut(x[:700], 0.35, 8, 4)
    tree = C.density_tree(df, 0.35, 4, n_pivots=6, block_size=40, forest=False)
    with pytest.raises(ValueError):
        C.flat_cut(tree, 0.2, 8)


def a_block(x, first=0):
    return NB._Block(pd.DataFrame({"id": np.arange(len(x)) + first, "v": list(x), "no": np.arange(len(x)) // 9, "core": 0.0}), "id", "v")


@pytest.mark.parametrize("pending", [5, 1 << 18])
def test_two_blocks_in_a_task(monkeypatch, pending):
    monkeypatch.setattr(NB, "PENDING", pending)
    monkeypatch.setattr(NB, "QUERY_ROWS", 20)
    rng = np.random.default_rng(14)
    x = rng.integers(0, 5, (110, 3)).astype(float)      # many ties
    a, b = a_block(x[:60]), a_block(x[60:], 60)
    d = np.sqrt(((x[:, None] - x[None]) ** 2).sum(-1))
    for theta in (np.inf, 1.5, 0.0):
        got = NB._search(a, b, np.full(60, theta), 4)
        want = [(i, j + 60, d[i, j + 60]) for i in range(60) for j in np.lexsort((np.arange(50), d[i, 60:]))[:4] if d[i, j + 60] <= theta]
        assert sorted(zip(got["q"], got["nbr"], got["dist"])) == sorted(want)
    for q, r, ids in ((a, b, range(110)), (a, a, range(60))):
        for eps in (0.0, 1.0, 2.0):
            pairs = [(float(d[i, j]), int(i), int(j)) for i in q.ids for j in r.ids if i < j and d[i, j] <= eps]
            want = kruskal(pairs, 110)
            u, v, w = NB._least_edges(q, r, eps, q is r)
            assert sorted(w) == sorted(c for _, _, c in want)
            some = list(zip(*(z.tolist() for z in NB._some_edges(q, r, eps, q is r)[:2])))
            assert len(some) == len(want) == len(kruskal([(0.0, i, j) for i, j in some], 110)) and all(d[i, j] <= eps for i, j in some)
            assert len(kruskal([(0.0, i, j) for i, j in some] + pairs, 110)) == len(want)


def jobs_of(spark, name, run):
    """Spark jobs that an action started."""
    spark.sparkContext.setJobGroup(name, name)
    try:
        return run(), len(spark.sparkContext.statusTracker().getJobIdsForGroup(name))
    finally:
        spark.sparkContext.setJobGroup("rest", "rest")


def test_few_jobs_cut_rows_into_buckets_and_cells(spark):
    x = clustered(3000, 8, 6, 15)
    df = vec_df(spark, x).repartition(3).localCheckpoint()
    got, jobs = jobs_of(spark, "few", lambda: lists(NB.knn(df, 3, n_pivots=4, block_size=40)))
    assert got == brute_knn(x, 3) and jobs < 60


def test_parts_larger_than_a_task_are_cut_by_joins(spark, monkeypatch):
    monkeypatch.setattr(NB, "PART_ROWS", 300)
    x = np.vstack([clustered(900, 5, 4, 16), np.arange(40)[:, None] * 1e-200 + np.zeros((1, 4))])   # the last ones are at distance 0 by rounding
    df = vec_df(spark, x)
    buckets = NB.projection_buckets(df, block_size=30, trees=2).groupBy("node").count().collect()
    assert sum(r["count"] for r in buckets) == 2 * len(x) and max(r["count"] for r in buckets) <= 30
    index = NB.ball_index(df, fan=5, block_size=30)
    cells = index.rows.groupBy("cell").count().collect()
    assert sum(r["count"] for r in cells) == len(x) and max(r["count"] for r in cells) <= 30
    assert lists(NB.knn(df.filter("id < 900"), 3, n_pivots=5, block_size=30)) == brute_knn(x[:900], 3)


def test_equal_vectors_are_looked_for_once(spark, monkeypatch):
    calls, real = [], NB.distinct_vectors
    monkeypatch.setattr(NB, "distinct_vectors", lambda *a: (calls.append(1), real(*a))[1])
    x = clustered(60, 3, 3, 17)
    x[20:30] = x[4]
    tree = C.density_tree(vec_df(spark, x), 0.6, 3)
    assert len(calls) == 1
    assert {r["id"]: r["cluster_id"] for r in C.flat_cut(tree, 0.6, 5).collect()} == brute_cut(x, 0.6, 5, 3)
