"""Clustering operators (M6-M11) as distributed Spark jobs.

* ``density_cluster`` — DBSCAN* (flat cut of the HDBSCAN* hierarchy at ε):
  exact kNN core distances → spanning forests of the ε-range join among core
  rows → connected components → components of ≥ ``min_cluster_size`` rows become
  clusters numbered by (size desc, smallest id); the rest is noise (−1).
* ``density_tree`` / ``flat_cut`` — the minimum spanning forest of mutual
  reachability by Borůvka rounds, from which every flat cut is a filter.
* ``connected_components`` — min-label propagation with pointer jumping;
  lineage is cut with ``checkpoint()`` in the shared checkpoint folder.
* ``hybrid_cluster`` / ``soft_assign`` — noise rows to the nearest centroid.
* ``kmeans_fit`` / ``pca_reduce`` — MLlib (k-means||, distributed covariance).
* ``average_linkage`` — agglomerative clustering with average linkage on
  cosine distance, exact, via reciprocal-nearest-neighbour rounds.
"""

from __future__ import annotations

import hashlib
import math
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml.clustering import KMeans
from pyspark.ml.feature import PCA
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.operators import neighbors as NB
from quire.operators import relational as R
from quire.operators import vectors as V
from quire.session import cut_lineage, ensure_checkpoint_dir

NOISE = -1
UNASSIGNED = -999


# edges that one task may merge; larger edge tables go through rounds of joins first
ONE_TASK_EDGES = 1 << 17


def connected_components(edges: DataFrame, src: str = "src", dst: str = "dst", one_task: int = 0) -> DataFrame:
    """(node, component) with component = smallest node id of its component.

    At most ``one_task`` edges are labelled by a single task; more go through rounds.

    Labels start at min(node, smallest neighbour) and then alternate
    min-label propagation with pointer jumping (label ← label of label);
    every round is checkpointed, and the loop ends when no label changed (labels
    only fall, so it always does).
    """
    ensure_checkpoint_dir(edges.sparkSession)
    # the edge input feeds both the edge list and the node list: compute it once
    edges = cut_lineage(edges.select(F.col(src).alias(src), F.col(dst).alias(dst)))
    e = edges.select(F.col(src).alias("a"), F.col(dst).alias("b")).filter(F.col("a") != F.col("b"))
    e = cut_lineage(e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct())
    nodes = edges.select(F.col(src).alias("node")).unionByName(edges.select(F.col(dst).alias("node"))).distinct()
    if one_task and e.count() <= 2 * one_task:
        kind = e.schema["a"].dataType.simpleString()
        found = e.groupBy().applyInPandas(_label_components, f"node {kind}, component {kind}")
        return nodes.join(found, "node", "left").select("node", F.coalesce("component", "node").alias("component"))
    start = e.groupBy("a").agg(F.min("b").alias("m"))
    labels = cut_lineage(nodes.join(start, nodes["node"] == start["a"], "left").select(
        "node", F.least(F.col("node"), F.coalesce("m", "node")).alias("label")))
    while True:
        nb = (e.join(labels.select(F.col("node").alias("b"), F.col("label").alias("lb")), "b")
              .groupBy("a").agg(F.min("lb").alias("m")))
        new = (labels.join(nb, labels["node"] == nb["a"], "left")
               .select("node", F.least("label", F.coalesce("m", "label")).alias("label")))
        jump = new.select(F.col("node").alias("label"), F.col("label").alias("l2"))
        new = new.join(jump, "label", "left").select("node", F.least("label", F.coalesce("l2", "label")).alias("label"))
        new = cut_lineage(new)
        changed = (new.join(labels.select("node", F.col("label").alias("old")), "node")
                   .filter(F.col("label") != F.col("old")).limit(1).count())
        labels = new
        if changed == 0:
            break
    return labels.select("node", F.col("label").alias("component"))


def _label_components(pdf: pd.DataFrame) -> pd.DataFrame:
    """Smallest node of each node's component, for edges (a, b) in both directions."""
    names, flat = np.unique(np.concatenate((pdf["a"].to_numpy(), pdf["b"].to_numpy())), return_inverse=True)
    a, b = flat[:len(pdf)], flat[len(pdf):]
    label = np.arange(len(names))
    while True:
        new = label.copy()
        np.minimum.at(new, label[a], label[b])
        while (new[new] != new).any():
            new = new[new]
        if (new == label).all():
            return pd.DataFrame({"node": names, "component": names[label]})
        label = new


def core_distances(df: DataFrame, min_samples: int, id_col: str = "id", vec_col: str = "v", index=None,
                   **kw) -> DataFrame:
    """Distance to the ``min_samples``-th nearest row counting the row itself."""
    k = max(min_samples - 1, 1)
    nn = NB.knn(df, k, id_col, vec_col, index=index, **kw)
    return nn.filter(F.col("rank") == k).select(id_col, F.col("dist").alias("core"))


def spanning_forest(edges: DataFrame, one_task: int = ONE_TASK_EDGES) -> DataFrame:
    """Minimum spanning forest of edges (a, b, w), by Borůvka rounds.

    Each round every component takes its least edge (ties: smaller ends), the
    components that hang together merge (pointer jumping), and of the edges
    between two components only the least stays, so components and edges
    at least halve a round. Rounds are checkpointed and end when no edge is
    left, or when at most ``one_task`` are, which a single task merges.
    """
    ends = [F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")]
    e = cut_lineage(edges.filter(F.col("a") != F.col("b")).select(*ends, "w").groupBy("a", "b").agg(F.min("w").alias("w"))
                    .select(F.col("a").alias("x"), F.col("b").alias("y"), "a", "b", "w"))
    kind = e.schema["a"].dataType.simpleString()
    picked = None
    while True:
        left = e.count()
        if left <= one_task:
            last = e.groupBy().applyInPandas(lambda pdf: _least(pdf), f"a {kind}, b {kind}, w double") if left else e.select("a", "b", "w")
            return last if picked is None else picked.unionByName(last).distinct()
        best = F.min(F.struct("w", "a", "b", "other")).alias("m")
        both = e.select(F.col("x").alias("c"), "w", "a", "b", F.col("y").alias("other")).unionByName(
            e.select(F.col("y").alias("c"), "w", "a", "b", F.col("x").alias("other")))
        least = cut_lineage(both.groupBy("c").agg(best).select("c", "m.w", "m.a", "m.b", "m.other"))
        mine = least.select("a", "b", "w").distinct()
        picked = mine if picked is None else picked.unionByName(mine)
        label = _roots(least.select("c", "other"))
        to = lambda c: label.select(F.col("c").alias(c), F.col("root").alias(f"{c}r"))
        moved = e.join(to("x"), "x").join(to("y"), "y").filter(F.col("xr") != F.col("yr"))
        e = cut_lineage(moved.groupBy(F.least("xr", "yr").alias("x"), F.greatest("xr", "yr").alias("y")).agg(F.min(F.struct("w", "a", "b")).alias("m"))
                        .select("x", "y", "m.a", "m.b", "m.w"))


def _least(pdf: pd.DataFrame) -> pd.DataFrame:
    """The least forest of one task's edges between components x and y."""
    order = np.lexsort((pdf["b"].to_numpy(), pdf["a"].to_numpy(), pdf["w"].to_numpy()))
    pdf = pdf.iloc[order]
    return pdf.iloc[NB.least_forest(pdf["x"].to_numpy(), pdf["y"].to_numpy(), np.arange(len(pdf)))][["a", "b", "w"]]


def _roots(hooks: DataFrame) -> DataFrame:
    """(c, root) of a table (c, other) in which each c hangs on another; of two that
    hang on each other the smaller is the root."""
    back = hooks.select(F.col("c").alias("other"), F.col("other").alias("back"))
    up = F.when((F.col("back") == F.col("c")) & (F.col("c") < F.col("other")), F.col("c")).otherwise(F.col("other"))
    label = cut_lineage(hooks.join(back, "other").select("c", up.alias("root")))
    while True:
        above = label.select(F.col("c").alias("root"), F.col("root").alias("top"))
        new = cut_lineage(label.join(above, "root").select("c", "top", F.col("root").alias("was")))
        label = new.select("c", F.col("top").alias("root"))
        if not new.filter(F.col("top") != F.col("was")).limit(1).count():
            return label


@dataclass
class DensityTree:
    """Minimum spanning forest of the mutual reachability graph up to ``eps``: every flat
    cut at a radius of at least ``least`` is a filter of it. ``core`` (id, core), ``edges`` (a, b, w)."""

    core: DataFrame
    edges: DataFrame
    eps: float
    ids: DataFrame
    least: float = 0.0


def density_tree(df: DataFrame, eps: float | None = None, min_samples: int = 3, quantile: float = 0.9,
                 id_col: str = "id", vec_col: str = "v", n_pivots: int = 32, block_size: int = 512, seed: int = 42,
                 forest: bool = True, slack: float = 0.0) -> DensityTree:
    """The tree that answers all cuts up to ``eps``, or up to a ``quantile`` of the core distances
    (an actual core distance, from a sketch of relative rank error 1e-5, plus ``slack``). Without ``forest``
    it answers that one cut, from edges that hold the components only."""
    vectors = NB.distinct_vectors(df, id_col, vec_col)
    index = NB.ball_index(vectors.reps, id_col, vec_col, n_pivots, block_size, seed)
    core = cut_lineage(core_distances(df, min_samples, id_col, vec_col, index=index, n_pivots=n_pivots, block_size=block_size, seed=seed, vectors=vectors))
    if eps is None:
        eps = core.agg(F.percentile_approx("core", quantile, 100_000)).first()[0]
        eps = 0.0 if eps is None else float(eps) + slack
    edges = NB.range_forest(index, core, eps, weighted=forest)
    if vectors.copies is not None:   # equal vectors are at distance 0: core distance apart
        of = core.select(F.col(id_col).alias("rep"), F.col("core").alias("w"))
        edges = edges.unionByName(vectors.copies.filter(F.col("rep") != F.col("id")).join(of, "rep").filter(F.col("w") <= eps)
                                  .select(F.col("rep").alias("a"), F.col("id").alias("b"), "w"))
    edges = spanning_forest(edges) if forest else edges
    return DensityTree(core, cut_lineage(edges), eps, df.select(id_col), 0.0 if forest else eps)


def flat_cut(tree: DensityTree, eps: float, min_cluster_size: int, id_col: str = "id") -> DataFrame:
    """(id, cluster_id) of one cut: components of the edges up to ``eps``, those of at least
    ``min_cluster_size`` rows numbered by (size desc, smallest id), -1 for the rest."""
    if eps > tree.eps:
        raise ValueError(f"the tree answers cuts up to {tree.eps}")
    if eps < tree.least:
        raise ValueError(f"the tree answers cuts from {tree.least}")
    rows = tree.core.filter(F.col("core") <= eps).select(F.col(id_col).alias("a"), F.col(id_col).alias("b"))
    comps = connected_components(tree.edges.filter(F.col("w") <= eps).select("a", "b").unionByName(rows), "a", "b", ONE_TASK_EDGES)
    sizes = comps.groupBy("component").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= min_cluster_size)
    ranked = R.global_row_number(sizes, [F.col("n").desc(), F.col("component")], "_r")
    ranked = ranked.select("component", (F.col("_r") - 1).cast("int").alias("cluster_id"))
    lab = comps.join(ranked, "component").select(F.col("node").alias(id_col), "cluster_id")
    return (tree.ids.join(lab, id_col, "left")
            .select(id_col, F.coalesce("cluster_id", F.lit(NOISE)).cast("int").alias("cluster_id")))


def density_cluster(df: DataFrame, eps: float | None = None, min_cluster_size: int = 10, min_samples: int = 3,
                    id_col: str = "id", vec_col: str = "v", n_pivots: int = 32, block_size: int = 512,
                    seed: int = 42, quantile: float = 0.9) -> DataFrame:
    """M7: (id, cluster_id) with −1 for noise; ``eps`` given, or a quantile of the core distances.
    One cut needs no tree: the forests of the tasks are cut as they are."""
    tree = density_tree(df, eps, min_samples, quantile, id_col, vec_col, n_pivots, block_size, seed, forest=False)
    return flat_cut(tree, tree.eps, min_cluster_size, id_col)


def hybrid_cluster(df: DataFrame, labels: DataFrame, id_col: str = "id", vec_col: str = "v") -> DataFrame:
    """M9: keep density labels; every noise row joins its most cosine-similar
    centroid (centroids over the clustered rows). → (id, cluster_id, from_noise, sim)."""
    # read by the centroid collection and by the final join: materialise once
    x = cut_lineage(df.select(id_col, vec_col).join(labels, id_col))
    cents = V.centroids(x.filter(F.col("cluster_id") != NOISE), "cluster_id", vec_col)
    noise = x.filter(F.col("cluster_id") == NOISE)
    best = V.top_centroids(noise, cents, 1, id_col, vec_col, "cluster_id", "centroid").select(
        id_col, F.col("cluster_id").alias("nearest"), "sim")
    out = x.select(id_col, "cluster_id").join(best, id_col, "left")
    return out.select(id_col, F.coalesce("nearest", "cluster_id").cast("int").alias("cluster_id"),
                      F.col("nearest").isNotNull().alias("from_noise"), "sim")


def soft_assign(df: DataFrame, labels: DataFrame, threshold: float = 0.3, id_col: str = "id",
                vec_col: str = "v") -> DataFrame:
    """M8: noise rows join their nearest centroid if cosine ≥ threshold,
    otherwise −999; clustered rows keep their label. → (id, cluster)."""
    x = cut_lineage(df.select(id_col, vec_col).join(labels, id_col))
    cents = V.centroids(x.filter(F.col("cluster_id") != NOISE), "cluster_id", vec_col)
    noise = x.filter(F.col("cluster_id") == NOISE)
    best = V.top_centroids(noise, cents, 1, id_col, vec_col, "cluster_id", "centroid", min_sim=threshold).select(
        id_col, F.col("cluster_id").alias("nearest"))
    out = x.select(id_col, "cluster_id").join(best, id_col, "left")
    c = (F.when(F.col("cluster_id") != NOISE, F.col("cluster_id"))
         .when(F.col("nearest").isNotNull(), F.col("nearest")).otherwise(F.lit(UNASSIGNED)))
    return out.select(id_col, c.cast("int").alias("cluster"))


def kmeans_fit(df: DataFrame, k: int, seed: int = 42, n_init: int = 10, id_col: str = "id", vec_col: str = "v",
               max_iter: int = 20):
    """K-means|| with ``n_init`` seeded restarts; the lowest-cost model wins.

    Returns (assignments(id, cluster), centers DataFrame(cluster, center), cost)."""
    x = df.select(id_col, array_to_vector(V.as_double(vec_col)).alias("features"))
    x = cut_lineage(x)
    best = None
    for i in range(n_init):
        model = KMeans(k=k, seed=seed + i, maxIter=max_iter, initMode="k-means||").fit(x)
        cost = model.summary.trainingCost
        if best is None or cost < best[1]:
            best = (model, cost)
    model, cost = best
    assign = model.transform(x).select(id_col, F.col("prediction").cast("int").alias("cluster"))
    centers = df.sparkSession.createDataFrame(
        [(i, [float(v) for v in c]) for i, c in enumerate(model.clusterCenters())], "cluster int, center array<double>")
    return assign, centers, cost


def pca_reduce(df: DataFrame, k: int, id_col: str = "id", vec_col: str = "v") -> tuple[DataFrame, list[float]]:
    """M6: project onto the top-k principal components → (id, reduced), explained variance."""
    x = df.select(id_col, array_to_vector(V.as_double(vec_col)).alias("features"))
    model = PCA(k=k, inputCol="features", outputCol="pc").fit(x)
    out = model.transform(x).select(id_col, vector_to_array("pc").alias("reduced"))
    return out, [float(v) for v in model.explainedVariance]


def gaussian_entry(seed: int, i: int, j: int) -> float:
    """Standard normal number of a place in a matrix: Box-Muller on two 52-bit pieces of a SHA-256."""
    h = hashlib.sha256(f"{seed}|{i}|{j}".encode()).hexdigest()
    u, w = (int(h[:13], 16) + 1) / 2.0 ** 52, int(h[13:26], 16) / 2.0 ** 52
    return math.sqrt(-2.0 * math.log(u)) * math.cos(2.0 * math.pi * w)


def gaussian_project(df: DataFrame, k: int, seed: int = 42, id_col: str = "id", vec_col: str = "v") -> DataFrame:
    """M6 for wide vectors: (id, reduced), v·R/√k with a Gaussian matrix R (d × k).

    An entry of R is a function of the seed and its place, so every task makes the rows that its
    vectors need and nothing is fitted, broadcast or shuffled. A squared distance is kept within
    1 ± ε with probability 1 − 2·exp(−k(ε²/4 − ε³/6)). Null vectors give null; vectors may differ in length."""
    id_type = df.schema[id_col].dataType.simpleString()

    def run(batches):
        rows: list[np.ndarray] = []
        for batch in batches:
            out = []
            for v in batch.column(1):
                if not v.is_valid:
                    out.append(None)
                    continue
                x = v.values.to_numpy(zero_copy_only=False).astype(np.float64)
                while len(rows) < len(x):
                    rows.append(np.array([gaussian_entry(seed, len(rows), j) for j in range(k)]))
                out.append((x @ np.vstack(rows[:len(x)]) if len(x) else np.zeros(k)) / math.sqrt(k))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.list_(pa.float64()))], names=[id_col, "reduced"])

    return df.select(id_col, vec_col).mapInArrow(run, f"`{id_col}` {id_type}, reduced array<double>")


# groups that one search task compares
GROUP_ROWS = 1024


def average_linkage(points: DataFrame, n_clusters: int, id_col: str = "id", vec_col: str = "v") -> DataFrame:
    """Agglomerative clustering, average linkage, cosine distance, cut at ``n_clusters``.

    Exact without a table of pairwise distances: with unit vectors û, the mean cosine
    similarity between groups A and B equals (Σ_A û)·(Σ_B û)/(|A||B|), so a group is
    a row of its sum, size, height and smallest member. In each round every
    group without a known nearest group looks for it, in tasks of GROUP_ROWS x
    GROUP_ROWS distances that return one row a group; all reciprocal
    nearest pairs merge at once, by a group-by over sums. Average linkage is
    reducible, so a group whose nearest group hasn't merged keeps it. Rounds are
    checkpointed; nothing but counts reaches the driver. The last GROUP_ROWS groups
    are merged by a single task, one nearest pair after the other. The merges, ranked by
    height, are cut after n − n_clusters, and what they tie together is a cluster.
    A null id or vector takes no part; a zero vector is at distance 1 from all.
    Returns (id, meta_id) with meta ids numbered by smallest member id.
    """
    id_type = points.schema[id_col].dataType.simpleString()
    groups = cut_lineage(points.filter(F.col(id_col).isNotNull() & F.col(vec_col).isNotNull())
                         .select(F.col(id_col).alias("g"), V.scale_by_norm(V.as_double(vec_col)).alias("s"), F.lit(1).cast("bigint").alias("n"),
                                 F.lit(0.0).alias("h"), F.lit(None).cast(id_type).alias("nn"), F.lit(None).cast("double").alias("d")))
    start, merges, number = groups, None, 0
    n = count = groups.count()
    while count > GROUP_ROWS:
        known = groups.filter(F.col("nn").isNotNull())
        groups = cut_lineage(known.unionByName(_nearest_groups(groups.filter(F.col("nn").isNull()), groups, count, id_type)))
        other = groups.select(F.col("g").alias("nn"), F.col("nn").alias("back"), F.col("h").alias("oh"))
        pairs = cut_lineage(groups.select("g", "nn", "d", "h").join(other, "nn").filter((F.col("g") == F.col("back")) & (F.col("g") < F.col("nn")))
                            .select(F.col("g").alias("a"), F.col("nn").alias("b"), F.greatest("d", "h", "oh").alias("height")))
        merged = pairs.count()
        if not merged:   # ties in the last bit only: the nearest pair of all merges
            pairs = groups.select(F.least("g", "nn").alias("a"), F.greatest("g", "nn").alias("b"), F.greatest("d", "h").alias("height"), "d").orderBy("d", "a", "b").limit(1).drop("d")
            pairs, merged = cut_lineage(pairs), 1
        rows = pairs.withColumn("round", F.lit(number))
        merges = rows if merges is None else merges.unionByName(rows)
        to = pairs.select(F.explode(F.array("a", "b")).alias("g"), F.col("a").alias("to"), "height")
        moved = groups.join(to, "g", "left")
        joined = (moved.filter(F.col("to").isNotNull()).select("to", "n", "height", F.posexplode("s").alias("pos", "x"))
                  .groupBy("to", "pos").agg(F.sum("x").alias("x"), F.sum("n").alias("n"), F.max("height").alias("h"))
                  .groupBy(F.col("to").alias("g")).agg(F.array_sort(F.collect_list(F.struct("pos", "x"))).alias("xs"), F.max("n").alias("n"), F.max("h").alias("h"))
                  .select("g", F.col("xs.x").alias("s"), "n", "h", F.lit(None).cast(id_type).alias("nn"), F.lit(None).cast("double").alias("d")))
        gone = to.select(F.col("g").alias("nn"), F.lit(True).alias("gone"))
        stay = (moved.filter(F.col("to").isNull()).drop("to", "height").join(gone, "nn", "left")
                .select("g", "s", "n", "h", F.when(F.col("gone").isNull(), F.col("nn")).alias("nn"), F.when(F.col("gone").isNull(), F.col("d")).alias("d")))
        groups = cut_lineage(stay.unionByName(joined))
        count -= merged
        number += 1
    if count > 1:
        rest = groups.select("g", "s", "n", "h").groupBy().applyInPandas(lambda pdf: _agglomerate(pdf, number), f"a {id_type}, b {id_type}, height double, round int")
        merges = cut_lineage(rest if merges is None else merges.unionByName(rest))
    ties = start.select(F.col("g").alias("a"), F.col("g").alias("b"))
    if merges is not None and n > n_clusters:
        ranked = R.global_row_number(merges, [F.col("height"), F.col("round"), F.col("a")], "_r")
        ties = ties.unionByName(ranked.filter(F.col("_r") <= n - n_clusters).select("a", "b"))
    comps = connected_components(ties, "a", "b", ONE_TASK_EDGES)
    first = R.global_row_number(comps.select("component").distinct(), [F.col("component")], "_r")
    return comps.join(first, "component").select(F.col("node").alias(id_col), (F.col("_r") - 1).cast("int").alias("meta_id"))


def _agglomerate(pdf: pd.DataFrame, number: int) -> pd.DataFrame:
    """All merges of at most GROUP_ROWS groups: always the nearest pair (ties: the smaller ids)."""
    pdf = pdf.sort_values("g")
    names, n, h = pdf["g"].to_numpy(), pdf["n"].to_numpy(dtype=np.float64), pdf["h"].to_numpy().copy()
    s = NB._stack(pdf["s"])
    d = 1.0 - (s @ s.T) / np.outer(n, n)
    d[np.tril_indices(len(n))] = np.inf
    out = []
    for step in range(len(n) - 1):
        a, b = np.unravel_index(d.argmin(), d.shape)
        h[a] = max(d[a, b], h[a], h[b])
        out.append((names[a], names[b], h[a], number + step))
        s[a] += s[b]
        n[a] += n[b]
        d[b, :] = d[:, b] = np.inf
        live = np.flatnonzero(np.isfinite(d).any(axis=0) | np.isfinite(d).any(axis=1))
        live = live[live != a]
        new = 1.0 - (s[live] @ s[a]) / (n[live] * n[a])
        d[np.minimum(live, a), np.maximum(live, a)] = new
    return pd.DataFrame(out, columns=["a", "b", "height", "round"])


def _nearest_groups(asking: DataFrame, groups: DataFrame, count: int, id_type: str) -> DataFrame:
    """The asking groups with their nearest other group (ties: the smaller id) and its distance."""
    blocks = -(-count // GROUP_ROWS)
    block = lambda c: F.pmod(F.xxhash64(c), F.lit(blocks)).cast("int")
    mean = F.zip_with("s", F.array_repeat("n", F.size("s")), lambda x, n: x / n)
    every = F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))
    left = asking.select(F.col("g").alias("g"), mean.alias("m")).withColumn("qb", block("g")).withColumn("rb", every)
    right = groups.select(F.col("g").alias("r"), mean.alias("rm")).withColumn("rb", block("r")).withColumn("qb", every)

    def fn(q: pd.DataFrame, r: pd.DataFrame) -> pd.DataFrame:
        if len(q) == 0 or len(r) == 0:
            return pd.DataFrame({"g": [], "r": [], "d": []})
        q, r = q.sort_values("g"), r.sort_values("r")
        names, others = q["g"].to_numpy(), r["r"].to_numpy()
        d = 1.0 - NB._stack(q["m"]) @ NB._stack(r["rm"]).T
        d[names[:, None] == others[None, :]] = np.inf
        at = d.argmin(axis=1)   # the first of equals: the smaller id
        return pd.DataFrame({"g": names, "r": others[at], "d": d[np.arange(len(q)), at]})

    left, right = (x.select([F.col(c).alias(c) for c in x.columns]) for x in (left, right))
    found = left.groupBy("qb", "rb").cogroup(right.groupBy("qb", "rb")).applyInPandas(fn, f"g {id_type}, r {id_type}, d double")
    best = found.filter(F.col("d") < float("inf")).groupBy("g").agg(F.min(F.struct("d", "r")).alias("m"))
    return asking.drop("nn", "d").join(best, "g").select("g", "s", "n", "h", F.col("m.r").alias("nn"), F.col("m.d").alias("d"))
