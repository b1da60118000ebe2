"""Registered queries: vector functions, neighbours and clustering."""

from __future__ import annotations

from pyspark.sql import functions as F

from quire.operators import cluster as C
from quire.operators import neighbors as NB
from quire.operators import vectors as V
from quire.plans.registry import register
from quire.sources import fixtures as FX
from quire.sources.tables import Tables

# ---- binding parameters (fixed for the registered queries) ----
KNN_K = 5
DENSITY = dict(eps=0.9, min_cluster_size=10, min_samples=3)
SOFT_THRESHOLD = 0.3
KMEANS_K = 10
PCA_K = 10
META_K = 10
META_MIN_DOCS = 5


def raw(t: Tables):
    """(vec_id, v, label): fixture embeddings as double vectors."""
    return t.embeddings.select("vec_id", V.as_double("embedding").alias("v"), "label")


def anchored(t: Tables):
    return FX.anchored(t)


RAW_SQL = "raw AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS v FROM embeddings)"
CENT_SQL = f"""{RAW_SQL},
cx AS (SELECT label, i - 1 AS pos, avg(v[i]) AS x FROM (
         SELECT label, v, unnest(generate_series(1, len(v))) AS i FROM raw) GROUP BY label, i),
cents AS (SELECT label, list(x ORDER BY pos) AS c FROM cx GROUP BY label)"""


@register("l2_normalize", f"""
WITH {RAW_SQL},
u AS (SELECT vec_id, list_transform(v, lambda z: z / sqrt(list_sum(list_transform(v, lambda w: w * w)))) AS u
      FROM raw)
SELECT vec_id, CAST(i - 1 AS INTEGER) AS pos, round(u[i], 6) AS value
FROM u, LATERAL (SELECT unnest(generate_series(1, len(u))) AS i)
""")
def l2_normalize(spark, sf):
    """unit vectors, one row per coordinate."""
    r = raw(Tables(spark, sf))
    u = r.select("vec_id", V.l2_normalize("v").alias("u"))
    return u.select("vec_id", F.posexplode("u").alias("pos", "value")).select(
        "vec_id", "pos", F.round("value", 6).alias("value"))


@register("centroids", f"""
WITH {CENT_SQL}
SELECT label, CAST(pos AS INTEGER) AS pos, round(x, 6) AS value FROM cx
""")
def centroids(spark, sf):
    """Mean vector per label (not re-normalised), one row per coordinate."""
    c = V.centroids(raw(Tables(spark, sf)), "label", "v")
    return c.select("label", F.posexplode("centroid").alias("pos", "value")).select(
        "label", "pos", F.round("value", 6).alias("value"))


@register("cosine_pairs", f"""
WITH {CENT_SQL}
SELECT r.vec_id, round(list_cosine_similarity(r.v, c.c), 6) AS cos FROM raw r JOIN cents c ON r.label = c.label
""")
def cosine_pairs(spark, sf):
    """cosine between each vector and its own label's centroid (equi-join)."""
    r = raw(Tables(spark, sf))
    c = V.centroids(r, "label", "v")
    j = r.join(c, "label")
    return j.select("vec_id", F.round(V.cosine("v", "centroid"), 6).alias("cos"))


@register("multi_assign", f"""
WITH {CENT_SQL},
s AS (SELECT r.vec_id, c.label AS cluster_id, list_cosine_similarity(r.v, c.c) AS sim FROM raw r, cents c)
SELECT vec_id, CAST(rank AS INTEGER) AS rank, cluster_id, round(sim, 6) AS score FROM (
  SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY sim DESC, cluster_id) AS rank FROM s) WHERE rank <= 3
""")
def multi_assign(spark, sf):
    """The 3 most similar centroids of every vector (broadcast centroid matrix)."""
    r = raw(Tables(spark, sf))
    c = V.centroids(r, "label", "v")
    top = V.top_centroids(r, c, 3, "vec_id", "v", "label", "centroid")
    return top.select("vec_id", "rank", F.col("label").alias("cluster_id"), F.round("sim", 6).alias("score"))


@register("multi_assign_arrays", f"""
WITH {CENT_SQL},
s AS (SELECT r.vec_id, c.label AS cluster_id, list_cosine_similarity(r.v, c.c) AS sim FROM raw r, cents c),
t AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY sim DESC, cluster_id) AS rank
                     FROM s) WHERE rank <= 3)
SELECT vec_id, array_to_string(list(cluster_id ORDER BY rank), ',') AS cluster_ids,
       array_to_string(list(printf('%.6f', sim) ORDER BY rank), ',') AS cluster_scores
FROM t GROUP BY vec_id
""")
def multi_assign_arrays(spark, sf):
    """J8 in its output contract: parallel arrays of the top-3 cluster ids and scores."""
    r = raw(Tables(spark, sf))
    top = V.top_centroids(r, V.centroids(r, "label", "v"), 3, "vec_id", "v", "label", "centroid")
    arr = V.as_parallel_arrays(top.withColumnRenamed("label", "cluster_id"), "vec_id")
    return arr.select("vec_id", F.array_join(F.col("cluster_ids").cast("array<string>"), ",").alias("cluster_ids"),
                      F.array_join(F.transform("cluster_scores", lambda x: F.format_string("%.6f", x)), ",")
                      .alias("cluster_scores"))


@register("knn_join", f"""
WITH {RAW_SQL},
p AS (SELECT a.vec_id, b.vec_id AS nbr_id, list_distance(a.v, b.v) AS d FROM raw a, raw b WHERE a.vec_id <> b.vec_id)
SELECT vec_id, CAST(rank AS INTEGER) AS rank, nbr_id, round(d, 6) AS dist FROM (
  SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY d, nbr_id) AS rank FROM p) WHERE rank <= {KNN_K}
""")
def knn_join(spark, sf):
    """Exact 5 nearest neighbours (pivot cells + pruned block pairs)."""
    nn = NB.knn(raw(Tables(spark, sf)), KNN_K, "vec_id", "v")
    return nn.select("vec_id", F.col("rank").cast("int"), F.col("nbr").alias("nbr_id"),
                     F.round("dist", 6).alias("dist"))


def density_sql(eps=0.9, min_cluster_size=10, min_samples=3) -> str:
    return f"""
p AS (SELECT a.vec_id AS i, b.vec_id AS j, list_distance(a.v, b.v) AS d FROM anchored a, anchored b
      WHERE a.vec_id <> b.vec_id),
core AS (SELECT i, d AS core FROM (SELECT i, d, row_number() OVER (PARTITION BY i ORDER BY d, j) AS rn FROM p)
         WHERE rn = {max(min_samples - 1, 1)}),
cp AS (SELECT i FROM core WHERE core <= {eps}),
edges AS (SELECT p.i, p.j FROM p JOIN cp ci ON p.i = ci.i JOIN cp cj ON p.j = cj.i WHERE p.d <= {eps}),
reach(node, lab) AS (SELECT i, i FROM cp UNION SELECT e.j, r.lab FROM reach r JOIN edges e ON r.node = e.i),
comp AS (SELECT node, min(lab) AS comp FROM reach GROUP BY node),
sizes AS (SELECT comp, count(*) AS n FROM comp GROUP BY comp HAVING count(*) >= {min_cluster_size}),
ren AS (SELECT comp, row_number() OVER (ORDER BY n DESC, comp) - 1 AS cid FROM sizes),
labels AS (SELECT a.vec_id, CAST(coalesce(ren.cid, -1) AS INTEGER) AS cluster_id
           FROM anchored a LEFT JOIN comp ON a.vec_id = comp.node LEFT JOIN ren ON comp.comp = ren.comp)
"""


CUTS = (0.9, 0.8)
DENSITY_QUANTILE = 0.6


def cuts_sql(cuts: str) -> str:
    """Flat cuts at all radii of a table cuts(eps), from the pair distances."""
    return f"""
WITH RECURSIVE p AS (SELECT a.vec_id AS i, b.vec_id AS j, list_distance(a.v, b.v) AS d FROM anchored a, anchored b
      WHERE a.vec_id <> b.vec_id),
core AS (SELECT i, d AS core FROM (SELECT i, d, row_number() OVER (PARTITION BY i ORDER BY d, j) AS rn FROM p)
         WHERE rn = {max(DENSITY['min_samples'] - 1, 1)}),
cuts AS ({cuts}),
cp AS (SELECT eps, i FROM core, cuts WHERE core <= eps),
edges AS (SELECT ci.eps, p.i, p.j FROM p JOIN cp ci ON p.i = ci.i JOIN cp cj ON p.j = cj.i AND ci.eps = cj.eps
          WHERE p.d <= ci.eps),
reach(eps, node, lab) AS (SELECT eps, i, i FROM cp
                          UNION SELECT e.eps, e.j, r.lab FROM reach r JOIN edges e ON r.node = e.i AND r.eps = e.eps),
comp AS (SELECT eps, node, min(lab) AS comp FROM reach GROUP BY eps, node),
sizes AS (SELECT eps, comp, count(*) AS n FROM comp GROUP BY eps, comp HAVING count(*) >= {DENSITY['min_cluster_size']}),
ren AS (SELECT eps, comp, row_number() OVER (PARTITION BY eps ORDER BY n DESC, comp) - 1 AS cid FROM sizes)
SELECT round(cuts.eps, 6) AS eps, a.vec_id, CAST(coalesce(ren.cid, -1) AS INTEGER) AS cluster_id
FROM anchored a CROSS JOIN cuts LEFT JOIN comp ON a.vec_id = comp.node AND cuts.eps = comp.eps
LEFT JOIN ren ON comp.comp = ren.comp AND cuts.eps = ren.eps
"""


DENSITY_SQL = density_sql(**DENSITY)
ASSIGN_SQL = DENSITY_SQL.strip() + """,
ax AS (SELECT a.vec_id, a.v, l.cluster_id FROM anchored a JOIN labels l ON a.vec_id = l.vec_id),
cx AS (SELECT cluster_id, i, avg(v[i]) AS x FROM (
         SELECT cluster_id, v, unnest(generate_series(1, len(v))) AS i FROM ax WHERE cluster_id <> -1)
       GROUP BY cluster_id, i),
cents AS (SELECT cluster_id, list(x ORDER BY i) AS c FROM cx GROUP BY cluster_id),
best AS (SELECT vec_id, cluster_id, sim FROM (
           SELECT n.vec_id, c.cluster_id, list_cosine_similarity(n.v, c.c) AS sim,
                  row_number() OVER (PARTITION BY n.vec_id ORDER BY list_cosine_similarity(n.v, c.c) DESC,
                                     c.cluster_id) AS rk
           FROM ax n, cents c WHERE n.cluster_id = -1) WHERE rk = 1)
"""


def _density_labels(t: Tables):
    return C.density_cluster(anchored(t), id_col="vec_id", vec_col="v", **DENSITY)


@register("density_cluster", f"WITH RECURSIVE {DENSITY_SQL.strip()} SELECT vec_id, cluster_id FROM labels",
          ("anchored",))
def density_cluster(spark, sf):
    """M7: DBSCAN* labels (−1 = noise) on the anchored vectors."""
    return _density_labels(Tables(spark, sf))


@register("density_cuts", cuts_sql("SELECT unnest([" + ", ".join(f"{c}::DOUBLE" for c in CUTS) + "]) AS eps"), ("anchored",))
def density_cuts(spark, sf):
    """M7: two flat cuts of one minimum spanning tree of mutual reachability."""
    t = Tables(spark, sf)
    tree = C.density_tree(anchored(t), max(CUTS), DENSITY["min_samples"], id_col="vec_id", vec_col="v")
    out = [C.flat_cut(tree, eps, DENSITY["min_cluster_size"], "vec_id").select(F.lit(eps).alias("eps"), "vec_id", "cluster_id") for eps in CUTS]
    return out[0].unionByName(out[1])


@register("density_quantile", cuts_sql(f"SELECT quantile_disc(core, {DENSITY_QUANTILE}) AS eps FROM core"), ("anchored",))
def density_quantile(spark, sf):
    """M7 with its radius from a quantile of the core distances."""
    t = Tables(spark, sf)
    tree = C.density_tree(anchored(t), None, DENSITY["min_samples"], DENSITY_QUANTILE, "vec_id", "v", forest=False)
    cut = C.flat_cut(tree, tree.eps, DENSITY["min_cluster_size"], "vec_id")
    return cut.select(F.round(F.lit(tree.eps), 6).alias("eps"), "vec_id", "cluster_id")


@register("noise_assign", f"""
WITH RECURSIVE {ASSIGN_SQL.strip()}
SELECT vec_id, cluster_id, round(sim, 6) AS sim FROM best
""", ("anchored",))
def noise_assign(spark, sf):
    """Nearest centroid (cosine argmax) of every noise row."""
    t = Tables(spark, sf)
    h = C.hybrid_cluster(anchored(t), _density_labels(t), "vec_id", "v")
    return h.filter("from_noise").select("vec_id", "cluster_id", F.round("sim", 6).alias("sim"))


@register("hybrid_cluster", f"""
WITH RECURSIVE {ASSIGN_SQL.strip()}
SELECT l.vec_id, CAST(coalesce(b.cluster_id, l.cluster_id) AS INTEGER) AS cluster_id
FROM labels l LEFT JOIN best b ON l.vec_id = b.vec_id
""", ("anchored",))
def hybrid_cluster(spark, sf):
    """M9: density clusters with every noise row moved to its nearest centroid."""
    t = Tables(spark, sf)
    return C.hybrid_cluster(anchored(t), _density_labels(t), "vec_id", "v").select("vec_id", "cluster_id")


@register("soft_assign", f"""
WITH RECURSIVE {ASSIGN_SQL.strip()}
SELECT l.vec_id, CAST(CASE WHEN l.cluster_id <> -1 THEN l.cluster_id
                           WHEN b.sim >= {SOFT_THRESHOLD} THEN b.cluster_id ELSE -999 END AS INTEGER) AS cluster
FROM labels l LEFT JOIN best b ON l.vec_id = b.vec_id
""", ("anchored",))
def soft_assign(spark, sf):
    """M8: noise rows joined to the nearest centroid only above a cosine threshold, else −999."""
    t = Tables(spark, sf)
    return C.soft_assign(anchored(t), _density_labels(t), SOFT_THRESHOLD, "vec_id", "v")


@register("kmeans_fit")
def kmeans_fit(spark, sf):
    """MLlib k-means|| with seeded restarts (lowest cost kept)."""
    assign, _centers, _cost = C.kmeans_fit(raw(Tables(spark, sf)), KMEANS_K, seed=42, n_init=10,
                                           id_col="vec_id", vec_col="v")
    return assign


@register("pca_reduce")
def pca_reduce(spark, sf):
    """M6: PCA to 10 dimensions (distributed covariance)."""
    out, _ev = C.pca_reduce(raw(Tables(spark, sf)), PCA_K, "vec_id", "v")
    return out


PROJECT_K, PROJECT_SEED = 16, 42


@register("gaussian_project", f"""
WITH {RAW_SQL},
places AS (SELECT i, j, sha256('{PROJECT_SEED}|' || i || '|' || j) AS h
           FROM (SELECT unnest(range((SELECT max(len(v)) FROM raw))) AS i), (SELECT unnest(range({PROJECT_K})) AS j)),
r AS (SELECT i, j, sqrt(-2 * ln((CAST('0x' || substr(h, 1, 13) AS BIGINT) + 1) / 2.0::DOUBLE ^ 52))
                   * cos(2 * pi() * (CAST('0x' || substr(h, 14, 13) AS BIGINT) / 2.0::DOUBLE ^ 52)) AS z FROM places),
cells AS (SELECT vec_id, unnest(v) AS x, generate_subscripts(v, 1) - 1 AS i FROM raw)
SELECT vec_id, CAST(j AS INTEGER) AS pos, round(sum(x * z) / sqrt({PROJECT_K}), 6) AS value FROM cells JOIN r USING (i) GROUP BY vec_id, j
""")
def gaussian_project(spark, sf):
    """M6: seeded Gaussian projection to 16 dimensions, its matrix made from hashes."""
    p = C.gaussian_project(raw(Tables(spark, sf)), PROJECT_K, PROJECT_SEED, "vec_id", "v")
    return p.select("vec_id", F.posexplode("reduced").alias("pos", "value")).select("vec_id", "pos", F.round("value", 6).alias("value"))


#: One merge of the two groups of least mean distance a step; ties go to the smaller ids.
META_CLUSTER_SQL = f"""
WITH RECURSIVE vbase AS (
  SELECT e.vec_id, CAST(e.label AS BIGINT) * 10 + coalesce(list_position(['de', 'en', 'es', 'fr'], d.lang), 0) AS base_id,
         CAST(e.embedding AS DOUBLE[]) AS v
  FROM embeddings e JOIN documents d ON e.vec_id = d.doc_id),
cx AS (SELECT base_id, i, avg(v[i] / sqrt(list_sum(list_transform(v, lambda w: w * w)))) AS x
       FROM (SELECT base_id, v, unnest(generate_series(1, len(v))) AS i FROM vbase
             WHERE base_id IN (SELECT base_id FROM vbase GROUP BY base_id HAVING count(*) >= {META_MIN_DOCS}))
       GROUP BY base_id, i),
mcents AS (SELECT base_id, list(x ORDER BY i) AS c FROM cx GROUP BY base_id),
mp AS (SELECT a.base_id AS i, b.base_id AS j, 1 - list_cosine_similarity(a.c, b.c) AS d FROM mcents a, mcents b),
st(t, base_id, g) AS (
  SELECT 0, base_id, base_id FROM mcents
  UNION ALL
  SELECT st.t + 1, st.base_id, CASE WHEN st.g = m.b THEN m.a ELSE st.g END
  FROM st, (SELECT x.g AS a, y.g AS b FROM st x JOIN st y ON x.g < y.g JOIN mp ON mp.i = x.base_id AND mp.j = y.base_id
            GROUP BY x.g, y.g ORDER BY avg(mp.d), x.g, y.g LIMIT 1) m),
cut AS (SELECT base_id, g FROM st WHERE t = (SELECT greatest(count(*) - {META_K}, 0) FROM mcents)),
meta AS (SELECT base_id, dense_rank() OVER (ORDER BY g) - 1 AS meta_id FROM cut)
"""


@register("meta_cluster", META_CLUSTER_SQL + "SELECT base_id, CAST(meta_id AS INTEGER) AS meta_id FROM meta")
def meta_cluster(spark, sf):
    """Average-linkage (cosine) meta-clusters of base-cluster centroids of
    unit vectors; base clusters with fewer than 5 posts are skipped."""
    t = Tables(spark, sf)
    b = _base(t)
    u = b.select("base_id", V.l2_normalize("v").alias("u"))
    cents = V.centroids(u, "base_id", "u").filter(F.col("n") >= META_MIN_DOCS)
    return C.average_linkage(cents.select("base_id", "centroid"), META_K, "base_id", "centroid")


LANG_RANK = {"de": 1, "en": 2, "es": 3, "fr": 4}


def _base(t: Tables):
    """(vec_id, v, base_id, text): base cluster = label × language of the post."""
    docs = t.documents.select(F.col("doc_id").alias("vec_id"), "lang", "text")
    x = raw(t).join(docs, "vec_id")
    lang_no = F.coalesce(F.array_position(F.array(*[F.lit(k) for k in sorted(LANG_RANK)]), F.col("lang")),
                         F.lit(0)).cast("bigint")
    return x.withColumn("base_id", F.col("label").cast("bigint") * 10 + lang_no)
