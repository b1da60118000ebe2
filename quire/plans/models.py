"""Registered queries: LM encoding, hash embedding, MMR, topic labels, generation, meta topics."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from quire.operators import cluster as C
from quire.operators import keywords as K
from quire.operators import models as M
from quire.operators import relational as R
from quire.operators import trainset as TS
from quire.operators import vectors as V
from quire.plans import sqlfrag as Q
from quire.plans.corpus import SQL_TRAINING, scored_corpus
from quire.plans.keywords import INSPECT_SQL, sql_tfidf
from quire.plans.registry import register
from quire.plans.vectors import META_CLUSTER_SQL, META_K, META_MIN_DOCS, _base
from quire.sources import fixtures as FX
from quire.session import cut_lineage
from quire.sources.tables import Tables

TOK_SQL = "regexp_extract_all(lower({x}), '([\\pL\\pN_]{{2,}})', 1)"
L = M.MAX_LEN


@register("lm_tokenize", SQL_TRAINING + f""",
tt AS (SELECT doc_id, {TOK_SQL.format(x='text')} AS tk FROM texts),
vocab AS (SELECT term, row_number() OVER (ORDER BY cnt DESC, term) AS token_id FROM (
            SELECT term, count(*) AS cnt FROM (SELECT unnest(tk) AS term FROM tt) GROUP BY term)),
ids AS (SELECT doc_id, list(token_id ORDER BY pos) AS ids FROM (
          SELECT doc_id, i AS pos, tk[i] AS term FROM tt,
                 LATERAL (SELECT unnest(generate_series(1, least(len(tk), {L}))) AS i)) x
        JOIN vocab USING (term) GROUP BY doc_id),
enc AS (SELECT t.doc_id, coalesce(ids, []) AS ids FROM texts t LEFT JOIN ids USING (doc_id))
SELECT doc_id, CAST(len(ids) AS INTEGER) AS n_tokens,
       array_to_string(list_transform(range({L}), lambda i: coalesce(ids[i + 1], 0)), ',') AS input_ids,
       array_to_string(list_transform(range({L}), lambda i: CASE WHEN i < len(ids) THEN 1 ELSE 0 END), ',')
         AS attention_mask,
       array_to_string(list_transform(range({L}), lambda i: coalesce(ids[i + 1], -100)), ',') AS labels
FROM enc
""", ("votes_by_text", "topic_corpus"))
def lm_tokenize(spark, sf):
    """Training texts → fixed-length ids / mask / labels (pad masked to −100)."""
    # read by the vocabulary and the encoder: written once to the checkpoint folder
    ts = cut_lineage(TS.training_set(scored_corpus(Tables(spark, sf))).select("doc_id", "text"))
    enc = M.lm_encode(ts, "doc_id", "text", M.build_vocab(ts, "text"))
    j = lambda c: F.array_join(F.col(c).cast("array<string>"), ",")
    return enc.select("doc_id", "n_tokens", j("input_ids").alias("input_ids"),
                      j("attention_mask").alias("attention_mask"), j("labels").alias("labels"))


@register("embed_hash", f"""
WITH t AS (SELECT doc_id, unnest({TOK_SQL.format(x='text')}) AS term FROM documents),
b AS (SELECT doc_id, CAST('0x' || substr(sha256(term), 1, 8) AS BIGINT) % 64 AS pos,
             sum(CASE WHEN CAST('0x' || substr(sha256(term), 9, 1) AS BIGINT) % 2 = 0 THEN 1.0 ELSE -1.0 END) AS x
      FROM t GROUP BY doc_id, pos),
n AS (SELECT doc_id, sqrt(sum(x * x)) AS nrm FROM b GROUP BY doc_id)
SELECT b.doc_id, CAST(pos AS INTEGER) AS pos, round(x / nrm, 6) AS value FROM b JOIN n USING (doc_id) WHERE x <> 0
""")
def embed_hash(spark, sf):
    """M5 default encoder: signed hashing of word tokens to 64 dims, unit length."""
    d = Tables(spark, sf).documents
    e = M.hash_embed(d, "doc_id", "text", 64)
    x = e.select("doc_id", F.posexplode("embedding").alias("pos", "value"))
    return x.filter(F.col("value") != 0).select("doc_id", "pos", F.round("value", 6).alias("value"))


MMR = dict(first_docs=30, top_n=15, diversity=0.5)


def mmr_sql(first_docs: int, top_n: int, diversity: float) -> str:
    """Greedy choice a step: of each cluster the free term of best score, then every term's nearest chosen one."""
    return f"""
WITH RECURSIVE f AS (SELECT * FROM (SELECT cluster_id AS c, text,
         row_number() OVER (PARTITION BY cluster_id ORDER BY doc_id) AS rn FROM clustered WHERE cluster_id <> -1) WHERE rn <= {first_docs}),
t AS (SELECT c, rn, term, count(*) AS tf FROM (SELECT c, rn, unnest({TOK_SQL.format(x='text')}) AS term FROM f) GROUP BY ALL),
grid AS (SELECT c, term, rn FROM (SELECT DISTINCT c, term FROM t), (SELECT unnest(range(1, {first_docs} + 1)) AS rn)),
x AS (SELECT c, term, list(CAST(coalesce(tf, 0) AS DOUBLE) ORDER BY rn) AS v FROM grid LEFT JOIN t USING (c, term, rn) GROUP BY c, term),
whole AS (SELECT c, list(s ORDER BY rn) AS w FROM (SELECT c, rn, CAST(sum(coalesce(tf, 0)) AS DOUBLE) AS s FROM grid LEFT JOIN t USING (c, term, rn) GROUP BY c, rn) GROUP BY c),
st(step, c, term, v, rel, near, rank) AS (
  SELECT 0, c, term, v, list_cosine_similarity(v, w), CAST(NULL AS DOUBLE), CAST(NULL AS INTEGER) FROM x JOIN whole USING (c)
  UNION ALL
  SELECT st.step + 1, st.c, st.term, st.v, st.rel, greatest(coalesce(st.near, -1), list_cosine_similarity(st.v, b.v)),
         CASE WHEN st.term = b.term THEN st.step + 1 ELSE st.rank END
  FROM st JOIN (SELECT c, term, v FROM (SELECT c, term, v, row_number() OVER (PARTITION BY c ORDER BY
                  round(CASE WHEN near IS NULL THEN rel ELSE {1 - diversity} * rel - {diversity} * near END, 9) DESC, term) AS k
                FROM st WHERE rank IS NULL) WHERE k = 1) b ON st.c = b.c
  WHERE st.step < {top_n})
SELECT c AS cluster_id, rank, term FROM st WHERE step = (SELECT max(s.step) FROM st s WHERE s.c = st.c) AND rank IS NOT NULL
"""


@register("mmr_keywords", mmr_sql(**MMR), ("clustered",))
def mmr_keywords(spark, sf):
    """15 diverse keywords per cluster (MMR, diversity 0.5) from its first 30 posts."""
    c = FX.clustered(Tables(spark, sf)).filter(F.col("cluster_id") != FX.NOISE)
    return M.mmr_keywords(c, "cluster_id", "doc_id", "text", **MMR)


def _inspect_kw(t: Tables):
    top = K.inspect_keywords(FX.clustered(t))
    return top.groupBy("cluster_id").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("rank", "term"))), lambda s: s["term"]).alias("keywords"))


LABEL_SQL = f"""
WITH {INSPECT_SQL.strip()},
kw AS (SELECT c AS cluster_id, list(term ORDER BY rank) AS keywords FROM top GROUP BY c),
pr AS (SELECT cluster_id, keywords, {Q.q(M.LABEL_PROMPT_HEAD)} || array_to_string(keywords, ', ')
              || {Q.q(M.LABEL_PROMPT_TAIL)} AS prompt FROM kw)
"""


@register("label_prompt", LABEL_SQL + "SELECT cluster_id, prompt FROM pr", ("clustered",))
def label_prompt(spark, sf):
    """topic-labelling prompt from each cluster's keywords."""
    kw = _inspect_kw(Tables(spark, sf))
    return kw.select("cluster_id", M.label_prompt(F.col("keywords")).alias("prompt"))


@register("label_topics_stub", LABEL_SQL + f"""
, gen AS (SELECT cluster_id, keywords,
                 prompt || ' ' || array_to_string(list_reverse(string_split_regex({Q.strip('prompt')},
                                                                                  {Q.q(Q.WS + '+')})), ' ') AS out
          FROM pr),
parsed AS (SELECT cluster_id, keywords, {Q.strip("string_split(out, 'Tema:')[-1]")} AS t FROM gen)
SELECT cluster_id, coalesce(nullif(t, ''), keywords[1], 'Misc') AS topic FROM parsed
""", ("clustered",))
def label_topics_stub(spark, sf):
    """Keywords → prompt → (stub) model → parsed topic, fallback first keyword / 'Misc'."""
    return M.label_topics(_inspect_kw(Tables(spark, sf)), "cluster_id", "keywords")


@register("label_parse", f"""
SELECT a.conv_id, a.turn,
       coalesce(nullif({Q.strip("string_split(a.text, 'Tema:')[-1]")}, ''),
                {TOK_SQL.format(x='u.text')}[1]) AS label
FROM conversations a JOIN conversations u ON u.conv_id = a.conv_id AND u.turn = a.turn - 1
WHERE a.role = 'assistant' AND u.role = 'user'
""")
def label_parse(spark, sf):
    """label = text after the last 'Tema:' of a model answer, else the prompt's first keyword."""
    c = Tables(spark, sf).conversations
    a = c.filter(F.col("role") == "assistant").select("conv_id", "turn", F.col("text").alias("out"))
    u = c.filter(F.col("role") == "user").select("conv_id", (F.col("turn") + 1).alias("turn"),
                                                 M.word_tokens(F.col("text")).alias("kws"))
    j = a.join(u, ["conv_id", "turn"])
    return j.select("conv_id", "turn", M.label_parse(F.col("out"), F.col("kws")).alias("label"))


@register("generate_stub")
def generate_stub(spark, sf):
    """Batched (chunked) generation harness over the user prompts, with
    the ``### SAMPLE i`` report block per prompt (stub model)."""
    c = Tables(spark, sf).conversations.filter(F.col("role") == "user")
    p = c.select((F.col("conv_id") * 100 + F.col("turn")).alias("prompt_id"), F.col("text").alias("prompt"))
    g = M.generate(p, "prompt", "prompt_id", chunked=True)
    g = R.global_row_number(g, [F.col("prompt_id")], "sample_no")
    block = F.concat(F.lit("### SAMPLE "), F.col("sample_no").cast("string"), F.lit("\n"), F.col("prompt"),
                     F.lit("\n"), F.col("continuation"), F.lit("\n"))
    return g.select("prompt_id", "sample_no", "continuation", block.alias("block"))


# ------------------------------------------------------- meta topics --

BASE_SQL = """
base AS (SELECT CAST(e.label AS BIGINT) * 10 + CASE d.lang WHEN 'de' THEN 1 WHEN 'en' THEN 2 WHEN 'es' THEN 3
                     WHEN 'fr' THEN 4 ELSE 0 END AS base_id, d.doc_id, d.text, e.label
         FROM embeddings e JOIN documents d ON e.vec_id = d.doc_id)
"""
def meta_sql(groups: str) -> str:
    """Keywords of base clusters and names of their meta clusters; ``groups``: base_id, meta_id, n of base clusters."""
    return f"""
{BASE_SQL.strip()},
{sql_tfidf(f"SELECT base_id AS c, doc_id AS d, {Q.strip('text')} AS t FROM base", K.TAG_STOPWORDS,
           2, None, 100, 3, 1).strip()},
kw AS (SELECT c, string_agg(term, '_' ORDER BY rank) AS kw FROM top GROUP BY c),
bs AS ({groups}),
bk AS (SELECT bs.base_id, bs.meta_id, coalesce(nullif(kw.kw, ''), 'TOPIC_' || CAST(bs.base_id AS VARCHAR)) AS keyword,
              row_number() OVER (PARTITION BY bs.meta_id ORDER BY bs.base_id) AS crank
       FROM bs LEFT JOIN kw ON bs.base_id = kw.c),
mtoks AS (SELECT meta_id, crank, tok, tpos FROM (
           SELECT meta_id, crank, unnest(string_split(keyword, '_')) AS tok,
                  unnest(generate_series(1, len(string_split(keyword, '_')))) AS tpos FROM bk) WHERE tok <> ''),
freq AS (SELECT meta_id, tok, count(*) AS cnt, min(crank * 100000 + tpos) AS first FROM mtoks GROUP BY meta_id, tok),
top3 AS (SELECT meta_id, string_agg(tok, '_' ORDER BY r) AS name FROM (
           SELECT *, row_number() OVER (PARTITION BY meta_id ORDER BY cnt DESC, first) AS r FROM freq) WHERE r <= 3
         GROUP BY meta_id),
names AS (SELECT m.meta_id, CASE WHEN t.name IS NOT NULL AND t.name <> '' THEN 'TOPIC_' || upper(t.name)
                                 ELSE 'TOPIC_' || CAST(m.meta_id AS VARCHAR) END AS meta_topic
          FROM (SELECT DISTINCT meta_id FROM bk) m LEFT JOIN top3 t ON m.meta_id = t.meta_id)
"""


META_SQL = "WITH " + meta_sql(f"""SELECT base_id, any_value(label) AS meta_id, count(*) AS n FROM base GROUP BY base_id
       HAVING count(*) >= {META_MIN_DOCS}""")


def _meta_keywords(t: Tables):
    """(base_id, meta_id, keyword, crank) for base clusters with ≥ 5 posts; meta id = label."""
    b = _base(t)
    docs = b.select(F.col("base_id").alias("cluster_id"), F.col("vec_id").alias("doc_id"), "text")
    kw = K.tag_keywords(docs)
    bs = b.groupBy("base_id").agg(F.first("label").alias("meta_id"), F.count(F.lit(1)).alias("n")).filter(
        F.col("n") >= META_MIN_DOCS)
    bk = bs.join(kw.withColumnRenamed("cluster_id", "base_id"), "base_id", "left")
    bk = bk.select("base_id", "meta_id", F.coalesce(F.nullif("keyword", F.lit("")), F.concat(
        F.lit("TOPIC_"), F.col("base_id").cast("string"))).alias("keyword"))
    return bk.withColumn("crank", F.row_number().over(Window.partitionBy("meta_id").orderBy("base_id")))


def meta_names(bk):
    """Top-3 keyword tokens per meta cluster → TOPIC_ name."""
    toks = bk.select("meta_id", "crank", F.posexplode(F.split("keyword", "_")).alias("tpos", "tok")).filter(
        F.col("tok") != "")
    freq = toks.groupBy("meta_id", "tok").agg(F.count(F.lit(1)).alias("cnt"),
                                              F.min(F.struct("crank", "tpos")).alias("first"))
    top = R.first_n_per_group(freq, "meta_id", [F.col("cnt").desc(), F.col("first")], 3, "r")
    name = top.groupBy("meta_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("r", "tok"))),
                                                               lambda s: s["tok"]), "_").alias("name"))
    metas = bk.select("meta_id").distinct().join(name, "meta_id", "left")
    return metas.select("meta_id", F.when(F.col("name").isNotNull() & (F.col("name") != ""),
                                          F.concat(F.lit("TOPIC_"), F.upper("name")))
                        .otherwise(F.concat(F.lit("TOPIC_"), F.col("meta_id").cast("string"))).alias("meta_topic"))


@register("meta_topic_names", META_SQL + """
SELECT n.meta_id, n.meta_topic, CAST(count(*) AS BIGINT) AS num_clusters,
       string_agg(CAST(bk.base_id AS VARCHAR), ',' ORDER BY bk.base_id) AS clusters
FROM names n JOIN bk ON n.meta_id = bk.meta_id GROUP BY n.meta_id, n.meta_topic
""")
def meta_topic_names(spark, sf):
    """Meta topic name, cluster count and member list per meta cluster."""
    bk = _meta_keywords(Tables(spark, sf))
    names = meta_names(bk)
    g = bk.groupBy("meta_id").agg(F.count(F.lit(1)).alias("num_clusters"), F.array_join(
        F.array_sort(F.collect_list("base_id")).cast("array<string>"), ",").alias("clusters"))
    return names.join(g, "meta_id").select("meta_id", "meta_topic", "num_clusters", "clusters")


@register("meta_topic_map", META_SQL + """
SELECT bk.base_id AS cluster_id, bk.meta_id, n.meta_topic FROM bk JOIN names n ON bk.meta_id = n.meta_id
""")
def meta_topic_map(spark, sf):
    """Base cluster → meta topic mapping."""
    bk = _meta_keywords(Tables(spark, sf))
    return bk.join(meta_names(bk), "meta_id").select(F.col("base_id").alias("cluster_id"), "meta_id", "meta_topic")


@register("meta_cluster_named", META_CLUSTER_SQL.rstrip() + "," + meta_sql("""SELECT base.base_id, any_value(CAST(meta.meta_id AS INTEGER)) AS meta_id, count(*) AS n
FROM base JOIN meta ON base.base_id = meta.base_id GROUP BY base.base_id""") + """
SELECT bk.base_id AS cluster_id, bk.meta_id, n.meta_topic FROM bk JOIN names n ON bk.meta_id = n.meta_id
""")
def meta_cluster_named(spark, sf):
    """M11 + M12: average-linkage meta clusters of the base-cluster centroids, named by their keywords."""
    t = Tables(spark, sf)
    b = _base(t)
    u = b.select("base_id", V.l2_normalize("v").alias("u"))
    cents = V.centroids(u, "base_id", "u").filter(F.col("n") >= META_MIN_DOCS)
    meta = C.average_linkage(cents.select("base_id", "centroid"), META_K, "base_id", "centroid")
    bk = _meta_keywords(t).drop("meta_id", "crank").join(meta, "base_id")
    bk = bk.withColumn("crank", F.row_number().over(Window.partitionBy("meta_id").orderBy("base_id")))
    return bk.join(meta_names(bk), "meta_id").select(F.col("base_id").alias("cluster_id"), "meta_id", "meta_topic")

# ------------------------------------------------- text to clusters --

TEXT_CLUSTERS = dict(dims=64, reduced=16, seed=42, quantile=0.5, min_cluster_size=10, min_samples=3)


def text_clusters_sql(dims: int, reduced: int, seed: int, quantile: float, min_cluster_size: int, min_samples: int) -> str:
    return f"""
WITH RECURSIVE t AS (SELECT doc_id, unnest({TOK_SQL.format(x='text')}) AS term FROM documents),
b AS (SELECT doc_id, CAST('0x' || substr(sha256(term), 1, 8) AS BIGINT) % {dims} AS pos,
             sum(CASE WHEN CAST('0x' || substr(sha256(term), 9, 1) AS BIGINT) % 2 = 0 THEN 1.0::DOUBLE ELSE -1.0 END) AS x
      FROM t GROUP BY doc_id, pos),
e0 AS (SELECT doc_id AS id, list(coalesce(x, 0.0) ORDER BY pos) AS v
       FROM (SELECT doc_id, unnest(range({dims})) AS pos FROM documents) LEFT JOIN b USING (doc_id, pos) GROUP BY doc_id),
e AS (SELECT id, CASE WHEN list_sum(list_transform(v, lambda w: w * w)) > 0
                      THEN list_transform(v, lambda z: z / sqrt(list_sum(list_transform(v, lambda w: w * w)))) ELSE v END AS v FROM e0),
places AS (SELECT i, j, sha256('{seed}|' || i || '|' || j) AS h FROM (SELECT unnest(range({dims})) AS i), (SELECT unnest(range({reduced})) AS j)),
r AS (SELECT i, j, sqrt(-2 * ln((CAST('0x' || substr(h, 1, 13) AS BIGINT) + 1) / 2.0::DOUBLE ^ 52))
                   * cos(2 * pi() * (CAST('0x' || substr(h, 14, 13) AS BIGINT) / 2.0::DOUBLE ^ 52)) AS z FROM places),
cells AS (SELECT id, unnest(v) AS x, generate_subscripts(v, 1) - 1 AS i FROM e),
red AS (SELECT id, list(y ORDER BY j) AS v FROM (SELECT id, j, sum(x * z) / sqrt({reduced}) AS y FROM cells JOIN r USING (i) GROUP BY id, j) GROUP BY id),
p AS (SELECT a.id AS i, b.id AS j, list_distance(a.v, b.v) AS d FROM red a, red b WHERE a.id <> b.id),
core AS (SELECT i, d AS core FROM (SELECT i, d, row_number() OVER (PARTITION BY i ORDER BY d, j) AS rn FROM p) WHERE rn = {max(min_samples - 1, 1)}),
q AS (SELECT quantile_disc(core, {quantile}) AS eps FROM core),
cp AS (SELECT i FROM core, q WHERE core <= eps + 1e-9),
edges AS (SELECT p.i, p.j FROM p JOIN cp ci ON p.i = ci.i JOIN cp cj ON p.j = cj.i, q WHERE p.d <= eps + 1e-9),
reach(node, lab) AS (SELECT i, i FROM cp UNION SELECT e.j, r.lab FROM reach r JOIN edges e ON r.node = e.i),
comp AS (SELECT node, min(lab) AS comp FROM reach GROUP BY node),
sizes AS (SELECT comp, count(*) AS n FROM comp GROUP BY comp HAVING count(*) >= {min_cluster_size}),
ren AS (SELECT comp, row_number() OVER (ORDER BY n DESC, comp) - 1 AS cid FROM sizes),
labels AS (SELECT e.id, e.v, CAST(coalesce(ren.cid, -1) AS INTEGER) AS cluster_id
           FROM e LEFT JOIN comp ON e.id = comp.node LEFT JOIN ren ON comp.comp = ren.comp)
SELECT l.id AS doc_id, CAST(l.cluster_id AS INTEGER) AS density_id FROM labels l
"""


@register("text_clusters", text_clusters_sql(**TEXT_CLUSTERS))
def text_clusters(spark, sf):
    """Text to clusters as one job: hash embedding, Gaussian projection, density clusters with a radius by quantile."""
    o = TEXT_CLUSTERS
    d = Tables(spark, sf).documents
    e = cut_lineage(M.hash_embed(d, "doc_id", "text", o["dims"]).withColumnRenamed("embedding", "v"))
    low = cut_lineage(C.gaussian_project(e, o["reduced"], o["seed"], "doc_id", "v").withColumnRenamed("reduced", "v"))
    tree = C.density_tree(low, None, o["min_samples"], o["quantile"], "doc_id", "v", forest=False, slack=1e-9)
    return C.flat_cut(tree, tree.eps, o["min_cluster_size"], "doc_id").select("doc_id", F.col("cluster_id").alias("density_id"))
