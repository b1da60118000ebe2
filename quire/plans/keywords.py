"""Registered queries: terms, TF-IDF keywords, cluster inspection / summary / report."""

from __future__ import annotations

from pyspark.sql import functions as F

from quire.functions import text as T
from quire.operators import keywords as K
from quire.operators import relational as R
from quire.operators import topics as TP
from quire.plans import sqlfrag as Q
from quire.plans.registry import register
from quire.session import scratch_path
from quire.sources import fixtures as FX
from quire.sources.tables import Tables


def _stops_sql(words) -> str:
    return "[" + ", ".join(Q.q(w) for w in dict.fromkeys(words)) + "]"


def sql_terms(docs_cte: str, stops) -> str:
    """CTEs toks/grams/tf over a docs CTE (c, d, t)."""
    return f"""
toks AS (SELECT c, d, list_filter(regexp_extract_all(lower(t), '([\\pL\\pN_]{{2,}})', 1),
                                  lambda x: NOT list_contains({_stops_sql(stops)}, x)) AS tk FROM {docs_cte}),
grams AS (SELECT c, d, list_concat(tk, list_transform(generate_series(1, len(tk) - 1),
                                                      lambda i: tk[i] || ' ' || tk[i + 1])) AS g FROM toks),
tf AS (SELECT c, d, term, count(*) AS tf FROM (SELECT c, d, unnest(g) AS term FROM grams) GROUP BY c, d, term)
"""


def sql_tfidf(docs_sql: str, stops, min_df: int, max_df: float | None, max_features: int, top_k: int,
              min_docs: int) -> str:
    """CTE chain ending in ``top(c, term, score, rank)``."""
    maxdf = f"AND df <= {max_df} * n" if max_df is not None else ""
    return f"""
alld AS ({docs_sql}),
sizes AS (SELECT c, count(*) AS n FROM alld GROUP BY c HAVING count(*) >= {min_docs}),
docs AS (SELECT * FROM alld WHERE c IN (SELECT c FROM sizes)),
{sql_terms('docs', stops).strip()},
stats AS (SELECT tf.c, term, count(*) AS df, sum(tf) AS cf, any_value(s.n) AS n
          FROM tf JOIN sizes s ON tf.c = s.c GROUP BY tf.c, term),
vocab AS (SELECT c, term, n, ln((1.0 + n) / (1.0 + df)) + 1.0 AS idf FROM (
            SELECT *, row_number() OVER (PARTITION BY c ORDER BY cf DESC, term ASC) AS r
            FROM stats WHERE df >= {min_df} {maxdf}) WHERE r <= {max_features}),
wt AS (SELECT tf.c, tf.d, tf.term, v.n, tf.tf * v.idf AS w FROM tf JOIN vocab v ON tf.c = v.c AND tf.term = v.term),
norms AS (SELECT c, d, sqrt(sum(w * w)) AS norm FROM wt GROUP BY c, d),
scored AS (SELECT wt.c, wt.term, sum(wt.w / norms.norm) / any_value(wt.n) AS score
           FROM wt JOIN norms ON wt.c = norms.c AND wt.d = norms.d GROUP BY wt.c, wt.term),
top AS (SELECT * FROM (SELECT c, term, score,
          row_number() OVER (PARTITION BY c ORDER BY round(score, 12) DESC, term DESC) AS rank FROM scored)
        WHERE rank <= {top_k})
"""


INSPECT_SQL = sql_tfidf("SELECT cluster_id AS c, doc_id AS d, text AS t FROM clustered WHERE cluster_id <> -1",
                        K.INSPECT_STOPWORDS, 5, 0.8, 8000, 10, 20)
TAG_SQL = sql_tfidf(f"SELECT cluster_id AS c, doc_id AS d, {Q.strip('text')} AS t FROM clustered WHERE cluster_id <> -1",
                    K.TAG_STOPWORDS, 2, None, 100, 3, 1)
TAG_KW_SQL = TAG_SQL.strip() + """,
kw AS (SELECT c, string_agg(term, '_' ORDER BY rank) AS kw FROM top GROUP BY c),
keywords AS (SELECT i.cluster_id, CASE WHEN i.cluster_id = -1 THEN 'NO_TOPIC'
                    WHEN kw.kw IS NOT NULL AND kw.kw <> '' THEN kw.kw
                    ELSE 'TOPIC_' || CAST(i.cluster_id AS VARCHAR) END AS keyword
             FROM (SELECT DISTINCT cluster_id FROM clustered) i LEFT JOIN kw ON i.cluster_id = kw.c)
"""


@register("terms_ngrams", f"""
WITH docs AS (SELECT 0 AS c, doc_id AS d, text AS t FROM documents),
{sql_terms('docs', K.INSPECT_STOPWORDS).strip()}
SELECT term, CAST(count(*) AS BIGINT) AS n_docs, CAST(sum(tf) AS BIGINT) AS n_occ FROM tf GROUP BY term
""")
def terms_ngrams(spark, sf):
    """Unigrams + bigrams after stop words; document and corpus frequency per term."""
    d = Tables(spark, sf).documents.select(F.lit(0).alias("c"), "doc_id", "text")
    tf = K.doc_terms(d, "c", "doc_id", "text", K.INSPECT_STOPWORDS)
    return tf.groupBy("term").agg(F.count(F.lit(1)).alias("n_docs"), F.sum("tf").cast("bigint").alias("n_occ"))


@register("tfidf_inspect", f"""
WITH {INSPECT_SQL.strip()}
SELECT c AS cluster_id, CAST(rank AS INTEGER) AS rank, term, round(score, 6) AS score FROM top
""", ("clustered",))
def tfidf_inspect(spark, sf):
    """Top-10 keywords per cluster (inspection profile)."""
    top = K.inspect_keywords(FX.clustered(Tables(spark, sf)))
    return top.withColumn("score", F.round("score", 6))


@register("tfidf_keywords", f"WITH {TAG_KW_SQL.strip()} SELECT cluster_id, keyword FROM keywords", ("clustered",))
def tfidf_keywords(spark, sf):
    """One keyword label per cluster (tag profile)."""
    return K.tag_keywords(FX.clustered(Tables(spark, sf)))


@register("tag_keywords", f"""
WITH {TAG_KW_SQL.strip()}
SELECT c.doc_id, '<' || coalesce(k.keyword, 'UNKNOWN') || '> Ispovest:' || chr(10) || {Q.strip('c.text')}
       || ' <' || coalesce(k.keyword, 'UNKNOWN') || '>' AS text
FROM clustered c LEFT JOIN keywords k ON c.cluster_id = k.cluster_id
""", ("clustered",))
def tag_keywords(spark, sf):
    """Keyword tags around each post (lookup default UNKNOWN)."""
    c = FX.clustered(Tables(spark, sf))
    kw = K.tag_keywords(c)
    j = c.join(kw, "cluster_id", "left")  # one row per cluster; AQE broadcasts it when small
    k = F.coalesce(F.col("keyword"), F.lit(K.UNKNOWN))
    return j.select("doc_id", TP.keyword_tag(k, T.py_strip(F.col("text"))).alias("text"))


def _inspection_sql(include_noise: bool) -> str:
    where = "" if include_noise else "WHERE cluster_id <> -1"
    tfidf = sql_tfidf(f"SELECT cluster_id AS c, doc_id AS d, text AS t FROM clustered {where}",
                      K.INSPECT_STOPWORDS, 5, 0.8, 8000, 10, 20)
    return f"""
WITH {tfidf.strip()},
kws AS (SELECT c, string_agg(term, ', ' ORDER BY rank) AS keywords FROM top GROUP BY c),
smp AS (SELECT cluster_id, string_agg(CAST(doc_id AS VARCHAR), ',' ORDER BY rk) AS sample_ids FROM (
          SELECT cluster_id, doc_id,
                 row_number() OVER (PARTITION BY cluster_id ORDER BY {Q.sample_key('doc_id')}, doc_id) AS rk
          FROM clustered {where}) WHERE rk <= 5 GROUP BY cluster_id),
sz AS (SELECT cluster_id, count(*) AS size FROM clustered {where} GROUP BY cluster_id)
SELECT sz.cluster_id, CAST(sz.size AS BIGINT) AS size, coalesce(kws.keywords, '') AS keywords, smp.sample_ids
FROM sz LEFT JOIN kws ON sz.cluster_id = kws.c JOIN smp ON sz.cluster_id = smp.cluster_id
"""


def _inspection(spark, sf, include_noise: bool):
    c = FX.clustered(Tables(spark, sf))
    if not include_noise:
        c = c.filter(F.col("cluster_id") != FX.NOISE)
    sizes = R.count_by(c, "cluster_id", "size")
    kws = K.inspect_keywords(c, include_noise=include_noise).groupBy("cluster_id").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("rank", "term"))), lambda s: s["term"]),
                     ", ").alias("keywords"))
    smp = R.sample_per_group(c.select("cluster_id", "doc_id"), "cluster_id", "doc_id", 5).groupBy("cluster_id").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("sample_rank", "doc_id"))),
                                 lambda s: s["doc_id"].cast("string")), ",").alias("sample_ids"))
    out = sizes.join(kws, "cluster_id", "left").join(smp, "cluster_id")
    return out.select("cluster_id", "size", F.coalesce("keywords", F.lit("")).alias("keywords"), "sample_ids")


@register("cluster_inspection", _inspection_sql(False), ("clustered",))
def cluster_inspection(spark, sf):
    """M4: size + top-10 keywords + 5 seeded samples per cluster (noise excluded)."""
    return _inspection(spark, sf, False)


@register("cluster_inspection_noise", _inspection_sql(True), ("clustered",))
def cluster_inspection_noise(spark, sf):
    """M4 with ``include_noise``: the noise group (−1) is inspected like a cluster."""
    return _inspection(spark, sf, True)


@register("cluster_summary", f"""
WITH {TAG_KW_SQL.strip()},
g AS (SELECT cluster_id, count(*) AS num_texts, min(doc_id) AS first_id FROM clustered GROUP BY cluster_id),
s3 AS (SELECT cluster_id, string_agg(CAST(doc_id AS VARCHAR), ',' ORDER BY doc_id) AS sample_ids FROM (
         SELECT cluster_id, doc_id, row_number() OVER (PARTITION BY cluster_id ORDER BY doc_id) AS rn FROM clustered)
       WHERE rn <= 3 GROUP BY cluster_id)
SELECT CAST(row_number() OVER (ORDER BY g.num_texts DESC, g.first_id) AS BIGINT) AS summary_rank,
       g.cluster_id, coalesce(k.keyword, 'UNKNOWN') AS keyword, CAST(g.num_texts AS BIGINT) AS num_texts, s3.sample_ids
FROM g LEFT JOIN keywords k ON g.cluster_id = k.cluster_id JOIN s3 ON g.cluster_id = s3.cluster_id
""", ("clustered",))
def cluster_summary(spark, sf):
    """Id, keyword, size, first 3 posts; sorted by size desc, first-seen first."""
    c = FX.clustered(Tables(spark, sf))
    g = c.groupBy("cluster_id").agg(F.count(F.lit(1)).alias("num_texts"), F.min("doc_id").alias("first_id"))
    kw = K.tag_keywords(c)
    s3 = R.first_n_per_group(c.select("cluster_id", "doc_id"), "cluster_id", "doc_id", 3).groupBy("cluster_id").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("rn", "doc_id"))),
                                 lambda s: s["doc_id"].cast("string")), ",").alias("sample_ids"))
    out = g.join(kw, "cluster_id", "left").join(s3, "cluster_id")
    out = R.global_row_number(out, [F.col("num_texts").desc(), F.col("first_id")], "summary_rank")
    return out.select("summary_rank", "cluster_id", F.coalesce("keyword", F.lit(K.UNKNOWN)).alias("keyword"),
                      "num_texts", "sample_ids")


# fixed value: the banner of the preview report
BANNER = "=" * 40


@register("cluster_preview_report", f"""
WITH e AS (
  SELECT cluster, rn, chr(10) || '[' || CAST(rn AS VARCHAR) || ']' || chr(10)
         || CASE WHEN {Q.strip('cluster_topic')} <> '' THEN 'Topic: ' || {Q.strip('cluster_topic')} || chr(10) ELSE '' END
         || {Q.strip('text')} || chr(10) AS entry
  FROM (SELECT *, row_number() OVER (PARTITION BY cluster ORDER BY doc_id) AS rn FROM topic_corpus) WHERE rn <= 10)
SELECT cluster, '{BANNER}' || chr(10) || 'CLUSTER ID: ' || CAST(cluster AS VARCHAR) || chr(10) || '{BANNER}' || chr(10)
       || string_agg(entry, '' ORDER BY rn) || chr(10) || chr(10) AS report
FROM e GROUP BY cluster
""", ("topic_corpus",))
def cluster_preview_report(spark, sf):
    """Per-cluster preview block of the first 10 posts, numbered."""
    c = FX.topic_corpus(Tables(spark, sf))
    first = R.first_n_per_group(c, "cluster", "doc_id", 10)
    topic = T.py_strip(F.col("cluster_topic"))
    entry = F.concat(F.lit("\n["), F.col("rn").cast("string"), F.lit("]\n"),
                     F.when(topic != "", F.concat(F.lit("Topic: "), topic, F.lit("\n"))).otherwise(F.lit("")),
                     T.py_strip(F.col("text")), F.lit("\n"))
    g = first.groupBy("cluster").agg(F.array_sort(F.collect_list(F.struct("rn", entry.alias("e")))).alias("es"))
    head = F.concat(F.lit(BANNER + "\nCLUSTER ID: "), F.col("cluster").cast("string"), F.lit("\n" + BANNER + "\n"))
    return g.select("cluster", F.concat(head, F.array_join(F.col("es.e"), ""), F.lit("\n\n")).alias("report"))


@register("cluster_samples", f"""
SELECT cluster_id, CAST(rk AS INTEGER) AS sample_rank, doc_id, text FROM (
  SELECT cluster_id, doc_id, text, row_number() OVER (PARTITION BY cluster_id ORDER BY {Q.sample_key('doc_id')}, doc_id) AS rk
  FROM clustered WHERE cluster_id <> -1) WHERE rk <= 5
""", ("clustered",))
def cluster_samples(spark, sf):
    """M4: the texts of 5 seeded samples per cluster; ids are ranked alone, texts joined to the few that are left."""
    t = Tables(spark, sf)
    c = FX.clustered(t).filter(F.col("cluster_id") != FX.NOISE).select("cluster_id", "doc_id")
    few = R.sample_per_group(c, "cluster_id", "doc_id", 5)
    return few.join(t.documents.select("doc_id", "text"), "doc_id").select("cluster_id", "sample_rank", "doc_id", "text")


@register("cluster_report_file", f"""
WITH e AS (
  SELECT cluster, rn, chr(10) || '[' || CAST(rn AS VARCHAR) || ']' || chr(10)
         || CASE WHEN {Q.strip('cluster_topic')} <> '' THEN 'Topic: ' || {Q.strip('cluster_topic')} || chr(10) ELSE '' END
         || {Q.strip('text')} || chr(10) AS entry
  FROM (SELECT *, row_number() OVER (PARTITION BY cluster ORDER BY doc_id) AS rn FROM topic_corpus) WHERE rn <= 10),
r AS (SELECT cluster, '{BANNER}' || chr(10) || 'CLUSTER ID: ' || CAST(cluster AS VARCHAR) || chr(10) || '{BANNER}' || chr(10)
             || string_agg(entry, '' ORDER BY rn) || chr(10) || chr(10) AS report FROM e GROUP BY cluster),
l AS (SELECT unnest(regexp_split_to_array(report, '\\r\\n|\\r|\\n')[:-2]) AS line FROM r)
SELECT line, CAST(count(*) AS BIGINT) AS n FROM l GROUP BY line
""", ("topic_corpus",))
def cluster_report_file(spark, sf):
    """S13 as a file: the preview blocks of all clusters, in the order of their ids, written as text and
    read back line by line."""
    path = scratch_path(spark, "report")
    blocks = cluster_preview_report(spark, sf)
    blocks.repartitionByRange("cluster").sortWithinPartitions("cluster").select(F.expr("left(report, length(report) - 1)").alias("value")).write.text(path)
    return spark.read.text(path).groupBy(F.col("value").alias("line")).agg(F.count(F.lit(1)).alias("n"))
