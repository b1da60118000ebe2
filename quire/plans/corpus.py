"""Registered queries: text functions, relational core, topics, training set, sources."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from quire.functions import scores as S
from quire.functions import text as T
from quire.operators import relational as R
from quire.operators import topics as TP
from quire.operators import trainset as TS
from quire.plans import sqlfrag as Q
from quire.plans.registry import register
from quire.session import cut_lineage, scratch_path
from quire.sources import fixtures as FX
from quire.sources import frontier as FR
from quire.sources import jsonl as J
from quire.sources import textfiles as TF
from quire.sources.tables import Tables

# ------------------------------------------------------------- flagship --


def scored_corpus(t: Tables):
    """topic corpus ⟕ votes on the full normalised key."""
    return R.join_engagement(FX.topic_corpus(t), FX.votes_by_text(t), T.normalize_key)


SQL_SCORE_LOOKUP = f"""
lookup AS (
  SELECT k, max_by(score, ord) AS engagement_score FROM (
    SELECT {Q.normalize_key('text')} AS k, {Q.engagement_score('approve', 'disapprove')} AS score, ord
    FROM votes_by_text) GROUP BY k),
scored AS (
  SELECT c.doc_id, c.text, c.cluster, c.cluster_topic,
         coalesce(l.engagement_score, 0.0) AS engagement_score, l.k IS NOT NULL AS matched
  FROM topic_corpus c LEFT JOIN lookup l ON {Q.normalize_key('c.text')} = l.k)
"""


@register("engagement_by_cluster", f"""
WITH {SQL_SCORE_LOOKUP.strip()}
SELECT CAST(cluster AS INTEGER) AS cluster, CAST(count(*) AS BIGINT) AS n,
       CAST(count(*) FILTER (WHERE matched) AS BIGINT) AS matched,
       CAST(count(*) FILTER (WHERE NOT matched) AS BIGINT) AS missing,
       round(avg(engagement_score), 6) AS avg_score
FROM scored GROUP BY cluster
""", ("votes_by_text", "topic_corpus"))
def engagement_by_cluster(spark, sf):
    """§7.2 slice: votes joined on normalised text, summarised per cluster."""
    s = scored_corpus(Tables(spark, sf))
    return s.groupBy("cluster").agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if("matched").alias("matched"),
        F.count_if(~F.col("matched")).alias("missing"),
        F.round(F.avg("engagement_score"), 6).alias("avg_score"))


@register("join_engagement", f"""
WITH {SQL_SCORE_LOOKUP.strip()}
SELECT doc_id, cluster, cluster_topic, engagement_score FROM scored
""", ("votes_by_text", "topic_corpus"))
def join_engagement(spark, sf):
    """Per-post engagement score (0.0 when no vote row matches)."""
    return scored_corpus(Tables(spark, sf)).select("doc_id", "cluster", "cluster_topic", "engagement_score")


@register("merge_counters", f"""
WITH {SQL_SCORE_LOOKUP.strip()}
SELECT CAST(count(*) FILTER (WHERE matched) AS BIGINT) AS matched,
       CAST(count(*) FILTER (WHERE NOT matched) AS BIGINT) AS missing FROM scored
""", ("votes_by_text", "topic_corpus"))
def merge_counters(spark, sf):
    """A2: matched / missing counters of J2 in one pass."""
    s = scored_corpus(Tables(spark, sf))
    return s.agg(F.count_if("matched").alias("matched"), F.count_if(~F.col("matched")).alias("missing"))


@register("join_engagement_light", f"""
WITH lookup AS (
  SELECT k, max_by(score, ord) AS s FROM (
    SELECT {Q.normalize_light('text')} AS k,
           ({Q.parse_int('approve')} - {Q.parse_int('disapprove')})
             / ({Q.parse_int('approve')} + {Q.parse_int('disapprove')} + 1.0) AS score, ord
    FROM votes_by_text) GROUP BY k)
SELECT c.doc_id, coalesce(round_even(l.s, 4), 0.0) AS engagement_score
FROM topic_corpus c LEFT JOIN lookup l ON {Q.normalize_light('c.text')} = l.k
""", ("votes_by_text", "topic_corpus"))
def join_engagement_light(spark, sf):
    """Light key (prefix removed, strip, lower); unrounded lookup, rounded on assignment."""
    t = Tables(spark, sf)
    j = R.join_engagement(FX.topic_corpus(t), FX.votes_by_text(t), T.normalize_light)
    return j.select("doc_id", "engagement_score")


@register("semi_join_matched", f"""
SELECT c.doc_id FROM topic_corpus c
WHERE {Q.normalize_key('c.text')} IN (SELECT {Q.normalize_key('text')} FROM votes_by_text)
""", ("votes_by_text", "topic_corpus"))
def semi_join_matched(spark, sf):
    """Posts that have a vote row (left semi join on the key hash)."""
    t = Tables(spark, sf)
    key = lambda c: F.sha2(T.normalize_key(c), 256)
    v = FX.votes_by_text(t).select(key(F.col("text")).alias("k"))
    c = FX.topic_corpus(t).select("doc_id", key(F.col("text")).alias("k"))
    return c.join(v, "k", "left_semi").select("doc_id")


# ------------------------------------------------------- text functions --

@register("normalize_key", f"SELECT doc_id, {Q.normalize_key('text')} AS norm_text FROM documents")
def normalize_key_q(spark, sf):
    """F3 over the corpus."""
    d = Tables(spark, sf).documents
    return d.select("doc_id", T.normalize_key(F.col("text")).alias("norm_text"))


@register("normalize_light", f"SELECT doc_id, {Q.normalize_light('text')} AS norm_text FROM documents")
def normalize_light_q(spark, sf):
    """F2 over the corpus."""
    d = Tables(spark, sf).documents
    return d.select("doc_id", T.normalize_light(F.col("text")).alias("norm_text"))


@register("content_hash", f"SELECT doc_id, {Q.content_hash('text')} AS hash FROM documents")
def content_hash_q(spark, sf):
    """F4 over the corpus."""
    d = Tables(spark, sf).documents
    return d.select("doc_id", T.content_hash(F.col("text")).alias("hash"))


@register("engagement_score", f"""
SELECT user_id, {Q.parse_int('approve')} AS approve, {Q.parse_int('disapprove')} AS disapprove,
       {Q.engagement_score('approve', 'disapprove')} AS engagement_score
FROM votes
""", ("votes",))
def engagement_score_q(spark, sf):
    """F5/F6 over the vote table."""
    v = FX.votes(Tables(spark, sf))
    return v.select("user_id", S.parse_int("approve").alias("approve"), S.parse_int("disapprove").alias("disapprove"),
                    S.engagement_score("approve", "disapprove").alias("engagement_score"))


@register("parse_int", f"""
SELECT event_id, {Q.parse_int("regexp_extract(props, ':\\s*([^}}]*)', 1)")} AS k FROM events
""")
def parse_int_q(spark, sf):
    """F6 over a raw string field (the value inside each event's props)."""
    e = Tables(spark, sf).events
    raw = F.regexp_extract(F.col("props"), ":\\s*([^}]*)", 1)
    return e.select("event_id", S.parse_int(raw).alias("k"))


# ---------------------------------------------------------- cleaning --

@register("clean_corpus", f"""
SELECT doc_id, 'Ispovest:' || chr(10) || c AS text FROM (
  SELECT doc_id, {Q.clean_text_nfc_free('text')} AS c FROM documents) WHERE c <> ''
""")
def clean_corpus(spark, sf):
    """clean_text → drop empty → add prefix."""
    d = Tables(spark, sf).documents
    c = d.select("doc_id", T.clean_text(F.col("text")).alias("c")).filter(F.col("c") != "")
    return c.select("doc_id", T.add_prefix(F.col("c")).alias("text"))


@register("clean_counters", f"""
SELECT CAST(count(*) AS BIGINT) AS n_in,
       CAST(count(*) FILTER (WHERE c <> '') AS BIGINT) AS kept,
       CAST(count(*) FILTER (WHERE c = '') AS BIGINT) AS dropped_empty
FROM (SELECT {Q.clean_text_nfc_free('text')} AS c FROM documents)
""")
def clean_counters(spark, sf):
    """A2: kept / dropped counters of the cleaning job, one pass."""
    d = Tables(spark, sf).documents.select(T.clean_text(F.col("text")).alias("c"))
    return d.agg(F.count(F.lit(1)).alias("n_in"), F.count_if(F.col("c") != "").alias("kept"),
                 F.count_if(F.col("c") == "").alias("dropped_empty"))


@register("export_text", f"SELECT doc_id, {Q.clean_text_nfc_free('text')} AS text FROM documents")
def export_text(spark, sf):
    """Table → clean_text, no prefix, empties kept."""
    d = Tables(spark, sf).documents
    return d.select("doc_id", T.clean_text(F.col("text")).alias("text"))


@register("project_text", "SELECT text FROM documents")
def project_text(spark, sf):
    """Project to the text column (the scan reads one column)."""
    return Tables(spark, sf).documents.select("text")


@register("filter_required", """
SELECT d.doc_id, l.quality FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id
WHERE l.quality IS NOT NULL
""")
def filter_required(spark, sf):
    """P5: rows whose required field is present (non-null)."""
    t = Tables(spark, sf)
    j = t.documents.select("doc_id").join(t.labels.select("doc_id", "quality"), "doc_id", "left")
    return j.filter(F.col("quality").isNotNull())


@register("filter_min_length", "SELECT doc_id, CAST(length(text) AS BIGINT) AS n FROM documents WHERE length(text) >= 40")
def filter_min_length(spark, sf):
    """Texts of at least 40 characters."""
    d = Tables(spark, sf).documents
    return d.select("doc_id", F.length("text").cast("bigint").alias("n")).filter(F.col("n") >= 40)


@register("filter_noise", "SELECT doc_id, cluster_id FROM clustered WHERE cluster_id <> -1", ("clustered",))
def filter_noise(spark, sf):
    """Drop noise rows."""
    c = FX.clustered(Tables(spark, sf))
    return c.filter(F.col("cluster_id") != FX.NOISE).select("doc_id", "cluster_id")


# ------------------------------------------------------------ counts --

@register("cluster_sizes", "SELECT cluster_id, CAST(count(*) AS BIGINT) AS n FROM clustered GROUP BY cluster_id",
          ("clustered",))
def cluster_sizes(spark, sf):
    """A1."""
    return R.count_by(FX.clustered(Tables(spark, sf)), "cluster_id")


@register("cluster_having_size", """
SELECT cluster_id, CAST(count(*) AS BIGINT) AS n FROM clustered WHERE cluster_id <> -1
GROUP BY cluster_id HAVING count(*) >= 20
""", ("clustered",))
def cluster_having_size(spark, sf):
    """Clusters with ≥ 20 posts (noise excluded)."""
    c = FX.clustered(Tables(spark, sf)).filter(F.col("cluster_id") != FX.NOISE)
    return R.having_size(c, "cluster_id", 20)


@register("count_clusters", """
SELECT CAST(count(DISTINCT CASE WHEN cluster_id <> -1 THEN cluster_id END) AS BIGINT) AS n_clusters FROM clustered
""", ("clustered",))
def count_clusters(spark, sf):
    """A4: clusters excluding noise."""
    c = FX.clustered(Tables(spark, sf))
    return c.agg(F.count_distinct(F.when(F.col("cluster_id") != FX.NOISE, F.col("cluster_id"))).alias("n_clusters"))


@register("distinct_topics", f"""
SELECT DISTINCT lower({Q.strip('cluster_topic')}) AS topic FROM topic_corpus
WHERE lower({Q.strip('cluster_topic')}) <> ''
""", ("topic_corpus",))
def distinct_topics(spark, sf):
    """Distinct normalised topics."""
    c = FX.topic_corpus(Tables(spark, sf))
    return (c.select(T.topic_norm(F.col("cluster_topic")).alias("topic"))
            .filter(F.col("topic") != "").distinct())


# ----------------------------------------------------- dedupe / sets --

@register("dedupe_first", f"""
SELECT hash, min(doc_id) AS doc_id FROM (SELECT doc_id, {Q.content_hash('text')} AS hash FROM documents)
GROUP BY hash
""")
def dedupe_first(spark, sf):
    """First post (lowest id) per content hash."""
    d = Tables(spark, sf).documents.select("doc_id", T.content_hash(F.col("text")).alias("hash"))
    return R.dedupe_first(d, "hash", "doc_id")


@register("dedupe_last", f"""
SELECT key_hash, max(ord) AS ord, arg_max(approve, ord) AS approve, arg_max(disapprove, ord) AS disapprove
FROM (SELECT sha256({Q.normalize_key('text')}) AS key_hash, ord, approve, disapprove FROM votes_by_text)
GROUP BY key_hash
""", ("votes_by_text",))
def dedupe_last(spark, sf):
    """Last vote row per normalised text wins."""
    v = FX.votes_by_text(Tables(spark, sf))
    v = v.select(F.sha2(T.normalize_key(F.col("text")), 256).alias("key_hash"), "ord", "approve", "disapprove")
    return R.dedupe_last(v, "key_hash", "ord")


@register("anti_join_seen", f"""
SELECT doc_id, hash FROM (SELECT doc_id, {Q.content_hash('text')} AS hash FROM documents)
WHERE hash NOT IN (SELECT hash FROM seen)
""", ("seen",))
def anti_join_seen(spark, sf):
    """Posts whose content hash was not seen before."""
    t = Tables(spark, sf)
    return R.anti_join_seen(t.documents.select("doc_id", "text"), FX.seen_hashes(t)).select("doc_id", "hash")


SQL_ARCHIVES = f"""
WITH u AS (
  SELECT 0 AS archive, doc_id AS id, text FROM documents
  UNION ALL SELECT 1 AS archive, item_id AS id, text FROM benchmark),
h AS (SELECT archive, id, {Q.content_hash('text')} AS hash FROM u),
f AS (SELECT hash, min(archive * 1000000000000 + id) AS o FROM h GROUP BY hash)
"""


@register("combine_archives", SQL_ARCHIVES + """
SELECT h.hash, CAST(h.archive AS INTEGER) AS archive, h.id FROM h JOIN f ON h.hash = f.hash
  AND h.archive * 1000000000000 + h.id = f.o
""")
def combine_archives(spark, sf):
    """Union of two archives, first occurrence per content hash wins."""
    t = Tables(spark, sf)
    a = t.documents.select(F.lit(0).alias("archive"), F.col("doc_id").alias("id"), "text")
    b = t.benchmark.select(F.lit(1).alias("archive"), F.col("item_id").alias("id"), "text")
    u = a.unionByName(b).select("archive", "id", T.content_hash(F.col("text")).alias("hash"),
                                F.struct("archive", F.col("id")).alias("o"))
    return R.dedupe_first(u, "hash", "o").select("hash", F.col("archive").cast("int").alias("archive"), "id")


@register("dedupe_limit", f"""
SELECT hash, doc_id FROM (
  SELECT hash, min(doc_id) AS doc_id FROM (SELECT doc_id, {Q.content_hash('text')} AS hash FROM documents)
  GROUP BY hash) ORDER BY doc_id LIMIT 100000
""")
def dedupe_limit(spark, sf):
    """O3/T4: stop at N (100,000) unique posts in crawl order."""
    d = Tables(spark, sf).documents.select("doc_id", T.content_hash(F.col("text")).alias("hash"))
    return R.dedupe_first(d, "hash", "doc_id").orderBy("doc_id").limit(100_000)


# ------------------------------------------------- windows / samples --

@register("first_n_per_cluster", """
SELECT cluster_id, CAST(rn AS INTEGER) AS rn, doc_id FROM (
  SELECT cluster_id, doc_id, row_number() OVER (PARTITION BY cluster_id ORDER BY doc_id) AS rn FROM clustered)
WHERE rn <= 3
""", ("clustered",))
def first_n_per_cluster(spark, sf):
    """First 3 posts per cluster in file order."""
    c = FX.clustered(Tables(spark, sf)).select("cluster_id", "doc_id")
    return R.first_n_per_group(c, "cluster_id", "doc_id", 3).select("cluster_id", F.col("rn").cast("int"), "doc_id")


@register("sample_per_cluster", f"""
SELECT cluster_id, CAST(sample_rank AS INTEGER) AS sample_rank, doc_id FROM (
  SELECT cluster_id, doc_id,
         row_number() OVER (PARTITION BY cluster_id ORDER BY {Q.sample_key('doc_id')}, doc_id) AS sample_rank
  FROM clustered)
WHERE sample_rank <= 5
""", ("clustered",))
def sample_per_cluster(spark, sf):
    """5 seeded samples per cluster, without replacement."""
    c = FX.clustered(Tables(spark, sf)).select("cluster_id", "doc_id")
    return R.sample_per_group(c, "cluster_id", "doc_id", 5).select(
        "cluster_id", F.col("sample_rank").cast("int"), "doc_id")


@register("sample_fixed", f"""
SELECT doc_id FROM topic_corpus WHERE cluster = -999 OR lower(cluster_topic) = 'razno'
ORDER BY {Q.sample_key('doc_id')}, doc_id LIMIT 5000
""", ("topic_corpus",))
def sample_fixed(spark, sf):
    """min(5000, n) seeded sample of unassigned posts."""
    c = FX.topic_corpus(Tables(spark, sf))
    u = c.filter(TS.is_unassigned(F.col("cluster"), F.col("cluster_topic"))).select("doc_id")
    return R.sample_fixed(u, "doc_id", TS.SAMPLE_UNASSIGNED)


# -------------------------------------------------------- topics --

SQL_TOPIC_FOLD = f"""
parsed AS (
  SELECT line_no,
         CAST(regexp_extract(l, '^([0-9]+){Q.WS}+', 1) AS BIGINT) AS raw_id,
         {Q.strip(f"regexp_replace({Q.strip(f'regexp_extract(l, {Q.q(chr(94) + '[0-9]+' + Q.WS + '+(.*)$')}, 1)')}, {Q.q('(?s)' + Q.WS + '*[(].*$')}, '')")} AS topic
  FROM (SELECT line_no, {Q.strip('line')} AS l FROM topic_lines)
  WHERE l <> '' AND regexp_matches(l, {Q.q('^[0-9]+' + Q.WS + '+')})),
ordered AS (SELECT line_no, raw_id, row_number() OVER (ORDER BY line_no) AS i FROM parsed),
fold(i, line_no, fixed_id, used) AS (
  SELECT i, line_no, raw_id, [raw_id] FROM ordered WHERE i = 1
  UNION ALL
  SELECT o.i, o.line_no,
         CASE WHEN list_contains(f.used, o.raw_id) THEN f.fixed_id + 1 ELSE o.raw_id END,
         list_append(f.used, CASE WHEN list_contains(f.used, o.raw_id) THEN f.fixed_id + 1 ELSE o.raw_id END)
  FROM fold f JOIN ordered o ON o.i = f.i + 1),
repaired AS (
  SELECT p.line_no, p.raw_id, f.fixed_id, p.topic FROM parsed p JOIN fold f ON p.line_no = f.line_no),
lookup AS (SELECT CAST(fixed_id AS INTEGER) AS cluster, arg_max(topic, line_no) AS manual_topic
           FROM repaired GROUP BY fixed_id)
"""


@register("parse_topic_lines", f"WITH RECURSIVE {SQL_TOPIC_FOLD.strip()} SELECT line_no, raw_id, topic FROM parsed",
          ("topic_lines",))
def parse_topic_lines(spark, sf):
    """Numbered topic lines → (line_no, raw_id, topic)."""
    return TP.parse_topic_lines(FX.topic_lines(Tables(spark, sf)))


@register("repair_topic_ids", f"WITH RECURSIVE {SQL_TOPIC_FOLD.strip()} SELECT line_no, raw_id, fixed_id, topic FROM repaired",
          ("topic_lines",))
def repair_topic_ids(spark, sf):
    """Sequential duplicate-id repair."""
    return TP.repair_topic_ids(TP.parse_topic_lines(FX.topic_lines(Tables(spark, sf))))


@register("apply_manual_topics", f"""
WITH RECURSIVE {SQL_TOPIC_FOLD.strip()}
SELECT c.doc_id, c.cluster,
       CASE WHEN c.cluster = -999 THEN 'razno' WHEN l.manual_topic IS NOT NULL THEN l.manual_topic
            ELSE c.cluster_topic END AS cluster_topic,
       CASE WHEN c.cluster = -999 THEN 'razno' WHEN l.manual_topic IS NOT NULL THEN 'manual'
            ELSE 'untouched' END AS topic_source
FROM topic_corpus c LEFT JOIN lookup l ON c.cluster = l.cluster
""", ("topic_lines", "topic_corpus"))
def apply_manual_topics(spark, sf):
    """Manual topic file applied to the topic corpus."""
    t = Tables(spark, sf)
    out = TP.apply_manual_topics(FX.topic_corpus(t), TP.topic_lookup(FX.topic_lines(t)))
    return out.select("doc_id", "cluster", "cluster_topic", "topic_source")

@register("manual_topic_counters", f"""
WITH RECURSIVE {SQL_TOPIC_FOLD.strip()}
SELECT CASE WHEN c.cluster = -999 THEN 'razno' WHEN l.manual_topic IS NOT NULL THEN 'manual' ELSE 'untouched' END AS topic_source,
       CAST(count(*) AS BIGINT) AS n
FROM topic_corpus c LEFT JOIN lookup l ON c.cluster = l.cluster GROUP BY 1
""", ("topic_lines", "topic_corpus"))
def manual_topic_counters(spark, sf):
    """A2: how many posts got the default topic, a manual one, or kept their own."""
    t = Tables(spark, sf)
    out = TP.apply_manual_topics(FX.topic_corpus(t).drop("text"), TP.topic_lookup(FX.topic_lines(t)))
    return R.count_by(out, "topic_source", "n")


@register("split_assigned", """
SELECT doc_id, CASE WHEN cluster = -999 OR lower(cluster_topic) = 'razno' THEN 'unassigned' ELSE 'clustered' END
       AS branch FROM topic_corpus
""", ("topic_corpus",))
def split_assigned(spark, sf):
    """Unassigned vs clustered branch."""
    c = FX.topic_corpus(Tables(spark, sf))
    return c.select("doc_id", F.when(TS.is_unassigned(F.col("cluster"), F.col("cluster_topic")),
                                     F.lit("unassigned")).otherwise(F.lit("clustered")).alias("branch"))


@register("tag_cluster", f"""
SELECT doc_id, CASE WHEN cluster_id = -1 THEN '<NO_TOPIC> ' || {Q.strip('text')} || ' <NO_TOPIC>'
  ELSE '<CLUSTER_' || CAST(cluster_id AS VARCHAR) || '> ' || {Q.strip('text')} || ' <CLUSTER_'
       || CAST(cluster_id AS VARCHAR) || '>' END AS text
FROM clustered
""", ("clustered",))
def tag_cluster(spark, sf):
    """Cluster tags around each text."""
    c = FX.clustered(Tables(spark, sf))
    return c.select("doc_id", TP.cluster_tag(F.col("cluster_id"), F.col("text")).alias("text"))


# ---------------------------------------------------- training set --

SQL_TRAINING = f"""
WITH {SQL_SCORE_LOOKUP.strip()},
topics AS (SELECT topic, row_number() OVER (ORDER BY topic) AS topic_rank FROM (
  SELECT DISTINCT lower({Q.strip('cluster_topic')}) AS topic FROM scored
  WHERE lower({Q.strip('cluster_topic')}) <> '')),
ntop AS (SELECT count(*) AS n FROM topics),
flagged AS (SELECT *, (cluster = -999 OR lower(cluster_topic) = 'razno') AS unassigned FROM scored),
picked AS (
  SELECT * FROM flagged WHERE NOT unassigned
  UNION ALL
  SELECT * FROM (SELECT * FROM flagged WHERE unassigned
                 ORDER BY {Q.sample_key('doc_id')}, doc_id LIMIT 5000)),
ranked AS (
  SELECT p.*, lower({Q.strip('p.cluster_topic')}) AS main, t.topic_rank AS own,
         CASE WHEN t.topic_rank IS NULL THEN (SELECT n FROM ntop) ELSE (SELECT n FROM ntop) - 1 END AS n_cand
  FROM picked p LEFT JOIN topics t ON lower({Q.strip('p.cluster_topic')}) = t.topic),
chosen AS (
  SELECT r.*, CASE WHEN n_cand > 0 THEN
           (CAST('0x' || substr(sha256('11|' || CAST(doc_id AS VARCHAR)), 1, 15) AS BIGINT) % n_cand) + 1 END AS k
  FROM ranked r),
final AS (
  SELECT c.doc_id, c.text, c.engagement_score, c.main,
         x.topic AS extra FROM chosen c
  LEFT JOIN topics x ON x.topic_rank = CASE WHEN c.own IS NOT NULL AND c.k >= c.own THEN c.k + 1 ELSE c.k END),
texts AS (
  SELECT doc_id,
         '[engagement_score:' || printf('%.4f', engagement_score) || '] [' || main || ']'
         || CASE WHEN extra IS NOT NULL THEN ' [' || extra || ']' ELSE '' END
         || ' Ispovest:' || chr(10) || replace(text, 'Ispovest:' || chr(10), '') AS text
  FROM final)
"""


@register("training_set", SQL_TRAINING + """
SELECT doc_id, CAST(row_number() OVER (ORDER BY sha256('7|' || CAST(doc_id AS VARCHAR)), doc_id) AS BIGINT)
       AS shuffle_pos, text FROM texts
""", ("votes_by_text", "topic_corpus"))
def training_set(spark, sf):
    """Split, sample, union, shuffle, tag."""
    return TS.training_set(scored_corpus(Tables(spark, sf)))


@register("extra_topics", SQL_TRAINING + "SELECT doc_id, main, extra FROM final", ("votes_by_text", "topic_corpus"))
def extra_topics(spark, sf):
    """One seeded topic other than the post's own."""
    s = cut_lineage(scored_corpus(Tables(spark, sf)).drop("text"))   # read three times
    flag = TS.is_unassigned(F.col("cluster"), F.col("cluster_topic"))
    picked = s.filter(~flag).unionByName(R.sample_fixed(s.filter(flag), "doc_id", TS.SAMPLE_UNASSIGNED))
    x = TS.with_extra_topic(picked, TS.topic_set(s))
    return x.select("doc_id", F.col("_main").alias("main"), F.col("extra_topic").alias("extra"))


@register("strip_third_tag", SQL_TRAINING + f"""
SELECT doc_id, CASE WHEN len(g) > 2 THEN
    regexp_replace({Q.strip('replace(text, g[3], {e})'.format(e=chr(39) * 2))}, {Q.q(Q.WS + '{2,}')}, ' ', 'g')
  ELSE text END AS text
FROM (SELECT doc_id, text, regexp_extract_all(text, '(\\[.*?\\])', 1) AS g FROM texts)
""", ("votes_by_text", "topic_corpus"))
def strip_third_tag(spark, sf):
    """drop the third bracket group of each training text."""
    ts = TS.training_set(scored_corpus(Tables(spark, sf)))
    return ts.select("doc_id", T.strip_third_tag(F.col("text")).alias("text"))


# ---------------------------------------------------------- sources --

PROPS_SCHEMA = StructType([StructField("k", LongType(), True)])


def _jsonl_lines(t: Tables):
    """Lines of a mixed log: event props (JSON) and conversation text lines (prose)."""
    ev = t.events.select(F.lit("events").alias("src"), F.col("event_id").alias("id"), F.lit(0).cast("bigint").alias("turn"),
                         F.lit(1).cast("bigint").alias("line_no"), F.col("props").alias("line"))
    conv = t.conversations.select(F.lit("conversations").alias("src"), F.col("conv_id").alias("id"),
                                  F.col("turn").cast("bigint").alias("turn"), "text")
    conv = TF.lines(conv, "text", ("src", "id", "turn"))
    return ev.unionByName(conv)


@register("scan_jsonl_tolerant", f"""
WITH lines AS (
  SELECT 'events' AS src, event_id AS id, CAST(0 AS BIGINT) AS turn, CAST(1 AS BIGINT) AS line_no, props AS line FROM events
  UNION ALL
  SELECT 'conversations', conv_id, CAST(turn AS BIGINT), CAST(i AS BIGINT), {Q.strip('parts[i]')}
  FROM (SELECT conv_id, turn, regexp_split_to_array(text, '\\r\\n|\\r|\\n') AS parts FROM conversations),
       LATERAL (SELECT unnest(generate_series(1, len(parts))) AS i)
  WHERE {Q.strip('parts[i]')} <> ''),
s AS (SELECT src, id, turn, line_no, {Q.strip('line')} AS l FROM lines)
SELECT src, id, turn, line_no,
       CASE WHEN NOT coalesce(json_valid(l), false) OR NOT regexp_matches(l, '^[{{][\\s\\S]*[}}]$') THEN 'bad_json'
            WHEN NOT list_contains(json_keys(l), 'k') THEN 'missing_key' ELSE 'ok' END AS status,
       CASE WHEN coalesce(json_valid(l), false) AND regexp_matches(l, '^[{{][\\s\\S]*[}}]$')
                 AND list_contains(json_keys(l), 'k') THEN CAST(json_extract(l, '$.k') AS BIGINT) END AS k
FROM s WHERE l <> ''
""")
def scan_jsonl_tolerant(spark, sf):
    """Tolerant JSONL parse with per-line status (ok / bad_json / missing_key)."""
    lines = _jsonl_lines(Tables(spark, sf))
    return J.parse_json_lines(lines, PROPS_SCHEMA, "line", required=("k",), keys=("src", "id", "turn", "line_no"))


@register("scan_jsonl_strict", "SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events")
def scan_jsonl_strict(spark, sf):
    """Strict parse of the JSON event properties (a bad line fails the job)."""
    e = Tables(spark, sf).events.select("event_id", F.col("props").alias("line"))
    return J.parse_json_lines_strict(e, PROPS_SCHEMA, "line", keys=("event_id",))


@register("sink_jsonl_roundtrip", """
SELECT doc_id, text, source, cluster_id FROM clustered
""", ("clustered",))
def sink_jsonl_roundtrip(spark, sf):
    """S9 → S1: write the clustered corpus as JSONL to the shared scratch
    folder and read it back with the tolerant scan."""
    c = FX.clustered(Tables(spark, sf))
    path = scratch_path(spark, "jsonl-sink")
    J.write_jsonl(c, path)
    back = J.read_jsonl(spark, path, c.schema, required=("text",))
    return back.filter(F.col("status") == "ok").select("doc_id", "text", "source", "cluster_id")


@register("scan_text_lines", f"""
SELECT conv_id, turn, CAST(i AS BIGINT) AS line_no, {Q.strip('parts[i]')} AS line
FROM (SELECT conv_id, turn, regexp_split_to_array(text, '\\r\\n|\\r|\\n') AS parts FROM conversations),
     LATERAL (SELECT unnest(generate_series(1, len(parts))) AS i)
WHERE {Q.strip('parts[i]')} <> ''
""")
def scan_text_lines(spark, sf):
    """Stripped non-blank lines with 1-based line numbers."""
    c = Tables(spark, sf).conversations.select("conv_id", "turn", "text")
    return TF.lines(c, "text", ("conv_id", "turn"))


SQL_PROMPT_FILE = """
files AS (SELECT conv_id, string_agg(text, chr(10) || chr(10) ORDER BY turn) AS content
          FROM conversations WHERE role = 'user' GROUP BY conv_id)
"""


def _prompt_files(t: Tables):
    """One prompt file per conversation: its user turns separated by blank lines.

    ``collect_list`` here gathers the turns of one conversation (a handful),
    not a corpus-sized group."""
    u = t.conversations.filter(F.col("role") == "user").select("conv_id", "turn", "text")
    g = u.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", "text"))).alias("ts"))
    return g.select("conv_id", F.array_join(F.col("ts.text"), "\n\n").alias("content"))


@register("scan_text_blocks", f"""
WITH {SQL_PROMPT_FILE.strip()},
parts AS (SELECT conv_id, list_filter(list_transform(string_split(content, chr(10) || chr(10)),
                                      lambda b: {Q.strip('b')}), lambda b: b <> '') AS bs FROM files)
SELECT conv_id, CAST(i AS BIGINT) AS block_no, bs[i] AS block
FROM parts, LATERAL (SELECT unnest(generate_series(1, len(bs))) AS i)
""")
def scan_text_blocks(spark, sf):
    """Blank-line separated prompt blocks."""
    return TF.blocks(_prompt_files(Tables(spark, sf)), "content", ("conv_id",))


@register("prompt_pipe_parse", f"""
WITH {SQL_SCORE_LOOKUP.strip()},
lines AS (SELECT doc_id, printf('%.1f', engagement_score) || ' | ' || cluster_topic || '|' || cluster_topic AS line
          FROM scored),
p AS (SELECT doc_id, list_transform(string_split(line, '|'), lambda x: {Q.strip('x')}) AS parts FROM lines)
SELECT doc_id, parts[1] AS engagement,
       '[engagement:' || parts[1] || '] ' || array_to_string(list_transform(parts[2:], lambda t: '[' || t || ']'), ' ')
       || chr(10) || 'Ispovest:' AS prompt
FROM p
""", ("votes_by_text", "topic_corpus"))
def prompt_pipe_parse(spark, sf):
    """Pipe records ``score|topic|topic`` → generation prompts."""
    s = scored_corpus(Tables(spark, sf))
    lines = s.select("doc_id", F.concat(F.format_string("%.1f", F.col("engagement_score")), F.lit(" | "),
                                        F.col("cluster_topic"), F.lit("|"), F.col("cluster_topic")).alias("line"))
    score, _topics, prompt = TF.pipe_prompt("line")
    return lines.select("doc_id", score.alias("engagement"), prompt.alias("prompt"))


@register("continuation", f"""
SELECT u.conv_id, u.turn,
       {Q.strip("substr(u.text || a.text, length(u.text) + 1)")} AS continuation
FROM conversations u JOIN conversations a ON a.conv_id = u.conv_id AND a.turn = u.turn + 1
WHERE u.role = 'user' AND a.role = 'assistant'
""")
def continuation_q(spark, sf):
    """generated text (prompt + answer) with the prompt prefix cut off."""
    c = Tables(spark, sf).conversations
    u = c.filter(F.col("role") == "user").select("conv_id", "turn", F.col("text").alias("prompt"))
    a = c.filter(F.col("role") == "assistant").select("conv_id", (F.col("turn") - 1).alias("turn"),
                                                     F.col("text").alias("answer"))
    j = u.join(a, ["conv_id", "turn"])
    gen = F.concat(F.col("prompt"), F.col("answer"))
    return j.select("conv_id", "turn", TF.continuation(gen, F.col("prompt")).alias("continuation"))


SQL_ARCHIVE = """
archive AS (SELECT props AS text, strftime(ts, '%Y-%m-%d') AS date, event_id AS ord FROM events)
"""


@register("resume_state", f"""
WITH {SQL_ARCHIVE.strip()}
SELECT CAST(count(DISTINCT CASE WHEN text IS NOT NULL AND text <> '' THEN {Q.content_hash('text')} END) AS BIGINT)
         AS n_seen,
       min(TRY_CAST(date AS DATE)) AS oldest_date,
       CAST(min(TRY_CAST(date AS DATE)) - INTERVAL 1 DAY AS DATE) AS resume_date,
       arg_max(date, ord) AS last_date
FROM archive
""")
def resume_state(spark, sf):
    """Resume point of an appended archive (the event log)."""
    e = Tables(spark, sf).events
    arch = e.select(F.col("props").alias("text"), F.date_format("ts", "yyyy-MM-dd").alias("date"),
                    F.col("event_id").alias("ord"))
    return FR.resume_state(arch)


@register("crawl_frontier", f"""
WITH {SQL_ARCHIVE.strip()},
st AS (SELECT CAST(min(TRY_CAST(date AS DATE)) - INTERVAL 1 DAY AS DATE) AS resume_date FROM archive),
days AS (SELECT CAST(d AS DATE) AS crawl_date FROM st,
         LATERAL (SELECT unnest(generate_series(CAST(coalesce(resume_date, DATE '2015-12-17') AS TIMESTAMP),
                                                TIMESTAMP '2023-06-01', - INTERVAL 1 DAY)) AS d)
         WHERE coalesce(resume_date, DATE '2015-12-17') >= DATE '2023-06-01')
SELECT crawl_date, CAST(p AS INTEGER) AS page,
       'https://example.org/sort/calendar/' || strftime(crawl_date, '%d') || '/' || strftime(crawl_date, '%m') || '/'
       || strftime(crawl_date, '%Y') || '//' || CAST(p AS VARCHAR) AS url
FROM days, LATERAL (SELECT unnest(generate_series(1, 5)) AS p)
""")
def crawl_frontier(spark, sf):
    """Remaining calendar pages from the resume date down to a minimum date."""
    e = Tables(spark, sf).events
    arch = e.select(F.col("props").alias("text"), F.date_format("ts", "yyyy-MM-dd").alias("date"),
                    F.col("event_id").alias("ord"))
    return FR.crawl_frontier(FR.resume_state(arch), min_date="2023-06-01")
