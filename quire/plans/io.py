"""Registered queries: HTML extraction, streaming ingest/dedupe, JSON document sink, posts table."""

from __future__ import annotations

from pyspark.sql import functions as F

from quire.functions import text as T
from quire.operators import keywords as K
from quire.operators import relational as R
from quire.plans import sqlfrag as Q
from quire.plans.keywords import TAG_KW_SQL
from quire.plans.registry import register
from quire.session import cut_lineage, scratch_path, write_rows
from quire.sources import fixtures as FX
from quire.sources import html as H
from quire.sources import jsonl as J
from quire.sources import table as TB
from quire.sources.tables import Tables
from quire.streaming import ingest as ST

RECORD = H.FieldSpec("article")
FIELDS = {"title": H.FieldSpec("h1"), "para": H.FieldSpec("p")}


def _articles(spark, sf):
    return H.extract(Tables(spark, sf).pages, RECORD, FIELDS)


#: Arrivals of the documents at the stream, by ranges of their ids.
ARRIVALS = 4
ENTITY_DECODE = ("regexp_replace(replace(replace(replace(replace({x}, '&lt;', '<'), '&gt;', '>'), '&quot;', '\"'),"
                 " '&#x27;', ''''), '&amp;?', '&', 'g')")
#: Text of a piece of markup: each text node stripped, one after the other.
TEXT_NODES = ("array_to_string(list_transform(string_split_regex({x}, '<[^>]*>'), lambda x: "
              + Q.strip(ENTITY_DECODE.format(x="x")).replace("{", "{{").replace("}", "}}") + "), '')")
ARTICLE = r"regexp_extract_all(html, '<article[^>]*>([\s\S]*?)</article>', 1)"
#: The pages hold no article inside an article; a paragraph goes on to the next one, its end tag or the article's.
ARTICLES_SQL = rf"""
WITH art AS (SELECT page_id, unnest({ARTICLE}) AS art, generate_subscripts({ARTICLE}, 1) AS record_no FROM pages),
parts AS (SELECT page_id, CAST(record_no AS INTEGER) AS record_no,
                 CASE WHEN regexp_matches(art, '<h1[\s>]')
                      THEN {TEXT_NODES.format(x=r"regexp_extract(art, '<h1[^>]*>([\s\S]*?)</h1>', 1)")} END AS title,
                 list_transform(list_transform(string_split_regex(art, '<p(\s[^>]*)?>')[2:],
                                               lambda s: regexp_extract(s, '^([\s\S]*?)(</p>|$)', 1)),
                                lambda s: {TEXT_NODES.format(x='s')}) AS ps FROM art)
"""


@register("html_extract", ARTICLES_SQL + """
SELECT page_id, record_no, title, CAST(len(ps) AS INTEGER) AS n_paragraphs, array_to_string(ps, chr(10)) AS body FROM parts
""")
def html_extract(spark, sf):
    """M1: article records of every page: title, paragraph count, body text."""
    x = _articles(spark, sf)
    return x.select("page_id", "record_no", "title", F.size("para_all").alias("n_paragraphs"),
                    F.array_join("para_all", "\n").alias("body"))


@register("html_paragraph_counts", ARTICLES_SQL + """
SELECT page_id, record_no, title, CAST(len(ps) AS INTEGER) AS n_paragraphs FROM parts
""")
def html_paragraph_counts(spark, sf):
    """M1: title text and paragraph count of every article."""
    x = _articles(spark, sf)
    return x.select("page_id", "record_no", "title", F.size("para_all").cast("int").alias("n_paragraphs"))


#: Class that marks the records of ``html_selectors``, class and id prefix of their values.
POST = H.FieldSpec("div", "post")
VALUES = {"words": H.FieldSpec("div", "post-text"), "up": H.FieldSpec("div", "post-value", "up-"),
          "down": H.FieldSpec("div", "post-value", "down-")}


@register("html_selectors", """
SELECT conv_id, turn, CAST(1 AS INTEGER) AS record_no, trim(regexp_replace(coalesce(text, ''), '[^a-zA-Z ]', ' ', 'g')) AS words,
       CAST(length(coalesce(text, '')) AS VARCHAR) AS up, CAST(turn AS VARCHAR) AS down FROM conversations
""")
def html_selectors(spark, sf):
    """Records by class, their values by class and id prefix, from a page made of each turn."""
    c = Tables(spark, sf).conversations.select("conv_id", "turn", F.coalesce("text", F.lit("")).alias("text"))
    turn = F.col("turn").cast("string")

    def div(cls, mark, x):
        return F.concat(F.lit(f'<div class="x {cls}" id="{mark}-'), turn, F.lit('">'), x, F.lit("</div>"))

    page = F.concat(F.lit('<body><div class="posts"><div id="up-0" class="post-value">head</div><div class="post">'),
                    div("post-text", "text", F.regexp_replace("text", "[^a-zA-Z ]", " ")), div("post-value", "down", turn),
                    div("post-value", "up", F.length("text").cast("string")), F.lit("</div><p>foot</div></body>"))
    pages = c.select(F.concat_ws("|", "conv_id", "turn").alias("page_id"), page.alias("html"))
    key = F.split("page_id", "\\|")
    return H.extract(pages, POST, VALUES).select(key[0].cast("bigint").alias("conv_id"), key[1].cast("bigint").alias("turn"), "record_no",
                                                 F.coalesce("words", F.lit("")).alias("words"), "up", "down")


CRAWL_LEAST = 200     # characters below which a crawled record is left out


@register("crawl_to_posts", ARTICLES_SQL + f""",
rec AS (SELECT page_id, record_no, array_to_string(ps, ' ') AS text FROM parts),
firsts AS (SELECT page_id, record_no, text, row_number() OVER (PARTITION BY {Q.content_hash('text')} ORDER BY page_id, record_no) AS k
           FROM rec WHERE length({Q.strip('text')}) >= {CRAWL_LEAST})
SELECT CAST(row_number() OVER (ORDER BY page_id, record_no) AS BIGINT) AS id, {Q.strip('text')} AS text, CAST(page_id AS VARCHAR) AS timestamp_raw, 'crawl' AS source
FROM firsts WHERE k = 1
""")
def crawl_to_posts(spark, sf):
    """Crawl to table as one job: pages, their records, those long enough, the first of each content, appended to the
    posts table with ids in the order of the crawl."""
    rec = _articles(spark, sf).select("page_id", "record_no", F.array_join("para_all", " ").alias("text"))
    rec = rec.filter(F.length(T.py_strip(F.col("text"))) >= CRAWL_LEAST).withColumn("ord", F.struct("page_id", "record_no"))
    first = cut_lineage(R.dedupe_first(R.with_content_hash(rec, "text"), "hash", "ord"))
    raw = first.select("text", F.lit(None).cast("string").alias("approve"), F.lit(None).cast("string").alias("disapprove"),
                       F.col("ord.page_id").alias("timestamp"), "ord")
    posts = TB.ingest_posts(raw, scratch_path(spark, "crawl-table"), "crawl")
    return posts.select("id", "text", "timestamp_raw", "source")


@register("stream_ingest", f"""
SELECT hash, min(doc_id) AS doc_id FROM (SELECT doc_id, {Q.content_hash('text')} AS hash FROM documents)
GROUP BY hash
""")
def stream_ingest(spark, sf):
    """Documents arrive in ranges of their ids, the first range once more at the end. The stream
    is started anew after each arrival and takes what is new; a micro-batch is
    deduped first-wins and anti-joined against the sink (idempotent on replay)."""
    docs = Tables(spark, sf).documents
    low, high = docs.agg(F.min("doc_id"), F.max("doc_id")).first()
    low, high = (0, 0) if low is None else (low, high)
    cut = [low + (high - low + 1) * k // ARRIVALS for k in range(ARRIVALS + 1)]
    source, sink, ckpt = (scratch_path(spark, f"stream-{x}") for x in ("source", "sink", "ckpt"))
    for k in [*range(ARRIVALS), 0]:
        part = docs.filter((F.col("doc_id") >= cut[k]) & (F.col("doc_id") < cut[k + 1]) | (F.col("doc_id").isNull() if k == 0 else F.lit(False)))
        write_rows(part, source, "append")
        out = ST.ingest_stream(spark, source, "*.parquet", docs.schema, sink, ckpt, max_files=1_000_000, prefix=1)
    return out.select("hash", "doc_id")


@register("stream_dedupe", "SELECT DISTINCT props FROM events")
def stream_dedupe(spark, sf):
    """Stateful dedupe of the event stream on its payload."""
    schema = Tables(spark, sf).events.schema
    out = ST.dedupe_stream(spark, sf, "events.parquet", schema, ["props"], scratch_path(spark, "dedupe-sink"),
                           scratch_path(spark, "dedupe-ckpt"))
    return out.select("props")


@register("sink_json_document", f"""
WITH {TAG_KW_SQL.strip()},
g AS (SELECT cluster_id, count(*) AS num_texts FROM clustered GROUP BY cluster_id)
SELECT g.cluster_id, coalesce(k.keyword, 'UNKNOWN') AS keyword, CAST(g.num_texts AS BIGINT) AS num_texts
FROM g LEFT JOIN keywords k ON g.cluster_id = k.cluster_id
""", ("clustered",))
def sink_json_document(spark, sf):
    """S10 → S4: cluster summary written as one pretty JSON array document,
    read back with the multi-line JSON reader."""
    c = FX.clustered(Tables(spark, sf))
    summ = R.count_by(c, "cluster_id", "num_texts").join(K.tag_keywords(c), "cluster_id", "left")
    summ = summ.select("cluster_id", F.coalesce("keyword", F.lit(K.UNKNOWN)).alias("keyword"), "num_texts")
    path = scratch_path(spark, "json-doc")
    J.write_json_document(summ, path)
    back = J.read_json_array(spark, path, summ.schema)
    return back.select(F.col("cluster_id").cast("int"), "keyword", F.col("num_texts").cast("bigint"))


POSTS_SQL = f"""
raw AS (SELECT d.doc_id AS ord, d.text, v.approve, v.disapprove FROM documents d
        LEFT JOIN votes v ON v.user_id = d.doc_id),
posts AS (SELECT CAST(row_number() OVER (ORDER BY ord) AS BIGINT) AS id, {Q.strip("coalesce(text, '')")} AS text,
                 {Q.parse_int('approve')} AS approve_count, {Q.parse_int('disapprove')} AS disapprove_count,
                 CAST(NULL AS VARCHAR) AS timestamp_raw, 'archive' AS source FROM raw)
"""


def _ingest(spark, sf):
    t = Tables(spark, sf)
    raw = t.documents.select(F.col("doc_id").alias("ord"), "text").join(
        FX.votes(t).withColumnRenamed("user_id", "ord"), "ord", "left")
    raw = raw.withColumn("timestamp", F.lit(None).cast("string"))
    path = scratch_path(spark, "posts-table")
    return TB.ingest_posts(raw, path), path


@register("ingest_table", f"WITH {POSTS_SQL.strip()} SELECT * FROM posts", ("votes",))
def ingest_table(spark, sf):
    """Raw posts appended to the posts table with ids, parsed votes and defaults."""
    out, _ = _ingest(spark, sf)
    return out


@register("scan_table_project", f"WITH {POSTS_SQL.strip()} SELECT text, approve_count, disapprove_count FROM posts",
          ("votes",))
def scan_table_project(spark, sf):
    """Projected scan of the posts table (3 of 6 columns reach the reader)."""
    _, path = _ingest(spark, sf)
    return TB.scan_posts(spark, path)


@register("passthrough_update", f"""
WITH sc AS (SELECT user_id, {Q.engagement_score('approve', 'disapprove')} AS s FROM votes)
SELECT e.event_id,
       CASE WHEN regexp_matches(e.props, '^\\s*[{{]\\s*[}}]\\s*$')
            THEN '{{"engagement_score": ' || printf('%.4f', coalesce(sc.s, 0.0)) || '}}'
            ELSE regexp_replace(e.props, '[}}]\\s*$', '') || ', "engagement_score": '
                 || printf('%.4f', coalesce(sc.s, 0.0)) || '}}' END AS line
FROM events e LEFT JOIN sc ON e.user_id = sc.user_id
""", ("votes",))
def passthrough_update(spark, sf):
    """Each event's JSON payload gains its user's engagement score; all
    other keys pass through untouched."""
    t = Tables(spark, sf)
    from quire.functions import scores as S

    sc = FX.votes(t).select("user_id", S.engagement_score("approve", "disapprove").alias("s"))
    e = t.events.select("event_id", "user_id", "props").join(sc, "user_id", "left")
    val = F.format_string("%.4f", F.coalesce(F.col("s"), F.lit(0.0)))
    return e.select("event_id", J.set_json_field("props", "engagement_score", val).alias("line"))
