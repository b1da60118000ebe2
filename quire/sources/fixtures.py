"""Bindings of the corpus data model onto the driver tables.

The pipeline's inputs (clustered posts, vote tables, topic files, ...) are
derived here from the given tables with plain DataFrame operations, so every
query's work grows with the tables. Each binding has a SQL twin in
``quire.plans.sqlfrag`` (used by the oracle SQL) written independently for DuckDB.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.functions import text as T
from quire.sources.tables import Tables

# ---- fixed values of the binding ----
NOISE = -1            # density-cluster noise label
SHORT = 40            # characters below which a text without a label is noise
FIRST_SOURCE_CLUSTER = 10
UNASSIGNED = -999     # topic corpus "no cluster"
MISC_TOPIC = "razno"  # topic name of unassigned posts
APPROVE_EVENTS = ("click", "purchase", "signup")
DISAPPROVE_EVENTS = ("error",)


def clustered(t: Tables) -> DataFrame:
    """(doc_id, text, source, cluster_id): the embedding's label; a document without one
    belongs to its source (10 + the source's number), or is noise (−1) if it is shorter than
    ``SHORT`` characters or its source has no number."""
    number = F.regexp_extract("source", "([0-9]+)$", 1).try_cast("int")
    by_source = F.when(F.length("text") >= SHORT, number + FIRST_SOURCE_CLUSTER)
    # taken from the text before the join, so that a query that needs no text shuffles none
    docs = t.documents.select("doc_id", "text", "source", by_source.alias("_own"))
    labels = t.embeddings.select(F.col("vec_id").alias("doc_id"), F.col("label"))
    return (docs.join(labels, "doc_id", "left")
            .select("doc_id", "text", "source",
                    F.coalesce("label", "_own", F.lit(NOISE)).cast("int").alias("cluster_id")))


def topic_corpus(t: Tables) -> DataFrame:
    """(doc_id, text, cluster, cluster_topic): −999 = unassigned, topic = source."""
    c = clustered(t)
    cluster = F.when(F.col("cluster_id") == NOISE, F.lit(UNASSIGNED)).otherwise(F.col("cluster_id"))
    return c.select("doc_id", "text", cluster.cast("int").alias("cluster"),
                    F.when(cluster == UNASSIGNED, F.lit(MISC_TOPIC)).otherwise(F.col("source"))
                    .alias("cluster_topic"))


def votes(t: Tables) -> DataFrame:
    """(user_id, approve, disapprove) as strings: vote counts per user from events."""
    e = t.events.select("user_id", "event_type")
    return (e.groupBy("user_id")
            .agg(F.count_if(F.col("event_type").isin(*APPROVE_EVENTS)).alias("a"),
                 F.count_if(F.col("event_type").isin(*DISAPPROVE_EVENTS)).alias("d"))
            .select("user_id", F.col("a").cast("string").alias("approve"),
                    F.col("d").cast("string").alias("disapprove")))


def votes_by_text(t: Tables) -> DataFrame:
    """(text, approve, disapprove, ord): the posts table with its vote counts."""
    v = votes(t)
    d = t.documents.select(F.col("doc_id").alias("user_id"), "text")
    return v.join(d, "user_id").select("text", "approve", "disapprove", F.col("user_id").alias("ord"))


def seen_hashes(t: Tables) -> DataFrame:
    """(hash): content hashes of posts already processed (those with a label row)."""
    done = t.labels.select("doc_id")
    return (t.documents.select("doc_id", "text").join(done, "doc_id", "left_semi")
            .select(T.content_hash("text").alias("hash")).distinct())


def topic_lines(t: Tables) -> DataFrame:
    """(line_no, line): a manual topic file ``<id> <topic> (comment)``, one line per nation.

    The id is the region key, so ids repeat and the duplicate-id repair (W5)
    has work to do; the comment holds the nation key.
    """
    n = t.nation
    return n.select((F.col("n_nationkey") + 1).cast("bigint").alias("line_no"),
                    F.concat_ws(" ", F.col("n_regionkey").cast("string"), "n_name",
                                F.concat(F.lit("("), F.col("n_nationkey").cast("string"), F.lit(")")))
                    .alias("line"))


def anchored(t: Tables) -> DataFrame:
    """(vec_id, v, label): unit vectors pulled toward their label's axis.

    x = embedding as double; every vector whose id is not a multiple of 7
    gets +2.0 on coordinate ``label``; v = x / |x|. This gives the raw
    fixture (which has no density structure) clusters plus genuine noise.
    """
    e = t.embeddings
    x = F.transform(F.col("embedding"), lambda v, i: v.cast("double")
                    + F.when((i == F.col("label")) & (F.col("vec_id") % 7 != 0), F.lit(2.0)).otherwise(F.lit(0.0)))
    e = e.select("vec_id", "label", x.alias("x"))
    # norm evaluated once per row (not inside the element lambda)
    norm = F.array_repeat(F.sqrt(F.aggregate("x", F.lit(0.0), lambda acc, v: acc + v * v)), F.size("x"))
    return e.select("vec_id", F.zip_with("x", norm, lambda v, m: v / m).alias("v"), "label")
