"""Training-set preparation: split, sample, union, shuffle, topic tags."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quire.functions import text as T
from quire.operators import relational as R
from quire.session import cut_lineage
from quire.sources.fixtures import MISC_TOPIC, UNASSIGNED

# ---- fixed values ----
SAMPLE_UNASSIGNED = 5000   # unassigned posts kept in the training set
EXTRA_TOPICS = 1           # extra (other) topics appended per post
SCORE_TAG = "engagement_score"


def is_unassigned(cluster: Column, topic: Column) -> Column:
    """Unassigned when cluster == −999 or lower(topic) == 'razno' (no strip)."""
    return (cluster == UNASSIGNED) | (F.lower(topic) == MISC_TOPIC)


def topic_set(df: DataFrame, topic_col: str = "cluster_topic") -> DataFrame:
    """Distinct non-empty stripped lower-case topics, with a 1-based
    alphabetical rank (computed without a single-task window)."""
    t = df.select(T.topic_norm(F.col(topic_col)).alias("topic")).filter(F.col("topic") != "").distinct()
    return R.global_row_number(t, [F.col("topic")], "topic_rank")


def _hash_int(*parts: Column) -> Column:
    """Non-negative 60-bit integer from SHA-256 of the '|'-joined parts."""
    s = F.sha2(F.concat_ws("|", *[p.cast("string") for p in parts]), 256)
    return F.conv(F.substring(s, 1, 15), 16, 10).cast("bigint")


def with_extra_topic(df: DataFrame, topics: DataFrame, id_col: str = "doc_id",
                     topic_col: str = "cluster_topic", seed: int = 11) -> DataFrame:
    """One topic other than the row's own, chosen by a seeded hash.

    Equivalent to ``join(topics, topic != main)`` + pick one, without
    materialising the pairs: candidates are the ranks 1..n except the main
    topic's rank, so the k-th candidate maps to rank k (+1 past the own rank).
    ``topics`` is the topic set of ``topic_set`` (one row per topic), broadcast if a
    count shows it to be small and joined by shuffles otherwise.
    """
    topics = cut_lineage(topics)
    n = F.lit(topics.count())
    own = topics.select(F.col("topic").alias("_main"), F.col("topic_rank").alias("_own"))
    x = df.withColumn("_main", T.topic_norm(F.col(topic_col))).join(R.small_side(own), "_main", "left")
    n_cand = F.when(F.col("_own").isNull(), n).otherwise(n - 1)
    k = F.when(n_cand > 0, F.pmod(_hash_int(F.lit(seed), F.col(id_col)), n_cand) + 1)
    pick = F.when(F.col("_own").isNotNull() & (k >= F.col("_own")), k + 1).otherwise(k)
    x = x.withColumn("_pick", pick)
    extra = topics.select(F.col("topic_rank").alias("_pick"), F.col("topic").alias("extra_topic"))
    return x.join(R.small_side(extra), "_pick", "left").drop("_pick", "_own")


def training_text(score: Column, main: Column, extra: Column | None, text: Column,
                  tag: str = SCORE_TAG) -> Column:
    """``[tag:%.4f] [main] [extra] Ispovest:\\n<text without prefix>``.

    ``score`` must already be rounded (Spark's %.4f rounds half-up)."""
    tokens = F.concat(F.lit("["), main, F.lit("]"))
    if extra is not None:
        tokens = F.concat(tokens, F.when(extra.isNotNull(), F.concat(F.lit(" ["), extra, F.lit("]")))
                          .otherwise(F.lit("")))
    head = F.concat(F.lit(f"[{tag}:"), F.format_string("%.4f", F.coalesce(score, F.lit(0.0))), F.lit("] "))
    return F.concat(head, tokens, F.lit(" " + T.PREFIX), T.strip_prefix_everywhere(text))


def training_set(scored: DataFrame, sample_n: int = SAMPLE_UNASSIGNED, extra_topics: int = EXTRA_TOPICS,
                 id_col: str = "doc_id", sample_seed: int = 42, shuffle_seed: int = 7,
                 topic_seed: int = 11) -> DataFrame:
    """Clustered posts + a seeded sample of unassigned ones, shuffled and tagged.

    ``scored`` has (doc_id, text, cluster, cluster_topic, engagement_score).
    Returns (doc_id, shuffle_pos, text).
    """
    # the topic set, both branches of the union and the shuffle all read the
    # scored corpus: write it once (stage boundary, lineage cut)
    scored = cut_lineage(scored)
    flag = is_unassigned(F.col("cluster"), F.col("cluster_topic"))
    topics = topic_set(scored)
    clustered = scored.filter(~flag)
    sampled = R.sample_fixed(scored.filter(flag), id_col, sample_n, sample_seed)
    union = clustered.unionByName(sampled)
    main = T.topic_norm(F.col("cluster_topic"))
    if extra_topics > 0:
        union = with_extra_topic(union, topics, id_col, "cluster_topic", topic_seed)
        extra = F.col("extra_topic")
    else:
        extra = None
    out = union.withColumn("text", training_text(F.col("engagement_score"), main, extra, F.col("text")))
    out = R.shuffle_position(out.select(id_col, "text"), id_col, shuffle_seed)
    return out.select(id_col, "shuffle_pos", "text")
