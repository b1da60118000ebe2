"""Manual-topic lookups, topic naming and cluster tags."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quire.functions import text as T
from quire.operators import relational as R
from quire.session import cut_lineage
from quire.sources.fixtures import MISC_TOPIC, NOISE, UNASSIGNED

#: Lines that one task folds.
BLOCK_LINES = 50_000


def parse_topic_lines(lines: DataFrame, line_col: str = "line", no_col: str = "line_no") -> DataFrame:
    """``<int> <topic> (comment)`` lines → (line_no, raw_id, topic).

    Blank lines and lines without a leading number are skipped.
    """
    s = T.py_strip(F.col(line_col))
    ok = lines.select(F.col(no_col).alias("line_no"), s.alias("_l")).filter(
        (F.col("_l") != "") & F.col("_l").rlike(T.TOPIC_LINE))
    return ok.select("line_no", T.topic_line_id("_l").alias("raw_id"), T.topic_line_name("_l").alias("topic"))


def repair_topic_ids(parsed: DataFrame, block_lines: int | None = None) -> DataFrame:
    """Sequential duplicate-id repair in line order.

    Rule: the first line keeps its id; a later line whose id was already
    used takes (previous fixed id + 1), otherwise keeps its own id.

    The lines are numbered and cut into blocks, and every block is folded by a task of
    its own, given what earlier blocks hand on: the last fixed id before it, and
    which of its ids an earlier block has used (a join on the id). Both come from the
    round before; a block is right once all earlier ones are, and in fact as
    soon as what they hand on no longer changes, so rounds end when no id changes.
    Returns (line_no, raw_id, fixed_id, topic).
    """
    size = BLOCK_LINES if block_lines is None else block_lines
    kept = parsed.select(F.col("line_no").cast("bigint").alias("line_no"), F.col("raw_id").cast("bigint").alias("raw_id"), "topic")
    lines = cut_lineage(R.global_row_number(kept, [F.col("line_no"), F.col("raw_id")], "pos")
                        .withColumn("block", F.floor((F.col("pos") - 1) / size)))
    columns = "pos long, block long, line_no long, raw_id long, fixed_id long, topic string"

    def fold(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("pos")
        carry, used, fixed = pdf["carry"].iloc[0], set(), []
        now = None if pd.isna(carry) else int(carry)
        for raw, before in zip(pdf["raw_id"].tolist(), pdf["before"].tolist()):
            now = now + 1 if now is not None and (before or raw in used) else raw
            used.add(now)
            fixed.append(now)
        return pdf.assign(fixed_id=fixed)[["pos", "block", "line_no", "raw_id", "fixed_id", "topic"]]

    told = lines.withColumn("before", F.lit(False)).withColumn("carry", F.lit(None).cast("string"))
    state = cut_lineage(told.groupBy("block").applyInPandas(fold, columns))
    while state.filter(F.col("block") > 0).limit(1).count():
        first = state.groupBy(F.col("fixed_id").alias("raw_id")).agg(F.min("block").alias("_at"))
        last = state.groupBy((F.col("block") + 1).alias("block")).agg(F.max_by("fixed_id", "pos").cast("string").alias("carry"))
        told = (lines.join(first, "raw_id", "left").withColumn("before", F.coalesce(F.col("_at") < F.col("block"), F.lit(False)))
                .join(R.small_side(last), "block", "left").drop("_at"))
        new = cut_lineage(told.groupBy("block").applyInPandas(fold, columns))
        was = state.select("pos", F.col("fixed_id").alias("_was"))
        changed = new.join(was, "pos").filter(F.col("fixed_id") != F.col("_was")).limit(1).count()
        state = new
        if not changed:
            break
    return state.select("line_no", "raw_id", "fixed_id", "topic")


def topic_lookup(lines: DataFrame) -> DataFrame:
    """Topic file → (cluster, manual_topic); a later line overwrites an earlier one."""
    fixed = repair_topic_ids(parse_topic_lines(lines))
    last = R.dedupe_last(fixed.select(F.col("fixed_id").alias("cluster"), "topic", "line_no"), "cluster", "line_no")
    return last.select(F.col("cluster").cast("int").alias("cluster"), F.col("topic").alias("manual_topic"))


def apply_manual_topics(corpus: DataFrame, lookup: DataFrame) -> DataFrame:
    """−999 → 'razno'; mapped cluster → manual topic; else unchanged.

    The lookup is broadcast only if its count allows it.
    Adds ``topic_source`` in {razno, manual, untouched} for the A2 counters.
    """
    j = corpus.join(R.small_side(lookup), "cluster", "left")
    src = (F.when(F.col("cluster") == UNASSIGNED, F.lit("razno"))
           .when(F.col("manual_topic").isNotNull(), F.lit("manual")).otherwise(F.lit("untouched")))
    topic = (F.when(F.col("cluster") == UNASSIGNED, F.lit(MISC_TOPIC))
             .when(F.col("manual_topic").isNotNull(), F.col("manual_topic"))
             .otherwise(F.col("cluster_topic")))
    return j.withColumn("cluster_topic", topic).withColumn("topic_source", src).drop("manual_topic")


def cluster_tag(cluster_id: Column, text: Column) -> Column:
    """``<CLUSTER_n> text <CLUSTER_n>``; noise → ``<NO_TOPIC>``."""
    tag = F.when(cluster_id == NOISE, F.lit("<NO_TOPIC>")).otherwise(
        F.concat(F.lit("<CLUSTER_"), cluster_id.cast("string"), F.lit(">")))
    return F.concat(tag, F.lit(" "), T.py_strip(text), F.lit(" "), tag)


def keyword_tag(keyword: Column, text: Column) -> Column:
    """``<kw> Ispovest:\\n text <kw>``."""
    tag = F.concat(F.lit("<"), keyword, F.lit(">"))
    return F.concat(tag, F.lit(" " + T.PREFIX), text, F.lit(" "), tag)
