"""Relational operators of the corpus pipeline (P*, J*, W*, O*, U*).

Design notes for scale:
* first-/last-wins dedupe is an aggregate (``min_by``/``max_by``), not a
  window, so a key holding a third of all rows is reduced map-side before
  the shuffle instead of landing whole in one sort task;
* joins on long texts join on a SHA-256 of the normalised key, so the
  shuffle carries 32 bytes per row instead of the text;
* per-group first-N / samples use ``row_number() <= N`` which Spark turns
  into a partial ``WindowGroupLimit`` below the exchange;
* seeded samples order by ``sha2(seed|id)`` — deterministic and identical
  in any SQL engine — and use ``orderBy().limit()`` (TakeOrderedAndProject).
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quire.functions import scores as S
from quire.functions import text as T


def _cols(cols) -> list[str]:
    return [cols] if isinstance(cols, str) else list(cols)


# ---------------------------------------------------------------- dedupe --

def dedupe_first(df: DataFrame, key: str | Sequence[str], order: str) -> DataFrame:
    """Keep the first row (smallest ``order``, null last) of every key.

    Aggregate form: partial aggregation keeps one candidate per key per
    map task, so a hot key never gathers in one task.
    """
    keys = _cols(key)
    rest = [c for c in df.columns if c not in keys]
    if rest == [order]:  # nothing else to carry: a plain min stays in HashAggregate
        return df.groupBy(*keys).agg(F.min(order).alias(order))
    packed = F.struct(*[F.col(c) for c in rest])
    return (df.groupBy(*keys).agg(F.min_by(packed, F.struct(F.col(order).isNull(), F.col(order))).alias("_r"))
            .select(*keys, *[F.col(f"_r.{c}").alias(c) for c in rest]))


def dedupe_last(df: DataFrame, key: str | Sequence[str], order: str) -> DataFrame:
    """Dict-overwrite semantics — the row with the largest ``order`` wins
    (null is smaller than any)."""
    keys = _cols(key)
    rest = [c for c in df.columns if c not in keys]
    packed = F.struct(*[F.col(c) for c in rest])
    return (df.groupBy(*keys).agg(F.max_by(packed, F.struct(F.col(order).isNotNull(), F.col(order))).alias("_r"))
            .select(*keys, *[F.col(f"_r.{c}").alias(c) for c in rest]))


def with_content_hash(df: DataFrame, text_col: str = "text", name: str = "hash") -> DataFrame:
    return df.withColumn(name, T.content_hash(text_col))


def anti_join_seen(new: DataFrame, seen: DataFrame, text_col: str = "text") -> DataFrame:
    """Rows of ``new`` whose content hash is not in ``seen(hash)``."""
    return with_content_hash(new, text_col).join(seen.select("hash"), "hash", "left_anti")


def semi_join_seen(new: DataFrame, seen: DataFrame, text_col: str = "text") -> DataFrame:
    """Rows of ``new`` whose content hash is already in ``seen(hash)``."""
    return with_content_hash(new, text_col).join(seen.select("hash"), "hash", "left_semi")


# ------------------------------------------------------------ engagement --

KeyFn = Callable[[Column], Column]


def score_lookup(votes: DataFrame, key: KeyFn = T.normalize_key, text_col: str = "text",
                 order: str = "ord", digits: int | None = 4) -> DataFrame:
    """Build side of J1/J2: (key_hash, engagement_score), last row per key wins.

    ``votes`` holds (text, approve, disapprove, ord); the score is F5.
    """
    v = votes.select(F.sha2(key(F.col(text_col)), 256).alias("key_hash"),
                     S.engagement_score("approve", "disapprove", digits).alias("score"),
                     F.col(order).alias("_ord"))
    return v.groupBy("key_hash").agg(F.max_by("score", "_ord").alias("engagement_score"))


def join_engagement(corpus: DataFrame, votes: DataFrame, key: KeyFn = T.normalize_key,
                    text_col: str = "text", digits: int = 4, default: float = 0.0) -> DataFrame:
    """Left-join each corpus row to its vote score on the normalised text.

    Adds ``engagement_score`` (``default`` when unmatched) and ``matched``.
    The join key is SHA-256 of the normalised text; AQE splits a skewed
    probe-side key, and the build side has one row per key.
    """
    lookup = score_lookup(votes, key, digits=None)
    probe = corpus.withColumn("key_hash", F.sha2(key(F.col(text_col)), 256))
    joined = probe.join(lookup, "key_hash", "left")
    score = F.bround(F.col("engagement_score"), digits)
    return (joined.withColumn("matched", F.col("engagement_score").isNotNull())
            .withColumn("engagement_score", F.coalesce(score, F.lit(default)))
            .drop("key_hash"))


# ------------------------------------------------------- per-group top-N --

def first_n_per_group(df: DataFrame, group: str, order: str | Sequence[Column], n: int,
                      rank_col: str = "rn") -> DataFrame:
    """First ``n`` rows per group in ``order`` with a 1-based rank."""
    order_cols = [F.col(order)] if isinstance(order, str) else list(order)
    w = Window.partitionBy(group).orderBy(*order_cols)
    return df.withColumn(rank_col, F.row_number().over(w)).filter(F.col(rank_col) <= n)


def sample_key(id_col: str, seed: int = 42) -> Column:
    """Seeded, engine-neutral random order: sha2('<seed>|<id>')."""
    return F.sha2(F.concat(F.lit(f"{seed}|"), F.col(id_col).cast("string")), 256)


def sample_per_group(df: DataFrame, group: str, id_col: str, n: int, seed: int = 42) -> DataFrame:
    """``n`` rows per group without replacement (seeded)."""
    return first_n_per_group(df.withColumn("_sk", sample_key(id_col, seed)), group,
                             [F.col("_sk"), F.col(id_col)], n, "sample_rank").drop("_sk")


def sample_fixed(df: DataFrame, id_col: str, n: int, seed: int = 42) -> DataFrame:
    """``min(n, count)`` rows, seeded; a top-k, not a global sort."""
    return (df.withColumn("_sk", sample_key(id_col, seed))
            .orderBy("_sk", id_col).limit(n).drop("_sk"))


def global_row_number(df: DataFrame, order: Sequence[Column], name: str = "pos") -> DataFrame:
    """1-based position of every row in a global order, without a single-task window.

    Range-partition on the order and write the rows with their partition id
    as a reliable checkpoint (so every later read sees the same partition of
    each row, also after an executor loss); number rows inside each
    partition and add the row count of all earlier partitions (a table with
    one row per partition, so its broadcast is bounded by the partition count).
    """
    from quire.session import ensure_checkpoint_dir

    ensure_checkpoint_dir(df.sparkSession)
    order = list(order)
    ranged = df.repartitionByRange(*order).withColumn("_pid", F.spark_partition_id()).checkpoint()
    local = ranged.withColumn("_lrn", F.row_number().over(Window.partitionBy("_pid").orderBy(*order)))
    sizes = ranged.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"))
    offsets = sizes.select("_pid", F.coalesce(
        F.sum("_n").over(Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)),
        F.lit(0)).alias("_off"))
    return (local.join(F.broadcast(offsets), "_pid")
            .withColumn(name, (F.col("_off") + F.col("_lrn")).cast("bigint"))
            .drop("_pid", "_lrn", "_off"))


def late_row_number(df: DataFrame, keys: Sequence[str], order: Sequence[Column], name: str = "pos",
                    ties: Sequence[Column] = ()) -> DataFrame:
    """1-based position of every row in an order of its key columns, for rows that carry
    texts: only the keys are range-partitioned and numbered, with how often each stands, and
    the numbers are joined to the rows once. ``order`` is made of ``keys``; equal keys are
    numbered in the order of ``ties``.
    """
    from quire.session import cut_lineage

    counts = cut_lineage(df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")))
    ranged = cut_lineage(counts.repartitionByRange(*order).withColumn("_pid", F.spark_partition_id()))
    until = Window.partitionBy("_pid").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    offsets = ranged.groupBy("_pid").agg(F.sum("_n").alias("_m")).select("_pid", F.coalesce(
        F.sum("_m").over(Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_off"))   # a row a partition
    starts = (ranged.withColumn("_before", F.coalesce(F.sum("_n").over(until), F.lit(0))).join(F.broadcast(offsets), "_pid")
              .select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], (F.col("_off") + F.col("_before")).alias("_start")))
    same = [F.col(k).eqNullSafe(F.col(f"_k{i}")) for i, k in enumerate(keys)]
    joined = df.join(starts, same).drop(*[f"_k{i}" for i in range(len(keys))])
    place = F.lit(1)
    if counts.filter(F.col("_n") > 1).limit(1).count():
        place = F.row_number().over(Window.partitionBy(*keys).orderBy(*(ties or [F.lit(1)])))
    return joined.withColumn(name, (F.col("_start") + place).cast("bigint")).drop("_start")


def shuffle_position(df: DataFrame, id_col: str, seed: int = 7, name: str = "shuffle_pos") -> DataFrame:
    """A seeded shuffle expressed as a 1-based ``shuffle_pos`` column."""
    return late_row_number(df, [id_col], [sample_key(id_col, seed), F.col(id_col)], name)


#: Rows up to which a lookup table is broadcast; a larger one is joined by a shuffle.
SMALL_ROWS = 100_000


def small_side(df: DataFrame, rows: int | None = None) -> DataFrame:
    """The table marked for a broadcast if a count shows it to be small, else as it is."""
    most = SMALL_ROWS if rows is None else rows
    return F.broadcast(df) if df.limit(most + 1).count() <= most else df


# ------------------------------------------------------------ counters --

def count_by(df: DataFrame, group: str | Sequence[str], name: str = "n") -> DataFrame:
    """A1: rows per group (partial-aggregated map-side)."""
    return df.groupBy(*_cols(group)).agg(F.count(F.lit(1)).alias(name))


def having_size(df: DataFrame, group: str, min_size: int, name: str = "n") -> DataFrame:
    """Groups with at least ``min_size`` rows."""
    return count_by(df, group, name).filter(F.col(name) >= min_size)
