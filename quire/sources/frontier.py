"""Crawl frontier and resume state.

The network half of a crawler is not built; its data half is: where to
resume, and which calendar pages remain to be fetched.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.functions import text as T

# ---- fixed values ----
PAGES_PER_DAY = 5
DEFAULT_START = "2015-12-17"
DEFAULT_MIN_DATE = "2010-01-01"


def resume_state(archive: DataFrame, text_col: str = "text", date_col: str = "date",
                 order_col: str = "ord") -> DataFrame:
    """S3/A6/A7 over an appended archive (text, date string, ord).

    One row: number of distinct content hashes of non-empty texts, the
    oldest parseable date, the resume date (oldest − 1 day) and the date
    of the last archive row (sequential variant).
    """
    d = F.try_to_date(F.col(date_col), "yyyy-MM-dd")
    h = F.when(F.col(text_col).isNotNull() & (F.col(text_col) != ""), T.content_hash(F.col(text_col)))
    return archive.agg(
        F.count_distinct(h).alias("n_seen"),
        F.min(d).alias("oldest_date"),
        F.date_sub(F.min(d), 1).alias("resume_date"),
        F.max_by(F.col(date_col), F.col(order_col)).alias("last_date"))


def crawl_frontier(state: DataFrame, min_date: str = DEFAULT_MIN_DATE, pages: int = PAGES_PER_DAY,
                   base_url: str = "https://example.org/sort/calendar") -> DataFrame:
    """(crawl_date, page, url) still to fetch, newest day first."""
    start = F.coalesce(F.col("resume_date"), F.to_date(F.lit(DEFAULT_START)))
    lo = F.to_date(F.lit(min_date))
    days = F.when(start >= lo, F.sequence(start, lo, F.expr("INTERVAL -1 DAY"))).otherwise(
        F.array().cast("array<date>"))
    x = state.select(F.explode(days).alias("crawl_date"))
    x = x.select("crawl_date", F.explode(F.sequence(F.lit(1), F.lit(pages))).alias("page"))
    url = F.concat_ws("/", F.lit(base_url), F.date_format("crawl_date", "dd"), F.date_format("crawl_date", "MM"),
                      F.date_format("crawl_date", "yyyy"), F.lit(""), F.col("page").cast("string"))
    return x.select("crawl_date", F.col("page").cast("int").alias("page"), url.alias("url"))
