"""Posts table sink and scan.

The table lives as parquet under a shared folder (no database server);
appends number new rows after the table's current maximum id, in source
order, without a single-task window.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.functions import scores as S
from quire.functions import text as T
from quire.operators import relational as R

POSTS_COLUMNS = ("id", "text", "approve_count", "disapprove_count", "timestamp_raw", "source")


def _exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def ingest_posts(raw: DataFrame, path: str, source: str = "archive", order_col: str = "ord") -> DataFrame:
    """Raw posts (text, approve, disapprove, timestamp, ord) → posts table rows, appended.

    text stripped (null → ''), votes parsed as int (default 0), timestamp kept raw,
    ``source`` default; id = previous max id + position in source order.
    """
    spark = raw.sparkSession
    base = 0
    if _exists(spark, path):
        base = spark.read.parquet(path).agg(F.max("id")).first()[0] or 0
    rows = raw.select(T.py_strip(F.coalesce(F.col("text"), F.lit(""))).alias("text"),
                      S.parse_int("approve").alias("approve_count"),
                      S.parse_int("disapprove").alias("disapprove_count"),
                      F.col("timestamp").cast("string").alias("timestamp_raw"),
                      F.lit(source).alias("source"), F.col(order_col).alias("_ord"))
    # only the order column is ranked; the texts meet their numbers in one join
    rows = R.late_row_number(rows, ["_ord"], [F.col("_ord")], "_pos", [F.xxhash64("text", "timestamp_raw"), F.col("text")])
    out = rows.select((F.col("_pos") + F.lit(base)).cast("bigint").alias("id"), *POSTS_COLUMNS[1:])
    out.write.mode("append").parquet(path)
    return spark.read.parquet(path)


def scan_posts(spark: SparkSession, path: str, columns=("text", "approve_count", "disapprove_count")) -> DataFrame:
    """Projected scan; only the named columns are read from parquet."""
    return spark.read.parquet(path).select(*columns)
