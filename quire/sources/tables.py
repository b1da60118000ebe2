"""Driver tables: one parquet file per table under a scale-factor folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels",
          "conversations")


#: Session setting: number of partitions over which rows are dealt right after a scan (unset: none).
SCAN_PARTITIONS = "quire.scan.partitions"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Lazy parquet scan, listed anew at each call; Catalyst prunes columns and
    pushes filters into it. How it is split is left to ``maxPartitionBytes``,
    ``minPartitionNum`` and the files' row groups. For files written with fewer
    row groups than there are cores, ``quire.scan.partitions`` deals the projected and
    filtered rows over that many partitions before anything else is done
    with them; it depends on no size, and results are the same."""
    if name not in TABLES:
        raise KeyError(name)
    rows = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    parts = spark.conf.get(SCAN_PARTITIONS, None)
    return rows.repartition(int(parts)) if parts else rows


class Tables:
    """Attribute access to the tables of one scale factor: ``t.documents``."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        from quire.session import apply_runtime_conf

        apply_runtime_conf(spark)
        self.spark = spark
        self.sf_dir = sf_dir

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_") or name not in TABLES:
            raise AttributeError(name)
        return table(self.spark, self.sf_dir, name)
