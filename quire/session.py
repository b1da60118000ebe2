"""Spark session defaults and the checkpoint folder used by iterative jobs."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Session settings every job in this package assumes (AQE on, Arrow on, UTC).
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    # checkpoint files go when nothing refers to them any more
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # the driver keeps plan/metric history even with the UI off: keep it short
    "spark.sql.ui.retainedExecutions": "50",
    "spark.ui.retainedJobs": "200",
    "spark.ui.retainedStages": "200",
    "spark.ui.retainedTasks": "10000",
    # top-k filters up to this size are pushed below the shuffle (WindowGroupLimit)
    "spark.sql.optimizer.windowGroupLimitThreshold": "10000",
}


def get_spark(master: str | None = None, shuffle_partitions: int | None = None,
              app: str = "quire", extra: dict | None = None) -> SparkSession:
    """Create (or reuse) a session with the package defaults.

    On a cluster the master and ``spark.checkpoint.dir`` come from the
    submit configuration; only a local session gets a scratch checkpoint
    folder (see :func:`ensure_checkpoint_dir`).
    """
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    for k, v in DEFAULT_CONF.items():
        b = b.config(k, v)
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


# Runtime SQL settings the operators rely on; applied to any session handed in
# (static settings such as UI retention only apply to sessions built here).
RUNTIME_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # a Python worker holds several copies of a batch; Spark's own limit is 64 MB, and wide texts reach it on large inputs
    "spark.sql.execution.arrow.maxBytesPerBatch": "8m",
}
MIN_WINDOW_GROUP_LIMIT = 10000


def cluster_conf(input_bytes: int, target_partition_bytes: int = 128 << 20,
                 max_partitions: int = 200_000) -> dict[str, str]:
    """Settings for a cluster run over ``input_bytes`` of compressed parquet.

    Text expands roughly 2-3x when decompressed and exploded into terms, so
    shuffle partitions are sized for ~``target_partition_bytes`` of
    2 x input each (AQE coalesces the small ones and splits skewed ones);
    beyond ``max_partitions`` the partition size grows instead. Pass the
    result as ``get_spark(extra=cluster_conf(n_bytes))`` or to spark-submit.
    """
    n = -(-2 * input_bytes // target_partition_bytes)
    if n > max_partitions:
        target_partition_bytes = -(-2 * input_bytes // max_partitions)
        n = max_partitions
    n = max(n, 200)
    return {
        "spark.sql.shuffle.partitions": str(n),
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(n),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes),
        "spark.sql.files.maxPartitionBytes": str(target_partition_bytes),
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(4 * target_partition_bytes),
        # broadcast only what AQE measured to be small at run time
        "spark.sql.autoBroadcastJoinThreshold": str(64 << 20),
        "spark.sql.adaptive.autoBroadcastJoinThreshold": str(64 << 20),
        "spark.sql.streaming.stateStore.providerClass":
            "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    }


def apply_runtime_conf(spark: SparkSession) -> None:
    """Make a caller's session fit the plans: AQE (skew splits, coalescing),
    Arrow, and a WindowGroupLimit threshold large enough for the per-cluster
    top-8000 vocabulary filter to run partially below the shuffle."""
    for k, v in RUNTIME_CONF.items():
        spark.conf.set(k, v)
    key = "spark.sql.optimizer.windowGroupLimitThreshold"
    try:
        cur = int(spark.conf.get(key))
    except (TypeError, ValueError):
        cur = 0
    if cur < MIN_WINDOW_GROUP_LIMIT:
        spark.conf.set(key, str(MIN_WINDOW_GROUP_LIMIT))


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder, creating a scratch one only locally.

    The cluster names its shared folder in ``spark.checkpoint.dir``; that
    setting wins. A machine-local folder is only acceptable when the whole
    application runs in one local JVM (tests, benches).
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if conf_dir:
        sc.setCheckpointDir(conf_dir)
        return sc.getCheckpointDir()
    if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
        raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
    d = tempfile.mkdtemp(prefix="quire-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    sc.setCheckpointDir(d)
    return sc.getCheckpointDir()


# a task reads whole row groups: Spark's own 128 MB let one task read a file that few wrote
ROW_GROUP_BYTES = 8 << 20


def write_rows(df, path: str, mode: str = "error") -> None:
    """Write rows in row groups of about ``ROW_GROUP_BYTES``, so that they are read by many tasks even where
    few tasks held them all (a range of keys in one part of a table)."""
    df.write.mode(mode).option("parquet.block.size", ROW_GROUP_BYTES).parquet(path)


_SCRATCH: list[str] = []


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh sub-folder of the shared checkpoint folder for written tables (see :func:`drop_scratch`)."""
    import uuid

    base = ensure_checkpoint_dir(spark).rstrip("/")
    _SCRATCH.append(f"{base}/{name}-{uuid.uuid4().hex[:12]}")
    return _SCRATCH[-1]


def drop_scratch(spark: SparkSession) -> int:
    """Delete every folder that this process got from :func:`scratch_path`; for after the last
    action on anything that was read from them. Returns how many there were."""
    jvm, conf, gone = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration(), 0
    while _SCRATCH:
        path = jvm.org.apache.hadoop.fs.Path(_SCRATCH.pop())
        gone += bool(path.getFileSystem(conf).delete(path, True))
    return gone


def cut_lineage(df):
    """Reliable checkpoint in the shared checkpoint folder (never a local one)."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint()
