"""SparkSession factory and shared-storage helpers.

Cluster jobs must not rely on a machine-local folder: intermediate tables and
checkpoints go under ``spark.checkpoint.dir``, which the cluster provides.
Only when that setting is absent (local tests) do we create one in /tmp.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

# Settings every job relies on: UTC timestamps, AQE (runtime broadcast choice,
# partition coalescing, skew-join splitting), no web UI.
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


# Sizing for the 100 TB target (1000 executors). AQE starts from many shuffle
# partitions and coalesces them to ~256 MB each; scans split at 256 MB; a
# partition 5x the median and above 1 GB counts as skewed and is split; a join
# side is broadcast only when its measured runtime size is under 64 MB.
CLUSTER_CONF = {
    "spark.sql.shuffle.partitions": "20000",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(256 << 20),
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": str(64 << 20),
    "spark.sql.files.maxPartitionBytes": str(256 << 20),
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(1 << 30),
    "spark.sql.adaptive.autoBroadcastJoinThreshold": str(64 << 20),
    "spark.sql.autoBroadcastJoinThreshold": str(64 << 20),
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.parquet.aggregatePushdown": "true",
}


def get_session(master: str | None = None, app: str = "threatspark",
                shuffle_partitions: int | None = None,
                extra: dict | None = None, profile: str = "local") -> SparkSession:
    """``profile="cluster"`` applies CLUSTER_CONF (for spark-submit on a
    cluster, where master, executors and memory come from the submit)."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(BASE_CONF)
    if profile == "cluster":
        conf.update(CLUSTER_CONF)
    if profile != "cluster":
        conf.setdefault("spark.driver.memory", "8g")  # local mode: the driver is the executor
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder, setting a local one only if unset."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or \
        sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        if not (sc.master or "").startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
        configured = tempfile.mkdtemp(prefix="threatspark-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Within it, what a query shuffled is removed when the query ends, not
    when the driver next collects garbage. For steps that store their results."""
    before = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.unset(_CLEANUP) if before is None else spark.conf.set(_CLEANUP, before)


def materialised(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once as Parquet below the shared checkpoint folder and
    read back: compressed (by zstd, as it is read once or twice and goes) and by
    column, where ``checkpoint`` writes whole rows as they lie in memory."""
    path = work_dir(df.sparkSession, f"{name}-{uuid.uuid4().hex}")
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def work_dir(spark: SparkSession, name: str) -> str:
    """A folder for written intermediate tables, under the shared checkpoint dir."""
    return f"{ensure_checkpoint_dir(spark)}/tables/{name}"
