"""Session construction and shared scratch locations.

Every job takes a ``SparkSession``; nothing in the library creates one on
its own except :func:`build_session`, which tests, ``bench.py`` and the
command-line jobs use.

Scratch data (checkpoints, intermediate tables, stream state of the test
queries) always lives under the folder the cluster names in
``spark.checkpoint.dir``. We only set our own folder when the session has
none, which happens in local test sessions.
"""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings that shape the physical plans of every job. AQE re-plans joins at
# runtime from measured shuffle sizes (a size-checked broadcast with a
# sort-merge fallback), splits skewed join partitions and coalesces small
# shuffle partitions.
TUNED_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # remove checkpoint files once the DataFrames that wrote them are gone
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def build_session(
    master: str | None = None,
    app_name: str = "cdclake",
    shuffle_partitions: int | None = None,
    conf: dict[str, str] | None = None,
) -> SparkSession:
    """Create (or fetch) a session with the tuned settings.

    ``shuffle_partitions`` defaults to 2x the local cores for local masters;
    on a cluster pass a number sized for the data (partitions of ~128 MB of
    shuffle output) and let AQE coalesce.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = dict(TUNED_CONF)
    if shuffle_partitions is None and (master or "").startswith("local"):
        shuffle_partitions = 2 * (os.cpu_count() or 4)
    if shuffle_partitions:
        settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    settings.update(conf or {})
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def scale_conf(shuffle_bytes: int, total_cores: int, target_partition_bytes: int = 256 * 1024**2) -> dict[str, str]:
    """Settings for a large run, from the expected shuffle volume and the cluster's cores.

    Shuffle partitions are sized so each holds about ``target_partition_bytes``
    before AQE coalesces the small ones (at least three waves of tasks). Input
    splits are 512 MB; a partition counts as skewed above 1 GB and 5x the
    median, and AQE then splits it. The runtime broadcast limit is a measured
    size, so a dimension is broadcast only when it is actually small. The
    command-line jobs apply it with ``--shuffle-bytes`` and ``--cores``.
    """
    parts = max(3 * total_cores, -(-shuffle_bytes // target_partition_bytes))
    return {
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.files.maxPartitionBytes": str(512 * 1024**2),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes),
        "spark.sql.adaptive.coalescePartitions.minPartitionSize": str(64 * 1024**2),
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(1024**3),
        "spark.sql.adaptive.autoBroadcastJoinThreshold": str(64 * 1024**2),
    }


def _is_local(spark: SparkSession) -> bool:
    return spark.sparkContext.master.startswith("local")


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder, creating a local one only in local mode."""
    try:
        sc = spark.sparkContext
    except Exception:  # a Spark Connect session has no context: use the configured folder
        configured = spark.conf.get("spark.checkpoint.dir", None)
        if not configured:
            raise RuntimeError("spark.checkpoint.dir is not set")
        return configured
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        if not _is_local(spark):
            raise RuntimeError(
                "spark.checkpoint.dir is not set; a cluster run needs a shared folder for "
                "checkpoints and intermediate tables"
            )
        configured = tempfile.mkdtemp(prefix="cdclake-ckpt-")
        atexit.register(shutil.rmtree, configured, ignore_errors=True)
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def _scratch_root(spark: SparkSession) -> str:
    """This application's own folder below the shared checkpoint folder."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/cdclake/{spark.sparkContext.applicationId}"


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder below the shared checkpoint folder."""
    return f"{_scratch_root(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write an intermediate to the shared scratch folder and read it back.

    Its size is then known to the planner, several jobs may read it, and a
    lost executor re-reads files instead of recomputing the lineage.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def drop_scratch(spark: SparkSession) -> None:
    """Delete this application's scratch folder (at the end of a job, when nothing reads from it any more)."""
    root = spark._jvm.org.apache.hadoop.fs.Path(_scratch_root(spark))
    root.getFileSystem(spark._jsc.hadoopConfiguration()).delete(root, True)
