"""Spark session defaults and the shared checkpoint location."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings every job relies on.  On a cluster the operator passes the
# cluster-sized values (shuffle partitions, advisory partition size) through
# spark-submit; these are only used when the session is created here.
_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # keep hot-key partitions splittable even when they are "only" 64 MB
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64m",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "128m",
    "spark.sql.ui.retainedExecutions": "20",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "socialcart", extra: dict | None = None) -> SparkSession:
    """Create (or reuse) a session with the package defaults.

    ``master`` and ``shuffle_partitions`` are only applied when given, so a
    session configured by spark-submit keeps the cluster's values.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for k, v in _DEFAULTS.items():
        builder = builder.config(k, v)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster this setting points at shared storage and is read as is.
    Only when it is unset and the master is local (tests) a fresh scratch folder
    is created and registered, so ``DataFrame.checkpoint()`` and streaming
    checkpoints work; on a cluster executors would not share it, so that fails.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()  # set from spark.checkpoint.dir at start-up
    if current:
        return current
    path = sc.getConf().get("spark.checkpoint.dir", None)
    if not path:
        if not sc.master.startswith("local[") and sc.master != "local":
            raise ValueError(f"set spark.checkpoint.dir to a folder that all executors of {sc.master} share")
        path = tempfile.mkdtemp(prefix="socialcart-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    sc.setCheckpointDir(path)
    return sc.getCheckpointDir() or path


def cluster_conf(input_bytes: int, executor_cores: int, executors: int,
                 shuffle_bytes: int | None = None,
                 target_partition_bytes: int = 128 * 1024 ** 2,
                 max_shuffle_partitions: int = 100_000) -> dict[str, str]:
    """Settings sized for a cluster run over ``input_bytes`` of input.

    * scan splits of ``target_partition_bytes`` (``maxPartitionBytes``);
    * initial shuffle partitions ≈ largest shuffle / target size, clamped
      to [2 × total cores, ``max_shuffle_partitions``].  The shuffles here
      move pre-aggregated rows, so ``shuffle_bytes`` defaults to a tenth of
      the input; AQE then coalesces small partitions to the advisory size
      and splits skewed ones (the clamp keeps the maps × reducers shuffle
      bookkeeping bounded);
    * broadcasts stay decided by the explicit row checks in the plans; the
      automatic threshold is kept at the Spark default.

    Example: 100 TB on 1000 executors × 8 cores → 81,920 initial shuffle
    partitions of ~128 MB each for a 10 TB shuffle.
    """
    cores = executor_cores * executors
    sb = shuffle_bytes if shuffle_bytes is not None else input_bytes // 10
    shuffle = min(max(2 * cores, sb // target_partition_bytes), max_shuffle_partitions)
    return {
        "spark.sql.files.maxPartitionBytes": str(target_partition_bytes),
        "spark.sql.shuffle.partitions": str(shuffle),
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(shuffle),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes),
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(2 * target_partition_bytes),
        "spark.default.parallelism": str(2 * cores),
    }
