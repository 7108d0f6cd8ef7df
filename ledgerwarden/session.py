"""Session settings the operators are designed for.

The operators do not depend on these values for correctness except the
session time zone: history and fact timestamps are ``timestamp_ntz`` and the
time buckets of ``operators.sequence`` are exact for them in any zone, but
``timestamp`` (LTZ) inputs are bucketed on the session clock, so UTC is pinned.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

DEFAULTS = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # Small stages (dimensions, per-bucket summaries) still get several tasks.
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "256k",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # A partition is skewed when it is 4x the median and above 256 MB; AQE then
    # splits it (and replicates the other side's matching partition).
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "256m",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    # Static broadcast only under 32 MB of estimated size; AQE may still
    # convert at run time from measured shuffle sizes.
    "spark.sql.autoBroadcastJoinThreshold": "32m",
    "spark.sql.files.maxPartitionBytes": "128m",
    "spark.sql.parquet.filterPushdown": "true",
}


def build_session(master: str | None = None, app: str = "ledgerwarden",
                  shuffle_partitions: int | None = None,
                  extra: dict[str, str] | None = None) -> SparkSession:
    """Get or create a session with the settings above.

    ``master`` and ``shuffle_partitions`` are for local runs and tests; on a
    cluster leave them unset and let the submit configuration decide.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULTS)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    if master and master.startswith("local"):
        conf.setdefault("spark.driver.memory", "16g")
        # Local mode: shuffle partitions = cores already, so coalescing small
        # shuffles could only take parallelism away. Clusters keep it on.
        conf["spark.sql.adaptive.coalescePartitions.enabled"] = "false"
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    if not (master and master.startswith("local")) and not shuffle_partitions:
        size_shuffles(spark)
    checkpoint_dir(spark)
    return spark


def size_shuffles(spark: SparkSession, per_core: int = 3) -> int:
    """Cluster default: start shuffles at ``per_core`` partitions per core.

    AQE can merge small shuffle partitions but cannot split ordinary ones, so
    the initial count must be large enough for the biggest stage (200, the
    Spark default, is ~500 GB per partition at 100 TB); small stages are then
    coalesced toward ``advisoryPartitionSizeInBytes``. A value the user set
    (anything but the default 200) is kept.
    """
    current = int(spark.conf.get("spark.sql.shuffle.partitions", "200"))
    if current != 200:
        return current
    target = max(current, per_core * spark.sparkContext.defaultParallelism)
    spark.conf.set("spark.sql.shuffle.partitions", str(target))
    return target


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for checkpoints and run outputs.

    Read from ``spark.checkpoint.dir`` (the cluster names it). Only when it is
    unset -- a local test session -- a private folder is created.
    """
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        path = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if not path:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
        path = tempfile.mkdtemp(prefix="ledgerwarden-ckpt-")
        spark.conf.set("spark.checkpoint.dir", path)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(path)
    return path


def scratch_path(spark: SparkSession, *parts: str) -> str:
    """A path under the shared checkpoint folder."""
    return os.path.join(checkpoint_dir(spark), *parts)
