"""Session helpers.

Library code never pins a master or a local path: it reads what the cluster
configured. Only tests and local scripts call :func:`local_session`.
"""

from __future__ import annotations

import os
import re
import tempfile

from pyspark.sql import SparkSession

# Settings every job of this package relies on. They are safe defaults for a
# cluster too: AQE re-plans joins and coalesces shuffle partitions at run time,
# skew-join splitting handles hot keys, partition values stay strings.
RECOMMENDED_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionColumnTypeInference.enabled": "false",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.session.timeZone": "UTC",
}


# Sizing for the ~100 TB target on a large cluster (about 1000 executors).
# Shuffle partitions are set high and AQE coalesces them to ~256 MB each, so
# a stage never has partitions too large for executor memory, and small
# stages still end up with few tasks. Scan splits of 512 MB keep the task
# count of a 100 TB scan near 200k. Broadcasts stay under 64 MB; a join
# partition 5x the median and over 512 MB is split (hot keys).
CLUSTER_CONF = {
    **RECOMMENDED_CONF,
    "spark.sql.shuffle.partitions": "20000",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "64m",
    "spark.sql.files.maxPartitionBytes": "512m",
    "spark.sql.autoBroadcastJoinThreshold": "64m",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "64m",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "512m",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
}


def apply_defaults(spark: SparkSession, conf: dict[str, str] = CLUSTER_CONF) -> None:
    """Set the runtime SQL settings above where the cluster has not set
    them; explicit cluster settings always win."""
    for key, value in conf.items():
        if spark.conf.get(key, None) in (None, ""):
            spark.conf.set(key, value)


def local_session(app: str = "hirelake", cores: int | str = "*", shuffle_partitions: int = 8,
                  extra: dict | None = None, scratch: str | None = None) -> SparkSession:
    """A local session for tests, scripts and the benchmark; ``scratch`` is
    the checkpoint folder where the session names none."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", os.environ.get("HIRELAKE_DRIVER_MEMORY", "8g"))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    for key, value in {**RECOMMENDED_CONF, **(extra or {})}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    if checkpoint_dir(spark) is None and scratch:
        spark.conf.set("spark.checkpoint.dir", scratch)
    ensure_checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str | None:
    """The shared folder the cluster names for checkpoints, if any."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured
    return spark.sparkContext.getCheckpointDir()


def ensure_checkpoint_dir(spark: SparkSession) -> str | None:
    """Let the context use the configured checkpoint folder, if there is one."""
    current = checkpoint_dir(spark)
    if current and spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(current)
    return current


def shared_scratch(spark: SparkSession) -> str:
    """The shared checkpoint folder. A session whose executors are threads of
    this process (tests, local runs) gets one of its own where none is set;
    on a cluster the setting is required."""
    root = checkpoint_dir(spark)
    if not root:
        if not re.match(r"local(\[[^\]]*\])?\Z", spark.sparkContext.master):
            raise RuntimeError("spark.checkpoint.dir is not set; configure a shared folder")
        root = tempfile.mkdtemp(prefix="hirelake-scratch-")
        spark.sparkContext.setCheckpointDir(root)
    return root.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path for an intermediate table under the shared checkpoint folder."""
    root = checkpoint_dir(spark)
    if not root:
        raise RuntimeError("spark.checkpoint.dir is not set; configure a shared folder")
    return root.rstrip("/") + "/" + name
