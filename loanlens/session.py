"""Spark session settings for the reports and the shared folder for written state."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession

# Settings the plans rely on.  AQE re-plans at stage boundaries: it turns a
# sort-merge join into a broadcast join only when the measured side is small,
# splits skewed join partitions (also when that needs an extra shuffle before
# an aggregate on the join key), and coalesces small shuffle partitions.
SPARK_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "64MB",
    "spark.sql.optimizer.runtime.bloomFilter.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
}


# Sizing for a large cluster (about 100 TB of payments): start shuffles with many
# partitions and let AQE coalesce them to ~256 MB each, so a partition always fits
# an executor's memory without spilling; read Parquet in 256 MB splits; a skewed
# partition is one five times the median and above 512 MB, and is split.
CLUSTER_SETTINGS = {
    "spark.sql.shuffle.partitions": "8192",
    "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "32768",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256MB",
    "spark.sql.files.maxPartitionBytes": "256MB",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "512MB",
    "spark.sql.optimizer.runtime.bloomFilter.creationSideThreshold": "256MB",
}


def build_session(
    master: str | None = None,
    app_name: str = "loanlens",
    shuffle_partitions: int | None = None,
    extra: dict[str, str] | None = None,
    cluster: bool = False,
) -> SparkSession:
    """Session with the settings above (``cluster=True`` adds ``CLUSTER_SETTINGS``)."""
    b = SparkSession.builder.appName(app_name).config("spark.ui.enabled", "false")
    if master:
        b = b.master(master)
    for k, v in {**SPARK_DEFAULTS, **(CLUSTER_SETTINGS if cluster else {})}.items():
        b = b.config(k, v)
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        b = b.config(k, v)
    return b.getOrCreate()


_LOCAL_FOLDERS: dict[str, str] = {}


def shared_dir(spark: SparkSession, root: str | None = None) -> str:
    """Folder for written state (stored key sets, published tables): ``root`` if given, else ``spark.checkpoint.dir``.

    It must be one that the driver and all executors share.  Only a session that runs in this one
    process (a local master) may do without: it gets a temporary folder for its lifetime.  Anywhere
    else a missing folder is an error, because executors would write parts to disks of their own.
    """
    conf = spark.sparkContext.getConf()
    named = root or conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if spark.sparkContext.master != "local" and not spark.sparkContext.master.startswith("local["):
        raise ValueError("name a folder that the driver and all executors share: spark.checkpoint.dir, or the root argument")
    app = spark.sparkContext.applicationId
    if app not in _LOCAL_FOLDERS:
        _LOCAL_FOLDERS[app] = tempfile.mkdtemp(prefix="loanlens-")
    return _LOCAL_FOLDERS[app]
