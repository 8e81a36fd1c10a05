"""Session construction and shared-scratch helpers."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings we want unless the caller (cluster config, test) already chose one.
_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # runtime (measured) size limit under which AQE turns a shuffle join into
    # a broadcast join; the planner's static estimate keeps its own limit
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "64m",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    # Only matters when total shuffle data / cores is below 1 MB: keeps small
    # partitioned writes parallel instead of packing them into one task.
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "64k",
    "spark.sql.parquet.filterPushdown": "true",
}


def get_session(master: str | None = None, app: str = "meridian",
                shuffle_partitions: int | None = None,
                extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with UTC time, AQE and skew-join handling on.

    ``shuffle_partitions`` is the pre-AQE upper bound; AQE coalesces small
    partitions at runtime and splits skewed ones, so on a large cluster set it
    high (thousands) and let AQE size the tasks.
    """
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    b = b.config("spark.ui.enabled", "false")
    for k, v in _DEFAULTS.items():
        b = b.config(k, v)
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    apply_defaults(spark)
    return spark


def apply_defaults(spark: SparkSession) -> None:
    """Set those of our SQL settings that an existing session leaves unset."""
    # Listing many partition directories runs as a Spark job; size it to about
    # two waves of the cluster's cores rather than one task per directory.
    cores = spark.sparkContext.defaultParallelism
    listing = {"spark.sql.sources.parallelPartitionDiscovery.parallelism": str(max(2 * cores, 8))}
    for k, v in {**_DEFAULTS, **listing}.items():
        if spark.conf.get(k, None) is None:
            spark.conf.set(k, v)


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder the cluster names in ``spark.checkpoint.dir``.

    Only a local session that names none (tests) gets one here; on a cluster
    a folder made by the driver would not be shared, so the setting is required.
    """
    d = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not d:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        d = tempfile.mkdtemp(prefix="meridian-ckpt-")
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(d)
    return d


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A fresh, never-reused directory under the shared checkpoint folder."""
    root = checkpoint_root(spark).rstrip("/")
    return f"{root}/meridian-scratch/{name}-{uuid.uuid4().hex[:12]}"


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether ``path`` exists in its file system; any other failure raises."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)
