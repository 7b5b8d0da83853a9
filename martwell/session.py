"""Spark session settings and the shared scratch location.

Settings aim at large inputs: adaptive execution re-plans joins and coalesces
or splits shuffle partitions from real sizes, skewed join partitions are split,
and the broadcast threshold stays Spark's size check (no forced broadcasts of
unbounded tables anywhere in the library).
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Rows of a stored table up to which it is left to Spark's size check whether a join
# broadcasts it.
BROADCAST_ROWS = 100_000

# Session settings used by the library, tests and bench.  On a cluster the
# deployment supplies master, memory and spark.checkpoint.dir.
SCALE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.sources.bucketing.enabled": "true",
    # A bucketed scan whose buckets are single sorted files reports that
    # order, so the fact join skips re-sorting every bucket (Spark only does
    # this when each bucket is one file; the warehouse build writes exactly
    # one file per bucket).
    "spark.sql.legacy.bucketedTableScan.outputOrdering": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(
    master: str | None = None,
    app: str = "martwell",
    shuffle_partitions: int | None = None,
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """Create (or reuse) a session with the library's settings.

    ``master`` defaults to ``local[*]`` only when no master is configured;
    ``shuffle_partitions`` defaults to 2x the local cores (AQE coalesces it
    down at runtime; on a cluster set it to total cores x 2-3).
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    elif not os.environ.get("SPARK_MASTER") and not os.environ.get("MASTER"):
        builder = builder.master("local[*]")
    conf = dict(SCALE_CONF)
    if shuffle_partitions is None:
        shuffle_partitions = max(8, 2 * (os.cpu_count() or 4))
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.setdefault("spark.driver.memory", "16g")
    if extra:
        conf.update(extra)
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the session's checkpoint directory, setting one only if unset.

    On a cluster the deployment names a shared folder in
    ``spark.checkpoint.dir``; that is always used.  Only a local-mode session
    without one (tests) gets a fresh private folder under the system temp
    dir; a cluster session without one is an error, because a machine-local
    folder is invisible to the other executors.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None
    )
    if not conf_dir:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
        conf_dir = tempfile.mkdtemp(prefix="martwell-ckpt-")
    sc.setCheckpointDir(conf_dir)
    return sc.getCheckpointDir() or conf_dir


def scratch_root(spark: SparkSession) -> str:
    """Shared folder for written intermediate tables (lineage cuts, staging
    files, snapshots made by reports).  Lives next to the checkpoint dir so a
    cluster deployment controls where it goes."""
    base = ensure_checkpoint_dir(spark)
    return base.rstrip("/") + "/martwell-scratch"


def new_scratch_dir(spark: SparkSession, tag: str) -> str:
    """A never-before-used folder below the scratch root."""
    return f"{scratch_root(spark)}/{tag}-{uuid.uuid4().hex[:12]}"


def by_rows(df: DataFrame) -> DataFrame:
    """``df``, a stored dimension that is to be joined to many more rows.

    Spark's size check sees the bytes of the files: compressed, millions of rows that
    take a hundred times as much in memory pass it, and the driver has to hold them.
    So a table of more than ``BROADCAST_ROWS`` rows (counted from the file footers)
    asks for a sort-merge join."""
    return df.hint("merge") if df.count() > BROADCAST_ROWS else df


def cluster_settings(total_cores: int, input_bytes: int) -> dict[str, str]:
    """Partition sizing for a cluster run (pass to ``build_session(extra=...)``).

    * scan splits of 256 MB (512 MB above 10 TB of input) keep the task count
      of a 100 TB scan in the hundreds of thousands, not millions;
    * the initial shuffle partition count lets a full shuffle of the input
      land in ~256 MB partitions (never fewer than 3 per core); AQE then
      coalesces small partitions to the 256 MB advisory size and splits
      partitions above 1 GB that are 5x the median (skew);
    * the broadcast threshold stays a size check (64 MB) -- larger sides are
      shuffled, never forced into memory.
    """
    split = 512 if input_bytes > 10 * 1024**4 else 256
    mb = 1024 * 1024
    partitions = max(3 * total_cores, -(-input_bytes // (256 * mb)))
    return {
        "spark.sql.files.maxPartitionBytes": f"{split}m",
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
        # on a cluster, coalesce to the advisory size rather than to the
        # default parallelism (locally, with 8 cores, parallelism wins)
        "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
        "spark.sql.adaptive.coalescePartitions.minPartitionSize": "64m",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1g",
        "spark.sql.autoBroadcastJoinThreshold": "64m",
    }
