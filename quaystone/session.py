"""Session construction and the shared checkpoint folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Settings a job relies on. AQE re-plans joins/partition counts at runtime,
# skew-join splits hot partitions, ANSI stays on (dirty text goes through try_*).
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.sql.timestampType": "TIMESTAMP_NTZ",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # the JVM never compiles a method of more than 8000 bytes: a stage whose generated method is longer runs as projections
    # of many small methods instead
    "spark.sql.codegen.hugeMethodLimit": "8000",
    # a table bucketed by id is read by buckets also without a join (one bucket for one id)
    "spark.sql.sources.bucketing.autoBucketedScan.enabled": "false",
    # no call-site capture for each column expression that Python builds
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def cluster_conf(input_bytes: int, executors: int = 1000, cores_per_executor: int = 8,
                 target_partition_bytes: int = 256 << 20) -> dict:
    """Settings for a large cluster, derived from the input size (e.g. 100 TB, 1000 executors).

    * scan splits of ``target_partition_bytes`` (parquet row groups are split to that size);
    * an initial shuffle width that keeps each shuffle partition near the same size for the
      widest join (lineitem x orders), which AQE then coalesces to the advisory size;
    * skew-join thresholds relative to the partition size, so a key holding a third of a
      table is split into many tasks;
    * a broadcast threshold that stays far below executor memory.
    Checkpoints go to the shared folder named by ``spark.checkpoint.dir`` (set by the cluster).
    """
    slots = executors * cores_per_executor
    shuffle_parts = max(slots * 2, int(input_bytes // target_partition_bytes))
    return {
        "spark.sql.files.maxPartitionBytes": str(target_partition_bytes),
        "spark.sql.shuffle.partitions": str(shuffle_parts),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes),
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(4 * target_partition_bytes),
        "spark.sql.autoBroadcastJoinThreshold": str(64 << 20),
        "spark.sql.adaptive.autoBroadcastJoinThreshold": str(64 << 20),
        "spark.sql.sources.partitionOverwriteMode": "dynamic",
        "spark.sql.timestampType": "TIMESTAMP_NTZ",
        "spark.sql.codegen.hugeMethodLimit": "8000",
    }


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "quaystone", extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster the setting names a shared (distributed) folder and is used as
    is; without it only a local master works, which gets a private folder (tests).
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        spark.sparkContext.setCheckpointDir(configured)
        return configured
    master = spark.sparkContext.master
    if master != "local" and not master.startswith("local["):
        raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
    local = tempfile.mkdtemp(prefix="quaystone-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    spark.conf.set("spark.checkpoint.dir", local)
    spark.sparkContext.setCheckpointDir(local)
    return local


#: Setting under which Spark deletes the shuffles of a query when it ends, not when the driver's objects are collected.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def written(df: DataFrame, name: str) -> DataFrame:
    """Write a table to the shared folder of ``spark.checkpoint.dir`` and read it back: cuts the lineage and
    outlives executors. The shuffles of the write are deleted as soon as it ends. Parquet, so that a column of few values takes
    little disk."""
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    void = {c for c, kind in df.dtypes if kind == "void"}  # no file holds them
    if void:
        df = df.select(*[F.col(f"`{c}`").cast("string").alias(c) if c in void else F.col(f"`{c}`") for c in df.columns])
    before = spark.conf.get(_CLEANUP, "false")
    spark.conf.set(_CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(_CLEANUP, before)
    back = spark.read.schema(df.schema).parquet(path)
    return back.withColumns({c: F.lit(None) for c in void}) if void else back


def unwritten(df: DataFrame) -> None:
    """Delete the files of a table that :func:`written` gave, once nothing is to be read from it any more."""
    for path in {name.rsplit("/", 1)[0] for name in df.inputFiles()}:
        system, p = file_system(df.sparkSession, path)
        system.delete(p(path), True)


def file_system(spark: SparkSession, path: str):
    """(Hadoop file system of a path, constructor of its paths)."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), jvm.org.apache.hadoop.fs.Path
