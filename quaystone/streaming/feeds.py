"""Incremental ticket feed (T1) and incremental SCD2 feed.

Both read new JSON files with ``readStream`` and ``trigger(availableNow=True)`` and apply each
micro-batch with ``foreachBatch``. The state lives in Parquet tables; because Parquet has no
MERGE, a batch computes the new state of the touched partitions, cuts lineage with a reliable
``checkpoint()`` (in the shared folder named by ``spark.checkpoint.dir``) and then overwrites
those partitions. Re-running a batch gives the same state (idempotent), so a lost executor or
a restarted query only repeats work.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quaystone.operators.history import empty_history, scd2_apply_batches
from quaystone.session import checkpoint_dir, file_system
from quaystone.sources.sinks import overwrite_partitions


def _exists(spark: SparkSession, path: str) -> bool:
    fs, new_path = file_system(spark, path)
    return fs.exists(new_path(path))


# -- history table: closed versions are appended, open versions have a partition of their own ---------------
#
# <table>/state=closed/apply=<n>   the versions that step n closed
# <table>/state=open/apply=<n>     every open version after step n
#
# Step n is done when its open partition is complete (Spark's _SUCCESS file), which is written last. What a step left
# behind before that is not read and is written again.

def _steps(spark: SparkSession, table_path: str, state: str) -> list[int]:
    """The complete steps of a state's partitions, in order."""
    fs, new_path = file_system(spark, table_path)
    root = new_path(f"{table_path}/state={state}")
    if not fs.exists(root):
        return []
    names = [f.getPath().getName() for f in fs.listStatus(root)]
    steps = sorted(int(n.removeprefix("apply=")) for n in names if n.startswith("apply="))
    return [n for n in steps if fs.exists(new_path(f"{table_path}/state={state}/apply={n}/_SUCCESS"))]


def read_open_versions(spark: SparkSession, table_path: str) -> tuple[int, DataFrame | None]:
    """(last step, its open versions) of a history table; (0, None) before the first step."""
    done = _steps(spark, table_path, "open")
    if not done:
        return 0, None
    return done[-1], spark.read.parquet(f"{table_path}/state=open/apply={done[-1]}")


def read_history(spark: SparkSession, table_path: str) -> DataFrame:
    """All versions of a history table, as of its last complete step."""
    last, opened = read_open_versions(spark, table_path)
    if opened is None:
        raise FileNotFoundError(f"no history in {table_path}")
    parts = [f"{table_path}/state=closed/apply={n}" for n in _steps(spark, table_path, "closed") if n <= last]
    return opened.unionByName(spark.read.schema(opened.schema).parquet(*parts)) if parts else opened


def _write_step(spark: SparkSession, versions: DataFrame, table_path: str, step: int) -> None:
    """Append what the step closed, then put the open versions in place of the last step's."""
    versions.where(~F.col("is_current")).write.mode("overwrite").parquet(f"{table_path}/state=closed/apply={step}")
    versions.where("is_current").write.mode("overwrite").parquet(f"{table_path}/state=open/apply={step}")
    _drop_old_open(spark, table_path, step)


def _drop_old_open(spark: SparkSession, table_path: str, step: int) -> None:
    fs, new_path = file_system(spark, table_path)
    for old in _steps(spark, table_path, "open"):
        if old < step:
            fs.delete(new_path(f"{table_path}/state=open/apply={old}"), True)


def merge_tickets(current: DataFrame | None, batch: DataFrame, key: str, time_col: str) -> DataFrame:
    """Newest version per ticket; a version older than the stored one never overwrites it
    (late data), equal times keep the stored row. A row without a time counts as oldest (the order
    is a struct, which is never NULL itself)."""
    incoming = (batch.groupBy(key).agg(F.max_by(F.struct(*[F.col(c) for c in batch.columns]), F.struct(F.col(time_col))).alias("r"))
                .select("r.*").withColumn("__rank", F.lit(1)))
    if current is None:
        return incoming.drop("__rank")
    both = current.select(*batch.columns).withColumn("__rank", F.lit(2)).unionByName(incoming)
    best = both.groupBy(key).agg(F.max_by(F.struct(*[F.col(c) for c in batch.columns]),
                                          F.struct(F.col(time_col), F.col("__rank"))).alias("r"))
    return best.select("r.*")


def run_ticket_feed(spark: SparkSession, source_dir: str, schema: str, table_path: str, key: str = "ticket_id",
                    time_col: str = "update_dt", partition_col: str = "create_month_label",
                    max_files_per_trigger: int | None = None, stream_checkpoint: str | None = None,
                    delay: str | None = None, late_path: str | None = None) -> None:
    """Run the incremental ticket feed over every file present.

    With ``delay`` (an interval) the stream has a watermark on the time: a version that comes again within it is dropped before
    the merge, with state bounded by the delay, and a version older than the watermark is too late. The versions that
    passed are noted beside the table, so that those that came too late are told from repeats and written to ``late_path``
    after the run. Rows without a time have no watermark and pass."""
    ckpt_root = checkpoint_dir(spark)
    reader = spark.readStream.schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    stream = reader.json(source_dir)
    seen = f"{table_path.rstrip('/')}__versions"
    if delay:
        # a watermark needs an instant: the wall clock counted from 1970, whatever the session's zone
        at = F.timestamp_seconds(F.timestamp_diff("SECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), F.col(time_col)))
        timed = stream.where(F.col(time_col).isNotNull()).withColumn("__at", at).withWatermark("__at", delay)
        stream = timed.dropDuplicatesWithinWatermark([key, time_col]).drop("__at").unionByName(stream.where(F.col(time_col).isNull()))

    def upsert(batch_df: DataFrame, batch_id: int) -> None:
        if batch_df.isEmpty():
            return
        if delay:
            batch_df.where(F.col(time_col).isNotNull()).select(key, time_col).write.mode("overwrite").parquet(f"{seen}/batch={batch_id}")
        touched = batch_df.select(partition_col).distinct()
        current = None
        if _exists(spark, table_path):
            stored = spark.read.parquet(table_path)
            current = stored.join(touched, partition_col, "left_semi")
            if not touched.where(F.col(partition_col).isNull()).isEmpty():
                # an equality join never matches the partition of rows without a label
                current = current.unionByName(stored.where(F.col(partition_col).isNull()).select(current.columns))
        merged = merge_tickets(current, batch_df, key, time_col).checkpoint()
        overwrite_partitions(merged, table_path, [partition_col])

    location = stream_checkpoint or os.path.join(ckpt_root, "ticket_feed", os.path.basename(table_path.rstrip("/")))
    q = (stream.writeStream.foreachBatch(upsert).trigger(availableNow=True)
         .option("checkpointLocation", location).start())
    q.awaitTermination()
    if delay and late_path:
        passed = spark.read.parquet(seen).select(key, time_col) if _exists(spark, seen) else None
        came = spark.read.schema(schema).json(source_dir).where(F.col(time_col).isNotNull()).dropDuplicates([key, time_col])
        late = came if passed is None else came.join(passed, [key, time_col], "left_anti")
        late.write.mode("overwrite").parquet(late_path)


def run_scd2_feed(spark: SparkSession, source_dir: str, schema: str, table_path: str, key: str,
                  batch_no: str = "batch_no", batch_id_col: str = "sync_batch_id",
                  batch_time_col: str = "batch_time", max_files_per_trigger: int | None = None,
                  stream_checkpoint: str | None = None) -> None:
    """Run the incremental SCD2 feed (T2). All source batches of a micro-batch are applied in one pass, in the order of
    their times, which come from the data. Rows of keys that have a version of the batch's
    time or a later one are skipped, so replaying files (e.g. after losing the stream checkpoint) adds
    no versions and never reverts a newer state, and a batch spread over files is applied whole.

    Closed versions are appended and never read again; a micro-batch rewrites the open ones only. Every key
    of the table has an open version, so no closed one is needed to go on. :func:`read_history` reads the table."""
    ckpt_root = checkpoint_dir(spark)
    reader = spark.readStream.schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    stream = reader.json(source_dir)
    meta = {batch_no, batch_id_col, batch_time_col}

    def apply(batch_df: DataFrame, _micro_id: int) -> None:
        if batch_df.isEmpty():
            return
        last, opened = read_open_versions(spark, table_path)
        if opened is None:
            opened = empty_history(batch_df.select(*[c for c in batch_df.columns if c not in meta]))
        _drop_old_open(spark, table_path, last)
        versions, _ = scd2_apply_batches(opened, batch_df, key, batch_no, batch_id_col, batch_time_col)
        versions = versions.checkpoint()
        # a replay changes nothing and makes no step
        if versions.where(~F.col("is_current")).isEmpty() and versions.count() == opened.count():
            return
        _write_step(spark, versions, table_path, last + 1)

    location = stream_checkpoint or os.path.join(ckpt_root, "scd2_feed", os.path.basename(table_path.rstrip("/")))
    q = (stream.writeStream.foreachBatch(apply).trigger(availableNow=True)
         .option("checkpointLocation", location).start())
    q.awaitTermination()
