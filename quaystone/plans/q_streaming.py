"""Registered queries: the two incremental feeds, fed with files Spark writes from the tables.

Each call writes its input files and state under a fresh folder inside the shared checkpoint
folder (``spark.checkpoint.dir``), runs the stream to completion and returns the final table.
"""

from __future__ import annotations

import datetime as _dt
import os

from pyspark.sql import functions as F

from quaystone.functions.dates import month_label
from quaystone.plans.q_history import BATCH_TIMES, customer_batches, history_sql, named_batches
from quaystone.plans.tables import scratch_path, table
from quaystone.streaming.feeds import read_history, run_scd2_feed, run_ticket_feed

TICKET_SCHEMA = "ticket_id bigint, status string, update_dt timestamp_ntz, create_month_label string"


def _per_trigger(spark, files: str, schema: str, triggers: int) -> int:
    """Files per trigger so that the feed runs in about so many micro-batches."""
    return max(1, len(spark.read.schema(schema).json(files).inputFiles()) // triggers)


def q_stream_ticket_feed(spark, sf_dir):
    """Urgent tickets arrive without a time, every tenth customer's without a month."""
    root = scratch_path(spark, "ticket-feed")
    src, out = os.path.join(root, "in"), os.path.join(root, "table")
    o = table(spark, sf_dir, "orders")
    base = o.select(F.col("o_orderkey").alias("ticket_id"), F.col("o_orderstatus").alias("status"),
                    F.when(F.col("o_orderpriority") != "1-URGENT", F.col("o_orderdate")).alias("update_dt"),
                    F.when(F.col("o_custkey") % 10 != 0, month_label("o_orderdate")).alias("create_month_label"),
                    F.col("o_orderdate").alias("day"))
    # drop 1: every ticket; drop 2: open tickets closed a day later; drop 3: late, older versions
    updated = base.where(F.col("status") == "O").withColumn("status", F.lit("F")) \
        .withColumn("update_dt", F.timestamp_add("DAY", F.lit(1), F.col("day")))
    late = base.where((F.col("status") == "P") & F.col("update_dt").isNotNull()).withColumn("status", F.lit("X")) \
        .withColumn("update_dt", F.timestamp_add("DAY", F.lit(-1), F.col("day")))
    for i, part in enumerate((base, updated, late)):
        part.drop("day").write.mode("overwrite").json(os.path.join(src, f"drop={i}"))
    files = os.path.join(src, "*")
    run_ticket_feed(spark, files, TICKET_SCHEMA, out, max_files_per_trigger=_per_trigger(spark, files, TICKET_SCHEMA, 3))
    return spark.read.parquet(out).select("ticket_id", "status", "update_dt", "create_month_label")


def q_stream_ticket_late(spark, sf_dir):
    """Three runs of one feed with a delay of 30 days: every ticket; open ones closed the day after the last, and all tickets
    again; pending ones an hour more than a day before their time, most of them too late. The table, and the late versions."""
    root = scratch_path(spark, "ticket-late")
    src, out, late = (os.path.join(root, n) for n in ("in", "table", "late"))
    o = table(spark, sf_dir, "orders")
    base = o.select(F.col("o_orderkey").alias("ticket_id"), F.col("o_orderstatus").alias("status"), F.col("o_orderdate").alias("update_dt"),
                    month_label("o_orderdate").alias("create_month_label"))
    closed = base.where(F.col("status") == "O").withColumn("status", F.lit("F")).withColumn("update_dt", F.lit(LAST_DAY).cast("timestamp_ntz"))
    older = base.where(F.col("status") == "P").withColumn("status", F.lit("X")) \
        .withColumn("update_dt", F.timestamp_add("HOUR", F.lit(-25), F.col("update_dt")))
    for number, part in enumerate((base, closed.unionByName(base), older)):
        part.write.mode("overwrite").json(os.path.join(src, f"drop={number}"))
        run_ticket_feed(spark, os.path.join(src, "*"), TICKET_SCHEMA, out, stream_checkpoint=os.path.join(root, "seen"),
                        delay="30 days", late_path=late)
    columns = ["ticket_id", "status", "update_dt", "create_month_label"]
    return spark.read.parquet(out).select(*columns, F.lit("stored").alias("place")).unionByName(
        spark.read.parquet(late).select(*columns, F.lit("late").alias("place")))


LAST_DAY = "2002-01-01 00:00:00"
_LATE_SQL = f"""
SELECT o_orderkey AS ticket_id, CASE WHEN o_orderstatus = 'O' THEN 'F' ELSE o_orderstatus END AS status,
  CASE WHEN o_orderstatus = 'O' THEN TIMESTAMP '{LAST_DAY}' ELSE o_orderdate END AS update_dt,
  strftime(o_orderdate, '%Y-%m') AS create_month_label, 'stored' AS place
FROM orders
UNION ALL
SELECT o_orderkey, 'X', o_orderdate - INTERVAL 25 HOUR, strftime(o_orderdate, '%Y-%m'), 'late'
FROM orders WHERE o_orderstatus = 'P' AND o_orderdate - INTERVAL 25 HOUR <= TIMESTAMP '{LAST_DAY}' - INTERVAL 30 DAY"""

_TICKET_SQL = """
SELECT o_orderkey AS ticket_id,
  CASE WHEN o_orderstatus = 'O' THEN 'F' ELSE o_orderstatus END AS status,
  CASE WHEN o_orderstatus = 'O' THEN o_orderdate + INTERVAL 1 DAY WHEN o_orderpriority <> '1-URGENT' THEN o_orderdate
       END AS update_dt,
  CASE WHEN o_custkey % 10 <> 0 THEN strftime(o_orderdate, '%Y-%m') END AS create_month_label
FROM orders"""


_SCD2_SCHEMA = ("batch_no int, sync_batch_id string, batch_time timestamp_ntz, customer_id string, customer_name string, "
                "customer_type string, province string, company_id string, row_hash string")


def _write_batches(rows, numbers, src):
    """Each batch in several files: two groups of customers at least."""
    half = F.pmod(F.xxhash64("customer_id"), F.lit(2)).alias("half")
    for no in numbers:
        rows.where(F.col("batch_no") == no).select("*", half).write.mode("overwrite").partitionBy("half") \
            .json(os.path.join(src, f"batch={no}"))


def q_stream_scd2(spark, sf_dir):
    """Three source batches, each in several files that fall into different micro-batches."""
    root = scratch_path(spark, "scd2-feed")
    src, out = os.path.join(root, "in"), os.path.join(root, "table")
    _write_batches(named_batches(customer_batches(spark, sf_dir), BATCH_TIMES), BATCH_TIMES, src)
    files = os.path.join(src, "*", "*")
    run_scd2_feed(spark, files, _SCD2_SCHEMA, out, "customer_id",
                  max_files_per_trigger=_per_trigger(spark, files, _SCD2_SCHEMA, 6))
    return read_history(spark, out).drop("company_id")


# Half-years of the orders, 1995 to 2001, each a batch at its end.
HALF_YEARS = {2 * y + h + 1: _dt.datetime(1995 + y, 6 + 6 * h, 30) for y in range(7) for h in range(2)}


def q_stream_scd2_many(spark, sf_dir):
    """Fourteen source batches: twelve in one micro-batch, then the last two together with a replay of the twelfth."""
    root = scratch_path(spark, "scd2-many")
    src, out, seen = os.path.join(root, "in"), os.path.join(root, "table"), os.path.join(root, "seen")
    number = 2 * (F.year("o_orderdate") - 1995) + F.when(F.month("o_orderdate") > 6, 2).otherwise(1)
    rows = named_batches(customer_batches(spark, sf_dir, number), HALF_YEARS).checkpoint()
    for numbers in (range(1, 13), (12, 13, 14)):
        _write_batches(rows, numbers, src)
        run_scd2_feed(spark, os.path.join(src, "*", "*"), _SCD2_SCHEMA, out, "customer_id", stream_checkpoint=seen)
    return read_history(spark, out).drop("company_id")


QUERIES = {
    "stream_ticket_feed": q_stream_ticket_feed,
    "stream_ticket_late": q_stream_ticket_late,
    "stream_scd2": q_stream_scd2,
    "stream_scd2_many": q_stream_scd2_many,
}

_HISTORY_COLUMNS = """
SELECT customer_id, customer_name, customer_type, province, row_hash, version_no, sync_batch_id,
       effective_from, effective_to, is_current FROM hist"""
_HALF = "CAST(2 * (year(o_orderdate) - 1995) + CASE WHEN month(o_orderdate) > 6 THEN 2 ELSE 1 END AS INTEGER)"
_HALF_TIME = ("make_timestamp(CAST(1995 + (batch_no - 1) // 2 AS BIGINT), CASE WHEN batch_no % 2 = 0 THEN 12 ELSE 6 END, 30, "
              "0, 0, 0)")

SQL = {
    "stream_ticket_feed": _TICKET_SQL,
    "stream_ticket_late": _LATE_SQL,
    "stream_scd2": "WITH " + history_sql().strip() + _HISTORY_COLUMNS,
    "stream_scd2_many": "WITH " + history_sql(_HALF, _HALF_TIME).strip() + _HISTORY_COLUMNS,
}
