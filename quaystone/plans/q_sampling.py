"""Registered queries: sampling, listing, windows and counts on orders / lineitem."""

from __future__ import annotations

import datetime as _dt
import uuid

from pyspark.sql import Window
from pyspark.sql import functions as F

from quaystone.functions.dates import month_label
from quaystone.operators import sampling as S
from quaystone.operators.tickets import split_id_list
from quaystone.plans.tables import scratch_path, table
from quaystone.sources import envelope as EV
from quaystone.sources.partitions import read_newest_partition, save_by_id

TODAY = _dt.date(1998, 8, 15)


def q_stratified_sample(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select("o_orderkey", month_label("o_orderdate").alias("month"),
                                              "o_orderpriority")
    return S.stratified_sample(o, ["month", "o_orderpriority"], "o_orderkey", 3, seed="42")


_SAMPLE_SQL = """
WITH o AS (SELECT o_orderkey, strftime(o_orderdate, '%Y-%m') AS month, o_orderpriority FROM orders),
r AS (SELECT *, row_number() OVER (PARTITION BY month, o_orderpriority
        ORDER BY md5('42' || ':' || month || '|' || o_orderpriority || ':' || CAST(o_orderkey AS VARCHAR)), o_orderkey) AS sample_rank
      FROM o)
SELECT * FROM r WHERE sample_rank <= 3"""


def q_month_year_rollup(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select(F.year("o_orderdate").alias("y"), F.month("o_orderdate").alias("m"))
    return S.month_year_rollup(o, "y", "m")


def q_template_counts(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select(month_label("o_orderdate").alias("month"),
                                              F.col("o_orderpriority").alias("template"))
    return S.counts_per(o, ["month", "template"])


def q_log_topk(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_orderdate")
    return S.top_k(o, [F.col("o_orderkey").desc()], 20)


def q_point_lookup(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("ticket_id"), F.col("l_shipdate").alias("create_dt"),
                                                 "l_linenumber", "l_partkey", "l_suppkey")
    return S.newest_per_id(li.withColumn("__o", F.struct("create_dt", "l_linenumber", "l_partkey", "l_suppkey")),
                           "ticket_id", "__o").drop("__o")


def q_month_scan(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("ticket_id"), F.col("o_orderdate").alias("create_dt"), "o_orderpriority")
    return S.month_scan(o, "create_dt", "ticket_id", "1998-06")


def q_month_list(spark, sf_dir):
    """The first 25 tickets of a month (L2)."""
    o = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("ticket_id"), F.col("o_orderdate").alias("create_dt"), "o_orderpriority")
    return S.month_scan(o, "create_dt", "ticket_id", "1998-06", limit=25)


def q_latest_snapshot(spark, sf_dir):
    """The newest of the snapshots of a table partitioned by snapshot date."""
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber",
                                                 F.concat(F.year("l_shipdate").cast("string"), F.lit("1231")).alias("create_date"))
    path = scratch_path(spark, "snapshots")
    li.repartition("create_date").write.partitionBy("create_date").parquet(path)
    return read_newest_partition(spark, path, "create_date", li.schema)


def q_ticket_lookup(spark, sf_dir):
    """The newest line of the smallest order, in a table bucketed by order; every fifth line has no time."""
    li = table(spark, sf_dir, "lineitem")
    rows = li.select(F.col("l_orderkey").alias("ticket_id"), F.when(F.col("l_linenumber") % 5 != 0, F.col("l_shipdate")).alias("create_dt"),
                     "l_linenumber", "l_partkey", "l_suppkey")
    one = li.agg(F.min("l_orderkey")).first()[0]
    name = f"lines_{uuid.uuid4().hex[:10]}"
    stored = save_by_id(rows, name, scratch_path(spark, name), "ticket_id", 16)
    return S.rows_of_id(stored, "ticket_id", one, "create_dt", ["l_linenumber", "l_partkey", "l_suppkey"])


def q_completeness(spark, sf_dir):
    """Page bodies of a month's orders, a hundred orders a page: the total that the bodies declare against the items read.
    Every seventh page lost its last item, every fifth doesn't declare a total, every eleventh is broken."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", month_label("o_orderdate").alias("month"))
    total = F.count(F.lit(1)).over(Window.partitionBy("month"))
    page = F.floor(F.col("o_orderkey") / 100)
    paged = o.select("month", page.alias("page"), F.struct(F.col("o_orderkey").alias("id")).alias("item"), total.alias("total"))
    pages = paged.groupBy("month", "page").agg(F.array_sort(F.collect_list("item")).alias("items"), F.first("total").alias("total"))
    items = F.when(F.col("page") % 7 == 0, F.slice("items", 1, F.size("items") - 1)).otherwise(F.col("items"))
    whole = F.when(F.col("page") % 5 == 0, F.to_json(F.struct(F.struct(items.alias("list")).alias("data")))).otherwise(
        F.to_json(F.struct(F.struct(items.alias("list"), "total").alias("data"))))
    body = F.when(F.col("page") % 11 == 0, F.concat(whole, F.lit("]"))).otherwise(whole)
    parsed = EV.parse_body(pages.select("month", "page", body.alias("body")), "body")
    read = EV.unwrap_items(parsed, "doc", keep=["month"]).select("month", F.lit(None).cast("bigint").alias("declared"), F.lit(True).alias("was_read"))
    said = parsed.select("month", EV.declared_count("doc").alias("declared"), F.lit(False).alias("was_read"))
    return S.completeness(read.unionByName(said), ["month"], "declared", "was_read")


def q_file_date(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    names = o.select("o_orderstatus", F.concat(F.lit("export_"), F.year("o_orderdate").cast("string"), F.lit("-"),
                                               F.month("o_orderdate").cast("string"), F.lit("-"),
                                               F.dayofmonth("o_orderdate").cast("string"), F.lit(".xlsx")).alias("file_name"))
    return names.groupBy("o_orderstatus").agg(F.max(S.file_date(F.col("file_name"))).alias("source_date"))


def q_refresh_window(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select(F.trunc("o_orderdate", "month").alias("month_start"))
    return (o.select(F.date_format("month_start", "yyyy-MM").alias("month"),
                     S.refresh_window(F.col("month_start"), TODAY).alias("refresh"))
            .groupBy("month", "refresh").agg(F.count(F.lit(1)).alias("order_count")))


def q_distinct_ids(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    cc = F.concat_ws("，", F.col("l_linenumber").cast("string"), F.lit(" "), F.col("l_suppkey").cast("string"))
    return S.distinct_ids(li, [("supplier", F.col("l_suppkey")), ("part", F.col("l_partkey")),
                               ("supplier", split_id_list(cc))])


def q_month_cap(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("ticket_id"),
                                              F.col("o_orderdate").alias("create_dt"),
                                              month_label("o_orderdate").alias("month"))
    return S.first_n_per(o, ["month"], [F.col("create_dt"), F.col("ticket_id")], 5)


QUERIES = {
    "month_cap": q_month_cap,
    "stratified_sample": q_stratified_sample,
    "month_year_rollup": q_month_year_rollup,
    "template_counts": q_template_counts,
    "log_topk": q_log_topk,
    "point_lookup": q_point_lookup,
    "month_scan": q_month_scan,
    "month_list": q_month_list,
    "latest_snapshot": q_latest_snapshot,
    "ticket_lookup": q_ticket_lookup,
    "completeness": q_completeness,
    "file_date": q_file_date,
    "refresh_window": q_refresh_window,
    "distinct_ids": q_distinct_ids,
}

SQL = {
    "month_cap": """
WITH o AS (SELECT o_orderkey AS ticket_id, o_orderdate AS create_dt, strftime(o_orderdate, '%Y-%m') AS month FROM orders),
r AS (SELECT *, row_number() OVER (PARTITION BY month ORDER BY create_dt, ticket_id) AS row_in_group FROM o)
SELECT * FROM r WHERE row_in_group <= 5""",
    "stratified_sample": _SAMPLE_SQL,
    "month_year_rollup": """
SELECT CAST(year(o_orderdate) AS INTEGER) AS y, CAST(month(o_orderdate) AS INTEGER) AS m, COUNT(*) AS row_count
FROM orders GROUP BY ROLLUP (1, 2)""",
    "template_counts": """
SELECT strftime(o_orderdate, '%Y-%m') AS month, o_orderpriority AS template, COUNT(*) AS row_count FROM orders GROUP BY 1, 2""",
    "log_topk": "SELECT o_orderkey, o_orderstatus, o_orderdate FROM orders ORDER BY o_orderkey DESC LIMIT 20",
    "point_lookup": """
SELECT l_orderkey AS ticket_id, arg_max(l_shipdate, (l_shipdate, l_linenumber, l_partkey, l_suppkey)) AS create_dt,
  arg_max(l_linenumber, (l_shipdate, l_linenumber, l_partkey, l_suppkey)) AS l_linenumber,
  arg_max(l_partkey, (l_shipdate, l_linenumber, l_partkey, l_suppkey)) AS l_partkey,
  arg_max(l_suppkey, (l_shipdate, l_linenumber, l_partkey, l_suppkey)) AS l_suppkey
FROM lineitem GROUP BY l_orderkey""",
    "month_scan": """
SELECT o_orderkey AS ticket_id, o_orderdate AS create_dt, o_orderpriority FROM orders
WHERE strftime(o_orderdate, '%Y-%m') = '1998-06' ORDER BY create_dt, ticket_id""",
    "month_list": """
SELECT o_orderkey AS ticket_id, o_orderdate AS create_dt, o_orderpriority FROM orders
WHERE strftime(o_orderdate, '%Y-%m') = '1998-06' ORDER BY create_dt, ticket_id LIMIT 25""",
    "ticket_lookup": """
SELECT l_orderkey AS ticket_id, CASE WHEN l_linenumber % 5 <> 0 THEN l_shipdate END AS create_dt, l_linenumber, l_partkey, l_suppkey
FROM lineitem WHERE l_orderkey = (SELECT min(l_orderkey) FROM lineitem)
ORDER BY create_dt DESC NULLS LAST, l_linenumber DESC, l_partkey DESC, l_suppkey DESC LIMIT 1""",
    "latest_snapshot": """
WITH li AS (SELECT l_orderkey, l_linenumber, CAST(year(l_shipdate) AS VARCHAR) || '1231' AS create_date FROM lineitem)
SELECT * FROM li WHERE create_date = (SELECT max(create_date) FROM li)""",
    "completeness": """
WITH p AS (
  SELECT strftime(o_orderdate, '%Y-%m') AS month, o_orderkey // 100 AS page, COUNT(*) AS n FROM orders GROUP BY 1, 2),
t AS (SELECT *, SUM(n) OVER (PARTITION BY month) AS total FROM p)
SELECT month, CAST(max(total) FILTER (WHERE page % 5 <> 0 AND page % 11 <> 0) AS BIGINT) AS declared_count,
  CAST(COALESCE(SUM(CASE WHEN page % 7 = 0 THEN n - 1 ELSE n END) FILTER (WHERE page % 11 <> 0), 0) AS BIGINT) AS read_count,
  COALESCE(SUM(CASE WHEN page % 7 = 0 THEN n - 1 ELSE n END) FILTER (WHERE page % 11 <> 0), 0)
    < max(total) FILTER (WHERE page % 5 <> 0 AND page % 11 <> 0) AS is_partial
FROM t GROUP BY month""",
    "file_date": """
SELECT o_orderstatus, max(strftime(o_orderdate, '%Y%m%d')) AS source_date FROM orders GROUP BY 1""",
    "refresh_window": """
WITH o AS (SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS ms FROM orders)
SELECT strftime(ms, '%Y-%m') AS month,
  CASE WHEN ms >= DATE '1998-05-01' AND ms <= DATE '1998-08-01' THEN 'daily'
       WHEN year(ms) = 1998 AND ms < DATE '1998-05-01' AND (ms + INTERVAL 1 MONTH - INTERVAL 1 DAY) <= DATE '1998-05-17' THEN 'monthly'
       ELSE 'none' END AS refresh,
  COUNT(*) AS order_count
FROM o GROUP BY 1, 2""",
    "distinct_ids": """
SELECT DISTINCT kind, id FROM (
  SELECT 'supplier' AS kind, trim(CAST(l_suppkey AS VARCHAR)) AS id FROM lineitem
  UNION ALL SELECT 'supplier', CAST(l_linenumber AS VARCHAR) FROM lineitem
  UNION ALL SELECT 'part', trim(CAST(l_partkey AS VARCHAR)) FROM lineitem) WHERE id IS NOT NULL AND id NOT IN ('', '0')""",
}
