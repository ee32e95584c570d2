"""Registered queries: row hash, SCD2 history, upserts, incremental filter, service views."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import functions as F

from quaystone.functions.dates import ntz_literal
from quaystone.operators import history as H
from quaystone.operators import views as V
from quaystone.operators.contracts import dedup_keep_last
from quaystone.plans.jobs import service_views
from quaystone.plans.tables import table

HASH_FIELDS = ["customer_id", "customer_name", "customer_type", "province"]
BATCH_TIMES = {1: _dt.datetime(1996, 12, 31), 2: _dt.datetime(1998, 12, 31), 3: _dt.datetime(2001, 12, 31)}


def customer_rows(spark, sf_dir):
    c = table(spark, sf_dir, "customer")
    n = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    return c.join(n, c.c_nationkey == n.n_nationkey, "left").select(
        F.col("c_custkey").cast("string").alias("customer_id"), F.col("c_name").alias("customer_name"),
        F.col("c_mktsegment").alias("customer_type"), F.col("n_name").alias("province"))


def q_row_hash(spark, sf_dir):
    rows = customer_rows(spark, sf_dir)
    return rows.select("customer_id", H.row_hash(HASH_FIELDS).alias("row_hash"))


def customer_batches(spark, sf_dir, batch_of=None):
    """Batches of customer rows, by default three: customers with orders in 1995-96, 1997-98, 1999+;
    customer_type = the highest order priority text within the batch window."""
    o = table(spark, sf_dir, "orders")
    y = F.year("o_orderdate")
    no = F.when(y <= 1996, 1).when(y <= 1998, 2).otherwise(3) if batch_of is None else batch_of
    per = (o.groupBy("o_custkey", no.alias("batch_no"))
           .agg(F.max("o_orderpriority").alias("customer_type")))
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey")
    n = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    j = per.join(c, per.o_custkey == c.c_custkey).join(n, c.c_nationkey == n.n_nationkey, "left")
    rows = j.select("batch_no", F.col("c_custkey").cast("string").alias("customer_id"),
                    F.col("c_name").alias("customer_name"), "customer_type", F.col("n_name").alias("province"),
                    F.col("c_nationkey").cast("string").alias("company_id"))
    return rows.withColumn("row_hash", H.row_hash(HASH_FIELDS))


def named_batches(batches, times):
    """Batches with their id and time; ``times``: batch number -> time."""
    at = F.create_map(*[x for no, t in times.items() for x in (F.lit(no), ntz_literal(t))])
    return batches.select("*", F.concat(F.lit("B"), F.col("batch_no").cast("string")).alias("sync_batch_id"),
                          at[F.col("batch_no")].alias("batch_time"))


def scd2_history(spark, sf_dir):
    """The three batches applied to an empty history in one pass."""
    rows = named_batches(customer_batches(spark, sf_dir), BATCH_TIMES)
    empty = H.empty_history(rows.drop("batch_no", "sync_batch_id", "batch_time"))
    return H.scd2_apply_batches(empty, rows, "customer_id", "batch_no", "sync_batch_id", "batch_time")[0]


def q_scd2_history(spark, sf_dir):
    return scd2_history(spark, sf_dir).drop("company_id")


def q_relation_history(spark, sf_dir):
    h = scd2_history(spark, sf_dir)
    return H.relation_rows(h.drop("customer_name").withColumnRenamed("customer_id", "contact_id")
                           .withColumnRenamed("company_id", "customer_id")
                           .withColumnRenamed("province", "customer_name"),
                           "contact_id", ["customer_id", "customer_name"])


def q_max_version(spark, sf_dir):
    return H.max_version(scd2_history(spark, sf_dir), "customer_id")


def order_tickets(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    return o.select(F.col("o_orderkey").alias("ticket_id"), F.col("o_custkey").cast("string").alias("company_id"),
                    F.col("o_orderdate").alias("create_dt"),
                    F.when(F.col("o_orderstatus") == "F", "4").when(F.col("o_orderstatus") == "P", "已关闭")
                    .otherwise("2").alias("ticket_status"),
                    F.when(F.col("o_orderstatus") == "F", F.timestamp_add("DAY", F.lit(7), F.col("o_orderdate")))
                    .alias("solve_dt"))


def q_service_overview(spark, sf_dir):
    h = scd2_history(spark, sf_dir)
    return V.service_overview(h, order_tickets(spark, sf_dir), "customer_id", "company_id",
                              ["customer_name", "customer_type", "province", "effective_from", "effective_to"])


def q_contact_overview(spark, sf_dir):
    h = scd2_history(spark, sf_dir).withColumnRenamed("customer_id", "contact_id")
    return V.service_overview(h, order_tickets(spark, sf_dir), "contact_id", "company_id",
                              ["customer_name", "effective_from", "effective_to"], with_resolution=False)


def _service_views(spark, sf_dir):
    """Customers and contacts both come from the history of the customers."""
    h = scd2_history(spark, sf_dir)
    customers = h.withColumn("city", F.concat(F.col("province"), F.lit("市")))
    contacts = h.select(
        F.col("customer_id").alias("contact_id"), F.col("customer_name").alias("contact_name"), F.col("company_id").alias("customer_id"),
        F.col("province").alias("customer_name"), F.col("customer_type").alias("department_name"),
        F.lit(None).cast("string").alias("position_name"), "version_no", "effective_from", "effective_to")
    tickets = order_tickets(spark, sf_dir).withColumn("cust_user_id", F.when(F.col("ticket_id") % 3 != 0, F.col("company_id"))) \
        .withColumn("company_id", F.when(F.col("ticket_id") % 2 != 0, F.col("company_id")))
    c = table(spark, sf_dir, "customer")
    people = c.select(F.nullif(F.col("c_nationkey").cast("string"), F.lit("0")).alias("customer_id"),
                      F.nullif(F.col("c_mktsegment"), F.lit("BUILDING")).alias("phone"),
                      F.when(F.col("c_acctbal") > 0, F.col("c_name")).otherwise(F.lit("")).alias("email"))
    return service_views(customers, contacts, tickets, c, people)


def q_service_view_customers(spark, sf_dir):
    return _service_views(spark, sf_dir)["customer_overview"]


def q_service_view_contacts(spark, sf_dir):
    return _service_views(spark, sf_dir)["contact_overview"]


def q_service_view_quality(spark, sf_dir):
    return _service_views(spark, sf_dir)["quality"]


def q_quality_counts(spark, sf_dir):
    c = table(spark, sf_dir, "customer")
    contacts = c.select(F.nullif(F.col("c_nationkey").cast("string"), F.lit("0")).alias("customer_id"),
                        F.nullif(F.col("c_mktsegment"), F.lit("BUILDING")).alias("phone"),
                        F.when(F.col("c_acctbal") > 0, F.col("c_name")).otherwise(F.lit("")).alias("email"))
    o = table(spark, sf_dir, "orders")
    tickets = o.select(F.when(F.col("o_orderstatus") == "P", F.lit("")).otherwise(F.col("o_custkey").cast("string"))
                       .alias("company_id"))
    return V.quality_counts(c, contacts, tickets)


def q_name_join(spark, sf_dir):
    n = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    s = table(spark, sf_dir, "supplier")
    c = table(spark, sf_dir, "customer")
    sn = s.join(n, s.s_nationkey == n.n_nationkey).select(F.col("n_name").alias("s_nation"))
    cn = c.join(n, c.c_nationkey == n.n_nationkey).select(F.col("n_name").alias("c_nation"))
    return V.name_join_fanout(cn, sn, "c_nation", "s_nation")


def q_name_join_rows(spark, sf_dir):
    """The joined rows; names with more than 500 pairs are salted."""
    n = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    s = table(spark, sf_dir, "supplier")
    c = table(spark, sf_dir, "customer")
    sn = s.join(n, s.s_nationkey == n.n_nationkey).select("s_suppkey", F.col("n_name").alias("s_nation"))
    cn = c.join(n, c.c_nationkey == n.n_nationkey).select("c_custkey", F.col("n_name").alias("c_nation"))
    return V.name_join(cn, sn, "c_nation", "s_nation", rows_per_task=500)


def _upsert_frames(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    item = F.when((F.col("l_returnflag") == "N") & (F.col("l_linestatus") == "F"), F.lit(None).cast("string")) \
        .otherwise(F.col("l_partkey").cast("string"))
    # some suppliers are blank, some stored keys and some change keys carry blanks around them
    padded = F.when(F.year("l_shipdate") == 1996, F.concat(F.lit(" "), F.col("l_suppkey").cast("string"))).otherwise(
        F.concat(F.col("l_suppkey").cast("string"), F.lit("  ")))
    supplier = F.when(F.col("l_suppkey") % 7 == 0, F.lit(" ")).when(F.col("l_suppkey") % 7 < 3, padded).otherwise(
        F.col("l_suppkey").cast("string"))
    base = li.select(F.col("l_orderkey").cast("string").alias("contract_id"), item.alias("item_code"),
                     supplier.alias("exec_detail_id"), F.lit("19961231").alias("create_date"),
                     "l_shipdate", "l_linenumber", "l_returnflag", "l_extendedprice", "l_tax")
    order = F.struct("l_shipdate", "l_linenumber", "l_extendedprice")
    keys = ["contract_id", "item_code", "exec_detail_id", "create_date"]
    cur = base.where(F.year("l_shipdate") == 1996)
    cur = dedup_keep_last(cur, keys, order).select(
        *keys, F.col("l_extendedprice").cast("decimal(18,2)").alias("product_amount"))
    ch = base.where((F.col("l_shipdate") >= F.lit("1996-07-01").cast("timestamp_ntz")) &
                    (F.col("l_shipdate") < F.lit("1997-07-01").cast("timestamp_ntz")))
    price = F.col("l_extendedprice").cast("decimal(18,2)")
    ch = ch.select(*keys, F.when(F.col("l_returnflag") == "R", price * (1 + F.col("l_tax").cast("decimal(4,2)")))
                   .otherwise(price).cast("decimal(18,2)").alias("product_amount"),
                   order.alias("__order"))
    return cur, ch, keys


def snapshot_upsert(spark, sf_dir):
    cur, ch, keys = _upsert_frames(spark, sf_dir)
    return H.snapshot_upsert(cur, ch, keys, "__order", ["product_amount"])


def q_snapshot_upsert(spark, sf_dir):
    return snapshot_upsert(spark, sf_dir)


def q_run_report(spark, sf_dir):
    out = snapshot_upsert(spark, sf_dir).where(F.col("outcome") != "kept")
    counts = H.outcome_counts(out, extra=[F.count_distinct("create_date").alias("snapshot_dates")])
    return counts.withColumn("single_snapshot", F.col("snapshot_dates") == 1)


def _ticket_frames(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    stored = o.where(F.col("o_orderstatus") != "P").select(
        F.col("o_orderkey").alias("ticket_id"),
        F.when(F.col("o_orderstatus") == "F", F.col("o_orderdate"))
        .otherwise(F.timestamp_add("HOUR", F.lit(1), F.col("o_orderdate"))).alias("source_updated_at"),
        F.lit("stored").alias("version"))
    incoming = o.select(
        F.col("o_orderkey").alias("ticket_id"),
        F.when(F.col("o_orderpriority") == "1-URGENT", F.lit(None).cast("timestamp_ntz"))
        .otherwise(F.timestamp_add("MILLISECOND", F.lit(400), F.col("o_orderdate"))).alias("update_dt"))
    return stored, incoming


def q_incremental_filter(spark, sf_dir):
    stored, incoming = _ticket_frames(spark, sf_dir)
    return H.incremental_filter(incoming, stored, "ticket_id", "update_dt")


def q_ticket_upsert(spark, sf_dir):
    stored, incoming = _ticket_frames(spark, sf_dir)
    li = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("ticket_id"), "l_linenumber")
    child = li.join(stored.select("ticket_id"), "ticket_id", "left_semi").withColumn("version", F.lit("stored"))
    load = H.incremental_filter(incoming, stored, "ticket_id", "update_dt").where(F.col("action") == "load")
    new_main = load.select("ticket_id", F.col("update_dt").alias("source_updated_at"), F.lit("new").alias("version"))
    new_child = li.join(load.select("ticket_id"), "ticket_id", "left_semi").where(F.col("l_linenumber") <= 2) \
        .withColumn("version", F.lit("new"))
    _, child_out = H.ticket_upsert(stored, child, new_main, new_child, "ticket_id")
    return child_out


def q_scd2_closed_form(spark, sf_dir):
    """All batches at once (W7 intervals by lead); must equal the incremental history."""
    rows = named_batches(customer_batches(spark, sf_dir), BATCH_TIMES).drop("company_id")
    return H.scd2_from_batches(rows, "customer_id", "batch_no", "sync_batch_id", "batch_time")


QUERIES = {
    "scd2_closed_form": q_scd2_closed_form,
    "row_hash": q_row_hash,
    "scd2_history": q_scd2_history,
    "relation_history": q_relation_history,
    "max_version": q_max_version,
    "service_overview": q_service_overview,
    "contact_overview": q_contact_overview,
    "quality_counts": q_quality_counts,
    "service_view_customers": q_service_view_customers,
    "service_view_contacts": q_service_view_contacts,
    "service_view_quality": q_service_view_quality,
    "name_join": q_name_join,
    "name_join_rows": q_name_join_rows,
    "snapshot_upsert": q_snapshot_upsert,
    "run_report": q_run_report,
    "incremental_filter": q_incremental_filter,
    "ticket_upsert": q_ticket_upsert,
}

# -- SQL twins ---------------------------------------------------------------------

_CUST = """
cust AS (
  SELECT CAST(c_custkey AS VARCHAR) AS customer_id, c_name AS customer_name, c_mktsegment AS customer_type,
         n_name AS province
  FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey)"""

_HASH = ("sha256(to_json({'customer_id': customer_id, 'customer_name': customer_name, "
         "'customer_type': customer_type, 'province': province}))")

_THREE = "CASE WHEN year(o_orderdate) <= 1996 THEN 1 WHEN year(o_orderdate) <= 1998 THEN 2 ELSE 3 END"
_THREE_TIMES = "CASE batch_no WHEN 1 THEN TIMESTAMP '1996-12-31' WHEN 2 THEN TIMESTAMP '1998-12-31' ELSE TIMESTAMP '2001-12-31' END"


def history_sql(batch_no=_THREE, batch_time=_THREE_TIMES):
    """CTEs up to ``hist``, the history of the customer batches."""
    return f"""
per AS (
  SELECT o_custkey, {batch_no} AS batch_no,
         max(o_orderpriority) AS customer_type
  FROM orders GROUP BY ALL),
b0 AS (
  SELECT batch_no, CAST(c_custkey AS VARCHAR) AS customer_id, c_name AS customer_name, customer_type,
         n_name AS province, CAST(c_nationkey AS VARCHAR) AS company_id
  FROM per JOIN customer ON o_custkey = c_custkey LEFT JOIN nation ON c_nationkey = n_nationkey),
b AS (SELECT *, {_HASH} AS row_hash,
        {batch_time} AS bt
      FROM b0),
c AS (SELECT *, lag(row_hash) OVER (PARTITION BY customer_id ORDER BY batch_no) AS prev FROM b),
v AS (SELECT * FROM c WHERE prev IS NULL OR prev <> row_hash),
hist AS (
  SELECT customer_id, customer_name, customer_type, province, company_id, row_hash,
    CAST(row_number() OVER (PARTITION BY customer_id ORDER BY batch_no) AS INTEGER) AS version_no,
    'B' || CAST(batch_no AS VARCHAR) AS sync_batch_id, bt AS effective_from,
    lead(bt) OVER (PARTITION BY customer_id ORDER BY batch_no) AS effective_to,
    lead(bt) OVER (PARTITION BY customer_id ORDER BY batch_no) IS NULL AS is_current
  FROM v)"""


_HIST = history_sql()

_TICKETS = """
tk AS (
  SELECT o_orderkey AS ticket_id, CAST(o_custkey AS VARCHAR) AS company_id, o_orderdate AS create_dt,
    CASE WHEN o_orderstatus = 'F' THEN '4' WHEN o_orderstatus = 'P' THEN '已关闭' ELSE '2' END AS ticket_status,
    CASE WHEN o_orderstatus = 'F' THEN o_orderdate + INTERVAL 7 DAY END AS solve_dt
  FROM orders)"""

_RESOLVED = "('4', '5', '6', '已解决', '已关闭')"

_UPSERT = """
base AS (
  SELECT CAST(l_orderkey AS VARCHAR) AS contract_id,
    CASE WHEN l_returnflag = 'N' AND l_linestatus = 'F' THEN NULL ELSE CAST(l_partkey AS VARCHAR) END AS item_code,
    CASE WHEN l_suppkey % 7 = 0 THEN ' ' WHEN l_suppkey % 7 >= 3 THEN CAST(l_suppkey AS VARCHAR)
      WHEN year(l_shipdate) = 1996 THEN ' ' || CAST(l_suppkey AS VARCHAR) ELSE CAST(l_suppkey AS VARCHAR) || '  ' END AS exec_detail_id, '19961231' AS create_date,
    l_shipdate, l_linenumber, l_returnflag, l_extendedprice, l_tax
  FROM lineitem),
curr0 AS (
  SELECT *, COALESCE(trim(contract_id), '') <> '' AND COALESCE(trim(item_code), '') <> ''
            AND COALESCE(trim(exec_detail_id), '') <> '' AND COALESCE(trim(create_date), '') <> '' AS complete,
    row_number() OVER (PARTITION BY COALESCE(trim(contract_id), ''), COALESCE(trim(item_code), ''),
      COALESCE(trim(exec_detail_id), ''), COALESCE(trim(create_date), '')
      ORDER BY l_shipdate DESC, l_linenumber DESC, l_extendedprice DESC) AS rn
  FROM base WHERE year(l_shipdate) = 1996),
curr AS (SELECT contract_id, item_code, exec_detail_id, create_date, CAST(l_extendedprice AS DECIMAL(18,2)) AS product_amount,
           complete FROM curr0 WHERE rn = 1 OR NOT complete),
ch0 AS (
  SELECT contract_id, item_code, exec_detail_id, create_date,
    CAST(CASE WHEN l_returnflag = 'R' THEN CAST(l_extendedprice AS DECIMAL(18,2)) * (1 + CAST(l_tax AS DECIMAL(4,2)))
              ELSE CAST(l_extendedprice AS DECIMAL(18,2)) END AS DECIMAL(18,2)) AS product_amount,
    COALESCE(trim(contract_id), '') <> '' AND COALESCE(trim(item_code), '') <> ''
      AND COALESCE(trim(exec_detail_id), '') <> '' AND COALESCE(trim(create_date), '') <> '' AS complete,
    row_number() OVER (PARTITION BY COALESCE(trim(contract_id), ''), COALESCE(trim(item_code), ''),
      COALESCE(trim(exec_detail_id), ''), COALESCE(trim(create_date), '')
      ORDER BY l_shipdate DESC, l_linenumber DESC, l_extendedprice DESC) AS rn
  FROM base WHERE l_shipdate >= TIMESTAMP '1996-07-01' AND l_shipdate < TIMESTAMP '1997-07-01'),
ch AS (SELECT contract_id, item_code, exec_detail_id, create_date, product_amount, complete FROM ch0 WHERE rn = 1 OR NOT complete),
up AS (
  SELECT coalesce(o.contract_id, n.contract_id) AS contract_id, coalesce(o.item_code, n.item_code) AS item_code,
    coalesce(o.exec_detail_id, n.exec_detail_id) AS exec_detail_id, coalesce(o.create_date, n.create_date) AS create_date,
    CASE WHEN n.contract_id IS NOT NULL THEN n.product_amount ELSE o.product_amount END AS product_amount,
    CASE WHEN n.contract_id IS NOT NULL AND o.contract_id IS NULL THEN 'inserted'
         WHEN n.contract_id IS NOT NULL AND n.product_amount IS NOT DISTINCT FROM o.product_amount THEN 'unchanged'
         WHEN n.contract_id IS NOT NULL THEN 'updated' ELSE 'kept' END AS outcome
  FROM (SELECT * FROM ch WHERE complete) n FULL OUTER JOIN (SELECT * FROM curr WHERE complete) o
    ON n.contract_id = o.contract_id AND n.item_code = o.item_code
    AND trim(n.exec_detail_id) = trim(o.exec_detail_id) AND n.create_date = o.create_date
  UNION ALL
  SELECT contract_id, item_code, exec_detail_id, create_date, product_amount, 'inserted' FROM ch WHERE NOT complete
  UNION ALL
  SELECT contract_id, item_code, exec_detail_id, create_date, product_amount, 'kept' FROM curr WHERE NOT complete)"""

_TFRAMES = """
stored AS (
  SELECT o_orderkey AS ticket_id,
    CASE WHEN o_orderstatus = 'F' THEN o_orderdate ELSE o_orderdate + INTERVAL 1 HOUR END AS source_updated_at
  FROM orders WHERE o_orderstatus <> 'P'),
incoming AS (
  SELECT o_orderkey AS ticket_id,
    CASE WHEN o_orderpriority = '1-URGENT' THEN NULL ELSE o_orderdate + INTERVAL 400 MILLISECOND END AS update_dt
  FROM orders),
filt AS (
  SELECT i.ticket_id, i.update_dt,
    CASE WHEN i.update_dt IS NULL OR s.ticket_id IS NULL OR s.source_updated_at IS NULL
           OR date_trunc('second', i.update_dt) <> date_trunc('second', s.source_updated_at)
         THEN 'load' ELSE 'skipped' END AS action
  FROM incoming i LEFT JOIN stored s ON i.ticket_id = s.ticket_id)"""


SQL = {
    "scd2_closed_form": None,
    "row_hash": "WITH " + _CUST.strip() + f"\nSELECT customer_id, {_HASH} AS row_hash FROM cust",
    "scd2_history": "WITH " + _HIST.strip() + """
SELECT customer_id, customer_name, customer_type, province, row_hash, version_no, sync_batch_id,
       effective_from, effective_to, is_current FROM hist""",
    "relation_history": "WITH " + _HIST.strip() + """
SELECT customer_id AS contact_id, version_no, company_id AS customer_id, province AS customer_name,
       sync_batch_id, effective_from, effective_to, is_current FROM hist""",
    "max_version": "WITH " + _HIST.strip() + """
SELECT customer_id, max(version_no) AS max_version FROM hist GROUP BY customer_id""",
    "service_overview": "WITH " + _HIST.strip() + "," + _TICKETS + f"""
SELECT h.customer_id, h.version_no, h.customer_name, h.customer_type, h.province, h.effective_from, h.effective_to,
  COUNT(t.ticket_id) AS ticket_count,
  CAST(SUM(CAST(t.ticket_status IN {_RESOLVED} AS BIGINT)) AS BIGINT) AS resolved_ticket_count,
  AVG(CASE WHEN t.solve_dt IS NOT NULL THEN date_diff('second', t.create_dt, t.solve_dt) END) AS avg_resolution_seconds
FROM hist h LEFT JOIN tk t ON t.company_id = h.customer_id AND t.create_dt >= h.effective_from
  AND (h.effective_to IS NULL OR t.create_dt < h.effective_to)
GROUP BY ALL""",
    "contact_overview": "WITH " + _HIST.strip() + "," + _TICKETS + f"""
SELECT h.customer_id AS contact_id, h.version_no, h.customer_name, h.effective_from, h.effective_to,
  COUNT(t.ticket_id) AS ticket_count,
  CAST(SUM(CAST(t.ticket_status IN {_RESOLVED} AS BIGINT)) AS BIGINT) AS resolved_ticket_count
FROM hist h LEFT JOIN tk t ON t.company_id = h.customer_id AND t.create_dt >= h.effective_from
  AND (h.effective_to IS NULL OR t.create_dt < h.effective_to)
GROUP BY ALL""",
    "service_view_customers": "WITH " + _HIST.strip() + "," + _TICKETS + f"""
SELECT h.customer_id, h.version_no, h.customer_name, h.customer_type, h.province, h.province || '市' AS city, h.effective_from, h.effective_to,
  COUNT(t.ticket_id) AS ticket_count,
  CAST(SUM(CAST(t.ticket_status IN {_RESOLVED} AS BIGINT)) AS BIGINT) AS resolved_ticket_count,
  AVG(CASE WHEN t.solve_dt IS NOT NULL THEN date_diff('second', t.create_dt, t.solve_dt) END) AS avg_resolution_seconds
FROM hist h LEFT JOIN tk t ON t.company_id = h.customer_id AND t.ticket_id % 2 <> 0 AND t.create_dt >= h.effective_from
  AND (h.effective_to IS NULL OR t.create_dt < h.effective_to)
GROUP BY ALL""",
    "service_view_contacts": "WITH " + _HIST.strip() + "," + _TICKETS + f"""
SELECT h.customer_id AS contact_id, h.version_no, h.customer_name AS contact_name, h.company_id AS customer_id,
  h.province AS customer_name, h.customer_type AS department_name, CAST(NULL AS VARCHAR) AS position_name, h.effective_from, h.effective_to,
  COUNT(t.ticket_id) AS ticket_count,
  CAST(SUM(CAST(t.ticket_status IN {_RESOLVED} AS BIGINT)) AS BIGINT) AS resolved_ticket_count
FROM hist h LEFT JOIN tk t ON t.company_id = h.customer_id AND t.ticket_id % 3 <> 0 AND t.create_dt >= h.effective_from
  AND (h.effective_to IS NULL OR t.create_dt < h.effective_to)
GROUP BY ALL""",
    "service_view_quality": """
SELECT (SELECT COUNT(*) FROM customer) AS customer_count,
  (SELECT COUNT(*) FROM customer) AS contact_count,
  (SELECT COUNT(*) FROM customer WHERE c_nationkey <> 0) AS linked_contact_count,
  (SELECT COUNT(*) FROM customer WHERE c_mktsegment <> 'BUILDING') AS phone_covered_contact_count,
  (SELECT COUNT(*) FROM customer WHERE c_acctbal > 0 AND c_name <> '') AS email_covered_contact_count,
  (SELECT COUNT(*) FROM orders WHERE o_orderkey % 2 = 0 OR o_custkey IS NULL) AS unlinked_ticket_count""",
    "quality_counts": """
SELECT (SELECT COUNT(*) FROM customer) AS customer_count,
  (SELECT COUNT(*) FROM customer) AS contact_count,
  (SELECT COUNT(*) FROM customer WHERE c_nationkey <> 0) AS linked_contact_count,
  (SELECT COUNT(*) FROM customer WHERE c_mktsegment <> 'BUILDING') AS phone_covered_contact_count,
  (SELECT COUNT(*) FROM customer WHERE c_acctbal > 0 AND c_name <> '') AS email_covered_contact_count,
  (SELECT COUNT(*) FROM orders WHERE o_orderstatus = 'P' OR o_custkey IS NULL) AS unlinked_ticket_count""",
    "name_join_rows": """
SELECT c_custkey, c.n_name AS c_nation, s_suppkey, s.n_name AS s_nation
FROM (customer JOIN nation ON c_nationkey = n_nationkey) c
JOIN (SELECT s_suppkey, n_name FROM supplier JOIN nation ON s_nationkey = n_nationkey) s ON c.n_name = s.n_name""",
    "name_join": """
WITH cn AS (SELECT n_name AS name, COUNT(*) AS left_rows FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY 1),
sn AS (SELECT n_name AS name, COUNT(*) AS right_rows FROM supplier JOIN nation ON s_nationkey = n_nationkey GROUP BY 1)
SELECT cn.name, left_rows, right_rows, left_rows * right_rows AS pair_count FROM cn JOIN sn ON cn.name = sn.name""",
    "snapshot_upsert": "WITH " + _UPSERT.strip() + "\nSELECT * FROM up",
    "run_report": "WITH " + _UPSERT.strip() + """,
o AS (SELECT * FROM up WHERE outcome <> 'kept')
SELECT COUNT(*) AS rows,
  COUNT(*) FILTER (WHERE outcome = 'inserted') AS inserted, COUNT(*) FILTER (WHERE outcome = 'updated') AS updated,
  COUNT(*) FILTER (WHERE outcome = 'unchanged') AS unchanged, COUNT(*) FILTER (WHERE outcome = 'skipped') AS skipped,
  COUNT(*) FILTER (WHERE outcome = 'failed') AS failed, 'success' AS status,
  COUNT(DISTINCT create_date) AS snapshot_dates, COUNT(DISTINCT create_date) = 1 AS single_snapshot
FROM o""",
    "incremental_filter": "WITH " + _TFRAMES.strip() + "\nSELECT ticket_id, update_dt, action FROM filt",
    "ticket_upsert": "WITH " + _TFRAMES.strip() + """,
li AS (SELECT l_orderkey AS ticket_id, l_linenumber FROM lineitem),
loaded AS (SELECT ticket_id FROM filt WHERE action = 'load')
SELECT ticket_id, l_linenumber, 'stored' AS version FROM li
WHERE ticket_id IN (SELECT ticket_id FROM stored) AND ticket_id NOT IN (SELECT ticket_id FROM loaded)
UNION ALL
SELECT ticket_id, l_linenumber, 'new' AS version FROM li
WHERE ticket_id IN (SELECT ticket_id FROM loaded) AND l_linenumber <= 2""",
}

SQL["scd2_closed_form"] = SQL["scd2_history"]
