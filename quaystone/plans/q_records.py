"""Registered queries: account snapshot, personnel upsert, source guard, labels, agent fields,
offline enrichment, value-type tags, snapshot scan."""

from __future__ import annotations

from pyspark.sql import functions as F

from quaystone.operators import history as H
from quaystone.operators import labels as LB
from quaystone.operators import sampling as S
from quaystone.operators import tickets as T
from quaystone.plans import jobs as J
from quaystone.plans.tables import table

ACCOUNT_NAMES = ["account_id", "customer_name", "customer_name2", "balance", "open_date", "remark"]


def q_account_snapshot(spark, sf_dir):
    c = table(spark, sf_dir, "customer")
    cells = c.select(F.array(
        F.col("c_custkey").cast("string"),
        F.when(F.col("c_mktsegment") == "BUILDING", F.lit("")).otherwise(F.col("c_name")),
        F.when(F.col("c_acctbal") > 5000, F.col("c_name")),
        F.format_number("c_acctbal", 2),
        F.when(F.col("c_mktsegment") == "MACHINERY", F.lit(" ")).otherwise(F.lit("2026/07/13"))).alias("cells"))
    return J.load_accounts(cells, ACCOUNT_NAMES, "20260713", money=["balance"])


_ACCOUNT_SQL = """
WITH r AS (
  SELECT CAST(c_custkey AS VARCHAR) AS account_id,
    NULLIF(trim(CASE WHEN c_mktsegment = 'BUILDING' THEN '' ELSE c_name END), '') AS customer_name,
    NULLIF(trim(CASE WHEN c_acctbal > 5000 THEN c_name END), '') AS customer_name2,
    CAST(CAST(replace(format('{:,.2f}', c_acctbal), ',', '') AS DOUBLE) AS DECIMAL(18,2)) AS balance,
    NULLIF(trim(CASE WHEN c_mktsegment = 'MACHINERY' THEN ' ' ELSE '2026/07/13' END), '') AS open_date,
    CAST(NULL AS VARCHAR) AS remark
  FROM customer)
SELECT *, '20260713' AS create_date FROM r WHERE customer_name IS NOT NULL OR customer_name2 IS NOT NULL"""


def q_personnel_upsert(spark, sf_dir):
    s = table(spark, sf_dir, "supplier")
    src = s.select(F.when(F.col("s_acctbal") < 0, F.lit(""))
                   .otherwise(F.concat((F.col("s_suppkey") + 1000000).cast("string"), F.lit(".0"))).alias("工号"),
                   F.when(F.col("s_nationkey").between(8, 15), F.concat("s_name", F.lit("*"))).otherwise(F.col("s_name"))
                   .alias("姓名"), "s_nationkey")
    current = s.where(F.col("s_nationkey") < 12).select(
        (F.col("s_suppkey") + 1000000).cast("string").alias("employee_no"), F.col("s_name").alias("name"))
    return J.load_personnel(src, current, {"工号": "employee_no", "姓名": "name"})


_PERSONNEL_SQL = """
WITH src AS (
  SELECT NULLIF(regexp_replace(trim(CASE WHEN s_acctbal < 0 THEN '' ELSE CAST(s_suppkey + 1000000 AS VARCHAR) || '.0' END),
                               '^(-?\\d+)\\.0+$', '\\1'), '') AS employee_no,
         CASE WHEN s_nationkey BETWEEN 8 AND 15 THEN s_name || '*' ELSE s_name END AS name
  FROM supplier),
ch AS (SELECT * FROM src WHERE employee_no IS NOT NULL),
cur AS (SELECT CAST(s_suppkey + 1000000 AS VARCHAR) AS employee_no, s_name AS name FROM supplier WHERE s_nationkey < 12)
SELECT COALESCE(ch.employee_no, cur.employee_no) AS employee_no,
  CASE WHEN ch.employee_no IS NOT NULL THEN ch.name ELSE cur.name END AS name,
  CASE WHEN ch.employee_no IS NOT NULL AND cur.employee_no IS NULL THEN 'inserted'
       WHEN ch.employee_no IS NOT NULL AND ch.name IS NOT DISTINCT FROM cur.name THEN 'unchanged'
       WHEN ch.employee_no IS NOT NULL THEN 'updated' ELSE 'kept' END AS outcome
FROM ch FULL OUTER JOIN cur ON ch.employee_no = cur.employee_no"""

DECLARED_SOURCES = ["F", "O", "P", "X"]


def q_source_guard(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    counts = o.groupBy(F.col("o_orderstatus").alias("source")).agg(F.count(F.lit(1)).alias("rows"))
    declared = spark.createDataFrame([(s,) for s in DECLARED_SOURCES], "source string")
    return H.guarded_batch_status(declared.join(counts, "source", "left")
                                  .withColumn("rows", F.coalesce("rows", F.lit(0)).cast("long")))


_GUARD_SQL = """
WITH d(source) AS (VALUES ('F'), ('O'), ('P'), ('X')),
c AS (SELECT o_orderstatus AS source, COUNT(*) AS rows FROM orders GROUP BY 1)
SELECT d.source, COALESCE(c.rows, 0) AS rows,
  CASE WHEN COALESCE(c.rows, 0) = 0 THEN 'failed' ELSE 'success' END AS status,
  COALESCE(c.rows, 0) <> 0 AS write
FROM d LEFT JOIN c ON d.source = c.source"""

ORDER_LABELS = {"O_ORDERKEY": "订单号", "o-orderstatus": "状态", "o_totalprice": "金额", "o_orderdate": "金额"}
ORDER_ALIASES = {"o_custkey": "O_ORDERKEY"}
ORDER_EXTRA = {"o_orderpriority": "优先级"}


def q_label_columns(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    return LB.label_columns(o, ORDER_LABELS, ORDER_ALIASES, ORDER_EXTRA)


_LABELCOLS_SQL = """
SELECT o_orderkey AS "订单号", o_custkey AS "订单号(o_custkey)", o_orderstatus AS "状态", o_totalprice AS "金额",
       o_orderdate AS "金额(o_orderdate)", o_orderpriority AS "优先级" FROM orders"""


def q_agent_field_decode(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    eav = li.select(F.col("l_orderkey").alias("ticket_id"), F.col("l_linenumber").alias("field_order"),
                    F.when(F.col("l_linenumber") == 1, F.lit("record_serviceruserid_main"))
                    .when(F.col("l_linenumber") == 3, F.lit("record_serviceruserid_cc"))
                    .otherwise(F.concat(F.lit("field_"), F.col("l_linenumber").cast("string"))).alias("field_key"),
                    F.when(F.col("l_linenumber") == 3, F.lit(" ")).otherwise(F.col("l_suppkey").cast("string")).alias("field_value"))
    return T.decode_agent_fields(eav, table(spark, sf_dir, "supplier"), "s_suppkey", "s_name")


_AGENT_SQL = """
WITH e AS (
  SELECT l_orderkey AS ticket_id, l_linenumber AS field_order,
    CASE WHEN l_linenumber = 1 THEN 'record_serviceruserid_main' WHEN l_linenumber = 3 THEN 'record_serviceruserid_cc'
         ELSE 'field_' || CAST(l_linenumber AS VARCHAR) END AS field_key,
    CASE WHEN l_linenumber = 3 THEN ' ' ELSE CAST(l_suppkey AS VARCHAR) END AS field_value
  FROM lineitem)
SELECT e.ticket_id, e.field_order, e.field_key,
  CASE WHEN starts_with(e.field_key, 'record_serviceruserid') AND s.s_suppkey IS NOT NULL
       THEN COALESCE(NULLIF(trim(s.s_name), ''), e.field_value) ELSE e.field_value END AS field_value
FROM e LEFT JOIN supplier s ON starts_with(e.field_key, 'record_serviceruserid') AND trim(e.field_value) <> ''
  AND trim(e.field_value) = CAST(s.s_suppkey AS VARCHAR)"""


def q_offline_enrich(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    tickets = o.select("o_orderkey", F.col("o_custkey").cast("string").alias("custUserId"),
                       F.length("o_orderpriority").cast("string").alias("companyId"))
    c = table(spark, sf_dir, "customer").where(F.col("c_mktsegment") != "AUTOMOBILE")
    v1 = c.select(F.col("c_custkey").alias("cId"), F.col("c_name").alias("realName"),
                  F.col("c_nationkey").alias("userId"), F.lit(1).alias("__v"))
    v2 = c.where(F.col("c_mktsegment") == "HOUSEHOLD").select(
        F.col("c_custkey").alias("cId"), F.col("c_name").alias("realName"),
        F.when(F.col("c_nationkey") == 24, 0).otherwise(F.col("c_nationkey") + 1).alias("userId"), F.lit(2).alias("__v"))
    contacts = v1.unionByName(v2)
    n = table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("uId"), F.col("n_name").alias("companyName"))
    out = T.offline_enrich(tickets, contacts, n, ticket_contact="custUserId", ticket_company="companyId",
                           contact_id="cId", contact_company="userId", customer_id="uId",
                           contact_order="__v", customer_order="uId")
    return out.select("o_orderkey", F.col("contact.cId").alias("contact_id"), F.col("contact.userId").alias("contact_company"),
                      F.col("customer.companyName").alias("customer_name"))


_OFFLINE_SQL = """
WITH t AS (SELECT o_orderkey, CAST(o_custkey AS VARCHAR) AS cu, CAST(length(o_orderpriority) AS VARCHAR) AS co FROM orders),
c AS (
  SELECT c_custkey AS cId, c_nationkey AS userId, 1 AS v FROM customer WHERE c_mktsegment <> 'AUTOMOBILE'
  UNION ALL
  SELECT c_custkey, CASE WHEN c_nationkey = 24 THEN 0 ELSE c_nationkey + 1 END, 2 FROM customer WHERE c_mktsegment = 'HOUSEHOLD'),
cl AS (SELECT cId, arg_max(userId, v) AS userId FROM c GROUP BY cId)
SELECT t.o_orderkey, cl.cId AS contact_id, cl.userId AS contact_company, COALESCE(n1.n_name, n2.n_name) AS customer_name
FROM t LEFT JOIN cl ON t.cu = CAST(cl.cId AS VARCHAR)
LEFT JOIN nation n1 ON CAST(cl.userId AS VARCHAR) = CAST(n1.n_nationkey AS VARCHAR)
LEFT JOIN nation n2 ON t.co = CAST(n2.n_nationkey AS VARCHAR)"""


def q_value_type_tags(spark, sf_dir):
    ev = table(spark, sf_dir, "events")
    k = F.get_json_object("props", "$.k")
    text = (F.when(F.col("event_type") == "signup", k)
            .when(F.col("event_type") == "view", F.concat(F.lit('"'), k, F.lit('"')))
            .when(F.col("event_type") == "click", F.concat(F.lit("["), k, F.lit("]")))
            .when(F.col("event_type") == "purchase", F.col("props"))
            .when(F.col("value") < 1, F.lit("null"))
            .when(F.col("value") > 400, F.lit("true"))
            .otherwise(F.col("value").cast("string")))
    rows = ev.select("event_id", text.alias("value_text"))
    return rows.select("event_id", "value_text", T.value_type_tag(F.try_parse_json("value_text")).alias("value_type"))


_VTYPE_SQL = """
WITH r AS (
  SELECT event_id,
    CASE WHEN event_type = 'signup' THEN json_extract_string(props, '$.k')
         WHEN event_type = 'view' THEN '"' || json_extract_string(props, '$.k') || '"'
         WHEN event_type = 'click' THEN '[' || json_extract_string(props, '$.k') || ']'
         WHEN event_type = 'purchase' THEN props
         WHEN value < 1 THEN 'null' WHEN value > 400 THEN 'true' ELSE CAST(value AS VARCHAR) END AS value_text
  FROM events)
SELECT event_id, value_text,
  CASE json_type(value_text) WHEN 'VARCHAR' THEN 'str' WHEN 'BIGINT' THEN 'int' WHEN 'UBIGINT' THEN 'int'
    WHEN 'DOUBLE' THEN 'float' WHEN 'BOOLEAN' THEN 'bool' WHEN 'ARRAY' THEN 'list' WHEN 'OBJECT' THEN 'dict'
    WHEN 'NULL' THEN 'null' END AS value_type
FROM r"""


def q_snapshot_scan(spark, sf_dir):
    """Snapshot '<year>1231' holds the lines shipped in that year."""
    li = table(spark, sf_dir, "lineitem").where(S.in_year("l_shipdate", 1998)).select(
        "l_orderkey", "l_linenumber", F.concat(F.year("l_shipdate").cast("string"), F.lit("1231")).alias("create_date"))
    return S.snapshot_scan(li, "19981231")


_SCAN_SQL = """
SELECT l_orderkey, l_linenumber, CAST(year(l_shipdate) AS VARCHAR) || '1231' AS create_date
FROM lineitem WHERE CAST(year(l_shipdate) AS VARCHAR) || '1231' = '19981231'"""

def dictionary_texts(spark, sf_dir):
    """The documents, and one dictionary text per part (negative ids)."""
    p = table(spark, sf_dir, "part")
    lines = F.concat_ws(
        "\n", F.lit("数据字典"), F.concat(F.lit("t_"), F.col("p_partkey").cast("string"), F.lit("  "), F.col("p_name")),
        F.lit("字段 类型 说明"), F.concat(F.lit("p_partkey  bigint(20) 编号"), F.col("p_size").cast("string")),
        F.concat(F.lit("p_type varchar (16) "), F.col("p_type"), F.lit("(类型)")), F.lit("---- ----"),
        F.concat(F.lit("P_SIZE INT unsigned "), F.col("p_brand"), F.lit(" 1=小;2=大")), F.lit("p_name text"),
        F.lit("p_containervarchar(10) 容器 0 - 无"), F.lit("p_unsigned int unsignedly 2x"), F.lit("p_painter the wall"),
        F.when(F.col("p_size") > 25, F.lit("h3. extra 附表\r\nx\n字段\nmade_at datetime\t时间")), F.lit("no field here"))
    made = p.select((-F.col("p_partkey") - 1).alias("doc_id"), lines.alias("text"))
    return table(spark, sf_dir, "documents").select("doc_id", "text").unionByName(made)


def q_label_extract(spark, sf_dir):
    return LB.dictionary_fields(LB.text_lines(dictionary_texts(spark, sf_dir), "doc_id", "text"), text="line")


_LABEL_EXTRACT_SQL = r"""
WITH texts AS (
  SELECT doc_id, text FROM documents
  UNION ALL
  SELECT -p_partkey - 1, concat_ws(chr(10), '数据字典', 't_' || CAST(p_partkey AS VARCHAR) || '  ' || p_name, '字段 类型 说明',
    'p_partkey  bigint(20) 编号' || CAST(p_size AS VARCHAR), 'p_type varchar (16) ' || p_type || '(类型)', '---- ----',
    'P_SIZE INT unsigned ' || p_brand || ' 1=小;2=大', 'p_name text', 'p_containervarchar(10) 容器 0 - 无',
    'p_unsigned int unsignedly 2x', 'p_painter the wall',
    CASE WHEN p_size > 25 THEN 'h3. extra 附表' || chr(13) || chr(10) || 'x' || chr(10) || '字段' || chr(10) || 'made_at datetime' || chr(9) || '时间' END,
    'no field here') FROM part),
l AS (
  SELECT doc_id, CAST(generate_subscripts(string_split_regex(text, '\r?\n'), 1) - 1 AS INTEGER) AS line_no,
         unnest(string_split_regex(text, '\r?\n')) AS line
  FROM texts),
b AS (
  SELECT *, CASE WHEN starts_with(line, 'h3.') THEN regexp_replace(line, '^h3\.\s*', '') ELSE line END AS body,
    contains(concat_ws(chr(10), lead(line, 1) OVER w, lead(line, 2) OVER w, lead(line, 3) OVER w, lead(line, 4) OVER w), '字段') AS near
  FROM l WINDOW w AS (PARTITION BY doc_id ORDER BY line_no)),
h AS (SELECT *, regexp_extract(body, '^[A-Za-z][A-Za-z0-9_]+') AS name FROM b),
t AS (SELECT *, substr(body, length(name) + 1) AS title FROM h),
s AS (
  SELECT doc_id, line_no, trim(regexp_replace(line, '[ \t]+', ' ', 'g')) AS n,
    last_value(CASE WHEN near AND name <> '' AND regexp_matches(title, '^\s+\S') THEN {'name': name, 'title': title} END IGNORE NULLS)
      OVER (PARTITION BY doc_id ORDER BY line_no ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS section
  FROM t),
i AS (
  SELECT *, regexp_extract(n, '^[A-Za-z_]\w*') AS id FROM s
  WHERE section IS NOT NULL AND n <> '' AND NOT starts_with(n, '----') AND NOT starts_with(n, '字段 ')),
k AS (
  SELECT *, ltrim(substr(n, length(id) + 1)) AS nxt, regexp_extract(ltrim(substr(n, length(id) + 1)), '^[A-Za-z]+') AS word,
    list_filter(['timestamp', 'smallint', 'datetime', 'tinyint', 'varchar', 'decimal', 'bigint', 'text', 'date', 'time', 'char', 'int'],
                lambda x: ends_with(lower(id), x) AND length(id) > length(x)) AS tails
  FROM i WHERE id <> ''),
f AS (
  SELECT *, lower(word) IN ('timestamp', 'smallint', 'datetime', 'tinyint', 'varchar', 'decimal', 'bigint', 'text', 'date',
                            'time', 'char', 'int') AS apart,
    CASE WHEN apart THEN id ELSE left(id, length(id) - length(tails[1])) END AS field,
    CASE WHEN apart THEN word ELSE right(id, length(tails[1])) END AS type,
    CASE WHEN apart THEN substr(nxt, length(word) + 1) ELSE substr(n, length(id) + 1) END AS rest
  FROM k WHERE apart OR len(tails) > 0),
z AS (
  SELECT *, CASE WHEN regexp_matches(rest, '^ ?[(][^)]+[)]') THEN regexp_extract(rest, '^ ?[(][^)]+[)]')
                 WHEN regexp_matches(rest, '(?i)^ unsigned($|[^A-Za-z])') THEN left(rest, 9) ELSE '' END AS size,
    trim(substr(rest, length(size) + 1)) AS comment
  FROM f)
SELECT doc_id, line_no, section.name AS "table", trim(regexp_replace(section.title, '[ \t]+', ' ', 'g')) AS table_title, field,
  trim(type || size) AS field_type, comment,
  COALESCE(NULLIF(trim(regexp_replace(regexp_extract(comment, '^[^;(（]*'), ' [0-9]+ ?[-=:>].*$', '')), ''),
           NULLIF(comment, ''), field) AS label
FROM z"""


QUERIES = {
    "label_extract": q_label_extract,
    "account_snapshot": q_account_snapshot,
    "personnel_upsert": q_personnel_upsert,
    "source_guard": q_source_guard,
    "label_columns": q_label_columns,
    "agent_field_decode": q_agent_field_decode,
    "offline_enrich": q_offline_enrich,
    "value_type_tags": q_value_type_tags,
    "snapshot_scan": q_snapshot_scan,
}

SQL = {
    "label_extract": _LABEL_EXTRACT_SQL,
    "account_snapshot": _ACCOUNT_SQL,
    "personnel_upsert": _PERSONNEL_SQL,
    "source_guard": _GUARD_SQL,
    "label_columns": _LABELCOLS_SQL,
    "agent_field_decode": _AGENT_SQL,
    "offline_enrich": _OFFLINE_SQL,
    "value_type_tags": _VTYPE_SQL,
    "snapshot_scan": _SCAN_SQL,
}
