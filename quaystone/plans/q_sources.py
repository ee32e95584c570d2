"""Registered queries: page bodies, layouts, documents, archive, canonical entities, long form."""

from __future__ import annotations

from pyspark.sql import functions as F

from quaystone.operators.entities import CONTACT_CANDIDATES, CUSTOMER_CANDIDATES, canonical_rows
from quaystone.operators.sampling import in_year
from quaystone.sources import envelope as EV
from quaystone.sources import layout as L
from quaystone.sources import sinks as K
from quaystone.plans.tables import scratch_path, table


def page_bodies(spark, sf_dir):
    ev = table(spark, sf_dir, "events")
    p = F.col("props")
    body = (F.when(F.col("event_type") == "view", F.concat(F.lit('{"data": ['), p, F.lit(', 5]}')))
            .when(F.col("event_type") == "click", F.concat(F.lit('{"list": {"x": 1}, "items": ['), p, F.lit(']}')))
            .when(F.col("event_type") == "purchase", F.concat(F.lit("["), p, F.lit("]")))
            .when(F.col("event_type") == "signup", F.concat(F.lit('{"data": {"rows": ['), p, F.lit(']}, "total": 2}')))
            .otherwise(F.concat(F.lit('{"tickets": ['), p, F.lit(", "), p, F.lit("]}"))))
    return ev.select("event_id", body.alias("body"))


def q_envelope_unwrap(spark, sf_dir):
    docs = EV.parse_body(page_bodies(spark, sf_dir), "body")
    items = EV.unwrap_items(docs, "doc", keep=["event_id"])
    return items.select("event_id", F.col("item_pos").cast("int").alias("item_pos"),
                        F.try_variant_get("item", "$.k", "bigint").alias("k"))


_ENV_SQL = """
WITH b AS (
  SELECT event_id,
    CASE event_type WHEN 'view' THEN '{"data": [' || props || ', 5]}'
      WHEN 'click' THEN '{"list": {"x": 1}, "items": [' || props || ']}'
      WHEN 'purchase' THEN '[' || props || ']'
      WHEN 'signup' THEN '{"data": {"rows": [' || props || ']}, "total": 2}'
      ELSE '{"tickets": [' || props || ', ' || props || ']}' END AS body
  FROM events),
c AS (
  SELECT event_id,
    CASE WHEN json_type(body) = 'ARRAY' THEN json(body)
      WHEN json_type(body, '$.data') = 'ARRAY' THEN json_extract(body, '$.data')
      WHEN json_type(body, '$.list') = 'ARRAY' THEN json_extract(body, '$.list')
      WHEN json_type(body, '$.items') = 'ARRAY' THEN json_extract(body, '$.items')
      WHEN json_type(body, '$.records') = 'ARRAY' THEN json_extract(body, '$.records')
      WHEN json_type(body, '$.rows') = 'ARRAY' THEN json_extract(body, '$.rows')
      WHEN json_type(body, '$.companies') = 'ARRAY' THEN json_extract(body, '$.companies')
      WHEN json_type(body, '$.users') = 'ARRAY' THEN json_extract(body, '$.users')
      WHEN json_type(body, '$.contacts') = 'ARRAY' THEN json_extract(body, '$.contacts')
      WHEN json_type(body, '$.contacters') = 'ARRAY' THEN json_extract(body, '$.contacters')
      WHEN json_type(body, '$.tickets') = 'ARRAY' THEN json_extract(body, '$.tickets')
      WHEN json_type(body, '$.data.data') = 'ARRAY' THEN json_extract(body, '$.data.data')
      WHEN json_type(body, '$.data.list') = 'ARRAY' THEN json_extract(body, '$.data.list')
      WHEN json_type(body, '$.data.items') = 'ARRAY' THEN json_extract(body, '$.data.items')
      WHEN json_type(body, '$.data.records') = 'ARRAY' THEN json_extract(body, '$.data.records')
      WHEN json_type(body, '$.data.rows') = 'ARRAY' THEN json_extract(body, '$.data.rows') END AS arr
  FROM b),
i AS (
  SELECT event_id, unnest(json_extract(arr, '$[*]')) AS item,
         unnest(generate_series(0, CAST(json_array_length(arr) AS BIGINT) - 1)) AS item_pos
  FROM c WHERE arr IS NOT NULL)
SELECT event_id, CAST(item_pos AS INTEGER) AS item_pos, CAST(json_extract(item, '$.k') AS BIGINT) AS k
FROM i WHERE json_type(item) = 'OBJECT'"""


def damaged_bodies(spark, sf_dir):
    ev = table(spark, sf_dir, "events")
    body = F.when(F.col("value") < 1, F.concat(F.lit('{"k": '), F.get_json_object("props", "$.k"))) \
        .otherwise(F.concat(F.lit('{"path": "C:\\dir\\'), F.col("event_type"), F.lit('", "k": '),
                            F.get_json_object("props", "$.k"), F.lit("}")))
    return ev.select("event_id", body.alias("body"))


def q_json_repair(spark, sf_dir):
    docs = EV.parse_body(damaged_bodies(spark, sf_dir), "body")
    return docs.select("event_id", F.try_variant_get("doc", "$.path", "string").alias("path"),
                       F.try_variant_get("doc", "$.k", "bigint").alias("k"),
                       F.when(F.col("doc").isNull(), "rejected").otherwise("ok").alias("status"))


_REPAIR_SQL = r"""
WITH b AS (
  SELECT event_id, CASE WHEN value < 1 THEN '{"k": ' || json_extract_string(props, '$.k')
    ELSE '{"path": "C:\dir\' || event_type || '", "k": ' || json_extract_string(props, '$.k') || '}' END AS body
  FROM events),
r AS (SELECT event_id, replace(body, '\', '\\') AS fixed FROM b)
SELECT event_id,
  CASE WHEN json_valid(fixed) THEN json_extract_string(fixed, '$.path') END AS path,
  CASE WHEN json_valid(fixed) THEN CAST(json_extract(fixed, '$.k') AS BIGINT) END AS k,
  CASE WHEN json_valid(fixed) THEN 'ok' ELSE 'rejected' END AS status
FROM r"""


def q_quarantine_replay(spark, sf_dir):
    """Damaged bodies of two batches are quarantined; two replays, which close an open object and wrap a lone one, move
    the mended rows on. Per batch and reason: rejects, and rows that moved in the first and in the second replay."""
    ev = table(spark, sf_dir, "events")
    kind = F.pmod(F.col("event_id"), F.lit(10))
    item = F.concat(F.lit('{"k": '), F.get_json_object("props", "$.k"))
    body = (F.when(kind == 0, F.concat(F.lit('{"items": ['), item)).when(kind == 1, F.concat(item, F.lit("}")))
            .when(kind == 2, F.lit(" ")).when(kind == 3, F.lit("[1, 2"))
            .otherwise(F.concat(F.lit('{"items": ['), item, F.lit("}]}"))))
    bodies = ev.select("event_id", "event_type", body.alias("body"))
    path = scratch_path(spark, "quarantine")
    for batch in ("click", "view", "click"):  # the first batch comes again
        EV.quarantine(bodies.where(F.col("event_type") == batch), path, batch, ["event_id"])
    closed = lambda c: F.when(c.startswith('{"items"'), F.concat(c, F.lit("}]}"))).otherwise(c)
    wrapped = lambda c: F.when(c.startswith('{"k"'), F.concat(F.lit("["), c, F.lit("]"))).otherwise(closed(c))
    rejects = spark.read.parquet(f"{path}/rejects").groupBy("batch", "reason").agg(F.count(F.lit(1)).alias("rejected"))
    for run, mend in (("first", closed), ("second", wrapped), ("second", wrapped)):  # a run that is done over
        moved = EV.replay(spark, path, run, ["event_id"], mend, "event_id bigint")
        moved = moved.groupBy("batch", "reason").agg(F.count(F.lit(1)).alias(f"moved_{run}"))
        rejects = (rejects if f"moved_{run}" not in rejects.columns else rejects.drop(f"moved_{run}")).join(moved, ["batch", "reason"], "left")
    none = lambda c: F.coalesce(c, F.lit(0).cast("long")).alias(c)
    return rejects.select("batch", "reason", "rejected", none("moved_first"), none("moved_second"))


_QUARANTINE_SQL = """
WITH e AS (SELECT event_type AS batch, CASE event_id % 10 WHEN 0 THEN 'broken' WHEN 1 THEN 'no_list' WHEN 2 THEN 'empty'
             WHEN 3 THEN 'broken' END AS reason, event_id % 10 AS kind FROM events WHERE event_type IN ('click', 'view'))
SELECT batch, reason, COUNT(*) AS rejected, COUNT(*) FILTER (WHERE kind = 0) AS moved_first,
  COUNT(*) FILTER (WHERE kind = 1) AS moved_second
FROM e WHERE reason IS NOT NULL GROUP BY 1, 2"""


#: Whole number types from the narrowest on, with the bits of their values.
_WHOLE_BITS = {"short": 15, "int": 31, "long": 63}


def narrowest_types(df, wanted):
    """The type of each key (name -> expression, narrowest type allowed) that holds all its values: one row of bounds reaches
    the driver."""
    bounds = df.agg(*[f(e.cast("long")).alias(f"{n}_{f.__name__}") for n, (e, _) in wanted.items() for f in (F.min, F.max)]).collect()[0]
    kinds = list(_WHOLE_BITS)

    def holds(kind, name):
        low, high = bounds[f"{name}_min"], bounds[f"{name}_max"]
        return low is None or -(1 << _WHOLE_BITS[kind]) <= low and high < 1 << _WHOLE_BITS[kind]

    return {n: next(k for k in kinds[kinds.index(least):] if holds(k, n)) for n, (_, least) in wanted.items()}


def q_evolving_schema(spark, sf_dir):
    """Orders written in three versions of a schema, read as one: whole numbers that become long and decimal, a number that
    becomes text, a struct that gets a field, a column that comes late. The old versions have the narrowest types that hold
    their keys."""
    o = table(spark, sf_dir, "orders")
    y, path = F.year("o_orderdate"), scratch_path(spark, "versions")
    code = F.substring("o_orderpriority", 1, 1)
    key, customer = F.col("o_orderkey"), F.col("o_custkey")
    kind = narrowest_types(o, {"id": (F.when(y <= 1996, key), "int"), "customer": (F.when(y <= 1996, customer), "int"),
                               "late_customer": (F.when(y > 1998, customer), "short")})
    first = o.where(y <= 1996).select(key.cast(kind["id"]).alias("id"), F.floor("o_totalprice").cast("int").alias("total"),
                                      code.cast("int").alias("priority"), F.struct(customer.cast(kind["customer"]).alias("id")).alias("customer"))
    second = o.where(y.between(1997, 1998)).select(
        F.col("o_orderkey").alias("id"), F.col("o_totalprice").cast("decimal(12,1)").alias("total"), F.col("o_orderpriority").alias("priority"),
        F.struct(F.col("o_custkey").alias("id"), F.col("o_orderstatus").alias("state")).alias("customer"))
    third = o.where(y > 1998).select(
        F.col("o_totalprice").cast("decimal(9,2)").alias("total"), F.col("o_orderkey").alias("id"),
        F.col("o_orderdate").cast("date").alias("day"), F.struct(customer.cast(kind["late_customer"]).alias("id")).alias("customer"))
    paths = [f"{path}/v{k}" for k in (1, 2, 3)]
    for df, p in zip((first, second, third), paths):
        df.write.parquet(p)
    return L.read_versions(spark, paths).select("id", "total", "priority", F.col("customer.id").alias("customer_id"),
                                                F.col("customer.state").alias("customer_state"), "day")


_EVOLVING_SQL = """
SELECT o_orderkey AS id, CAST(CASE WHEN year(o_orderdate) <= 1996 THEN floor(o_totalprice)
    WHEN year(o_orderdate) <= 1998 THEN CAST(o_totalprice AS DECIMAL(12,1)) ELSE CAST(o_totalprice AS DECIMAL(9,2)) END AS DECIMAL(13,2)) AS total,
  CASE WHEN year(o_orderdate) <= 1996 THEN left(o_orderpriority, 1) WHEN year(o_orderdate) <= 1998 THEN o_orderpriority END AS priority,
  CAST(o_custkey AS BIGINT) AS customer_id, CASE WHEN year(o_orderdate) BETWEEN 1997 AND 1998 THEN o_orderstatus END AS customer_state,
  CASE WHEN year(o_orderdate) > 1998 THEN CAST(o_orderdate AS DATE) END AS day
FROM orders"""


def q_key_profile(spark, sf_dir):
    ev = table(spark, sf_dir, "events")
    js = F.when(F.col("event_type") == "click", F.concat(F.lit('{"b": 1, '), F.expr("substr(props, 2)"))) \
        .otherwise(F.col("props"))
    return EV.key_profile(ev.select("event_type", js.alias("payload")), "payload", ["event_type"])


_KEYS_SQL = """
WITH e AS (SELECT event_type, CASE WHEN event_type = 'click' THEN '{"b": 1, ' || substr(props, 2) ELSE props END AS payload FROM events),
k AS (SELECT event_type, unnest(json_keys(payload)) AS key FROM e),
ks AS (SELECT event_type, string_agg(DISTINCT key, ',' ORDER BY key) AS keys FROM k GROUP BY 1),
c AS (SELECT event_type, COUNT(*) AS row_count FROM e GROUP BY 1)
SELECT c.event_type, COALESCE(ks.keys, '') AS keys, row_count, CASE WHEN row_count > 0 THEN 'ok' ELSE 'empty' END AS status
FROM c LEFT JOIN ks ON c.event_type = ks.event_type"""

SUPPLIER_LAYOUTS = (["s_suppkey", "s_name", "s_acctbal"], ["s_suppkey", "s_name", "s_nationkey", "s_acctbal"])
SUPPLIER_TYPES = {"s_suppkey": "bigint", "s_nationkey": "int", "s_acctbal": "decimal(18,2)"}


def q_layout_contract(spark, sf_dir):
    s = table(spark, sf_dir, "supplier").select("s_acctbal", "s_name", "s_suppkey")
    L.check_layout(s.columns, SUPPLIER_LAYOUTS)
    return L.project_by_name(s, SUPPLIER_LAYOUTS[-1], SUPPLIER_TYPES)


_LAYOUT_SQL = """
SELECT s_suppkey, s_name, CAST(NULL AS INTEGER) AS s_nationkey, CAST(s_acctbal AS DECIMAL(18,2)) AS s_acctbal FROM supplier"""


def q_snapshot_document(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem").where(in_year("l_shipdate", 1998))
    start = (F.when(F.col("l_returnflag") == "A", F.date_format("l_shipdate", "yyyyMMdd"))
             .when(F.col("l_returnflag") == "R", F.date_format("l_shipdate", "yyyy-MM-dd"))
             .when(F.col("l_linestatus") == "O", F.lit("0000-12-30")).otherwise(F.lit("")))
    snap = li.select(F.col("l_orderkey").alias("seq_no"), F.col("l_linenumber").alias("line_id"),
                     F.col("l_orderkey").cast("string").alias("contract_id"), start.alias("ops_start_date"))
    return K.document_rows(snap, ["seq_no", "line_id"], ["ops_start_date"])


_DOC_SQL = r"""
WITH s AS (
  SELECT l_orderkey AS seq_no, l_linenumber AS line_id, CAST(l_orderkey AS VARCHAR) AS contract_id,
    CASE WHEN l_returnflag = 'A' THEN strftime(l_shipdate, '%Y%m%d') WHEN l_returnflag = 'R' THEN strftime(l_shipdate, '%Y-%m-%d')
         WHEN l_linestatus = 'O' THEN '0000-12-30' ELSE '' END AS t
  FROM lineitem WHERE year(l_shipdate) = 1998)
SELECT '文档行' AS "文档类别", seq_no, line_id, contract_id,
  CASE WHEN regexp_full_match(t, '\d{8}') AND substr(t, 1, 4) <> '0000' THEN strftime(strptime(t, '%Y%m%d'), '%Y-%m-%d')
       ELSE t END AS ops_start_date
FROM s ORDER BY seq_no, line_id"""


def q_raw_archive(spark, sf_dir):
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_name", F.col("c_acctbal").cast("decimal(18,2)").cast("string").alias("c_acctbal"))
    replayed = c.unionByName(c)
    return K.raw_archive(replayed, "B1", "customer", "customer_api", "c_custkey")


_ARCHIVE_SQL = """
SELECT 'B1' AS sync_batch_id, 'customer' AS entity_type, 'customer_api' AS source_name,
  CAST(c_custkey AS VARCHAR) AS source_record_id,
  CAST(to_json({'c_custkey': c_custkey, 'c_name': c_name, 'c_acctbal': CAST(CAST(c_acctbal AS DECIMAL(18,2)) AS VARCHAR)}) AS VARCHAR) AS payload_json
FROM customer"""


def _update_text(key):
    """Seconds, milliseconds or plain text, by the key."""
    epoch = (F.col(key) + 1700000000).cast("string")
    return (F.when(F.col(key) % 3 == 0, epoch).when(F.col(key) % 3 == 1, F.concat(epoch, F.lit("007")))
            .otherwise(F.lit("2026/6/1 8:05:00")))


def q_canonical_entities(spark, sf_dir):
    c = table(spark, sf_dir, "customer")
    cust = c.select(F.when(F.col("c_acctbal") < 0, F.lit("")).otherwise(F.col("c_custkey").cast("string")).alias("UID"),
                    F.col("c_name").alias("companyName"), F.col("c_mktsegment").alias("RANK"),
                    F.col("c_nationkey").cast("string").alias("area"), F.lit(" ").alias("city"), F.col("c_mktsegment").alias("cityName"),
                    F.lit("区").alias("area3Name"), F.concat(F.lit(" "), F.col("c_name"), F.lit("\n")).alias("addr"),
                    F.lit("").alias("contactor"), F.col("c_name").alias("linkman"),
                    F.when(F.col("c_custkey") % 2 == 0, F.lit("")).otherwise(F.lit("138")).alias("Mobile"), F.lit("010").alias("tel"),
                    F.lit("a@b").alias("mail"), _update_text("c_custkey").alias("updateTime"))
    s = table(spark, sf_dir, "supplier")
    sup = s.select(F.col("s_suppkey").cast("string").alias("id"), F.col("s_name").alias("name"),
                   F.col("s_nationkey").cast("string").alias("areaName"))
    return canonical_rows(cust, CUSTOMER_CANDIDATES, "customer").unionByName(canonical_rows(sup, CUSTOMER_CANDIDATES, "company"))


def q_canonical_contacts(spark, sf_dir):
    c = table(spark, sf_dir, "customer")
    rows = c.select(F.when(F.col("c_acctbal") < 0, F.lit(" ")).otherwise(F.col("c_custkey").cast("string")).alias("contacterId"),
                    F.lit("").alias("realName"), F.col("c_name").alias("contactName"),
                    F.when(F.col("c_custkey") % 2 == 0, F.lit("139")).alias("mobilePhone"), F.lit("0571").alias("phone"),
                    F.lit("x@y").alias("email"), F.col("c_custkey").cast("string").alias("qq"), F.lit("w").alias("wx"),
                    F.col("c_nationkey").cast("string").alias("companyId"), F.col("c_mktsegment").alias("customerName"),
                    F.lit(None).cast("string").alias("department"), F.lit("dep").alias("deptName"), F.lit("job").alias("jobTitle"),
                    _update_text("c_custkey").alias("modifyTime"))
    return canonical_rows(rows, CONTACT_CANDIDATES, "contact_api")


_UPDATE_SQL = """CASE WHEN c_custkey % 3 = 2 THEN TIMESTAMP '2026-06-01 08:05:00'
    ELSE make_timestamp((c_custkey + 1700000000) * 1000000) + INTERVAL 8 HOUR END AS source_updated_at"""
_NO_TEXT = "CAST(NULL AS VARCHAR)"
_CANON_SQL = f"""
SELECT CASE WHEN c_acctbal >= 0 THEN CAST(c_custkey AS VARCHAR) END AS customer_id,
  c_name AS customer_name, c_mktsegment AS customer_type, CAST(c_nationkey AS VARCHAR) AS province,
  {_NO_TEXT} AS city, '区' AS district, c_name AS address, c_name AS contact_name,
  CASE WHEN c_custkey % 2 = 0 THEN '010' ELSE '138' END AS phone, 'a@b' AS email,
  'customer' AS source_flags, {_UPDATE_SQL}, c_acctbal < 0 AS rejected
FROM customer
UNION ALL
SELECT CAST(s_suppkey AS VARCHAR), s_name, {_NO_TEXT}, CAST(s_nationkey AS VARCHAR), {_NO_TEXT}, {_NO_TEXT}, {_NO_TEXT}, {_NO_TEXT},
  {_NO_TEXT}, {_NO_TEXT}, 'company', CAST(NULL AS TIMESTAMP), false
FROM supplier"""
_CONTACT_SQL = f"""
SELECT CASE WHEN c_acctbal >= 0 THEN CAST(c_custkey AS VARCHAR) END AS contact_id, c_name AS contact_name,
  CASE WHEN c_custkey % 2 = 0 THEN '139' END AS phone, '0571' AS fixed_phone, 'x@y' AS email, CAST(c_custkey AS VARCHAR) AS qq,
  'w' AS wechat, CAST(c_nationkey AS VARCHAR) AS customer_id, c_mktsegment AS customer_name, 'dep' AS department_name,
  'job' AS position_name, 'contact_api' AS source_flags, {_UPDATE_SQL}, c_acctbal < 0 AS rejected
FROM customer"""

LABELS = {"o_orderstatus": "状态", "o_orderpriority": "优先级", "o_totalprice": "金额"}


def q_label_long_form(spark, sf_dir):
    from quaystone.operators.labels import long_form
    o = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_orderstatus", "o_orderpriority", "o_custkey",
        F.col("o_totalprice").cast("decimal(18,2)").alias("o_totalprice"),
        (F.col("o_totalprice") > 100000).alias("is_large"), F.array("o_orderstatus", "o_orderpriority").alias("codes"),
        F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss").alias("o_orderdate"))
    names = spark.createDataFrame(list(LABELS.items()), "k string, label string")
    return long_form(o, "o_orderkey", names)


_LONG_SQL = """
WITH o AS (
  SELECT o_orderkey, o_orderstatus, o_orderpriority, CAST(o_custkey AS VARCHAR) AS o_custkey,
         CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR) AS o_totalprice,
         CASE WHEN o_totalprice > 100000 THEN 'True' ELSE 'False' END AS is_large,
         CAST(to_json([o_orderstatus, o_orderpriority]) AS VARCHAR) AS codes,
         strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS o_orderdate FROM orders),
l AS (UNPIVOT o ON o_orderstatus, o_orderpriority, o_custkey, o_totalprice, is_large, codes, o_orderdate INTO NAME field_key VALUE value)
SELECT o_orderkey, field_key,
  CASE field_key WHEN 'o_orderstatus' THEN '状态' WHEN 'o_orderpriority' THEN '优先级' WHEN 'o_totalprice' THEN '金额' ELSE field_key END AS field_label,
  value, CASE field_key WHEN 'o_custkey' THEN 'int' WHEN 'o_totalprice' THEN 'float' WHEN 'is_large' THEN 'bool' WHEN 'codes' THEN 'list' ELSE 'str' END AS value_type
FROM l"""

QUERIES = {
    "quarantine_replay": q_quarantine_replay,
    "evolving_schema": q_evolving_schema,
    "envelope_unwrap": q_envelope_unwrap,
    "json_repair": q_json_repair,
    "key_profile": q_key_profile,
    "layout_contract": q_layout_contract,
    "snapshot_document": q_snapshot_document,
    "raw_archive": q_raw_archive,
    "canonical_entities": q_canonical_entities,
    "canonical_contacts": q_canonical_contacts,
    "label_long_form": q_label_long_form,
}

SQL = {
    "quarantine_replay": _QUARANTINE_SQL,
    "evolving_schema": _EVOLVING_SQL,
    "envelope_unwrap": _ENV_SQL,
    "json_repair": _REPAIR_SQL,
    "key_profile": _KEYS_SQL,
    "layout_contract": _LAYOUT_SQL,
    "snapshot_document": _DOC_SQL,
    "raw_archive": _ARCHIVE_SQL,
    "canonical_entities": _CANON_SQL,
    "canonical_contacts": _CONTACT_SQL,
    "label_long_form": _LONG_SQL,
}
