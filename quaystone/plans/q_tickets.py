"""Registered queries: ticket decoding and shaping on orders / events / conversations."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import functions as F

from quaystone.functions.codes import TICKET_ENUMS
from quaystone.functions.dates import entity_datetime, metric_datetime, unix_text_to_display
from quaystone.operators import tickets as T
from quaystone.plans.tables import table


def q_enum_decode(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    raw = o.select(
        "o_orderkey",
        F.when(F.col("o_orderstatus") == "F", "2").when(F.col("o_orderstatus") == "O", "3").otherwise("99").alias("ticketType"),
        F.substring("o_orderpriority", 1, 1).alias("priorityLevel"),
        F.when(F.col("o_orderstatus") == "F", "4").when(F.col("o_orderstatus") == "O", " 1 ").otherwise("").alias("ticketStatus"),
        F.when(F.col("o_totalprice") > 100000, "1").otherwise("0").alias("createrType"),
        F.lit("0").alias("isDeleted"))
    return T.decode_enums(raw, TICKET_ENUMS)


def _enum_sql(col, mapping):
    whens = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in mapping.items())
    return f"CASE WHEN {col} IS NULL OR trim({col}) = '' THEN {col} ELSE COALESCE(CASE trim({col}) {whens} END, {col}) END"


_ENUM_SQL = f"""
WITH raw AS (
  SELECT o_orderkey,
    CASE WHEN o_orderstatus = 'F' THEN '2' WHEN o_orderstatus = 'O' THEN '3' ELSE '99' END AS ticketType,
    substr(o_orderpriority, 1, 1) AS priorityLevel,
    CASE WHEN o_orderstatus = 'F' THEN '4' WHEN o_orderstatus = 'O' THEN ' 1 ' ELSE '' END AS ticketStatus,
    CASE WHEN o_totalprice > 100000 THEN '1' ELSE '0' END AS createrType, '0' AS isDeleted
  FROM orders)
SELECT o_orderkey, {', '.join(f'{_enum_sql(c, m)} AS {c}' for c, m in TICKET_ENUMS.items())} FROM raw"""


def q_enrich_chain(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    tickets = o.select("o_orderkey", F.when(F.col("o_orderpriority") == "5-LOW", F.lit("0"))
                       .when(F.col("o_orderstatus") == "P", F.lit("")).otherwise(F.col("o_custkey").cast("string"))
                       .alias("custUserId"))
    cust = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey")
    nation = table(spark, sf_dir, "nation")
    region = table(spark, sf_dir, "region")
    t = T.enrich_name(tickets, "custUserId", cust, "c_custkey", "c_name", "contact_name", zero_is_blank=False)
    # company through the contact
    link = cust.select(F.col("c_custkey").cast("string").alias("__cid"),
                                          F.col("c_nationkey").cast("string").alias("company_id"))
    t = t.join(link, F.trim(t.custUserId) == link["__cid"], "left").drop("__cid")
    t = T.enrich_name(t, "company_id", nation, "n_nationkey", "n_name", "company_name")
    glink = nation.select(F.col("n_nationkey").cast("string").alias("__nid"),
                                             F.col("n_regionkey").cast("string").alias("group_id"))
    valid_company = F.trim(t.company_id).isNotNull() & ~F.trim(t.company_id).isin("", "0")
    t = t.join(glink, valid_company & (F.trim(t.company_id) == glink["__nid"]), "left").drop("__nid")
    return T.enrich_name(t, "group_id", region, "r_regionkey", "r_name", "group_name")


_ENRICH_SQL = """
WITH t AS (
  SELECT o_orderkey, CASE WHEN o_orderpriority = '5-LOW' THEN '0' WHEN o_orderstatus = 'P' THEN ''
                          ELSE CAST(o_custkey AS VARCHAR) END AS custUserId FROM orders),
a AS (
  SELECT t.*, CASE WHEN trim(custUserId) <> '' THEN COALESCE(NULLIF(trim(c.c_name), ''), trim(custUserId)) END AS contact_name,
         CAST(c.c_nationkey AS VARCHAR) AS company_id
  FROM t LEFT JOIN customer c ON trim(t.custUserId) = CAST(c.c_custkey AS VARCHAR)),
b AS (
  SELECT a.*, CASE WHEN trim(company_id) NOT IN ('', '0') THEN COALESCE(NULLIF(trim(n.n_name), ''), trim(company_id)) END AS company_name,
         CAST(n.n_regionkey AS VARCHAR) AS group_id
  FROM a LEFT JOIN nation n ON trim(a.company_id) NOT IN ('', '0') AND trim(a.company_id) = CAST(n.n_nationkey AS VARCHAR))
SELECT b.o_orderkey, b.custUserId, b.contact_name, b.company_id, b.company_name, b.group_id,
  CASE WHEN trim(group_id) NOT IN ('', '0') THEN COALESCE(NULLIF(trim(r.r_name), ''), trim(group_id)) END AS group_name
FROM b LEFT JOIN region r ON trim(b.group_id) NOT IN ('', '0') AND trim(b.group_id) = CAST(r.r_regionkey AS VARCHAR)"""


def q_id_list_enrich(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus")
    lists = li.groupBy("l_orderkey").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("l_linenumber", "l_suppkey", "l_partkey"))),
                                 lambda s: s["l_suppkey"].cast("string")), ",").alias("ids"))
    t = lists.join(o, lists.l_orderkey == o.o_orderkey).select(
        "o_orderkey", F.when(F.col("o_orderstatus") == "O", F.regexp_replace("ids", ",", "，"))
        .otherwise(F.col("ids")).alias("servicer_ids"))
    # every third supplier stands in the dimension twice, with another name; every fifth ticket comes twice
    sup = table(spark, sf_dir, "supplier").select("s_suppkey", "s_name")
    sup = sup.unionByName(sup.where("s_suppkey % 3 = 0").withColumn("s_name", F.concat(F.lit("A "), F.col("s_name"))))
    t = t.unionByName(t.where("o_orderkey % 5 = 0"))
    return T.enrich_id_list(t, "servicer_ids", sup, "s_suppkey", "s_name", "servicer_names")


_IDLIST_SQL = """
WITH lists AS (
  SELECT l_orderkey, string_agg(CAST(l_suppkey AS VARCHAR), ',' ORDER BY l_linenumber, l_suppkey, l_partkey) AS ids
  FROM lineitem GROUP BY l_orderkey),
t AS (
  SELECT o_orderkey, CASE WHEN o_orderstatus = 'O' THEN replace(ids, ',', '，') ELSE ids END AS servicer_ids,
    unnest(CASE WHEN o_orderkey % 5 = 0 THEN [1, 2] ELSE [1] END) AS copy
  FROM lists JOIN orders ON l_orderkey = o_orderkey),
sup AS (SELECT s_suppkey, CASE WHEN s_suppkey % 3 = 0 THEN least(s_name, 'A ' || s_name) ELSE s_name END AS s_name FROM supplier),
ex AS (
  SELECT o_orderkey, copy, servicer_ids, trim(x.v) AS id, x.i
  FROM t, LATERAL (SELECT unnest(string_split(replace(servicer_ids, '，', ','), ',')) AS v,
                          generate_subscripts(string_split(replace(servicer_ids, '，', ','), ','), 1) AS i) x),
named AS (
  SELECT o_orderkey, copy, servicer_ids, i, COALESCE(NULLIF(trim(s_name), ''), id) AS name
  FROM ex LEFT JOIN sup ON id = CAST(s_suppkey AS VARCHAR) WHERE id <> '')
SELECT o_orderkey, servicer_ids, string_agg(name, ',' ORDER BY i) AS servicer_names
FROM named GROUP BY o_orderkey, copy, servicer_ids"""


def option_tree(spark, sf_dir):
    n = table(spark, sf_dir, "nation")
    r = table(spark, sf_dir, "region")
    kids = n.groupBy("n_regionkey").agg(F.array_sort(F.collect_list(
        F.struct(F.col("n_nationkey").alias("key"), F.col("n_name").alias("value")))).alias("children"))
    regions = r.join(kids, r.r_regionkey == kids.n_regionkey, "left").select(
        F.struct(F.col("r_regionkey").alias("key"), F.col("r_name").alias("value"), "children").alias("opt"))
    return regions.agg(F.array_sort(F.collect_list("opt")).alias("options")).select(
        F.lit("region").alias("field_key"), "options")


def q_option_flatten(spark, sf_dir):
    flat = T.flatten_option_tree(option_tree(spark, sf_dir), "field_key", "options")
    return T.last_option_wins(flat)


_OPTFLAT_SQL = """
WITH r AS (SELECT r_regionkey, r_name, row_number() OVER (ORDER BY r_regionkey) - 1 AS ri FROM region),
n AS (SELECT n_nationkey, n_name, n_regionkey, row_number() OVER (PARTITION BY n_regionkey ORDER BY n_nationkey) - 1 AS ni FROM nation),
flat AS (
  SELECT CAST(r_regionkey AS VARCHAR) AS option_key, r_name AS option_value, ri * 1000 AS ord FROM r
  UNION ALL
  SELECT CAST(n_nationkey AS VARCHAR), n_name, ri * 1000 + ni + 1 FROM n JOIN r ON n.n_regionkey = r.r_regionkey)
SELECT 'region' AS field_key, option_key, arg_max(option_value, ord) AS option_value FROM flat GROUP BY option_key"""

FIELD_NAMES = {"click": "点击", "view": "浏览", "purchase": "购买", "signup": "注册"}


def q_option_decode(spark, sf_dir):
    ev = table(spark, sf_dir, "events")
    eav = ev.select("event_id", F.col("event_type").alias("field_key"),
                    F.get_json_object("props", "$.k").alias("field_value"))
    n = table(spark, sf_dir, "nation")
    field_opts = n.select(F.lit("click").alias("field_key"), F.col("n_nationkey").cast("string").alias("option_key"),
                          F.col("n_name").alias("option_value"))
    r = table(spark, sf_dir, "region")
    global_opts = r.select(F.col("r_regionkey").cast("string").alias("option_key"), F.col("r_name").alias("option_value"))
    # options and names that are given twice: the same option with another text, a name that is blank once
    field_opts = field_opts.unionByName(field_opts.where("option_key % 2 = 0").withColumn("option_value", F.lit("ZZ")))
    global_opts = global_opts.unionByName(global_opts.withColumn("option_value", F.lit("")))
    names = spark.createDataFrame([*FIELD_NAMES.items(), ("click", " "), ("view", "览")], "key string, name string")
    return T.decode_field_values(eav, field_opts, global_opts, names)


_NAMES_VALUES = ", ".join(f"('{k}', '{v}')" for k, v in FIELD_NAMES.items())
_OPTDEC_SQL = f"""
WITH eav AS (SELECT event_id, event_type AS field_key, json_extract_string(props, '$.k') AS field_value FROM events),
names(key, name) AS (VALUES {_NAMES_VALUES})
SELECT e.event_id, e.field_key, e.field_value,
  COALESCE(CASE WHEN e.field_key = 'click' THEN CASE WHEN n.n_nationkey % 2 = 0 THEN least(n.n_name, 'ZZ') ELSE n.n_name END END,
           r.r_name, e.field_value) AS decoded_value,
  COALESCE(NULLIF(trim(nm.name), ''), e.field_key) AS field_name
FROM eav e
LEFT JOIN nation n ON e.field_key = 'click' AND trim(e.field_value) = CAST(n.n_nationkey AS VARCHAR)
LEFT JOIN region r ON trim(e.field_value) = CAST(r.r_regionkey AS VARCHAR)
LEFT JOIN names nm ON e.field_key = nm.key"""


def q_zip_arrays(spark, sf_dir):
    """Turns as raw fields with values of every kind, the assistant's turns as resolved fields."""
    c = table(spark, sf_dir, "conversations")
    kind = F.col("turn") % 5
    value = (F.when(kind == 1, F.parse_json(F.length("text").cast("string")))
             .when(kind == 2, F.parse_json(F.concat(F.lit("["), F.col("turn").cast("string"), F.lit(",true]"))))
             .when(kind == 3, F.parse_json(F.lit("true"))).when(kind == 4, F.parse_json(F.lit('{"n":1.5}')))
             .otherwise(F.col("text").cast("variant")))
    turns = c.select("conv_id", "turn", "role", value.alias("value"))
    typed = lambda prefix, v: F.transform(F.array_sort(F.collect_list(F.struct("turn", v)), _by_turn),
                                          lambda s: F.struct(F.concat(F.lit(prefix), s["turn"].cast("string")).alias("key"),
                                                             s["value"].alias("value")))
    raw = turns.groupBy("conv_id").agg(typed("turn_", F.col("value")).alias("raw"))
    res = turns.where(F.col("role") == "assistant").groupBy("conv_id").agg(
        typed("reply_", F.col("role").cast("variant").alias("value")).alias("resolved"))
    j = raw.join(res, "conv_id", "left").select(
        "conv_id", "raw", F.coalesce("resolved", F.array().cast(res.schema["resolved"].dataType)).alias("resolved"))
    return T.zip_custom_fields(j, "conv_id", "raw", "resolved")


def _by_turn(a, b):
    return F.when(a["turn"] < b["turn"], -1).when(a["turn"] > b["turn"], 1).otherwise(0)


_ZIP_SQL = r"""
WITH v AS (
  SELECT conv_id, turn, role, 'turn_' || CAST(turn AS VARCHAR) AS k,
    CASE turn % 5 WHEN 1 THEN CAST(length(text) AS VARCHAR) WHEN 2 THEN '[' || CAST(turn AS VARCHAR) || ',true]' WHEN 3 THEN 'True'
      WHEN 4 THEN '{"n":1.5}' ELSE text END AS v,
    CASE turn % 5 WHEN 1 THEN 'int' WHEN 2 THEN 'list' WHEN 3 THEN 'bool' WHEN 4 THEN 'dict' ELSE 'str' END AS kind
  FROM conversations),
raw AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS pos FROM v),
res AS (SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS pos, 'reply_' || CAST(turn AS VARCHAR) AS k, role AS v
        FROM conversations WHERE role = 'assistant'),
z AS (SELECT COALESCE(raw.conv_id, res.conv_id) AS conv_id, COALESCE(raw.pos, res.pos) AS pos, raw.k AS rk, res.k AS vk,
        COALESCE(res.v, raw.v) AS v, CASE WHEN res.v IS NOT NULL THEN 'str' WHEN raw.v IS NULL THEN 'null' ELSE raw.kind END AS kind
      FROM raw FULL OUTER JOIN res ON raw.conv_id = res.conv_id AND raw.pos = res.pos)
SELECT conv_id, CAST(pos AS INTEGER) AS field_order, COALESCE(rk, '') AS field_key, COALESCE(vk, rk) AS field_name,
  NULLIF(regexp_replace(v, '^\s+|\s+$', '', 'g'), '') AS field_value,
  CASE WHEN kind IN ('list', 'dict') THEN v END AS field_value_json, kind AS field_value_type
FROM z"""


def region_fields(spark, sf_dir):
    """Orders with custom fields built from their customer's nation/region, rendered with codes."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderpriority")
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    n = table(spark, sf_dir, "nation")
    r = table(spark, sf_dir, "region")
    j = o.join(c, o.o_custkey == c.c_custkey).join(n, F.col("c_nationkey") == n.n_nationkey) \
        .join(r, n.n_regionkey == r.r_regionkey)
    f = lambda k, v: F.struct(F.lit(k).alias("key"), v.alias("value"))
    fields = F.array(
        f("所属区域", F.concat(F.lit("(12) "), F.col("r_name"), F.lit("市"))),
        f("省份", F.concat(F.lpad(F.col("n_nationkey").cast("string"), 6, "1"), F.lit(" "), F.col("n_name"), F.lit("省"))),
        f("区县", F.when(F.col("o_orderpriority") == "1-URGENT", F.lit("010 ")).otherwise(F.concat(F.col("n_name"), F.lit("区")))),
        f("客户性质", F.col("o_orderpriority")),
        f("产品线", F.lit("   ")),
        f("产品名称", F.col("r_name")))
    return j.select("o_orderkey", fields.alias("custom_fields"))


def q_dimension_extract(spark, sf_dir):
    return T.extract_dimensions(region_fields(spark, sf_dir), "custom_fields").drop("custom_fields")


MAIN_MAP = {"ticketId": "ticket_id", "createDT": "create_dt", "subject": "subject", "category": "ticket_category"}


def q_ticket_main_row(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    raw = o.select(
        F.col("o_orderkey").cast("string").alias("ticketId"),
        F.when(F.col("o_orderstatus") == "F", F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss"))
        .when(F.col("o_orderstatus") == "O", F.date_format("o_orderdate", "yyyy-MM-dd"))
        .when(F.col("o_orderpriority") == "1-URGENT", F.lit("0")).otherwise(F.lit("")).alias("createDT"),
        F.concat(F.lit(" "), F.col("o_orderpriority"), F.lit(" ")).alias("subject"),
        F.when(F.col("o_orderstatus") == "F", F.lit("子单")).alias("category"))
    return T.main_row(raw, MAIN_MAP, datetime_cols=["create_dt"])


_MAIN_SQL = """
WITH raw AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS ticketId,
    CASE WHEN o_orderstatus = 'F' THEN strftime(o_orderdate, '%Y-%m-%d %H:%M:%S')
         WHEN o_orderstatus = 'O' THEN strftime(o_orderdate, '%Y-%m-%d')
         WHEN o_orderpriority = '1-URGENT' THEN '0' ELSE '' END AS createDT,
    ' ' || o_orderpriority || ' ' AS subject,
    CASE WHEN o_orderstatus = 'F' THEN '子单' END AS category
  FROM orders),
m AS (
  SELECT TRY_CAST(trim(ticketId) AS BIGINT) AS ticket_id,
    CASE WHEN trim(createDT) = '0' THEN NULL ELSE COALESCE(try_strptime(trim(createDT), '%Y-%m-%d %H:%M:%S'),
         try_strptime(trim(createDT), '%Y-%m-%d')) END AS create_dt,
    NULLIF(trim(subject), '') AS subject, COALESCE(NULLIF(trim(category), ''), '原单') AS ticket_category
  FROM raw)
SELECT *, CAST(year(create_dt) AS INTEGER) AS create_year, CAST(month(create_dt) AS INTEGER) AS create_month,
  strftime(create_dt, '%Y-%m') AS create_month_label FROM m"""


def q_since_filter(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    rows = o.select("o_orderkey",
                    F.when(F.col("o_orderpriority") != "1-URGENT", F.col("o_orderdate")).alias("updateDT"),
                    F.when(F.col("o_orderstatus") != "P", F.timestamp_add("DAY", F.lit(400), F.col("o_orderdate"))).alias("createDT"))
    return T.since_filter(rows, ["updateDT", "createDT"], _dt.datetime(1998, 1, 1))


_SINCE_SQL = """
WITH rows AS (
  SELECT o_orderkey, CASE WHEN o_orderpriority <> '1-URGENT' THEN o_orderdate END AS updateDT,
         CASE WHEN o_orderstatus <> 'P' THEN o_orderdate + INTERVAL 400 DAY END AS createDT FROM orders)
SELECT * FROM rows WHERE COALESCE(updateDT, createDT) IS NULL OR COALESCE(updateDT, createDT) >= TIMESTAMP '1998-01-01'"""


def q_text_dates(spark, sf_dir):
    ev = table(spark, sf_dir, "events")
    epoch = F.timestamp_diff("SECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), F.col("ts"))
    raw = ev.select("event_id", epoch.cast("string").alias("epoch_text"),
                    F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss").alias("iso_text"),
                    F.date_format("ts", "yyyy/M/d H:mm:ss").alias("slash_text"))
    return raw.select("event_id", "epoch_text",
                      unix_text_to_display("epoch_text").alias("display_time"),
                      entity_datetime(F.concat("epoch_text", F.lit("123"))).alias("entity_from_millis"),
                      entity_datetime("slash_text").alias("entity_from_slash"),
                      metric_datetime("iso_text").alias("metric_legacy"),
                      metric_datetime("iso_text", legacy=False).alias("metric_fixed"))


_DATES_SQL = """
WITH raw AS (
  SELECT event_id, CAST(date_diff('second', TIMESTAMP '1970-01-01', ts) AS VARCHAR) AS epoch_text,
         strftime(ts, '%Y-%m-%dT%H:%M:%S') AS iso_text, ts FROM events)
SELECT event_id, epoch_text,
  strftime(make_timestamp(CAST(epoch_text AS BIGINT) * 1000000) + INTERVAL 8 HOUR, '%Y-%m-%d %H:%M:%S') AS display_time,
  make_timestamp(CAST(substr(epoch_text || '123', 1, 10) AS BIGINT) * 1000000) + INTERVAL 8 HOUR AS entity_from_millis,
  date_trunc('second', ts) AS entity_from_slash,
  CAST(CAST(ts AS DATE) AS TIMESTAMP) AS metric_legacy,
  date_trunc('second', ts) AS metric_fixed
FROM raw"""

def _dimension_sql() -> str:
    """The W6 fold unrolled over the six fields of ``region_fields``: one CTE per field
    carries the 13 dimension slots (generated from the keyword table)."""
    from quaystone.functions.codes import (ANALYTIC_FIELD_KEYWORDS as KW, DISTRICT_SUFFIXES, MUNICIPALITIES,
                                           PROVINCE_SUFFIXES)
    dims = list(KW)
    fields = [
        ("所属区域", "'(12) ' || r_name || '市'"),
        ("省份", "lpad(CAST(n_nationkey AS VARCHAR), 6, '1') || ' ' || n_name || '省'"),
        ("区县", "CASE WHEN o_orderpriority = '1-URGENT' THEN '010 ' ELSE n_name || '区' END"),
        ("客户性质", "o_orderpriority"),
        ("产品线", "'   '"),
        ("产品名称", "r_name"),
    ]

    def clean(v):
        t = f"trim({v})"
        t = f"regexp_replace({t}, '^\\d{{6}}\\s*', '')"
        t = f"regexp_replace({t}, '^\\d{{2,4}}\\s+', '')"
        t = f"regexp_replace({t}, '[（(]\\d+[）)]\\s*', '', 'g')"
        t = f"trim({t})"
        return f"(CASE WHEN {t} IN ('[]', '{{}}') THEN '' ELSE COALESCE({t}, '') END)"

    def empty(d):
        return f"COALESCE(d_{d}, '') = ''"

    muni = ", ".join(f"'{m}'" for m in MUNICIPALITIES)
    ctes = ["base AS (SELECT o.o_orderkey, n.n_nationkey, n.n_name, r.r_name, o.o_orderpriority, "
            + ", ".join(f"CAST(NULL AS VARCHAR) AS d_{d}" for d in dims)
            + " FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey JOIN nation n ON c.c_nationkey = n.n_nationkey"
            + " JOIN region r ON n.n_regionkey = r.r_regionkey)"]
    prev = "base"
    for i, (name, value) in enumerate(fields):
        matches = [d for d in dims if any(k in name for k in KW[d])]
        claim = "CASE " + " ".join(f"WHEN {empty(d)} THEN '{d}'" for d in matches) + " END" if matches else "NULL"
        t = f"t{i}"
        step_in = f"s{i}a"
        ctes.append(f"{step_in} AS (SELECT *, {clean(value)} AS {t}, {claim} AS c{i} FROM {prev})")
        ok = f"(c{i} IS NOT NULL AND {t} <> '')"
        prov = f"({t} IN ({muni}) OR " + " OR ".join(f"ends_with({t}, '{x}')" for x in PROVINCE_SUFFIXES) + ")"
        dist = "(" + " OR ".join(f"ends_with({t}, '{x}')" for x in DISTRICT_SUFFIXES) + ")"
        city = f"ends_with({t}, '市')"
        cols = []
        for d in dims:
            if d == "province":
                cond = f"(c{i} = 'province' OR ((c{i} = 'district' OR c{i} = 'region_text') AND {prov}))"
            elif d == "city":
                cond = f"(c{i} = 'city' OR (c{i} = 'region_text' AND NOT {prov} AND {city}))"
            elif d == "district":
                cond = (f"((c{i} = 'district' AND NOT {prov}) OR "
                        f"(c{i} = 'region_text' AND NOT {prov} AND NOT {city} AND {dist}))")
            else:
                cond = f"c{i} = '{d}'"
            cols.append(f"CASE WHEN {ok} AND {cond} AND {empty(d)} THEN {t} ELSE d_{d} END AS d_{d}")
        keep = "o_orderkey, n_nationkey, n_name, r_name, o_orderpriority"
        ctes.append(f"s{i} AS (SELECT {keep}, " + ", ".join(cols) + f" FROM {step_in})")
        prev = f"s{i}"
    return ("WITH " + ",\n".join(ctes) + "\nSELECT o_orderkey, "
            + ", ".join(f"d_{d} AS {d}" for d in dims) + f" FROM {prev}")


QUERIES = {
    "enum_decode": q_enum_decode,
    "enrich_chain": q_enrich_chain,
    "id_list_enrich": q_id_list_enrich,
    "option_flatten": q_option_flatten,
    "option_decode": q_option_decode,
    "zip_arrays": q_zip_arrays,
    "dimension_extract": q_dimension_extract,
    "ticket_main_row": q_ticket_main_row,
    "since_filter": q_since_filter,
    "text_dates": q_text_dates,
}

SQL = {
    "dimension_extract": _dimension_sql(),
    "enum_decode": _ENUM_SQL,
    "enrich_chain": _ENRICH_SQL,
    "id_list_enrich": _IDLIST_SQL,
    "option_flatten": _OPTFLAT_SQL,
    "option_decode": _OPTDEC_SQL,
    "zip_arrays": _ZIP_SQL,
    "ticket_main_row": _MAIN_SQL,
    "since_filter": _SINCE_SQL,
    "text_dates": _DATES_SQL,
}
