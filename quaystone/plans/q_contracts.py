"""Registered queries: contract-source merge operators on lineitem / part / orders / customer."""

from __future__ import annotations

from pyspark.sql import functions as F

from quaystone.functions.dates import contract_date, snapshot_date_text
from quaystone.functions.numbers import parse_decimal_text, parse_int_text, parse_number
from quaystone.functions.text import strip_all
from quaystone.operators import contracts as C
from quaystone.plans.tables import supplier_platform, table

# -- money_parse (P12, P21) ---------------------------------------------------


def _money_text(li):
    price = F.col("l_extendedprice").cast("decimal(18,2)").cast("string")
    pct = F.concat(F.round(F.col("l_discount") * 100, 0).cast("int").cast("string"), F.lit("%"))
    return (F.when((F.col("l_returnflag") == "R") & (F.col("l_linestatus") == "O"), F.format_number("l_extendedprice", 2))
            .when((F.col("l_returnflag") == "N") & (F.col("l_linestatus") == "O"), pct)
            .when((F.col("l_returnflag") == "N") & (F.col("l_linestatus") == "F"),
                  F.regexp_replace(F.format_number("l_extendedprice", 2), ",", "，"))
            .when((F.col("l_returnflag") == "A") & (F.col("l_linestatus") == "F"), F.lit("/"))
            .when((F.col("l_returnflag") == "R") & (F.col("l_linestatus") == "F"), F.lit("n/a"))
            .otherwise(F.concat(F.lit(" "), price, F.lit(" "))))


def q_money_parse(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    raw = li.select("l_orderkey", "l_linenumber", _money_text(li).alias("raw_text"),
                    F.concat(F.round(F.col("l_discount") * 100, 0).cast("int").cast("string"), F.lit("%")).alias("ratio_text"))
    return raw.select("l_orderkey", "l_linenumber", "raw_text",
                      parse_number("raw_text").alias("parsed"),
                      C.shared_amount(F.col("raw_text"), F.col("ratio_text")).alias("shared_amount"))


_MONEY_SQL = r"""
WITH raw AS (
  SELECT l_orderkey, l_linenumber,
    CASE WHEN l_returnflag = 'R' AND l_linestatus = 'O' THEN format('{:,.2f}', l_extendedprice)
         WHEN l_returnflag = 'N' AND l_linestatus = 'O' THEN CAST(CAST(round(l_discount * 100, 0) AS INTEGER) AS VARCHAR) || '%'
         WHEN l_returnflag = 'N' AND l_linestatus = 'F' THEN replace(format('{:,.2f}', l_extendedprice), ',', '，')
         WHEN l_returnflag = 'A' AND l_linestatus = 'F' THEN '/'
         WHEN l_returnflag = 'R' AND l_linestatus = 'F' THEN 'n/a'
         ELSE ' ' || CAST(CAST(l_extendedprice AS DECIMAL(18,2)) AS VARCHAR) || ' ' END AS raw_text,
    CAST(CAST(round(l_discount * 100, 0) AS INTEGER) AS VARCHAR) || '%' AS ratio_text
  FROM lineitem),
p AS (
  SELECT *,
    trim(raw_text) AS t1, regexp_replace(regexp_replace(trim(raw_text), '[,，]', '', 'g'), '%+$', '') AS d1,
    trim(ratio_text) AS t2, regexp_replace(regexp_replace(trim(ratio_text), '[,，]', '', 'g'), '%+$', '') AS d2
  FROM raw),
v AS (
  SELECT *,
    COALESCE(CASE WHEN regexp_matches(d1, '^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$') THEN TRY_CAST(d1 AS DOUBLE) ELSE 0.0 END, 0.0) AS v1,
    COALESCE(CASE WHEN regexp_matches(d2, '^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$') THEN TRY_CAST(d2 AS DOUBLE) ELSE 0.0 END, 0.0) AS v2
  FROM p)
SELECT l_orderkey, l_linenumber, raw_text,
  CASE WHEN ends_with(t1, '%') THEN v1 / 100.0 ELSE v1 END AS parsed,
  (CASE WHEN ends_with(t1, '%') THEN v1 / 100.0 ELSE v1 END) * (CASE WHEN ends_with(t2, '%') THEN v2 / 100.0 ELSE v2 END) AS shared_amount
FROM v"""

# -- typed_convert (P13a, P14, P15) ---------------------------------------------


def q_typed_convert(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    d = F.col("o_orderdate")
    date_text = (F.when(F.col("o_orderstatus") == "F", F.date_format(d, "yyyyMMdd"))
                 .when(F.col("o_orderstatus") == "O", F.date_format(d, "yyyy/MM/dd"))
                 .when(F.col("o_orderpriority") == "1-URGENT", F.lit("/"))
                 .when(F.col("o_orderpriority") == "2-HIGH", F.lit("0000-12-30"))
                 .when(F.col("o_orderpriority") == "3-MEDIUM", F.lit("2026-02-30"))
                 .otherwise(F.date_format(d, "yyyy-MM-dd HH:mm:ss")))
    int_text = F.concat(F.col("o_custkey").cast("string"), F.lit(".0"))
    money_text = F.when(F.col("o_orderstatus") == "P", F.format_number("o_totalprice", 2)) \
        .otherwise(F.col("o_totalprice").cast("decimal(18,2)").cast("string"))
    stamp = F.concat(F.date_format(d, "yyyyMMdd"), F.lit("165231"))
    raw = o.select("o_orderkey", date_text.alias("date_text"), int_text.alias("int_text"),
                   money_text.alias("money_text"), stamp.alias("stamp_text"))
    return raw.select("o_orderkey", "date_text",
                      contract_date("date_text").alias("apply_date"),
                      parse_int_text("int_text").alias("free_ops_months"),
                      parse_decimal_text("money_text").cast("decimal(18,2)").alias("total_amount"),
                      snapshot_date_text("stamp_text").alias("create_date"))


_TYPED_SQL = r"""
WITH raw AS (
  SELECT o_orderkey,
    CASE WHEN o_orderstatus = 'F' THEN strftime(o_orderdate, '%Y%m%d')
         WHEN o_orderstatus = 'O' THEN strftime(o_orderdate, '%Y/%m/%d')
         WHEN o_orderpriority = '1-URGENT' THEN '/'
         WHEN o_orderpriority = '2-HIGH' THEN '0000-12-30'
         WHEN o_orderpriority = '3-MEDIUM' THEN '2026-02-30'
         ELSE strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') END AS date_text,
    CAST(o_custkey AS VARCHAR) || '.0' AS int_text,
    CASE WHEN o_orderstatus = 'P' THEN format('{:,.2f}', o_totalprice)
         ELSE CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR) END AS money_text,
    strftime(o_orderdate, '%Y%m%d') || '165231' AS stamp_text
  FROM orders),
t AS (SELECT *, trim(date_text) AS s, replace(trim(date_text), '/', '-') AS iso FROM raw)
SELECT o_orderkey, date_text,
  CASE WHEN s = '' OR s IN ('/', '-', '0', '0.0', '0000-00-00', '0000-12-30') THEN NULL
       WHEN regexp_full_match(s, '\d{8}') THEN CAST(try_strptime(s, '%Y%m%d') AS DATE)
       WHEN regexp_full_match(iso, '\d{4}-\d{2}-\d{2}([ T]\d{2}:\d{2}(:\d{2}(\.\d{1,6})?)?)?') THEN TRY_CAST(substr(iso, 1, 10) AS DATE)
  END AS apply_date,
  CAST(CAST(TRY_CAST(trim(int_text) AS DOUBLE) AS BIGINT) AS INTEGER) AS free_ops_months,
  CAST(TRY_CAST(replace(trim(money_text), ',', '') AS DOUBLE) AS DECIMAL(18,2)) AS total_amount,
  substr(trim(stamp_text), 1, 8) AS create_date
FROM t"""

# -- rule_projection (P20-P24) ---------------------------------------------------

RULE_OUTPUT = ["合同编号", "合同类型", "暂估运维运营", "虚拟合同", "业务类型", "合同分类", "营销平台",
               "累计开票金额", "去年同期收入金额", "备注", "合同总金额"]
RULES = {
    "合同编号": "合同编号",
    "合同类型": "按是否标准合同：统签散开合同保留，其余为普通销售合同",
    "暂估运维运营": "是否标准合同=运维收入暂估合同 为是",
    "虚拟合同": "是否标准合同=虚拟销售合同 为是",
    "业务类型": "按核算收入类型分组映射",
    "合同分类": "按合同类型映射",
    "营销平台": "营销平台旧",
    "累计开票金额": "累计开票金额 x 分成比例",
    "去年同期收入金额": "累计收入金额-去年同期 x 分成比例",
    "备注": "/",
    "合同总金额": "旧ERP数据源统一为0",
}
RULE_CONFIG = {
    "营销平台映射": {"Brand#1": "Brand#2", "Brand#3": "Brand#4", "Brand#5": "Brand#4"},
    "金额换算": {"乘数因子字段": "分成比例", "累计开票金额原字段": "累计开票金额",
                 "去年收入基数字段": "累计收入金额-去年同期", "累计回款金额原字段": "累计回款金额"},
}


def _old_source(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    p = table(spark, sf_dir, "part").select("p_partkey", "p_type", "p_brand")
    j = li.join(p, li.l_partkey == p.p_partkey, "left")
    return j.select(
        F.concat_ws("-", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string")).alias("合同编号"),
        F.when(F.col("l_returnflag") == "A", "统签散开合同").when(F.col("l_returnflag") == "R", "运维收入暂估合同")
        .otherwise("虚拟销售合同").alias("是否标准合同"),
        F.when(F.col("p_type") == "MEDIUM", "运维服务").when(F.col("p_type") == "STANDARD", "实施服务")
        .when(F.col("p_type") == "LARGE", "SaaS及运营服务").when(F.col("p_type") == "PROMO", "软件销售")
        .when(F.col("p_type") == "SMALL", "硬件及耗材销售").otherwise(F.col("p_type")).alias("核算收入类型分组"),
        F.when(F.col("l_linestatus") == "O", "运维合同").otherwise("实施合同").alias("合同类型"),
        F.concat(F.lit(" "), F.col("p_brand")).alias("营销平台旧"),
        F.format_number("l_extendedprice", 2).alias("累计开票金额"),
        F.col("l_tax").cast("decimal(18,2)").cast("string").alias("累计收入金额-去年同期"),
        F.concat(F.round(F.col("l_discount") * 100, 0).cast("int").cast("string"), F.lit("%")).alias("分成比例"),
    )


def q_rule_projection(spark, sf_dir):
    old = _old_source(spark, sf_dir)
    return C.convert_old_to_new(old, RULE_OUTPUT, RULES, RULE_CONFIG)


_RULE_SQL = r"""
WITH old AS (
  SELECT CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) AS c_no,
    CASE WHEN l_returnflag = 'A' THEN '统签散开合同' WHEN l_returnflag = 'R' THEN '运维收入暂估合同' ELSE '虚拟销售合同' END AS std,
    CASE p_type WHEN 'MEDIUM' THEN '运维服务' WHEN 'STANDARD' THEN '实施服务' WHEN 'LARGE' THEN 'SaaS及运营服务'
      WHEN 'PROMO' THEN '软件销售' WHEN 'SMALL' THEN '硬件及耗材销售' ELSE p_type END AS grp,
    CASE WHEN l_linestatus = 'O' THEN '运维合同' ELSE '实施合同' END AS kind,
    trim(' ' || p_brand) AS plat,
    CAST(replace(format('{:,.2f}', l_extendedprice), ',', '') AS DOUBLE) AS billing,
    CAST(CAST(l_tax AS DECIMAL(18,2)) AS DOUBLE) AS prev_income,
    CAST(round(l_discount * 100, 0) AS INTEGER) / 100.0 AS ratio
  FROM lineitem LEFT JOIN part ON l_partkey = p_partkey)
SELECT c_no AS "合同编号",
  CASE WHEN std = '统签散开合同' THEN std ELSE '普通销售合同' END AS "合同类型",
  CASE WHEN std = '运维收入暂估合同' THEN '是' ELSE '否' END AS "暂估运维运营",
  CASE WHEN std = '虚拟销售合同' THEN '是' ELSE '否' END AS "虚拟合同",
  CASE grp WHEN '运维服务' THEN '运维服务费' WHEN '实施服务' THEN '实施服务费' WHEN 'SaaS及运营服务' THEN 'SAAS运营服务'
    WHEN '软件销售' THEN '软件产品' WHEN '硬件及耗材销售' THEN '其他硬件销售' WHEN '定制软件开发' THEN '开发服务费' ELSE '其他' END AS "业务类型",
  CASE kind WHEN '运维合同' THEN '运维合同' WHEN '实施合同' THEN '非运维合同' ELSE '/' END AS "合同分类",
  CASE plat WHEN 'Brand#1' THEN 'Brand#2' WHEN 'Brand#3' THEN 'Brand#4' WHEN 'Brand#5' THEN 'Brand#4' ELSE plat END AS "营销平台",
  billing * ratio AS "累计开票金额",
  prev_income * ratio AS "去年同期收入金额",
  '/' AS "备注", 0 AS "合同总金额"
FROM old"""

# -- anti_join_sources (J1, U1) ------------------------------------------------


def _split_sources(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    line_id = F.concat_ws("-", F.col("l_partkey").cast("string"), F.col("l_suppkey").cast("string"))
    new = li.where(F.col("l_returnflag") == "N").select(
        "l_orderkey", "l_linenumber",
        F.when(F.col("l_linenumber") == 1, F.lit("")).otherwise(line_id).alias(C.NEW_LINE_KEY))
    old = li.where(F.col("l_returnflag") != "N").select(
        "l_orderkey", "l_linenumber",
        F.when(F.col("l_linenumber") == 7, F.lit(" ")).otherwise(F.concat(F.lit(" "), line_id)).alias(C.OLD_LINE_KEY))
    return old, new


def q_anti_join_sources(spark, sf_dir):
    old, new = _split_sources(spark, sf_dir)
    kept = C.remove_old_rows_existing_in_new(old, new)
    return (new.select("l_orderkey", "l_linenumber", F.lit(C.NEW_SOURCE_LABEL).alias(C.SOURCE_COLUMN))
            .unionByName(kept.select("l_orderkey", "l_linenumber", F.lit(C.OLD_SOURCE_LABEL).alias(C.SOURCE_COLUMN))))


_ANTI_SQL = """
WITH new AS (
  SELECT l_orderkey, l_linenumber,
    CASE WHEN l_linenumber = 1 THEN '' ELSE CAST(l_partkey AS VARCHAR) || '-' || CAST(l_suppkey AS VARCHAR) END AS k
  FROM lineitem WHERE l_returnflag = 'N'),
old AS (
  SELECT l_orderkey, l_linenumber,
    CASE WHEN l_linenumber = 7 THEN ' ' ELSE ' ' || CAST(l_partkey AS VARCHAR) || '-' || CAST(l_suppkey AS VARCHAR) END AS k
  FROM lineitem WHERE l_returnflag <> 'N')
SELECT l_orderkey, l_linenumber, '新ERP' AS "数据来源" FROM new
UNION ALL
SELECT l_orderkey, l_linenumber, '旧ERP' AS "数据来源" FROM old
WHERE trim(k) NOT IN (SELECT trim(k) FROM new WHERE trim(k) <> '')"""

# -- dedup_keep_last (W1), dedup_keep_first (W2, U3), renumber (W3) ------------


def q_dedup_keep_last(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    rows = li.select(
        F.col("l_orderkey").cast("string").alias("contract_id"),
        F.col("l_linenumber").cast("string").alias("item_code"),
        F.when((F.col("l_returnflag") == "R") & (F.col("l_linestatus") == "O"), F.lit(None).cast("string"))
        .when((F.col("l_returnflag") == "A") & (F.col("l_linestatus") == "F"), F.lit(" "))
        .otherwise(F.lit("D")).alias("exec_detail_id"),
        "l_shipdate", "l_partkey", "l_suppkey", "l_extendedprice")
    # (l_shipdate, l_partkey, l_suppkey) is unique within a (contract, item) key here
    out = C.dedup_keep_last(rows, ["contract_id", "item_code", "exec_detail_id"],
                            ["l_shipdate", "l_partkey", "l_suppkey"])
    return out


_DEDUP_LAST_SQL = """
WITH rows AS (
  SELECT CAST(l_orderkey AS VARCHAR) AS contract_id, CAST(l_linenumber AS VARCHAR) AS item_code,
    CASE WHEN l_returnflag = 'R' AND l_linestatus = 'O' THEN NULL
         WHEN l_returnflag = 'A' AND l_linestatus = 'F' THEN ' ' ELSE 'D' END AS exec_detail_id,
    l_shipdate, l_partkey, l_suppkey, l_extendedprice
  FROM lineitem),
r AS (
  SELECT *,
    COALESCE(trim(contract_id), '') <> '' AND COALESCE(trim(item_code), '') <> '' AND COALESCE(trim(exec_detail_id), '') <> '' AS complete,
    row_number() OVER (PARTITION BY COALESCE(trim(contract_id), ''), COALESCE(trim(item_code), ''), COALESCE(trim(exec_detail_id), '')
                       ORDER BY l_shipdate DESC, l_partkey DESC, l_suppkey DESC) AS rn
  FROM rows)
SELECT contract_id, item_code, exec_detail_id, l_shipdate, l_partkey, l_suppkey, l_extendedprice
FROM r WHERE rn = 1 OR NOT complete"""


def q_dedup_keep_first(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    src = li.select(F.when(F.col("l_linestatus") == "F", 1).otherwise(2).alias("source_rank"),
                    F.col("l_suppkey").cast("string").alias("entity_id"),
                    "l_shipdate", "l_partkey", "l_orderkey", "l_linenumber")
    return C.keep_first(src, "entity_id", ["source_rank", "l_shipdate", "l_partkey", "l_orderkey", "l_linenumber"])


_DEDUP_FIRST_SQL = """
WITH src AS (
  SELECT CASE WHEN l_linestatus = 'F' THEN 1 ELSE 2 END AS source_rank, CAST(l_suppkey AS VARCHAR) AS entity_id,
         l_shipdate, l_partkey, l_orderkey, l_linenumber FROM lineitem),
r AS (SELECT *, row_number() OVER (PARTITION BY trim(entity_id)
        ORDER BY source_rank, l_shipdate, l_partkey, l_orderkey, l_linenumber) AS rn
      FROM src WHERE COALESCE(trim(entity_id), '') <> '')
SELECT source_rank, entity_id, l_shipdate, l_partkey, l_orderkey, l_linenumber FROM r WHERE rn = 1"""


def q_renumber(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    return C.renumber(o, ["o_orderdate", "o_orderkey"], "seq_no").select("o_orderkey", "seq_no")


_RENUMBER_SQL = """
SELECT o_orderkey, row_number() OVER (ORDER BY o_orderdate, o_orderkey) AS seq_no FROM orders"""

# -- invalid_drop_defaults (P18, P19) ---------------------------------------------


def q_invalid_drop_defaults(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    rows = li.select(
        F.when((F.col("l_returnflag") == "N") & (F.col("l_linestatus") == "O"), F.lit(" / "))
        .when((F.col("l_returnflag") == "A") & (F.col("l_linenumber") == 3), F.lit(""))
        .otherwise(F.col("l_orderkey").cast("string")).alias("合同编号"),
        "l_linenumber",
        F.when(F.col("l_linestatus") == "F", F.lit(" ")).otherwise(F.lit("增值税票据")).alias("其他业务类型"),
        F.when(F.col("l_returnflag") == "R", F.lit(None).cast("string")).otherwise(F.lit("无效")).alias("无效合同类型"))
    return C.fill_defaults(C.drop_invalid_contracts(rows))


_INVALID_SQL = """
WITH rows AS (
  SELECT CASE WHEN l_returnflag = 'N' AND l_linestatus = 'O' THEN ' / '
              WHEN l_returnflag = 'A' AND l_linenumber = 3 THEN ''
              ELSE CAST(l_orderkey AS VARCHAR) END AS c_no, l_linenumber,
         CASE WHEN l_linestatus = 'F' THEN ' ' ELSE '增值税票据' END AS other,
         CASE WHEN l_returnflag = 'R' THEN NULL ELSE '无效' END AS invalid
  FROM lineitem)
SELECT c_no AS "合同编号", l_linenumber,
  CASE WHEN COALESCE(trim(other), '') = '' THEN '非税票据' ELSE trim(other) END AS "其他业务类型",
  CASE WHEN COALESCE(trim(invalid), '') = '' THEN '有效' ELSE trim(invalid) END AS "无效合同类型"
FROM rows WHERE COALESCE(trim(c_no), '') NOT IN ('', '/')"""

# -- total_row_drop (P17), header_detect (S4) -------------------------------------


def q_total_row_drop(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    rows = o.select(
        F.col("o_orderkey").cast("string").alias("k"),
        F.when((F.col("o_orderstatus") == "P") & (F.col("o_orderpriority") == "1-URGENT"), F.lit(" 合计："))
        .when((F.col("o_orderstatus") == "F") & (F.col("o_orderpriority") == "1-URGENT"), F.lit("合计::"))
        .when(F.col("o_orderpriority") == "5-LOW", F.lit(None).cast("string"))
        .when(F.col("o_orderpriority") == "2-HIGH", F.lit("小计"))
        .otherwise(F.col("o_orderpriority")).alias("label"),
        F.col("o_orderstatus").alias("status"))
    return C.drop_total_rows(rows)


_TOTAL_SQL = """
WITH rows AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS k,
    CASE WHEN o_orderstatus = 'P' AND o_orderpriority = '1-URGENT' THEN ' 合计：'
         WHEN o_orderstatus = 'F' AND o_orderpriority = '1-URGENT' THEN '合计::'
         WHEN o_orderpriority = '5-LOW' THEN NULL
         WHEN o_orderpriority = '2-HIGH' THEN '小计'
         ELSE o_orderpriority END AS label,
    o_orderstatus AS status FROM orders)
SELECT * FROM rows
WHERE NOT COALESCE(rtrim(trim(label), ':：') = '合计', false)
  AND NOT COALESCE(rtrim(trim(k), ':：') = '合计', false)
  AND NOT COALESCE(rtrim(trim(status), ':：') = '合计', false)"""

HEADER = ["客户编号", "客户名称", "国家", "余额", "行业"]


def customer_cells(spark, sf_dir):
    c = table(spark, sf_dir, "customer")
    data = c.select((F.col("c_custkey") + 2).cast("long").alias("row_no"),
                    F.array(F.col("c_custkey").cast("string"), F.col("c_name"), F.col("c_nationkey").cast("string"),
                            F.col("c_acctbal").cast("decimal(18,2)").cast("string"), F.col("c_mktsegment")).alias("cells"))
    note = spark.range(1).select(F.lit(0).cast("long").alias("row_no"),
                                 F.array(F.lit("导出说明"), F.lit(""), F.lit(""), F.lit(""), F.lit("")).alias("cells"))
    header = spark.range(1).select(F.lit(1).cast("long").alias("row_no"),
                                   F.array(*[F.lit(f" {h} ") for h in HEADER], F.lit("")).alias("cells"))
    total = c.agg((F.max("c_custkey") + 3).cast("long").alias("row_no")).select(
        "row_no", F.array(F.lit(""), F.lit(""), F.lit(""), F.lit(""), F.lit("合计：")).alias("cells"))
    return note.unionByName(header).unionByName(data).unionByName(total)


def q_header_detect(spark, sf_dir):
    return C.read_cells(customer_cells(spark, sf_dir), ["客户编号", "客户名称"], max_rows=10)


_HEADER_SQL = """
SELECT CAST(c_custkey + 2 AS BIGINT) AS row_no, CAST(c_custkey AS VARCHAR) AS "客户编号", c_name AS "客户名称",
       CAST(c_nationkey AS VARCHAR) AS "国家", CAST(CAST(c_acctbal AS DECIMAL(18,2)) AS VARCHAR) AS "余额",
       c_mktsegment AS "行业"
FROM customer"""

# -- map_platform (J12), baseline_override (J10, J11) ---------------------------------

PLATFORM_MAP = {"NATION_1": "NATION_2", "NATION_3": "NATION_4", "NATION_5": "NATION_4"}
ENGINEER_MAP = {"NATION_0": "ENG-A", "NATION_2": "ENG-B", "NATION_4": "ENG-C", "NATION_6": "ENG-A"}


def q_map_platform(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_suppkey")
    plat = supplier_platform(spark, sf_dir)
    rows = li.join(plat, li.l_suppkey == plat.s_suppkey, "left").drop("s_suppkey")
    rows = C.map_platform(rows, "sales_platform", C.map_table(spark, PLATFORM_MAP, "from", "to"))
    return C.add_engineer(rows, "sales_platform", C.map_table(spark, ENGINEER_MAP, "p", "e"), "system_engineer") \
        .select("l_orderkey", "l_linenumber", "sales_platform", "system_engineer")


def _case_map(expr, mapping, default):
    parts = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in mapping.items())
    return f"CASE {expr} {parts} ELSE {default} END"


_MAP_SQL = f"""
WITH r AS (
  SELECT l_orderkey, l_linenumber, COALESCE(trim(n_name), '') AS p0
  FROM lineitem LEFT JOIN supplier ON l_suppkey = s_suppkey LEFT JOIN nation ON s_nationkey = n_nationkey),
m AS (SELECT l_orderkey, l_linenumber, {_case_map('p0', PLATFORM_MAP, 'p0')} AS sales_platform FROM r)
SELECT l_orderkey, l_linenumber, sales_platform,
  {_case_map('COALESCE(trim(sales_platform), \'\')', ENGINEER_MAP, "''")} AS system_engineer
FROM m"""


def q_baseline_override(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    plat = supplier_platform(spark, sf_dir)
    item = F.when(F.col("l_returnflag") == "N", F.lit(None).cast("string")).otherwise(F.col("l_partkey").cast("string"))
    base = (li.where(F.col("l_linestatus") == "F")
            .join(plat, li.l_suppkey == plat.s_suppkey, "left")
            .select(F.col("l_orderkey").cast("string").alias("contract_id"), item.alias("item_code"),
                    F.lit(None).cast("string").alias("exec_detail_id"), "sales_platform")
            .groupBy("contract_id", "item_code", "exec_detail_id").agg(F.max("sales_platform").alias("sales_platform")))
    cur = li.where(F.col("l_linestatus") == "O").select(
        "l_orderkey", "l_linenumber",
        F.col("l_orderkey").cast("string").alias("contract_id"), item.alias("item_code"),
        F.lit(None).cast("string").alias("exec_detail_id"),
        F.concat(F.lit("NEW-"), F.col("l_returnflag")).alias("sales_platform"),
        F.lit("KEEP").alias("system_engineer"),
        F.date_format("l_shipdate", "yyyyMMdd").alias("create_date"))
    out = C.apply_baseline_platform(cur, base, ["contract_id", "item_code", "exec_detail_id"],
                                    baseline_date="19980101")
    out = C.apply_engineer_override(out, C.map_table(spark, ENGINEER_MAP, "p", "e"))
    return out.select("l_orderkey", "l_linenumber", "sales_platform", "system_engineer",
                      "reused_baseline", "mapped_engineer")


_BASELINE_SQL = f"""
WITH base AS (
  SELECT CAST(l_orderkey AS VARCHAR) AS contract_id,
         CASE WHEN l_returnflag = 'N' THEN NULL ELSE CAST(l_partkey AS VARCHAR) END AS item_code,
         CAST(NULL AS VARCHAR) AS exec_detail_id, max(n_name) AS sales_platform
  FROM lineitem LEFT JOIN supplier ON l_suppkey = s_suppkey LEFT JOIN nation ON s_nationkey = n_nationkey
  WHERE l_linestatus = 'F' GROUP BY ALL),
cur AS (
  SELECT l_orderkey, l_linenumber, CAST(l_orderkey AS VARCHAR) AS contract_id,
         CASE WHEN l_returnflag = 'N' THEN NULL ELSE CAST(l_partkey AS VARCHAR) END AS item_code,
         CAST(NULL AS VARCHAR) AS exec_detail_id, 'NEW-' || l_returnflag AS sales_platform,
         'KEEP' AS system_engineer, strftime(l_shipdate, '%Y%m%d') AS create_date
  FROM lineitem WHERE l_linestatus = 'O'),
j AS (
  SELECT c.*, b.sales_platform AS b_platform, b.contract_id IS NOT NULL AND c.create_date <> '19980101' AS hit
  FROM cur c LEFT JOIN base b ON c.contract_id IS NOT DISTINCT FROM b.contract_id
    AND c.item_code IS NOT DISTINCT FROM b.item_code AND c.exec_detail_id IS NOT DISTINCT FROM b.exec_detail_id),
f AS (SELECT l_orderkey, l_linenumber, CASE WHEN hit THEN b_platform ELSE sales_platform END AS sales_platform,
             system_engineer, hit AS reused_baseline FROM j)
SELECT l_orderkey, l_linenumber, sales_platform,
  {_case_map('sales_platform', ENGINEER_MAP, 'system_engineer')} AS system_engineer, reused_baseline,
  {_case_map('sales_platform', ENGINEER_MAP, 'NULL')} IS NOT NULL AS mapped_engineer
FROM f"""

QUERIES = {
    "money_parse": q_money_parse,
    "typed_convert": q_typed_convert,
    "rule_projection": q_rule_projection,
    "anti_join_sources": q_anti_join_sources,
    "dedup_keep_last": q_dedup_keep_last,
    "dedup_keep_first": q_dedup_keep_first,
    "renumber": q_renumber,
    "invalid_drop_defaults": q_invalid_drop_defaults,
    "total_row_drop": q_total_row_drop,
    "header_detect": q_header_detect,
    "map_platform": q_map_platform,
    "baseline_override": q_baseline_override,
}

SQL = {
    "money_parse": _MONEY_SQL,
    "typed_convert": _TYPED_SQL,
    "rule_projection": _RULE_SQL,
    "anti_join_sources": _ANTI_SQL,
    "dedup_keep_last": _DEDUP_LAST_SQL,
    "dedup_keep_first": _DEDUP_FIRST_SQL,
    "renumber": _RENUMBER_SQL,
    "invalid_drop_defaults": _INVALID_SQL,
    "total_row_drop": _TOTAL_SQL,
    "header_detect": _HEADER_SQL,
    "map_platform": _MAP_SQL,
    "baseline_override": _BASELINE_SQL,
}
