"""Registered end-to-end jobs on the driver's tables (composites of checked operators)."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import functions as F

from quaystone.functions.codes import ANALYTIC_FIELD_KEYWORDS
from quaystone.operators import contracts as C
from quaystone.operators import history as H
from quaystone.operators import tickets as T
from quaystone.operators.entities import CUSTOMER_CANDIDATES
from quaystone.plans import jobs as J
from quaystone.sources import layout as L
from quaystone.plans.tables import CURRENT_PERIOD, PRIOR_PERIOD, scratch_path, table

NEW_HEADER = ["合同编号", "销售组织", "签约客户", "标的行编码", "执行明细id", "企业版销售合同明细id", "营销平台",
              "明细运维开始开始日期", "明细运维结束日期", "产品金额", "合同申请日期", "当年应分摊金额", "去年同期应分摊金额", "备注"]
OLD_HEADER = ["合同编号", "签署公司", "合同分录ID", "执行明细id", "是否标准合同", "核算收入类型分组", "合同类型", "营销平台旧",
              "累计开票金额", "累计回款金额", "累计收入金额-去年同期", "分成比例", "运维开始", "运维结束", "产品金额旧",
              "当年原始分摊", "去年原始分摊", "汇总标记"]
MERGE_RULES = {
    "序号": "/", "合同编号": "合同编号", "销售组织": "签署公司", "签约客户": "/", "标的行编码": "合同分录ID",
    "执行明细id": "执行明细id", "企业版销售合同明细id": "合同分录ID",
    "合同类型": "是否标准合同：统签散开合同保留，其余普通销售合同", "暂估运维运营": "是否标准合同=运维收入暂估合同",
    "虚拟合同": "是否标准合同=虚拟销售合同", "业务类型": "按核算收入类型分组", "合同分类": "按合同类型", "营销平台": "营销平台旧",
    "累计开票金额": "x 分成比例", "累计回款金额": "x 分成比例", "去年同期收入金额": "x 分成比例",
    "明细运维开始开始日期": "运维开始", "明细运维结束日期": "运维结束", "产品金额": "产品金额旧", "合同申请日期": "/",
    "当年应分摊金额": "当年原始分摊", "去年同期应分摊金额": "去年原始分摊", "合同总金额": C.ZERO_RULE,
}
MERGE_CONFIG = {
    "营销平台映射": {"NATION_1": "NATION_2", "NATION_3": "NATION_4"},
    "金额换算": {"乘数因子字段": "分成比例", "累计开票金额原字段": "累计开票金额", "累计回款金额原字段": "累计回款金额",
                 "去年收入基数字段": "累计收入金额-去年同期"},
}
ENGINEERS = {"NATION_0": "ENG-A", "NATION_2": "ENG-B", "NATION_4": "ENG-C"}


def _cells(df, header, note_rows: int, row_key):
    """Raw sheet rows: ``note_rows`` note lines, the header, then the data rows (row_no after the header)."""
    spark = df.sparkSession
    notes = spark.range(note_rows).select(F.col("id").cast("decimal(38,0)").alias("row_no"),
                                          F.array(F.lit("导出说明"), *[F.lit("") for _ in header[1:]]).alias("cells"))
    head = spark.range(1).select(F.lit(note_rows).cast("decimal(38,0)").alias("row_no"),
                                 F.array(*[F.lit(h) for h in header]).alias("cells"))
    data = df.select((F.lit(note_rows + 1).cast("decimal(38,0)") + row_key).cast("decimal(38,0)").alias("row_no"), "cells")
    return notes.unionByName(head).unionByName(data)


def merge_sources(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    p = table(spark, sf_dir, "part").select("p_partkey", "p_type")
    s = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    n = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    j = li.join(p, li.l_partkey == p.p_partkey, "left").join(s, li.l_suppkey == s.s_suppkey, "left") \
        .join(n, F.col("s_nationkey") == n.n_nationkey, "left")
    line_id = F.concat_ws("-", F.col("l_partkey").cast("string"), F.col("l_suppkey").cast("string"))
    start = F.date_format("l_shipdate", "yyyyMMdd")
    end = F.date_format(F.date_add(F.col("l_shipdate").cast("date"), (F.col("l_quantity") * 7).cast("int")), "yyyy-MM-dd")
    # a unique row number per line: (order, line, part, supplier, ship day) packed into 33 digits
    d38 = "decimal(38,0)"
    row_key = (F.col("l_orderkey").cast(d38) * F.lit(str(10 ** 23)).cast(d38)
               + F.col("l_linenumber").cast(d38) * F.lit(str(10 ** 22)).cast(d38)
               + F.col("l_partkey").cast(d38) * F.lit(str(10 ** 13)).cast(d38)
               + F.col("l_suppkey").cast(d38) * F.lit(str(10 ** 5)).cast(d38)
               + F.unix_date(F.col("l_shipdate").cast("date")).cast(d38))
    new_rows = j.where(F.col("l_returnflag") == "N").select(row_key.alias("k"), F.array(
        F.col("l_orderkey").cast("string"), F.lit("ORG"), F.lit("CUST"), F.col("l_linenumber").cast("string"), F.lit("D"),
        line_id, F.col("n_name"), start, end, F.format_number("l_extendedprice", 2),
        F.date_format("l_shipdate", "yyyy-MM-dd"), F.lit("111"), F.lit("222"), F.lit("")).alias("cells"))
    old_rows = j.where(F.col("l_returnflag") != "N").select(row_key.alias("k"), F.array(
        F.col("l_orderkey").cast("string"), F.lit("ORG-OLD"), line_id, F.lit("D"),
        F.when(F.col("l_returnflag") == "A", "统签散开合同").otherwise("运维收入暂估合同"),
        F.when(F.col("p_type") == "MEDIUM", "运维服务").otherwise(F.col("p_type")),
        F.when(F.col("l_linestatus") == "O", "运维合同").otherwise("实施合同"),
        F.col("n_name"), F.format_number("l_extendedprice", 2), F.col("l_extendedprice").cast("decimal(18,2)").cast("string"),
        F.lit("/"), F.concat(F.round(F.col("l_discount") * 100, 0).cast("int").cast("string"), F.lit("%")),
        start, end, F.col("l_extendedprice").cast("decimal(18,2)").cast("string"), F.lit("1"), F.lit("2"),
        F.lit("")).alias("cells"))
    new_cells = _cells(new_rows, NEW_HEADER, 1, F.col("k"))
    old_cells = _cells(old_rows, OLD_HEADER, 3, F.col("k"))
    spark_maps = (C.map_table(spark, MERGE_CONFIG["营销平台映射"], "from", "to"),
                  C.map_table(spark, ENGINEERS, "p", "e"))
    merged = J.merge_contract_sources(new_cells, old_cells, list(MERGE_RULES), MERGE_RULES, MERGE_CONFIG,
                                      _dt.datetime(2026, 7, 15, 8, 30, 0),
                                      ["新ERP明细_2026-7-15.xlsx", "旧ERP明细_2026-7-1.xlsx"], *spark_maps)
    return merged


def q_merge_contract_sources(spark, sf_dir):
    merged = merge_sources(spark, sf_dir)
    return J.standard_sheet(merged, PRIOR_PERIOD, CURRENT_PERIOD)


def ticket_details(spark, sf_dir):
    """orders as ticket details (API keys as text, custom fields from the customer's nation/region)."""
    o = table(spark, sf_dir, "orders")
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    n = table(spark, sf_dir, "nation")
    r = table(spark, sf_dir, "region")
    li = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("l_linenumber", "l_suppkey", "l_partkey"))),
                                 lambda x: x["l_suppkey"].cast("string")), ",").alias("cc"))
    j = o.join(c, o.o_custkey == c.c_custkey, "left").join(n, F.col("c_nationkey") == n.n_nationkey, "left") \
        .join(r, n.n_regionkey == r.r_regionkey, "left").join(li, o.o_orderkey == li.l_orderkey, "left")
    f = lambda k, v: F.struct(F.lit(k).alias("key"), v.cast("string").alias("value"))
    epoch = F.timestamp_diff("SECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), F.col("o_orderdate"))
    return j.select(
        F.col("o_orderkey").cast("string").alias("ticketId"), F.col("o_orderpriority").alias("subject"),
        F.col("o_custkey").cast("string").alias("custUserId"),
        F.length("o_orderpriority").cast("string").alias("servicerUserId"),
        F.when(F.col("o_orderstatus") == "F", "0").when(F.col("o_orderstatus") == "O", "1").otherwise("2")
        .alias("servicerGroupId"),
        F.substring("o_orderpriority", 1, 1).alias("ticketTemplateId"),
        F.col("cc").alias("ccUserIdList"),
        F.when(F.col("o_orderstatus") == "F", "2").otherwise("1").alias("ticketType"),
        F.substring("o_orderpriority", 1, 1).alias("priorityLevel"),
        F.when(F.col("o_orderstatus") == "F", "4").when(F.col("o_orderstatus") == "O", "2").otherwise("1").alias("ticketStatus"),
        F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss").alias("createDT"),
        F.date_format(F.when(F.col("o_orderstatus") == "O", F.timestamp_add("HOUR", F.lit(3), F.col("o_orderdate")))
                      .otherwise(F.col("o_orderdate")), "yyyy-MM-dd HH:mm:ss").alias("updateDT"),
        F.lit("field_2").alias("currentNodeField"), F.col("r_regionkey").cast("string").alias("currentNodeFieldValue"),
        epoch.cast("string").alias("nodeFieldIntoTime"),
        F.array(f("field_1", F.concat(F.lpad(F.col("n_nationkey").cast("string"), 6, "1"), F.lit(" "), F.col("n_name"), F.lit("省"))),
                f("field_2", F.col("r_regionkey")),
                f("record_serviceruserid_1", F.length("o_orderpriority")),
                f("field_3", F.concat(F.lit('["'), F.col("r_regionkey").cast("string"), F.lit('","77"]')))).alias("custom_fields"))


def resolve_args(spark, sf_dir):
    n = table(spark, sf_dir, "nation")
    r = table(spark, sf_dir, "region")
    options = r.select(F.explode(F.array(F.lit("field_2"), F.lit("field_3"))).alias("field_key"),
                       F.col("r_regionkey").cast("string").alias("option_key"), F.col("r_name").alias("option_value"))
    return dict(
        contacts=table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("cId"), F.col("c_name").alias("realName"),
                                                         F.col("c_nationkey").cast("string").alias("companyId")),
        companies=n.select(F.col("n_nationkey").alias("id"), F.col("n_name").alias("name")),
        agents=table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("sId"), F.col("s_name").alias("name")),
        groups=r.select(F.col("r_regionkey").alias("gId"), F.col("r_name").alias("name")),
        templates=n.select(F.col("n_nationkey").alias("tId"), F.col("n_name").alias("name")),
        field_options=options,
        global_options=spark.createDataFrame([("99", "其他")], "option_key string, option_value string"),
        field_names=spark.createDataFrame([("field_1", "省份"), ("field_2", "所属区域")], "key string, name string"))


def q_resolve_tickets(spark, sf_dir):
    out = J.resolve_tickets(ticket_details(spark, sf_dir), **resolve_args(spark, sf_dir))
    return out.withColumn("resolved_fields", F.to_json("resolved_fields")).drop("custom_fields")


def q_ticket_narrow_row(spark, sf_dir):
    return T.narrow_main_row(ticket_details(spark, sf_dir))


SAMPLE_LABELS = {"ticket_id": "工单编号", "subject": "标题", "ticketStatus": "状态", "province": "省份", "resolved_fields": "字段",
                 "cust_user_name": "标题"}


def q_sample_details(spark, sf_dir):
    """Two tickets of each template and group: resolved, labelled, written as a JSON report and read back."""
    details = ticket_details(spark, sf_dir)
    report = scratch_path(spark, "sample-report")
    out = J.sample_details(details, ["ticketTemplateId", "servicerGroupId"], "ticketId", 2, "7", resolve_args(spark, sf_dir),
                           SAMPLE_LABELS, report)["details"]
    back = spark.read.schema(out.schema).json(report)
    return back.select("工单编号", "标题", "状态", "省份", "字段", "标题(cust_user_name)", "company_name", "createDT", "ccUserIdList")


def q_sample_counts(spark, sf_dir):
    return J.sample_details(ticket_details(spark, sf_dir), ["ticketTemplateId", "servicerGroupId"], "ticketId", 2, "7")["counts"]


def _ingest(spark, sf_dir):
    """Stored: closed (group 0) and open (group 1) orders. Arriving: all orders, open ones with another
    update time, some of them with another create time; pending ones are new, come twice (the second row
    must not count), and some have an id that is no number."""
    details = ticket_details(spark, sf_dir)
    stored = details.where(F.col("servicerGroupId") != "2")
    created = F.to_timestamp("createDT", "yyyy-MM-dd HH:mm:ss").cast("timestamp_ntz")
    row = T.main_row(stored.select("ticketId", "subject", "createDT", "updateDT"),
                     {**T.MAIN_COLUMNS, **{c: c for c in T.ANALYTIC_COLUMNS}}, T.MAIN_DATETIMES)
    stored_main = row.withColumn("sync_status", F.lit("stored"))
    stored_child = J.custom_field_rows(stored.withColumn("create_dt", created), "ticketId", "custom_fields") \
        .join(stored.select("ticketId", created.alias("create_dt")), "ticketId") \
        .select(F.col("ticketId").cast("long").alias("ticket_id"), F.lit(None).cast("string").alias("ticket_template_id"),
                "create_dt", "field_order", "field_key", F.col("field_key").alias("field_name"), "field_value",
                F.lit(None).cast("string").alias("field_value_json"), F.lit("str").alias("field_value_type"),
                F.date_format("create_dt", "yyyy-MM").alias("create_month_label"))
    is_open, pending = F.col("servicerGroupId") == "1", F.col("servicerGroupId") == "2"
    later = F.date_format(F.timestamp_add("DAY", F.lit(1), created), "yyyy-MM-dd HH:mm:ss")
    arriving = details.withColumn("row_no", F.lit(1)) \
        .withColumn("ticketId", F.when(pending & (F.col("subject") == "1-URGENT"), F.concat(F.lit("x"), F.col("ticketId")))
                    .otherwise(F.col("ticketId"))) \
        .withColumn("createDT", F.when(is_open & (F.col("subject") == "5-LOW"), later).otherwise(F.col("createDT")))
    arriving = arriving.withColumn("updateDT", F.when(is_open, F.col("createDT")).otherwise(F.col("updateDT")))
    again = arriving.where(pending & (F.col("subject") != "1-URGENT")) \
        .withColumn("row_no", F.lit(2)).withColumn("subject", F.lit("again"))
    return J.ingest_tickets(arriving.unionByName(again), stored_main, stored_child, resolve_args(spark, sf_dir),
                            arrival="row_no")


def q_ingest_tickets(spark, sf_dir):
    return _ingest(spark, sf_dir)["main"]


def q_ingest_tickets_child(spark, sf_dir):
    return _ingest(spark, sf_dir)["child"]


def q_ingest_tickets_counts(spark, sf_dir):
    return _ingest(spark, sf_dir)["counts"]


def q_sync_entities(spark, sf_dir):
    """Two batches: all customers, then suppliers and customers together (same ids: the first source wins).
    Customers with a negative balance have no id in the second batch."""
    c = table(spark, sf_dir, "customer")
    s = table(spark, sf_dir, "supplier")
    first = c.select(F.col("c_custkey").cast("string").alias("uId"), F.col("c_name").alias("companyName"),
                     F.col("c_mktsegment").alias("rank"), F.col("c_custkey").alias("row_no"))
    lost = F.col("c_acctbal") < 0
    second = c.select(F.when(lost, F.lit(" ")).otherwise(F.col("c_custkey").cast("string")).alias("customerId"),
                      F.when(F.col("c_mktsegment") == "BUILDING", F.concat("c_name", F.lit("*")))
                      .otherwise(F.col("c_name")).alias("name"),
                      F.col("c_mktsegment").alias("rank"), F.col("c_custkey").alias("row_no"))
    company = s.select((F.col("s_suppkey") * 2).cast("string").alias("id"), F.col("s_name").alias("companyName"),
                       F.col("s_suppkey").alias("row_no"))
    fields = list(CUSTOMER_CANDIDATES)
    args = dict(key="customer_id", entity_type="customer", hash_fields=fields, arrival="row_no")
    empty = H.empty_history(first.limit(0).select(
        *[F.lit(None).cast("string").alias(k) for k in CUSTOMER_CANDIDATES],
        F.lit(None).cast("string").alias("source_flags"), F.lit(None).cast("timestamp_ntz").alias("source_updated_at"),
        F.lit(None).cast("string").alias("row_hash")))
    one = J.sync_entities([("customer_api", first)], CUSTOMER_CANDIDATES, empty, batch_id="B1",
                          batch_time=_dt.datetime(2026, 6, 2), **args)
    return J.sync_entities([("customer_api", second), ("company_api", company)], CUSTOMER_CANDIDATES, one["history"],
                           batch_id="B2", batch_time=_dt.datetime(2026, 6, 3), **args)


def q_sync_entities_history(spark, sf_dir):
    return q_sync_entities(spark, sf_dir)["history"].select(
        "customer_id", "customer_name", "customer_type", "source_flags", "version_no", "sync_batch_id",
        "effective_from", "effective_to", "is_current")


def q_sync_entities_counts(spark, sf_dir):
    return q_sync_entities(spark, sf_dir)["counts"]


def q_run_log(spark, sf_dir):
    """The run-log row of the second batch."""
    return H.run_log_row(spark, "sync_entities", "B2", q_sync_entities(spark, sf_dir)["counts"])


#: Columns of the contract sheet that the stand-in computes itself; the others take their cells from :func:`cell_texts`.
OWN_COLUMNS = ("contract_id", "item_code", "exec_detail_id", "create_date", "sales_platform", "system_engineer", "product_amount",
               "contract_apply_date", "detail_qty")


def _kind(column: str) -> str:
    kinds = {"int": J.INT_COLUMNS, "date": J.DATE_COLUMNS, "decimal": J.DECIMAL_COLUMNS, "snapshot": ("create_date",)}
    return next((kind for kind, columns in kinds.items() if column in columns), "text")


def cell_forms(li):
    """lineitem with the texts that many cells share, each written once per line."""
    whole, money = F.col("l_quantity").cast("int").cast("string"), F.col("l_extendedprice")
    return li.select("*", whole.alias("__whole"), F.concat(F.lit(" -"), whole, F.lit(".0")).alias("__negative"),
                     F.date_format("l_shipdate", "yyyyMMdd").alias("__day"), F.date_format("l_shipdate", "yyyy/MM/dd").alias("__dashed"),
                     F.format_number(money, 2).alias("__money"), money.cast("decimal(18,2)").cast("string").alias("__amount"),
                     F.concat(F.lit("  "), F.col("l_returnflag"), F.lit(" ")).alias("__flag"), F.col("l_partkey").cast("string").alias("__part"))


def cell_texts():
    """Cells of every form for each column of the contract sheet, on :func:`cell_forms`: (header, column, text)."""
    for k, (header, column) in enumerate(L.STANDARD_LAYOUT):
        turn = (F.col("l_linenumber") + k) % 4
        forms = {"int": [F.col("__whole"), F.col("__negative"), F.lit("1,000"), F.lit("")],
                 "date": [F.col("__day"), F.col("__dashed"), F.lit("/"), F.lit("9999-12-31")],
                 "decimal": [F.col("__money"), F.col("__amount"), F.lit("x"), F.lit("-0.50 ")],
                 "snapshot": [F.lit("20260713165231")] * 4,
                 "text": [F.lit(" "), F.col("__flag"), F.lit("甲"), F.col("__part")]}
        first, *others, last = forms[_kind(column)]
        text = F.when(turn == 0, first)
        for number, form in enumerate(others, 1):
            text = text.when(turn == number, form)
        yield header, column, text.otherwise(last)


def cell_values():
    """The values of :func:`cell_texts` in DuckDB: column -> expression."""
    forms = {"int": ("CAST(l_quantity AS INTEGER)", "-CAST(l_quantity AS INTEGER)", "NULL", "NULL", "INTEGER"),
             "date": ("CAST(l_shipdate AS DATE)", "CAST(l_shipdate AS DATE)", "NULL", "DATE '9999-12-31'", "DATE"),
             "decimal": ("CAST(l_extendedprice AS DECIMAL(18,2))", "CAST(l_extendedprice AS DECIMAL(18,2))", "NULL", "-0.5", "DECIMAL(18,2)"),
             "snapshot": ("'20260713'",) * 4 + ("VARCHAR",),
             "text": ("NULL", "l_returnflag", "'甲'", "CAST(l_partkey AS VARCHAR)", "VARCHAR")}
    for k, (_, column) in enumerate(L.STANDARD_LAYOUT):
        *parts, kind = forms[_kind(column)]
        cases = " ".join(f"WHEN {number} THEN {part}" for number, part in enumerate(parts))
        yield column, f"CAST(CASE (l_linenumber + {k}) % 4 {cases} END AS {kind})"


def q_typed_snapshot(spark, sf_dir):
    """All 78 columns of the snapshot layout with the converters of their kinds."""
    li = cell_forms(table(spark, sf_dir, "lineitem"))
    sheet = _stored(li.select("l_orderkey", "l_linenumber", *[text.alias(header) for header, _, text in cell_texts()]), "sheet")
    return J.typed_snapshot(sheet, keep=["l_orderkey", "l_linenumber"])


def _stored(df, name):
    """A stand-in written as files, as the sheets of the jobs are."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _contract_load(spark, sf_dir):
    """lineitem as a snapshot sheet of two dates, without the lines of the highest discount. Stored: the even
    orders of the first date, all discounts. Baseline: the first lines of two platforms."""
    li = cell_forms(table(spark, sf_dir, "lineitem"))
    text = lambda c: F.col(c).cast("string")
    values = {"合同编号": F.when((F.col("l_returnflag") != "N") & (F.col("l_tax") < 0.01), F.lit(" "))
              .otherwise(text("l_orderkey")),
              "标的行编码": text("l_linenumber"), "执行明细id": (F.col("l_suppkey") % 5).cast("string"),
              "文件生成时间戳": F.when(F.col("l_linestatus") == "O", F.lit("20260713165231")).otherwise(F.lit("20260601120000")),
              "营销平台": F.concat(F.lit("P"), (F.col("l_suppkey") % 7).cast("string")),
              "体系工程师": F.lit("own"), "产品金额": F.col("__money"),
              "合同申请日期": F.when(F.col("l_returnflag") == "A", F.lit("9999-12-31")).otherwise(F.col("__dashed")),
              "明细数量": F.when(F.col("l_quantity") > 45, F.lit("99999999999")).otherwise(F.col("__whole"))}
    cells = [values.get(h, text).alias(h) for h, _, text in cell_texts()]
    place = F.struct("l_shipdate", "l_partkey", "l_suppkey").alias("row_no")
    whole = _stored(li.select("l_orderkey", "l_linestatus", "l_discount", *cells, place), "contract-sheet")
    sheet = whole.where("l_discount < 0.095").drop("l_orderkey", "l_linestatus", "l_discount")
    keys = ["contract_id", "item_code", "exec_detail_id"]
    held = J.typed_snapshot(whole.where("l_orderkey % 2 = 0 AND l_linestatus != 'O'"), keep=["row_no"])
    stored = C.dedup_keep_last(held.where("contract_id IS NOT NULL"), [*keys, "create_date"], "row_no").drop("row_no") \
        .withColumn("system_engineer", F.when(F.col("item_code") == "2", "old").otherwise("own"))
    baseline = J.typed_snapshot(sheet).where("item_code = '1' AND sales_platform IN ('P1', 'P2')").select(
        *keys, F.lit("P0").alias("sales_platform"))
    engineers = C.map_table(spark, {"P0": "E0", "P3": "E3"}, "p", "e")
    return J.load_contract_snapshot(sheet, stored, baseline, engineers)


def q_load_contract_snapshot(spark, sf_dir):
    """All 78 columns of the touched snapshots."""
    return _contract_load(spark, sf_dir)["table"]


def q_load_contract_counts(spark, sf_dir):
    return _contract_load(spark, sf_dir)["counts"]


QUERIES = {
    "merge_contract_sources": q_merge_contract_sources,
    "resolve_tickets": q_resolve_tickets,
    "ingest_tickets": q_ingest_tickets,
    "ingest_tickets_child": q_ingest_tickets_child,
    "ingest_tickets_counts": q_ingest_tickets_counts,
    "sync_entities": q_sync_entities_history,
    "sync_entities_counts": q_sync_entities_counts,
    "load_contract_snapshot": q_load_contract_snapshot,
    "load_contract_counts": q_load_contract_counts,
    "typed_snapshot": q_typed_snapshot,
    "ticket_narrow_row": q_ticket_narrow_row,
    "sample_details": q_sample_details,
    "sample_counts": q_sample_counts,
    "run_log": q_run_log,
}

def _alloc_sql(ps: str, pe: str) -> str:
    overlap = f"greatest(0, least(e_d, DATE '{pe}') - greatest(s_d, DATE '{ps}') + 1)"
    return (f"CAST(CASE WHEN s_d IS NOT NULL AND e_d IS NOT NULL AND days > 0 THEN CAST((2 * cents * {overlap} + days)"
            f" // (2 * days) AS DECIMAL(20,0)) * CAST(0.01 AS DECIMAL(3,2)) ELSE 0 END AS DECIMAL(18,2))")


_MERGE_SQL = f"""
WITH j AS (
  SELECT l.*, p.p_type, n.n_name,
    CAST(l_orderkey AS DECIMAL(38,0)) * CAST('100000000000000000000000' AS DECIMAL(38,0))
      + CAST(l_linenumber AS DECIMAL(38,0)) * CAST('10000000000000000000000' AS DECIMAL(38,0))
      + CAST(l_partkey AS DECIMAL(38,0)) * CAST('10000000000000' AS DECIMAL(38,0))
      + CAST(l_suppkey AS DECIMAL(38,0)) * CAST('100000' AS DECIMAL(38,0))
      + CAST(date_diff('day', DATE '1970-01-01', CAST(l_shipdate AS DATE)) AS DECIMAL(38,0)) AS seq,
    CAST(l_partkey AS VARCHAR) || '-' || CAST(l_suppkey AS VARCHAR) AS line_id,
    strftime(l_shipdate, '%Y%m%d') AS start_txt,
    strftime(CAST(l_shipdate AS DATE) + CAST(l_quantity * 7 AS INTEGER), '%Y%m%d') AS end_txt
  FROM lineitem l LEFT JOIN part p ON l.l_partkey = p.p_partkey LEFT JOIN supplier s ON l.l_suppkey = s.s_suppkey
  LEFT JOIN nation n ON s.s_nationkey = n.n_nationkey),
new_rows AS (
  SELECT 0 AS src, seq, CAST(l_orderkey AS VARCHAR) AS c_no, CAST(l_linenumber AS VARCHAR) AS item,
    COALESCE(n_name, '') AS platform,
    '/' AS c_type, '/' AS est, '/' AS biz, '/' AS cat, 0.0 AS billing, 'ORG' AS org, 'CUST' AS cust, line_id, '/' AS virtual,
    111.0::DOUBLE AS cur_amort, 222.0::DOUBLE AS prev_amort, year(l_shipdate) AS apply_year,
    CAST(CAST(l_extendedprice AS DECIMAL(18,2)) AS DOUBLE) AS amount,
    start_txt, end_txt, strftime(l_shipdate, '%Y%m%d') AS apply_txt,
    '有效' AS invalid_type, '非税票据' AS other_type, '新ERP' AS source
  FROM j WHERE l_returnflag = 'N'),
old_rows AS (
  SELECT 1 AS src, seq, CAST(l_orderkey AS VARCHAR) AS c_no, line_id AS item,
    CASE COALESCE(n_name, '') WHEN 'NATION_1' THEN 'NATION_2' WHEN 'NATION_3' THEN 'NATION_4' ELSE COALESCE(n_name, '') END AS platform,
    CASE WHEN l_returnflag = 'A' THEN '统签散开合同' ELSE '普通销售合同' END AS c_type,
    CASE WHEN l_returnflag = 'A' THEN '否' ELSE '是' END AS est,
    CASE WHEN p_type = 'MEDIUM' THEN '运维服务费' ELSE '其他' END AS biz,
    CASE WHEN l_linestatus = 'O' THEN '运维合同' ELSE '非运维合同' END AS cat,
    CAST(CAST(l_extendedprice AS DECIMAL(18,2)) AS DOUBLE) * (CAST(round(l_discount * 100, 0) AS INTEGER) / 100.0) AS billing,
    'ORG-OLD' AS org, '/' AS cust, line_id, '否' AS virtual, 1.0::DOUBLE AS cur_amort, 2.0::DOUBLE AS prev_amort, NULL AS apply_year,
    CAST(CAST(l_extendedprice AS DECIMAL(18,2)) AS DOUBLE) AS amount,
    start_txt, end_txt, '/' AS apply_txt, '/' AS invalid_type, '/' AS other_type, '旧ERP' AS source
  FROM j WHERE l_returnflag <> 'N'
    AND line_id NOT IN (SELECT line_id FROM j WHERE l_returnflag = 'N')),
u AS (SELECT * FROM new_rows UNION ALL SELECT * FROM old_rows),
d AS (SELECT *, row_number() OVER (PARTITION BY c_no, item ORDER BY src DESC, seq DESC) AS rn FROM u),
k AS (SELECT * FROM d WHERE rn = 1),
n AS (
  SELECT *, row_number() OVER (ORDER BY src, seq) AS seq_no,
    CASE platform WHEN 'NATION_0' THEN 'ENG-A' WHEN 'NATION_2' THEN 'ENG-B' WHEN 'NATION_4' THEN 'ENG-C' ELSE '' END AS engineer,
    CAST(strptime(start_txt, '%Y%m%d') AS DATE) AS s_d, CAST(strptime(end_txt, '%Y%m%d') AS DATE) AS e_d,
    CAST(round(amount * 100) AS BIGINT) AS cents
  FROM k),
a AS (SELECT *, CAST(COALESCE(e_d - s_d + 1, 0) AS INTEGER) AS days FROM n),
c AS (SELECT *, {_alloc_sql('1998-01-01', '1998-12-31')} AS cur_calc, {_alloc_sql('1997-01-01', '1997-12-31')} AS prev_calc FROM a)
"""
_SHEET = {
    "序号": "seq_no", "合同编号": "c_no", "销售组织": "org", "签约客户": "cust", "标的行编码": "item", "执行明细id": "'D'",
    "企业版销售合同明细id": "line_id", "营销平台": "platform", "体系工程师": "engineer", "合同类型": "c_type",
    "暂估运维运营": "est", "虚拟合同": "virtual", "业务类型": "biz", "合同分类": "cat", "累计开票金额": "billing",
    "累计回款金额": "billing", "产品金额": "amount", "合同申请日期": "apply_txt", "明细运维开始开始日期": "start_txt",
    "明细运维结束日期": "end_txt", "当年应分摊金额": "cur_amort", "去年同期应分摊金额": "prev_amort",
    "无效合同类型": "invalid_type", "其他业务类型": "other_type", "数据来源": "source",
    "文件生成时间戳": "'20260715083000'", "文件来源时间戳": "'20260715'", "合同天数": "days",
    "去年统计起始日期": "DATE '1997-01-01'", "去年统计截止日期": "DATE '1997-12-31'", "去年按期分摊服务费": "prev_calc",
    "去年倒签调整后分摊服务费": "CAST(CASE WHEN apply_year = 1998 THEN 0 ELSE prev_calc END AS DECIMAL(18,2))",
    "今年统计起始日期": "DATE '1998-01-01'", "今年统计截止日期": "DATE '1998-12-31'", "今年按期分摊服务费": "cur_calc",
    "今年倒签调整后分摊服务费": "CAST(CASE WHEN apply_year = 1998 AND prev_calc > 0 THEN cur_calc + prev_calc ELSE cur_calc END AS DECIMAL(18,2))",
}
# columns that neither extract fills: 0 where the header names money, else blank
_MERGE_SQL += "SELECT " + ", ".join(
    f'{_SHEET.get(h, "0.0::DOUBLE" if any(m in h for m in ("金额", "价税合计", "单价")) else chr(39) * 2)} AS "{h}"'
    for h, _ in L.STANDARD_LAYOUT) + " FROM c"

_TICKETS_SQL = '''
WITH cc AS (
  SELECT l_orderkey, string_agg(COALESCE(NULLIF(trim(s_name), ''), CAST(l_suppkey AS VARCHAR)), ','
                                ORDER BY l_linenumber, l_suppkey, l_partkey) AS cc_names
  FROM lineitem LEFT JOIN supplier ON l_suppkey = s_suppkey GROUP BY 1),
t AS (
  SELECT o_orderkey AS id, o_orderstatus AS st, o_orderpriority AS pr, o_orderdate AS created,
    CASE WHEN o_orderstatus = 'O' AND o_orderpriority = '5-LOW' THEN o_orderdate + INTERVAL 1 DAY ELSE o_orderdate END AS moved,
    o_orderdate + INTERVAL 3 HOUR AS open_upd, CAST(o_custkey AS VARCHAR) AS cust, c_name,
    CASE WHEN c_nationkey <> 0 THEN CAST(c_nationkey AS VARCHAR) END AS company_id,
    CASE WHEN c_nationkey <> 0 THEN n.n_name END AS company_name,
    CAST(length(o_orderpriority) AS VARCHAR) AS sid,
    COALESCE(NULLIF(trim(s_name), ''), CAST(length(o_orderpriority) AS VARCHAR)) AS servicer,
    CASE o_orderstatus WHEN 'F' THEN '0' WHEN 'O' THEN '1' ELSE '2' END AS gid, g.r_name AS group_name,
    substr(o_orderpriority, 1, 1) AS tid, tn.n_name AS template_name, cc_names,
    CASE o_orderstatus WHEN 'F' THEN '事务' ELSE '问题' END AS ticket_type,
    CASE substr(o_orderpriority, 1, 1) WHEN '1' THEN '低' WHEN '2' THEN '正常' WHEN '3' THEN '高' WHEN '4' THEN '紧急'
      ELSE substr(o_orderpriority, 1, 1) END AS priority_level,
    CASE o_orderstatus WHEN 'F' THEN '已解决' WHEN 'O' THEN '已开启' ELSE '新建' END AS ticket_status,
    r.r_name AS r_name, CAST(r.r_regionkey AS VARCHAR) AS region_id, n.n_name || '省' AS province,
    lpad(CAST(n.n_nationkey AS VARCHAR), 6, '1') || ' ' || n.n_name || '省' AS prov_raw,
    o_orderdate + INTERVAL 8 HOUR AS node_time
  FROM orders LEFT JOIN customer ON o_custkey = c_custkey LEFT JOIN nation n ON c_nationkey = n.n_nationkey
  LEFT JOIN region r ON n.n_regionkey = r.r_regionkey LEFT JOIN supplier ON s_suppkey = length(o_orderpriority)
  LEFT JOIN region g ON g.r_regionkey = CASE o_orderstatus WHEN 'O' THEN 1 WHEN 'P' THEN 2 END
  LEFT JOIN nation tn ON tn.n_nationkey = CAST(substr(o_orderpriority, 1, 1) AS INTEGER)
  LEFT JOIN cc ON cc.l_orderkey = o_orderkey)
'''
_LIST_SQL = "'[\"' || r_name || '\",\"77\"]'"
_FIELD_KEY = "CASE ord WHEN 1 THEN 'field_1' WHEN 2 THEN 'field_2' WHEN 3 THEN 'record_serviceruserid_1' ELSE 'field_3' END"
_IS_LOADED = "st = 'O' OR (st = 'P' AND pr <> '1-URGENT')"
_TIME_TEXT = "strftime({}, '%Y-%m-%d %H:%M:%S')"
_NAMED = {"cust_user_name": "c_name", "servicer_user_name": "servicer", "servicer_group_name": "group_name",
          "ticket_template_name": "template_name", "company_id": "company_id", "company_name": "company_name"}
_DIMENSIONS = {**{d: "CAST(NULL AS VARCHAR)" for d in ANALYTIC_FIELD_KEYWORDS}, "province": "province", "region_text": "r_name"}
_RESOLVED = {
    "ticketId": "CAST(id AS VARCHAR)", "subject": "pr", "custUserId": "cust", "servicerUserId": "sid", "servicerGroupId": "gid",
    "ticketTemplateId": "tid", "ccUserIdList": "cc_names", "ticketType": "ticket_type", "priorityLevel": "priority_level",
    "ticketStatus": "ticket_status", "createDT": _TIME_TEXT.format("created"),
    "updateDT": _TIME_TEXT.format("CASE WHEN st = 'O' THEN open_upd ELSE created END"), "currentNodeField": "'所属区域'",
    "currentNodeFieldValue": "r_name", "nodeFieldIntoTime": _TIME_TEXT.format("node_time"),
    "current_node_started_at": _TIME_TEXT.format("node_time"), **_NAMED, **_DIMENSIONS,
    "resolved_fields": f"CAST(to_json([{{'key': '省份', 'value': prov_raw}}, {{'key': '所属区域', 'value': r_name}}, "
                       f"{{'key': 'record_serviceruserid_1', 'value': servicer}}, {{'key': 'field_3', 'value': {_LIST_SQL}}}]) AS VARCHAR)",
}
_MAIN_ORDER = [*T.MAIN_COLUMNS.values(), *T.ANALYTIC_COLUMNS, "create_year", "create_month", "create_month_label", "sync_status"]


def _main_sql(exprs: dict) -> str:
    missing = {c: "CAST(NULL AS TIMESTAMP)" if c in T.MAIN_DATETIMES else "CAST(NULL AS VARCHAR)" for c in _MAIN_ORDER}
    return ", ".join(f"{ {**missing, **exprs}[c]} AS {c}" for c in _MAIN_ORDER)


def _created_sql(c: str) -> dict:
    return {"create_dt": c, "create_year": f"CAST(year({c}) AS INTEGER)", "create_month": f"CAST(month({c}) AS INTEGER)",
            "create_month_label": f"strftime({c}, '%Y-%m')", "ticket_id": "id", "subject": "pr", "ticket_category": "'原单'"}


_STORED_MAIN = {**_created_sql("created"), "sync_status": "'stored'",
                "source_updated_at": "CASE WHEN st = 'O' THEN open_upd ELSE created END"}
_LOADED_MAIN = {
    **_created_sql("moved"), "source_updated_at": "moved", "sync_status": "'success'", **_NAMED, "cust_user_id": "cust",
    "servicer_user_id": "sid", "servicer_group_id": "gid", "ticket_template_id": "tid", "cc_user_id_list": "cc_names",
    "ticket_type": "ticket_type", "priority_level": "priority_level", "ticket_status": "ticket_status",
    "current_node_field": "'所属区域'", "current_node_field_value": "r_name", "node_field_into_time": "node_time",
    "current_node_started_at": "node_time", "province": "province", "region_text": "r_name",
}

_SYNC_SQL = '''
WITH b1 AS (SELECT CAST(c_custkey AS VARCHAR) AS id, c_name AS name, c_mktsegment AS type FROM customer),
c2 AS (SELECT CAST(c_custkey AS VARCHAR) AS id, c_name || CASE WHEN c_mktsegment = 'BUILDING' THEN '*' ELSE '' END AS name,
         c_mktsegment AS type, 'customer_api' AS flags FROM customer WHERE c_acctbal >= 0),
s2 AS (SELECT CAST(s_suppkey * 2 AS VARCHAR) AS id, s_name AS name, CAST(NULL AS VARCHAR) AS type, 'company_api' AS flags FROM supplier),
b2 AS (SELECT * FROM c2 UNION ALL SELECT * FROM s2 WHERE id NOT IN (SELECT id FROM c2)),
j AS (SELECT b2.*, CASE WHEN b1.id IS NULL THEN 'inserted'
        WHEN b1.name IS NOT DISTINCT FROM b2.name AND b1.type IS NOT DISTINCT FROM b2.type THEN 'unchanged'
        ELSE 'changed' END AS outcome
      FROM b2 LEFT JOIN b1 ON b1.id = b2.id)'''

_SYNC_COUNTS = _SYNC_SQL + """,
x AS (SELECT outcome FROM j UNION ALL SELECT 'failed' FROM customer WHERE c_acctbal < 0)
SELECT COUNT(*) AS rows, COUNT(*) FILTER (WHERE outcome = 'inserted') AS inserted,
  COUNT(*) FILTER (WHERE outcome = 'changed') AS updated, COUNT(*) FILTER (WHERE outcome = 'unchanged') AS unchanged,
  COUNT(*) FILTER (WHERE outcome = 'skipped') AS skipped, COUNT(*) FILTER (WHERE outcome = 'failed') AS failed,
  CASE WHEN COUNT(*) FILTER (WHERE outcome = 'failed') = 0 THEN 'success' ELSE 'partial' END AS status
FROM x"""

_NARROW = {
    **{c: "CAST(NULL AS TIMESTAMP)" if c in T.MAIN_DATETIMES else "CAST(NULL AS VARCHAR)" for c in list(T.MAIN_COLUMNS.values())[:34]
       if c != "source_updated_at"},
    "ticket_id": "id", "subject": "pr", "cust_user_id": "cust", "servicer_user_id": "sid",
    "cc_user_id_list": "(SELECT string_agg(CAST(l_suppkey AS VARCHAR), ',' ORDER BY l_linenumber, l_suppkey, l_partkey) "
                       "FROM lineitem WHERE l_orderkey = id)",
    "ticket_type": "CASE st WHEN 'F' THEN '2' ELSE '1' END", "priority_level": "tid",
    "ticket_status": "CASE st WHEN 'F' THEN '4' WHEN 'O' THEN '2' ELSE '1' END", "create_dt": "created",
    "update_dt": "CASE WHEN st = 'O' THEN open_upd ELSE created END", "servicer_group_id": "gid", "ticket_template_id": "tid",
    "current_node_field": "'field_2'", "current_node_field_value": "region_id",
}
_SAMPLE_DETAILS = f"""
SELECT CAST(id AS VARCHAR) AS "工单编号", pr AS "标题", ticket_status AS "状态", province AS "省份", {_RESOLVED['resolved_fields']} AS "字段",
  c_name AS "标题(cust_user_name)", company_name, {_RESOLVED['createDT']} AS "createDT", cc_names AS "ccUserIdList"
FROM t QUALIFY row_number() OVER (PARTITION BY tid, gid ORDER BY md5('7:' || tid || '|' || gid || ':' || CAST(id AS VARCHAR)),
                                  CAST(id AS VARCHAR)) <= 2"""

_OTHERS = {column: sql for column, sql in cell_values() if column not in OWN_COLUMNS}
_LOAD_SQL = f'''
WITH b AS (
  SELECT l_orderkey, l_linestatus, l_discount, l_shipdate, l_partkey, l_suppkey,
    CASE WHEN l_returnflag <> 'N' AND l_tax < 0.01 THEN NULL ELSE CAST(l_orderkey AS VARCHAR) END AS contract_id,
    CAST(l_linenumber AS VARCHAR) AS item_code, CAST(l_suppkey % 5 AS VARCHAR) AS exec_detail_id,
    CASE WHEN l_linestatus = 'O' THEN '20260713' ELSE '20260601' END AS create_date,
    'P' || CAST(l_suppkey % 7 AS VARCHAR) AS platform, CAST(l_extendedprice AS DECIMAL(18,2)) AS product_amount,
    CASE WHEN l_returnflag = 'A' THEN DATE '9999-12-31' ELSE CAST(l_shipdate AS DATE) END AS contract_apply_date,
    CASE WHEN l_quantity <= 45 THEN CAST(l_quantity AS INTEGER) END AS detail_qty,
    {', '.join(f'{sql} AS {c}' for c, sql in _OTHERS.items())}
  FROM lineitem),
sheet AS (
  SELECT * FROM b WHERE l_discount < 0.095 AND contract_id IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY contract_id, item_code, exec_detail_id, create_date
                             ORDER BY l_shipdate DESC, l_partkey DESC, l_suppkey DESC) = 1),
base AS (SELECT DISTINCT contract_id, item_code, exec_detail_id FROM b
         WHERE l_discount < 0.095 AND contract_id IS NOT NULL AND item_code = '1' AND platform IN ('P1', 'P2')),
p AS (SELECT s.*, CASE WHEN k.contract_id IS NOT NULL THEN 'P0' ELSE s.platform END AS sales_platform
      FROM sheet s LEFT JOIN base k ON k.contract_id = s.contract_id AND k.item_code = s.item_code AND k.exec_detail_id = s.exec_detail_id),
n AS (SELECT *, CASE sales_platform WHEN 'P0' THEN 'E0' WHEN 'P3' THEN 'E3' ELSE 'own' END AS system_engineer FROM p),
o AS (
  SELECT *, platform AS sales_platform, CASE item_code WHEN '2' THEN 'old' ELSE 'own' END AS system_engineer FROM b
  WHERE l_orderkey % 2 = 0 AND l_linestatus <> 'O' AND contract_id IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY contract_id, item_code, exec_detail_id, create_date
                             ORDER BY l_shipdate DESC, l_partkey DESC, l_suppkey DESC) = 1),
up AS (
  SELECT COALESCE(n.contract_id, o.contract_id) AS contract_id, COALESCE(n.item_code, o.item_code) AS item_code,
    COALESCE(n.exec_detail_id, o.exec_detail_id) AS exec_detail_id, COALESCE(n.create_date, o.create_date) AS create_date,
    CASE WHEN n.contract_id IS NOT NULL THEN n.sales_platform ELSE o.sales_platform END AS sales_platform,
    CASE WHEN n.contract_id IS NOT NULL THEN n.system_engineer ELSE o.system_engineer END AS system_engineer,
    CASE WHEN n.contract_id IS NOT NULL THEN n.product_amount ELSE o.product_amount END AS product_amount,
    CASE WHEN n.contract_id IS NOT NULL THEN n.contract_apply_date ELSE o.contract_apply_date END AS contract_apply_date,
    CASE WHEN n.contract_id IS NOT NULL THEN n.detail_qty ELSE o.detail_qty END AS detail_qty,
    {', '.join(f'CASE WHEN n.contract_id IS NOT NULL THEN n.{c} ELSE o.{c} END AS {c}' for c in _OTHERS)},
    CASE WHEN n.contract_id IS NOT NULL AND o.contract_id IS NULL THEN 'inserted'
         WHEN n.contract_id IS NOT NULL AND n.sales_platform = o.sales_platform AND n.system_engineer = o.system_engineer
           AND n.product_amount = o.product_amount AND n.contract_apply_date = o.contract_apply_date
           AND n.detail_qty IS NOT DISTINCT FROM o.detail_qty
           AND {' AND '.join(f'n.{c} IS NOT DISTINCT FROM o.{c}' for c in _OTHERS)} THEN 'unchanged'
         WHEN n.contract_id IS NOT NULL THEN 'updated' ELSE 'kept' END AS outcome
  FROM n FULL OUTER JOIN o ON n.contract_id = o.contract_id AND n.item_code = o.item_code
    AND n.exec_detail_id = o.exec_detail_id AND n.create_date = o.create_date)'''


SQL: dict = {
    "merge_contract_sources": _MERGE_SQL,
    "resolve_tickets": _TICKETS_SQL + "SELECT " + ", ".join(f'{e} AS "{c}"' for c, e in _RESOLVED.items()) + " FROM t",
    "ingest_tickets": _TICKETS_SQL + f"""
SELECT {_main_sql(_STORED_MAIN)} FROM t WHERE st = 'F' OR (st = 'O' AND pr = '5-LOW')
UNION ALL
SELECT {_main_sql(_LOADED_MAIN)} FROM t WHERE {_IS_LOADED}""",
    "ingest_tickets_child": _TICKETS_SQL + f"""
, f AS (
  SELECT t.*, unnest([1, 2, 3, 4]) AS ord FROM t)
SELECT id AS ticket_id, CAST(NULL AS VARCHAR) AS ticket_template_id, created AS create_dt, ord AS field_order,
  {_FIELD_KEY} AS field_key, {_FIELD_KEY} AS field_name,
  CASE ord WHEN 1 THEN prov_raw WHEN 2 THEN region_id WHEN 3 THEN sid ELSE '["' || region_id || '","77"]' END AS field_value,
  CAST(NULL AS VARCHAR) AS field_value_json, 'str' AS field_value_type, strftime(created, '%Y-%m') AS create_month_label
FROM f WHERE st = 'F' OR (st = 'O' AND pr = '5-LOW')
UNION ALL
SELECT id, tid, moved, ord, {_FIELD_KEY}, CASE ord WHEN 1 THEN '省份' WHEN 2 THEN '所属区域' ELSE {_FIELD_KEY} END,
  CASE ord WHEN 1 THEN prov_raw WHEN 2 THEN r_name WHEN 3 THEN servicer ELSE {_LIST_SQL} END,
  CASE WHEN ord = 4 THEN {_LIST_SQL} END, CASE WHEN ord = 4 THEN 'list' ELSE 'str' END, strftime(moved, '%Y-%m')
FROM f WHERE {_IS_LOADED}""",
    "ingest_tickets_counts": """
WITH x AS (
  SELECT CASE WHEN o_orderstatus = 'P' AND o_orderpriority = '1-URGENT' THEN 'failed' WHEN o_orderstatus = 'P' THEN 'inserted'
              WHEN o_orderstatus = 'O' THEN 'updated' ELSE 'skipped' END AS outcome FROM orders)
SELECT COUNT(*) AS rows, COUNT(*) FILTER (WHERE outcome = 'inserted') AS inserted,
  COUNT(*) FILTER (WHERE outcome = 'updated') AS updated, COUNT(*) FILTER (WHERE outcome = 'unchanged') AS unchanged,
  COUNT(*) FILTER (WHERE outcome = 'skipped') AS skipped, COUNT(*) FILTER (WHERE outcome = 'failed') AS failed,
  CASE WHEN COUNT(*) FILTER (WHERE outcome = 'failed') = 0 THEN 'success'
       WHEN COUNT(*) FILTER (WHERE outcome <> 'failed') = 0 THEN 'failed' ELSE 'partial' END AS status
FROM x""",
    "sync_entities": _SYNC_SQL + """
SELECT id AS customer_id, name AS customer_name, type AS customer_type, 'customer_api' AS source_flags, 1 AS version_no,
  'B1' AS sync_batch_id, TIMESTAMP '2026-06-02' AS effective_from,
  CASE WHEN outcome = 'changed' THEN TIMESTAMP '2026-06-03' END AS effective_to, outcome IS DISTINCT FROM 'changed' AS is_current
FROM b1 LEFT JOIN (SELECT id AS bid, outcome FROM j) ON id = bid
UNION ALL
SELECT id, name, type, flags, CASE outcome WHEN 'changed' THEN 2 ELSE 1 END, 'B2', TIMESTAMP '2026-06-03',
  CAST(NULL AS TIMESTAMP), true
FROM j WHERE outcome <> 'unchanged'""",
    "sync_entities_counts": _SYNC_COUNTS,
    "load_contract_snapshot": _LOAD_SQL + "SELECT " + ", ".join(c for _, c in L.STANDARD_LAYOUT) + " FROM up",
    "typed_snapshot": "SELECT l_orderkey, l_linenumber, " + ", ".join(f"{sql} AS {c}" for c, sql in cell_values()) + " FROM lineitem",
    "run_log": "SELECT 'sync_entities' AS task_name, 'B2' AS sync_batch_id, * FROM (" + _SYNC_COUNTS + ")",
    "ticket_narrow_row": _TICKETS_SQL + "SELECT " + ", ".join(f"{e} AS {c}" for c, e in _NARROW.items()) + " FROM t",
    "sample_counts": _TICKETS_SQL + "SELECT tid AS \"ticketTemplateId\", gid AS \"servicerGroupId\", COUNT(*) AS row_count FROM t GROUP BY 1, 2",
    "sample_details": _TICKETS_SQL + _SAMPLE_DETAILS,
    "load_contract_counts": _LOAD_SQL + """,
x AS (SELECT outcome, create_date FROM up WHERE outcome <> 'kept'
      UNION ALL SELECT 'skipped', create_date FROM b WHERE l_discount < 0.095 AND contract_id IS NULL)
SELECT COUNT(*) AS rows, COUNT(*) FILTER (WHERE outcome = 'inserted') AS inserted,
  COUNT(*) FILTER (WHERE outcome = 'updated') AS updated, COUNT(*) FILTER (WHERE outcome = 'unchanged') AS unchanged,
  COUNT(*) FILTER (WHERE outcome = 'skipped') AS skipped, COUNT(*) FILTER (WHERE outcome = 'failed') AS failed,
  'success' AS status, COUNT(DISTINCT create_date) AS snapshot_dates
FROM x""",
}
