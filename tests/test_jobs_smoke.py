"""Run every composite job once on small inputs built from sf0.001."""
import pytest
import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from quaystone.operators import contracts as C
from quaystone.operators import history as H
from quaystone.operators import worktime as W
from quaystone.operators.entities import CUSTOMER_CANDIDATES
from quaystone.plans import jobs as J
from quaystone.sources import layout as L

SF = "/root/testdata/sf0.001"


def _t(spark, name):
    return spark.read.parquet(f"{SF}/{name}.parquet")


def test_sync_entities(spark):
    c = _t(spark, "customer")
    src_a = c.select(F.col("c_custkey").cast("string").alias("uId"), F.col("c_name").alias("companyName"),
                     F.col("c_mktsegment").alias("rank"), F.lit("2026-06-01 10:00:00").alias("updateTime"))
    src_b = c.select(F.col("c_custkey").cast("string").alias("id"), F.concat("c_name", F.lit("-b")).alias("name"))
    empty = H.empty_history(src_a.limit(0).select(
        *[F.lit(None).cast("string").alias(k) for k in CUSTOMER_CANDIDATES],
        F.lit(None).cast("string").alias("source_flags"), F.lit(None).cast("timestamp_ntz").alias("source_updated_at"),
        F.lit(None).cast("string").alias("row_hash")))
    out = J.sync_entities([("customer_api", src_a), ("company_api", src_b)], CUSTOMER_CANDIDATES, empty,
                          key="customer_id", batch_id="B1", batch_time=dt.datetime(2026, 6, 2),
                          entity_type="customer", hash_fields=list(CUSTOMER_CANDIDATES) + ["source_flags", "source_updated_at"])
    hist = out["history"]
    n = c.count()
    assert hist.count() == n and hist.where("source_flags = 'customer_api'").count() == n
    counts = out["counts"].first()
    assert counts.inserted == n and counts.status == "success"
    assert out["archive"].count() == 2 * n
    again = J.sync_entities([("customer_api", src_a)], CUSTOMER_CANDIDATES, hist, key="customer_id", batch_id="B2",
                            batch_time=dt.datetime(2026, 6, 3), entity_type="customer",
                            hash_fields=list(CUSTOMER_CANDIDATES) + ["source_flags", "source_updated_at"])
    assert again["counts"].first().unchanged == n and again["history"].count() == n
    replay = J.sync_entities([("customer_api", src_a)], CUSTOMER_CANDIDATES, again["history"], key="customer_id",
                             batch_id="B1", batch_time=dt.datetime(2026, 6, 2), entity_type="customer",
                             hash_fields=list(CUSTOMER_CANDIDATES) + ["source_flags", "source_updated_at"])
    assert replay["counts"].first().skipped == n and replay["history"].count() == n


def test_load_contract_snapshot(spark):
    headers = [h for h, _ in L.STANDARD_LAYOUT]
    li = _t(spark, "lineitem").limit(50)
    cols = {h: F.lit("/") for h in headers}
    cols.update({
        "合同编号": F.col("l_orderkey").cast("string"), "标的行编码": F.col("l_partkey").cast("string"),
        "执行明细id": F.col("l_suppkey").cast("string"), "文件生成时间戳": F.lit("20260713165231"),
        "营销平台": F.lit("NATION_1"), "体系工程师": F.lit("keep"), "产品金额": F.format_number("l_extendedprice", 2),
        "合同申请日期": F.lit("2026-07-13"), "明细数量": F.lit("3.0"), "序号": F.lit("1")})
    sheet = li.select(*[cols[h].alias(h) for h in reversed(headers)])
    typed = J.typed_snapshot(sheet)
    current = typed.limit(0).select(*typed.columns)
    baseline = typed.select("contract_id", "item_code", "exec_detail_id", F.lit("NATION_2").alias("sales_platform")).limit(10)
    eng = C.map_table(spark, {"NATION_2": "E2"}, "p", "e")
    out = J.load_contract_snapshot(sheet, current, baseline, eng)
    t = out["table"]
    assert t.count() == 50 and t.select("create_date").distinct().first()[0] == "20260713"
    assert t.where("sales_platform = 'NATION_2' AND system_engineer = 'E2'").count() >= 1
    r = out["counts"].first()
    assert r.inserted + r.skipped + r.updated + r.unchanged == 50 and r.snapshot_dates == 1
    row = t.first()
    assert row.detail_qty == 3 and row.contract_apply_date == dt.date(2026, 7, 13) and row.product_amount is not None


def test_revenue_summary_job(spark):
    snap = spark.createDataFrame([
        ("A", "否", "运维合同", "非税票据", "有效", "否", dt.date(2026, 3, 1), Decimal("100"), Decimal("10"),
         Decimal("120"), Decimal("5"), Decimal("1000"), "20260713"),
        ("B", "否", "运维合同", "非税票据", "有效", "否", dt.date(2025, 3, 1), Decimal("50"), Decimal("0"),
         Decimal("50"), Decimal("0"), Decimal("500"), "20260713"),
        ("A", "否", "运维合同", "非税票据", "有效", "否", dt.date(2026, 3, 1), Decimal("999"), Decimal("0"),
         Decimal("0"), Decimal("0"), Decimal("0"), "20260701")],
        "sales_platform string, is_public_cloud string, contract_category string, other_business_type string,"
        " invalid_contract_type string, is_estimated_ops string, contract_apply_date date, cur_year_revenue decimal(18,2),"
        " prev_year_revenue decimal(18,2), cur_year_adjusted_amort decimal(18,2), prev_year_adjusted_amort decimal(18,2),"
        " product_amount decimal(18,2), create_date string")
    targets = spark.createDataFrame([(2026, 6, "A", 200.0), (2026, 6, "合计", 1.0), (2026, 5, "A", 1.0)],
                                    "year int, month int, sales_platform string, revenue_target double")
    out = J.revenue_summary(targets, snap, 2026, 6)
    rows = {r.sales_platform: r for r in out["with_total"].collect()}
    assert rows["A"].recognized_revenue == 100 and rows["A"].revenue_completion_rate == Decimal("0.500000")
    assert rows["合计"].sort_order == 0
    assert [r.sales_platform for r in out["unmapped"].collect()] == ["B"]


def test_time_metrics_and_sampling_jobs(spark):
    tickets = spark.createDataFrame([(1, "2026-06"), (2, "2026-06")], "ticket_id int, month string")
    attrs = spark.createDataFrame([(1, "s", "2026-06-16 10:23:55", 1), (1, "e", "2026-06-18 03:21:18", 2)],
                                  "ticket_id int, field_key string, field_value string, field_order int")
    out = J.time_metrics(tickets, attrs, [{"code": "m", "start_field": "s", "end_field": "e"}], W.overrides_df(spark))
    st = {r.ticket_id: (r.status, r.business_minutes) for r in out["rows"].collect()}
    assert st == {1: ("success", 776), 2: ("missing_both", None)}
    o = _t(spark, "orders").select("o_orderkey", F.date_format("o_orderdate", "yyyy-MM").alias("m"))
    s = J.sample_details(o, ["m"], "o_orderkey", 2, seed="1")
    assert s["sample"].groupBy("m").count().where("count > 2").count() == 0
    assert s["counts"].agg(F.sum("row_count")).first()[0] == o.count()


def test_service_views_and_loaders(spark):
    hist = spark.createDataFrame([("1", 1, "n", "t", "p", "c", dt.datetime(2026, 1, 1), None)],
                                 "customer_id string, version_no int, customer_name string, customer_type string,"
                                 " province string, city string, effective_from timestamp_ntz, effective_to timestamp_ntz")
    chist = spark.createDataFrame([("9", 1, "cn", "1", "n", "d", "p", dt.datetime(2026, 1, 1), None)],
                                  "contact_id string, version_no int, contact_name string, customer_id string, customer_name string,"
                                  " department_name string, position_name string, effective_from timestamp_ntz, effective_to timestamp_ntz")
    tickets = spark.createDataFrame([(10, "1", "9", "4", dt.datetime(2026, 2, 1), dt.datetime(2026, 2, 2))],
                                    "ticket_id long, company_id string, cust_user_id string, ticket_status string,"
                                    " create_dt timestamp_ntz, solve_dt timestamp_ntz")
    customers = spark.createDataFrame([("1",)], "customer_id string")
    contacts = spark.createDataFrame([("9", "1", "138", "")], "contact_id string, customer_id string, phone string, email string")
    v = J.service_views(hist, chist, tickets, customers, contacts)
    assert v["customer_overview"].first().ticket_count == 1 and v["customer_overview"].first().avg_resolution_seconds == 86400
    assert v["contact_overview"].first().resolved_ticket_count == 1
    q = v["quality"].first()
    assert (q.customer_count, q.contact_count, q.linked_contact_count, q.email_covered_contact_count) == (1, 1, 1, 0)
    cells = spark.createDataFrame([(["1", "A", None, "1,234.50"],), (["2", "", None, "5"],)], "cells array<string>")
    acc = J.load_accounts(cells, ["id", "customer_name", "customer_name2", "balance"], "20260713", money=["balance"])
    assert [(r.id, r.balance) for r in acc.collect()] == [("1", Decimal("1234.50"))]
    rows = spark.createDataFrame([("1000012.0", "张"), ("", "x"), (" ", " ")], "`工号` string, `姓名` string")
    cur = spark.createDataFrame([("1000012", "旧")], "employee_no string, name string")
    p = J.load_personnel(rows, cur, {"工号": "employee_no", "姓名": "name"}).collect()
    assert [(r.employee_no, r.name, r.outcome) for r in p] == [("1000012", "张", "updated")]


def test_resolve_tickets_names_without_the_rows(spark, monkeypatch):
    """The names of the custom fields come from their keys, not from a first run of the whole resolve; ids and kinds that
    read alike when joined stay apart."""
    from quaystone.operators import tickets as T
    monkeypatch.setattr(T, "field_name_codes", lambda *a: pytest.fail("the resolved rows were read for the names"))
    details = spark.createDataFrame([("1", "0", [("p", "广东省"), ("x", "1:y"), ("x1", ":y"), (None, "z"), (" p ", "湖南省")]), ("2", None, None)],
                                    "ticketId string, servicerUserId string, custom_fields array<struct<key:string,value:string>>")
    pairs = lambda rows, names: spark.createDataFrame(rows, names)
    out = J.resolve_tickets(
        details, contacts=pairs([("c", "C")], "cId string, realName string"), agents=pairs([("0", "zero")], "sId string, name string"),
        groups=pairs([("1", "g")], "gId string, name string"), templates=pairs([("1", "t")], "tId string, name string"),
        field_options=pairs([("x", "1:y", "first"), ("x1", ":y", "second")], "field_key string, option_key string, option_value string"),
        global_options=pairs([("z", "any")], "option_key string, option_value string"),
        field_names=pairs([("p", "省份"), ("p", "省份2"), ("x", " ")], "key string, name string"))
    rows = {r.ticketId: r for r in out.collect()}
    assert [(f.key, f.value) for f in rows["1"].resolved_fields] == [
        ("省份", "广东省"), ("x", "first"), ("x1", "second"), (None, "any"), ("省份", "湖南省")]
    assert rows["1"].province == "广东省" and rows["1"].servicer_user_name is None and rows["2"].province is None
