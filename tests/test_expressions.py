import datetime as dt

import pytest
from pyspark.sql import functions as F

from quaystone.functions.codes import TICKET_ENUMS, clean_region_text
from quaystone.functions.dates import contract_date, metric_datetime, snapshot_date_text, strict_datetime
from quaystone.functions.numbers import parse_number
from quaystone.operators.contracts import shared_amount
from quaystone.operators.tickets import decode_enums, split_id_list


@pytest.mark.parametrize("text,expected", [("1000", 1000.0), ("1,000", 1000.0), ("25%", 0.25), ("", 0.0),
                                           ("/", 0.0), (None, 0.0), (" 1，234.5 ", 1234.5), ("abc", 0.0)])
def test_parse_number(spark, text, expected):
    got = spark.createDataFrame([(text,)], "s string").select(parse_number("s").alias("x")).first().x
    assert got == pytest.approx(expected)


def test_shared_amount(spark):
    df = spark.createDataFrame([("1000", "0.25"), ("1,000", "25%")], "a string, r string")
    got = [r.x for r in df.select(shared_amount(F.col("a"), F.col("r")).alias("x")).collect()]
    assert got == [250.0, 250.0]


@pytest.mark.parametrize("text,expected", [
    ("2026-07-13", dt.date(2026, 7, 13)), ("20260713", dt.date(2026, 7, 13)), ("2026/07/13", dt.date(2026, 7, 13)),
    ("/", None), ("0000-12-30", None), ("0", None), ("", None), ("2026-02-30", None), ("junk", None)])
def test_contract_date(spark, text, expected):
    got = spark.createDataFrame([(text,)], "s string").select(contract_date("s").alias("x")).first().x
    assert got == expected


def test_snapshot_date(spark):
    got = spark.createDataFrame([("20260713165231",)], "s string").select(snapshot_date_text("s").alias("x")).first().x
    assert got == "20260713"


def test_metric_datetime_legacy_iso_reads_midnight(spark):
    df = spark.createDataFrame([("2026-06-16T10:23:55",)], "s string")
    r = df.select(metric_datetime("s").alias("a"), metric_datetime("s", legacy=False).alias("b")).first()
    assert r.a == dt.datetime(2026, 6, 16) and r.b == dt.datetime(2026, 6, 16, 10, 23, 55)


def test_strict_datetime(spark):
    df = spark.createDataFrame([("2026-06-16 10:23:55",), ("0",), ("2026/06/16",), ("2026-06-16",)], "s string")
    got = [r.x for r in df.select(strict_datetime("s").alias("x")).collect()]
    assert got == [dt.datetime(2026, 6, 16, 10, 23, 55), None, None, dt.datetime(2026, 6, 16)]


def test_enum_decode(spark):
    df = spark.createDataFrame([("2", "3", "4", "0", "0"), ("99", "", "4", "1", "1")],
                               "ticketType string, priorityLevel string, ticketStatus string, createrType string, isDeleted string")
    rows = [tuple(r) for r in decode_enums(df, TICKET_ENUMS).collect()]
    assert rows[0] == ("事务", "高", "已解决", "客服", "否")
    assert rows[1] == ("99", "", "已解决", "客户", "是")


def test_id_lists(spark):
    df = spark.createDataFrame([("1,2,3",), ("1，2，3",), (" 1, ,2 ",)], "s string")
    assert [len(r.x) for r in df.select(split_id_list("s").alias("x")).collect()] == [3, 3, 2]


def test_region_clean(spark):
    df = spark.createDataFrame([("140000 山西省",), ("010 北京市",), ("010",), ("武汉(420100)市",)], "s string")
    got = [r.x for r in df.select(clean_region_text("s").alias("x")).collect()]
    assert got == ["山西省", "北京市", "010", "武汉市"]


def test_option_decode_lists_and_objects(spark):
    from quaystone.operators.tickets import decode_field_values
    eav = spark.createDataFrame([(1, 1, "f_status", '["1","2"]'), (1, 2, "f_status", '{"status":"1"}'),
                                 (1, 3, "f_status", "2"), (1, 4, "f_other", "1"), (1, 5, "f_other", "9"),
                                 (1, 6, "f_status", "")],
                                "ticket_id int, field_order int, field_key string, field_value string")
    fo = spark.createDataFrame([("f_status", "1", "待处理"), ("f_status", "2", "处理中")],
                               "field_key string, option_key string, option_value string")
    go = spark.createDataFrame([("1", "全局一")], "option_key string, option_value string")
    out = {r.field_order: r.decoded_value
           for r in decode_field_values(eav, fo, go, row_keys=["ticket_id", "field_order"]).collect()}
    assert out == {1: '["待处理","处理中"]', 2: '{"status":"待处理"}', 3: "处理中", 4: "全局一", 5: "9", 6: ""}


@pytest.mark.parametrize("text,expected", [
    ("2026-07-13", "20260713"), ("2026/7/3", "20260703"), ("20260713", "20260713"),
    ("2026-07-13 10:00:00", "20260713"), ("2026-07-13T10:00:00", "20260713"), (" / ", "/"), ("", ""),
    (None, ""), ("abc", "abc"), ("2026-13-01", "2026-13-01")])
def test_merge_date_text(spark, text, expected):
    from quaystone.functions.dates import merge_date_text
    got = spark.createDataFrame([(text,)], "s string").select(merge_date_text("s").alias("x")).first().x
    assert got == expected
