import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from quaystone.plans import jobs as J
from quaystone.plans import q_jobs as Q
from quaystone.sources import layout as L


def _plan(df):
    spark = df.sparkSession
    spark.conf.set("spark.sql.debug.maxToStringFields", "10000")
    try:
        return df._jdf.queryExecution().optimizedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.debug.maxToStringFields")


def test_each_cell_is_stripped_once(spark):
    sheet = spark.createDataFrame([(1, " 1 ")], "id int, cell string")
    sheet = sheet.select("id", *[F.concat("cell", F.lit(str(i))).alias(h) for i, (h, _) in enumerate(L.STANDARD_LAYOUT)])
    sheet = sheet.localCheckpoint()
    assert _plan(J.typed_snapshot(sheet, keep=["id"])).count("trim(") == len(L.STANDARD_LAYOUT)


def test_shared_texts_are_written_once_per_line(spark):
    li = spark.createDataFrame([(1, 2, 3.0, 4.5, "R", dt.datetime(2026, 1, 5))],
                               "l_linenumber int, l_partkey long, l_quantity double, l_extendedprice double, l_returnflag string, l_shipdate timestamp_ntz")
    li = li.localCheckpoint()
    plan = _plan(Q.cell_forms(li).select(*[text.alias(column) for _, column, text in Q.cell_texts()]))
    assert plan.count("format_number(") == 1 and plan.count("date_format(") == 2


def test_odd_cells(spark):
    name = {c: h for h, c in L.STANDARD_LAYOUT}
    cells = {"unit_price": [" 1,234.565 ", "12%", "1d", "NaN", "0x1p3", "Infinity", ",", "+.5", "1e2", "-", "x", None],
             "detail_qty": ["1,000", " -7.0", "1e999", "7f", "", "99999999999", "5.", ".", "１", "+", "/", None],
             "ops_end_date": ["20260105", "2026/01/05 10:11", "2026-02-30", "0000-12-30", "/", " 2026-01-05T10:11:12.5 ", "2026-1-5", "20261301",
                              "9999-12-31", "2026-01-05x", "0", None]}
    rows = [(i, *[cells[c][i] for c in cells]) for i in range(12)]
    sheet = spark.createDataFrame(rows, "id int, " + ", ".join(f"`{name[c]}` string" for c in cells))
    found = J.typed_snapshot(sheet, keep=["id"]).orderBy("id").collect()
    day, none = dt.date(2026, 1, 5), [None]
    assert [r.unit_price for r in found] == [Decimal("1234.57"), *none * 6, Decimal("0.50"), Decimal("100.00"), *none * 3]
    assert [r.detail_qty for r in found] == [None, -7, *none * 4, 5, *none * 5]
    assert [r.ops_end_date for r in found] == [day, day, *none * 3, day, *none * 2, dt.date(9999, 12, 31), *none * 3]
