import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from quaystone.operators import revenue as R
from quaystone.operators.sampling import latest_snapshot


def test_build_revenue_rows(spark):
    targets = spark.createDataFrame([("A", Decimal("100")), ("B", Decimal("50")), ("C", Decimal("100.5"))],
                                    "sales_platform string, revenue_target decimal(18,1)")
    raw = [("A", 20, 18, 10, 30, 15, 40, 20), ("B", 0, None, 0, 5, 0, 0, 0),
           ("C", Decimal("10.5"), None, None, None, None, None, None)]
    metrics = spark.createDataFrame(
        [tuple(x if isinstance(x, (str, type(None))) else Decimal(x) for x in r) for r in raw],
        "sales_platform string, recognized_revenue decimal(18,1), recognized_revenue_excluding_estimate decimal(18,1),"
        " prior_year_recognized_revenue decimal(18,1), contracts_on_hand_amount decimal(18,1),"
        " prior_year_contracts_on_hand_amount decimal(18,1), signing_completed_amount decimal(18,1),"
        " prior_year_signing_amount decimal(18,1)")
    rows = {r.sales_platform: r for r in R.build_revenue_rows(targets, metrics, 2026, 6).collect()}
    a = rows["A"]
    assert a.revenue_completion_rate == Decimal("0.200000")
    assert a.contracts_on_hand_yoy_amount == 15 and a.contracts_on_hand_yoy_rate == Decimal("1.000000")
    assert a.recognized_revenue_yoy_rate == Decimal("0.800000")
    assert a.signing_yoy_rate == Decimal("1.000000")
    b = rows["B"]
    assert b.revenue_completion_rate == Decimal("0.000000")
    assert b.contracts_on_hand_yoy_rate is None and b.recognized_revenue_yoy_rate is None and b.signing_yoy_rate is None
    c = rows["C"]
    assert c.revenue_target == 101 and c.recognized_revenue == 11


def test_total_row(spark):
    targets = spark.createDataFrame([("A", Decimal("100")), ("B", Decimal("0"))], "sales_platform string, revenue_target decimal(18,0)")
    metrics = spark.createDataFrame([("A", 20, 18, 10, 30, 15, 40, 20)],
                                    "sales_platform string, " + ", ".join(f"{m} int" for m in R.METRICS))
    out = R.with_total_rows(R.build_revenue_rows(targets, metrics, 2026, 6))
    total = out.where("sort_order = 0").first()
    assert total.sales_platform == "合计" and total.revenue_target == 100 and total.recognized_revenue == 20
    assert total.revenue_completion_rate == Decimal("0.200000")


def test_target_problems(spark):
    raw = spark.createDataFrame([(2026, 6, "A", 1.0), (2026, 6, "A", 2.0), (2026, 6, "B", None), (2026, 6, "合计", 3.0),
                                 (2026, 6, " ", 1.0), (2026, 6, "C", 5.0)],
                                "year int, month int, sales_platform string, revenue_target double")
    probs = {r.sales_platform for r in R.target_problems(raw).collect()}
    assert probs == {"A", "B"}


def test_platform_table_gives_the_sums_of_joined_lines(spark):
    flags = {**R.ELIGIBLE_VALUES, "is_estimated_ops": "否"}
    lines = spark.createDataFrame([(k, Decimal(n), Decimal(n), Decimal(1), Decimal(1), Decimal(1), dt.date(2026, 2, 1), *flags.values())
                                   for k, n in ((1, 10), (1, 5), (2, 7), (3, 9), (None, 4))],
                                  "k long, cur_year_revenue decimal(18,2), prev_year_revenue decimal(18,2), cur_year_adjusted_amort decimal(18,2), "
                                  "prev_year_adjusted_amort decimal(18,2), product_amount decimal(18,2), contract_apply_date date, "
                                  + ", ".join(f"{c} string" for c in flags))
    # key 1 twice, key 2 without a name, key 3 not named at all
    platforms = spark.createDataFrame([(1, " A"), (1, "B"), (2, " "), (None, "C")], "k long, sales_platform string")
    got = R.revenue_metrics(lines, 2026, 6, platforms=platforms)
    joined = R.revenue_metrics(lines.join(platforms, "k", "left"), 2026, 6)
    assert got.schema == joined.schema
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, joined.collect()))
    assert {r.sales_platform: int(r.recognized_revenue) for r in got.collect()} == {"A": 15, "B": 15}


def test_rows_of_older_snapshots_are_not_read(spark):
    lines = spark.range(10).withColumnRenamed("id", "line")
    both = lines.withColumn("create_date", F.lit("20260713")).unionByName(
        lines.where("line < 3").withColumn("create_date", F.lit("20260601")))
    newest = latest_snapshot(both)
    assert "Union" not in newest._jdf.queryExecution().optimizedPlan().toString()
    assert newest.count() == 10
    assert latest_snapshot(both.where("line > 20")).count() == 0
