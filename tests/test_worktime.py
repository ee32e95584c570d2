import datetime as dt

import pytest
from pyspark.sql import functions as F

from quaystone.operators import worktime as W

T = dt.datetime


@pytest.mark.parametrize("s,e,overrides,minutes", [
    (T(2026, 6, 16, 10, 23, 55), T(2026, 6, 18, 3, 21, 18), {}, 776),
    (T(2026, 6, 16, 10, 0), T(2026, 6, 18, 10, 0), {"2026-06-17": False}, 430),
    (T(2026, 1, 4, 9, 0), T(2026, 1, 4, 18, 0), {"2026-01-04": True}, 430),
    (T(2026, 1, 4, 9, 0), T(2026, 1, 4, 8, 0), {}, 0),
])
def test_business_minutes_both_forms(spark, s, e, overrides, minutes):
    spans = spark.createDataFrame([(1, s, e)], "id int, s timestamp_ntz, e timestamp_ntz")
    ov = W.overrides_df(spark, overrides)
    a = W.business_seconds_prefix(spans, "s", "e", ov).first().business_seconds // 60
    b = W.business_seconds_explode(spans, "s", "e", ov, key=["id"]).first().business_seconds // 60
    assert a == b == minutes


def test_additive_over_split(spark):
    s, m, e = T(2026, 3, 2, 10, 0), T(2026, 3, 5, 12, 30), T(2026, 3, 11, 17, 0)
    spans = spark.createDataFrame([(1, s, e), (2, s, m), (3, m, e)], "id int, s timestamp_ntz, e timestamp_ntz")
    got = {r.id: r.business_seconds for r in W.business_seconds_prefix(spans, "s", "e", W.overrides_df(spark)).collect()}
    assert got[1] == got[2] + got[3]


def test_metric_statuses(spark):
    tickets = spark.createDataFrame([(i,) for i in range(7)], "ticket_id int")
    vals = [(1, "a", "2026-06-16 10:23:55"), (2, "b", "2026-06-16 10:23:55"),
            (3, "a", "2026-06-16 10:23:55"), (3, "b", "2026-06-18 03:21:18"),
            (4, "a", "junk"), (4, "b", "2026-06-18"), (5, "a", "2026-06-18"), (5, "b", "bad"),
            (6, "a", "2026-06-18"), (6, "b", "2026-06-17")]
    values = spark.createDataFrame(vals, "ticket_id int, field_key string, field_value string") \
        .withColumn("field_order", F.lit(1))
    defs = [{"code": "m", "start_field": "a", "end_field": "b"}]
    wide = tickets.join(W.field_columns(values, ["ticket_id"], defs), "ticket_id", "left")
    rows = {r.ticket_id: r for r in W.metric_rows(wide, defs, W.overrides_df(spark)).collect()}
    assert [rows[i].status for i in range(7)] == ["missing_both", "missing_end", "missing_start", "success",
                                                  "invalid_start", "invalid_end", "invalid_time_order"]
    assert rows[3].raw_minutes == 2457 and rows[3].business_minutes == 776


def test_first_field_value_and_iso_text(spark):
    attrs = spark.createDataFrame(
        [(1, "a", "2026-06-16T10:23:55", None), (1, "a", "2026-06-16T09:00:00", 3), (1, "b", "2026-06-16T10:00:00", 1),
         (2, "c", "x", 1)], "ticket_id int, field_key string, field_value string, field_order int")
    defs = [{"code": "m", "start_field": "a", "end_field": "b"}]
    wide = W.field_columns(attrs, ["ticket_id"], defs)
    plan = wide._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "Join" not in plan
    rows = {r.ticket_id: r for r in W.metric_rows(wide, defs, {}).collect()}
    assert (rows[1].status, rows[1].raw_minutes, rows[2].status) == ("success", 60, "missing_both")
    old = {r.ticket_id: r for r in W.metric_rows(wide, defs, {}, legacy_iso=True).collect()}
    assert old[1].raw_minutes == 0


def test_closed_form_matches_explode_random(spark):
    import random
    rnd = random.Random(7)
    base = T(2026, 1, 1)
    rows = []
    for i in range(400):
        s = base + dt.timedelta(seconds=rnd.randrange(0, 120 * 86400))
        e = s + dt.timedelta(seconds=rnd.choice([rnd.randrange(0, 86400), rnd.randrange(0, 40 * 86400)]))
        if i % 17 == 0:
            e = s - dt.timedelta(hours=1)
        rows.append((i, s, e))
    spans = spark.createDataFrame(rows, "id int, s timestamp_ntz, e timestamp_ntz")
    ov = {"2026-01-01": False, "2026-01-04": True, "2026-02-16": False, "2026-02-28": True, "2026-03-02": False,
          "2026-03-03": True}
    a = {r.id: r.business_seconds for r in W.business_seconds_closed(spans, "s", "e", ov).collect()}
    b = {r.id: r.business_seconds for r in W.business_seconds_explode(spans, "s", "e", W.overrides_df(spark, ov),
                                                                       key=["id"]).collect()}
    c = {r.id: r.business_seconds for r in W.business_seconds_prefix(spans, "s", "e", W.overrides_df(spark, ov)).collect()}
    assert a == b == c


@pytest.mark.parametrize("s,e,overrides,minutes", [
    (T(2026, 6, 16, 10, 23, 55), T(2026, 6, 18, 3, 21, 18), {}, 776),
    (T(2026, 6, 16, 10, 0), T(2026, 6, 18, 10, 0), {"2026-06-17": False}, 430),
    (T(2026, 1, 4, 9, 0), T(2026, 1, 4, 18, 0), {"2026-01-04": True}, 430),
])
def test_closed_form_reference_values(spark, s, e, overrides, minutes):
    spans = spark.createDataFrame([(1, s, e)], "id int, s timestamp_ntz, e timestamp_ntz")
    assert W.business_seconds_closed(spans, "s", "e", overrides).first().business_seconds // 60 == minutes
