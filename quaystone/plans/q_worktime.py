"""Registered queries: working time and metric rows on events."""

from __future__ import annotations

from pyspark.sql import functions as F

from quaystone.operators import worktime as W
from quaystone.plans import jobs as J
from quaystone.plans.tables import table

# Calendar parameters for January 2024 (holiday, make-up Saturday, holiday).
OVERRIDES = {"2024-01-01": False, "2024-01-06": True, "2024-01-15": False}
METRICS = [
    {"code": "signup_to_purchase", "name": "signup to purchase", "start_field": "signup", "end_field": "purchase"},
    {"code": "view_to_click", "name": "view to click", "start_field": "view", "end_field": "click"},
    {"code": "click_to_error", "name": "click to error", "start_field": "click", "end_field": "error"},
]


def event_spans(spark, sf_dir):
    ev = table(spark, sf_dir, "events")
    start = F.date_trunc("second", F.col("ts")).cast("timestamp_ntz")
    return ev.select("event_id", start.alias("start_ts"),
                     F.timestamp_add("SECOND", F.floor(F.col("value") * 600), start).alias("end_ts"))


def q_worktime_minutes(spark, sf_dir):
    spans = event_spans(spark, sf_dir)
    out = W.business_seconds_prefix(spans, "start_ts", "end_ts", W.overrides_df(spark, OVERRIDES))
    return out.select("event_id", "start_ts", "end_ts",
                      F.floor(F.col("business_seconds") / 60).cast("long").alias("business_minutes"))


def q_worktime_minutes_closed(spark, sf_dir):
    spans = event_spans(spark, sf_dir)
    out = W.business_seconds_closed(spans, "start_ts", "end_ts", OVERRIDES)
    return out.select("event_id", "start_ts", "end_ts",
                      F.floor(F.col("business_seconds") / 60).cast("long").alias("business_minutes"))


def q_worktime_minutes_explode(spark, sf_dir):
    spans = event_spans(spark, sf_dir)
    secs = W.business_seconds_explode(spans, "start_ts", "end_ts", W.overrides_df(spark, OVERRIDES),
                                      key=["event_id"])
    return spans.join(secs, "event_id").select(
        "event_id", "start_ts", "end_ts", F.floor(F.col("business_seconds") / 60).cast("long").alias("business_minutes"))


def ticket_attributes(spark, sf_dir):
    """events as attribute rows of tickets (user, day): field = event type, order = event id."""
    ev = table(spark, sf_dir, "events")
    text = (F.when(F.col("value") < 2, F.lit("n/a"))
            .when(F.col("value") < 3, F.date_format("ts", "yyyy/MM/dd"))
            .otherwise(F.date_format("ts", "yyyy-MM-dd HH:mm:ss")))
    return ev.select("user_id", F.to_date("ts").alias("day"), F.col("event_type").alias("field_key"),
                     text.alias("field_value"), F.col("event_id").alias("field_order"))


def _metric_rows(spark, sf_dir):
    wide = W.field_columns(ticket_attributes(spark, sf_dir), ["user_id", "day"], METRICS)
    return W.metric_rows(wide, METRICS, OVERRIDES)


def q_metric_rows(spark, sf_dir):
    return _metric_rows(spark, sf_dir).select(
        "user_id", "day", "metric_code", "start_time", "end_time", "raw_minutes", "business_minutes", "status")


def q_metric_status(spark, sf_dir):
    attrs = ticket_attributes(spark, sf_dir)
    tickets = attrs.select("user_id", "day").distinct()
    return J.time_metrics(tickets, attrs, METRICS, OVERRIDES, ["user_id", "day"])["counts"]


def q_first_value(spark, sf_dir):
    attrs = ticket_attributes(spark, sf_dir)
    return W.first_field_values(attrs, ["user_id", "day"])


# -- SQL twins -------------------------------------------------------------------

_CAL = """
ov(day, is_workday) AS (VALUES (DATE '2024-01-01', false), (DATE '2024-01-06', true), (DATE '2024-01-15', false)),
ses(ss, se) AS (VALUES (32400, 42600), (49200, 64800))"""


def _bsec(spans: str, key: str) -> str:
    """CTE bsec(key..., business_seconds) by exploding days x sessions of ``spans``(key, s, e)."""
    return f"""
bdays AS (
  SELECT {key}, s, e, CAST(unnest(generate_series(CAST(s AS DATE), CAST(e AS DATE), INTERVAL 1 DAY)) AS DATE) AS day
  FROM {spans} WHERE e > s),
bwork AS (
  SELECT d.* FROM bdays d LEFT JOIN ov ON d.day = ov.day
  WHERE COALESCE(ov.is_workday, isodow(d.day) < 6)),
bsec AS (
  SELECT {key}, SUM(greatest(0, date_diff('second',
           greatest(s, CAST(day AS TIMESTAMP) + to_seconds(ss)),
           least(e, CAST(day AS TIMESTAMP) + to_seconds(se))))) AS business_seconds
  FROM bwork CROSS JOIN ses GROUP BY {key})"""


_SPANS = """
spans AS (
  SELECT event_id, date_trunc('second', ts) AS s,
         date_trunc('second', ts) + to_seconds(CAST(floor(value * 600) AS BIGINT)) AS e
  FROM events)"""

_WORKTIME_SQL = "WITH " + _CAL.strip() + "," + _SPANS + "," + _bsec("spans", "event_id") + """
SELECT sp.event_id, sp.s AS start_ts, sp.e AS end_ts,
       CAST(floor(COALESCE(b.business_seconds, 0) / 60) AS BIGINT) AS business_minutes
FROM spans sp LEFT JOIN bsec b ON sp.event_id = b.event_id"""

_ATTRS = """
attrs AS (
  SELECT user_id, CAST(ts AS DATE) AS day, event_type AS field_key,
    CASE WHEN value < 2 THEN 'n/a' WHEN value < 3 THEN strftime(ts, '%Y/%m/%d')
         ELSE strftime(ts, '%Y-%m-%d %H:%M:%S') END AS field_value,
    event_id AS field_order
  FROM events)"""


def _parse(x: str) -> str:
    t = f"replace(trim({x}), '/', '-')"
    return (f"(CASE WHEN regexp_full_match(substr({t}, 1, 19), '\\d{{4}}-\\d{{1,2}}-\\d{{1,2}} \\d{{1,2}}:\\d{{1,2}}:\\d{{1,2}}')"
            f" THEN try_strptime(substr({t}, 1, 19), '%Y-%m-%d %H:%M:%S')"
            f" WHEN regexp_full_match(substr({t}, 1, 16), '\\d{{4}}-\\d{{1,2}}-\\d{{1,2}} \\d{{1,2}}:\\d{{1,2}}')"
            f" THEN try_strptime(substr({t}, 1, 16), '%Y-%m-%d %H:%M')"
            f" WHEN regexp_full_match(substr({t}, 1, 10), '\\d{{4}}-\\d{{1,2}}-\\d{{1,2}}')"
            f" THEN try_strptime(substr({t}, 1, 10), '%Y-%m-%d') END)")


_METRICS_VALUES = ", ".join(f"('{m['code']}', '{m['start_field']}', '{m['end_field']}')" for m in METRICS)

_METRIC_BASE = "WITH " + _CAL.strip() + "," + _ATTRS + f""",
defs(metric_code, start_field, end_field) AS (VALUES {_METRICS_VALUES}),
tickets AS (SELECT DISTINCT user_id, day FROM attrs),
vals AS (SELECT user_id, day, field_key, arg_min(field_value, field_order) AS field_value
         FROM attrs WHERE field_key IN ('click', 'error', 'purchase', 'signup', 'view') GROUP BY ALL),
j AS (
  SELECT t.user_id, t.day, d.metric_code,
    NULLIF(trim(sv.field_value), '') AS st, NULLIF(trim(ev.field_value), '') AS et
  FROM tickets t CROSS JOIN defs d
  LEFT JOIN vals sv ON sv.user_id = t.user_id AND sv.day = t.day AND sv.field_key = d.start_field
  LEFT JOIN vals ev ON ev.user_id = t.user_id AND ev.day = t.day AND ev.field_key = d.end_field),
p AS (SELECT *, {_parse('st')} AS sp, {_parse('et')} AS ep FROM j),
r AS (
  SELECT *, CASE WHEN st IS NULL AND et IS NULL THEN 'missing_both' WHEN st IS NULL THEN 'missing_start'
    WHEN et IS NULL THEN 'missing_end' WHEN sp IS NULL THEN 'invalid_start' WHEN ep IS NULL THEN 'invalid_end'
    WHEN ep < sp THEN 'invalid_time_order' ELSE 'success' END AS status
  FROM p),
mspans AS (SELECT user_id, day, metric_code, sp AS s, ep AS e FROM r WHERE status = 'success'),
""" + _bsec("mspans", "user_id, day, metric_code").strip() + """,
rows AS (
  SELECT r.user_id, r.day, r.metric_code,
    CASE WHEN status = 'success' THEN strftime(sp, '%Y-%m-%d %H:%M:%S') ELSE st END AS start_time,
    CASE WHEN status = 'success' THEN strftime(ep, '%Y-%m-%d %H:%M:%S') ELSE et END AS end_time,
    CASE WHEN status = 'success' THEN CAST(floor(date_diff('second', sp, ep) / 60) AS BIGINT) END AS raw_minutes,
    CASE WHEN status = 'success' THEN CAST(floor(COALESCE(b.business_seconds, 0) / 60) AS BIGINT) END AS business_minutes,
    status
  FROM r LEFT JOIN bsec b ON b.user_id = r.user_id AND b.day = r.day AND b.metric_code = r.metric_code)
"""

QUERIES = {
    "worktime_minutes": q_worktime_minutes,
    "worktime_minutes_explode": q_worktime_minutes_explode,
    "worktime_minutes_closed": q_worktime_minutes_closed,
    "metric_rows": q_metric_rows,
    "metric_status": q_metric_status,
    "first_value": q_first_value,
}

SQL = {
    "worktime_minutes": _WORKTIME_SQL,
    "worktime_minutes_explode": _WORKTIME_SQL,
    "worktime_minutes_closed": _WORKTIME_SQL,
    "metric_rows": _METRIC_BASE + "SELECT * FROM rows",
    "metric_status": _METRIC_BASE + "SELECT metric_code, status, COUNT(*) AS n FROM rows GROUP BY ALL",
    "first_value": "WITH " + _ATTRS.strip() + """
SELECT user_id, day, field_key, arg_min(field_value, field_order) AS field_value FROM attrs GROUP BY ALL""",
}
