"""Working time on a holiday-aware calendar, and the metric rows built on it.

Two forms of the calendar overlap (J20):
  * explode form: one row per (span, day, session) -- simple, rows grow with span length;
  * prefix form: working seconds W(t) from a cumulative per-day table, W(end) - W(start);
    rows do not grow with span length. The day table spans the data's date range only
    (bounded by days in that range), so it is broadcast.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quaystone.functions.dates import metric_datetime
from quaystone.functions.text import strip_all

# Default work sessions (wall clock).
DEFAULT_SESSIONS = (("09:00", "11:50"), ("13:40", "18:00"))
# Metric outcome order.
STATUSES = ("missing_both", "missing_start", "missing_end", "invalid_start", "invalid_end",
            "invalid_time_order", "success")


def _sec(hhmm: str) -> int:
    t = _dt.time.fromisoformat(hhmm)
    return t.hour * 3600 + t.minute * 60 + t.second


def overrides_df(spark: SparkSession, overrides: Mapping[str, bool] | None = None) -> DataFrame:
    rows = [(_dt.date.fromisoformat(d), bool(v)) for d, v in (overrides or {}).items()]
    return spark.createDataFrame(rows, "day date, is_workday boolean")


def _tod_seconds(ts: Column) -> Column:
    return F.hour(ts) * 3600 + F.minute(ts) * 60 + F.second(ts)


def _is_workday(day: Column, override: Column) -> Column:
    # dayofweek: 1 = Sunday ... 7 = Saturday
    return F.coalesce(override, ~F.dayofweek(day).isin(1, 7))


def _session_array(sessions) -> Column:
    """Work sessions (driver-side config, a handful) as a literal array of (ss, se) seconds."""
    pairs = [(_sec(a), _sec(b)) for a, b in sessions]
    return F.array(*[F.struct(F.lit(a).alias("ss"), F.lit(b).alias("se")) for a, b in pairs])


def business_seconds_explode(spans: DataFrame, start: str, end: str, overrides: DataFrame,
                             sessions=DEFAULT_SESSIONS, key: Sequence[str] = ()) -> DataFrame:
    """Working seconds in [start, end) per ``key`` by exploding days x sessions."""
    valid = spans.where(F.col(end) > F.col(start))
    days = valid.select(*key, start, end,
                        F.explode(F.sequence(F.to_date(start), F.to_date(end))).alias("day"))
    ov = overrides.select("day", F.col("is_workday").alias("__ov"))
    days = days.join(ov, "day", "left").where(_is_workday(F.col("day"), F.col("__ov")))
    ses = days.select("*", F.explode(_session_array(sessions)).alias("__ses")) \
        .select("*", F.col("__ses.ss").alias("ss"), F.col("__ses.se").alias("se")).drop("__ses")
    day_ts = F.col("day").cast("timestamp_ntz")
    ws = F.timestamp_add("SECOND", F.col("ss"), day_ts)
    we = F.timestamp_add("SECOND", F.col("se"), day_ts)
    lo = F.greatest(F.col(start), ws)
    hi = F.least(F.col(end), we)
    secs = F.greatest(F.timestamp_diff("SECOND", lo, hi), F.lit(0))
    summed = ses.groupBy(*key).agg(F.sum(secs).alias("business_seconds"))
    return spans.select(*key).join(summed, list(key), "left") \
        .select(*key, F.coalesce("business_seconds", F.lit(0)).cast("long").alias("business_seconds"))


def day_table(spans: DataFrame, start: str, end: str, overrides: DataFrame, sessions=DEFAULT_SESSIONS) -> DataFrame:
    """(day, is_work, cum_before): cumulative working seconds of all whole days before ``day``,
    over the date range of the spans (one row per day in the range)."""
    work_per_day = sum(_sec(b) - _sec(a) for a, b in sessions)
    rng = spans.agg(F.min(F.to_date(start)).alias("lo"), F.max(F.to_date(end)).alias("hi"))
    days = rng.select(F.explode(F.sequence("lo", "hi")).alias("day"))
    ov = overrides.select("day", F.col("is_workday").alias("__ov"))
    d = days.join(ov, "day", "left")
    d = d.select("day", _is_workday(F.col("day"), F.col("__ov")).alias("is_work"), F.lit(work_per_day).alias("w"))
    w = Window.orderBy("day").rowsBetween(Window.unboundedPreceding, -1)
    return d.select("day", "is_work",
                    F.coalesce(F.sum(F.when(F.col("is_work"), F.col("w")).otherwise(0)).over(w), F.lit(0))
                    .cast("long").alias("cum_before"))


def _partial(ts: Column, sessions: Sequence[tuple[int, int]]) -> Column:
    """Working seconds of a workday before time-of-day ``ts``."""
    tod = _tod_seconds(ts)
    total = F.lit(0)
    for ss, se in sessions:
        total = total + F.least(F.greatest(tod - F.lit(ss), F.lit(0)), F.lit(se - ss))
    return total


def business_seconds_prefix(spans: DataFrame, start: str, end: str, overrides: DataFrame,
                            sessions=DEFAULT_SESSIONS, key: Sequence[str] = ()) -> DataFrame:
    """Working seconds in [start, end) as W(end) - W(start) with W from a cumulative day table.

    ``sessions`` are the session strings (driver-side config); the day table is bounded by
    the number of days in the data's range and is broadcast to both look-ups."""
    spark = spans.sparkSession
    ses = [(_sec(a), _sec(b)) for a, b in sessions]
    days = day_table(spans, start, end, overrides, sessions)
    days = days
    ds = days.select(F.col("day").alias("__ds"), F.col("is_work").alias("__ws"), F.col("cum_before").alias("__cs"))
    de = days.select(F.col("day").alias("__de"), F.col("is_work").alias("__we"), F.col("cum_before").alias("__ce"))
    j = spans.join(ds, F.to_date(spans[start]) == ds["__ds"], "left") \
             .join(de, F.to_date(spans[end]) == de["__de"], "left")
    w_start = F.col("__cs") + F.when(F.col("__ws"), _partial(F.col(start), ses)).otherwise(0)
    w_end = F.col("__ce") + F.when(F.col("__we"), _partial(F.col(end), ses)).otherwise(0)
    secs = F.when(F.col(end) > F.col(start), w_end - w_start).otherwise(F.lit(0))
    return j.select(*spans.columns, F.coalesce(secs, F.lit(0)).cast("long").alias("business_seconds"))


# -- metric rows (J15, W5, P36, A5) --------------------------------------------

def first_field_values(attrs: DataFrame, ticket_key: Sequence[str], field_keys: Sequence[str] | None = None) -> DataFrame:
    """First value per (ticket, field) by field order (W5); optional key filter."""
    rows = attrs if field_keys is None else attrs.where(F.col("field_key").isin(*field_keys))
    return rows.groupBy(*ticket_key, "field_key").agg(
        F.min_by("field_value", _field_rank()).alias("field_value"))


def _field_rank() -> Column:
    """Order of a field row; a row without an order comes last instead of hiding the others."""
    return F.struct(F.col("field_order").isNull(), F.col("field_order"))


def field_columns(attrs: DataFrame, ticket_key: Sequence[str], metrics: Sequence[Mapping]) -> DataFrame:
    """First values of the fields that the metrics name (S14 + W5), one row per ticket with one
    column per field: one scan, one grouped aggregation. A ticket without these fields keeps its
    row (all NULL)."""
    return attrs.groupBy(*ticket_key).agg(*[
        F.min_by("field_value", F.when(F.col("field_key") == k, _field_rank())).alias(f"__f{i}")
        for i, k in enumerate(_metric_fields(metrics))])


def _metric_fields(metrics: Sequence[Mapping]) -> list[str]:
    used = [m for m in metrics if m.get("enabled", True)]
    return sorted({str(m["start_field"]) for m in used} | {str(m["end_field"]) for m in used})


def metric_rows(wide: DataFrame, metrics: Sequence[Mapping], overrides, sessions=DEFAULT_SESSIONS,
                legacy_iso: bool = False) -> DataFrame:
    """One row per (ticket, metric) with status, raw and business minutes (J15 + P36).
    ``wide`` has one row per ticket with the columns of ``field_columns``; its other columns are
    kept. ``overrides`` is the calendar: a dict (day -> is_workday; closed form) or a (day,
    is_workday) DataFrame (prefix form). ``legacy_iso`` reads 'T' texts as midnight.

    The metric definitions are config: a literal array exploded per ticket, each element with its
    two field values, so no join is needed."""
    at = {k: F.col(f"__f{i}") for i, k in enumerate(_metric_fields(metrics))}
    keep = [c for c in wide.columns if c not in {f"__f{i}" for i in range(len(at))}]
    one = [F.struct(F.lit(str(m["code"])).alias("metric_code"),
                    F.lit(str(m.get("name") or m["code"])).alias("metric_name"),
                    F.lit(str(m["start_field"])).alias("start_field"), F.lit(str(m["end_field"])).alias("end_field"),
                    at[str(m["start_field"])].alias("__sv"), at[str(m["end_field"])].alias("__ev"))
           for m in metrics if m.get("enabled", True)]
    j = wide.select(*keep, F.explode(F.array(*one)).alias("__m")).select(*keep, "__m.*")
    texts = j.select(*keep, "metric_code", "metric_name", "start_field", "end_field",
                     F.nullif(strip_all("__sv"), F.lit("")).alias("start_text"),
                     F.nullif(strip_all("__ev"), F.lit("")).alias("end_text"))
    parsed = texts.select("*", metric_datetime("start_text", legacy_iso).alias("start_ts"),
                          metric_datetime("end_text", legacy_iso).alias("end_ts"))
    st, et, sp, ep = (F.col(c) for c in ("start_text", "end_text", "start_ts", "end_ts"))
    status = (F.when(st.isNull() & et.isNull(), "missing_both")
              .when(st.isNull(), "missing_start")
              .when(et.isNull(), "missing_end")
              .when(sp.isNull(), "invalid_start")
              .when(ep.isNull(), "invalid_end")
              .when(ep < sp, "invalid_time_order")
              .otherwise("success"))
    base = parsed.select("*", status.alias("status"))
    ok = F.col("status") == "success"
    spans = base.withColumn("__s", F.when(ok, F.col("start_ts"))).withColumn("__e", F.when(ok, F.col("end_ts")))
    if isinstance(overrides, DataFrame):
        timed = business_seconds_prefix(spans, "__s", "__e", overrides, sessions)
    else:  # calendar given as config: closed form, no day table
        timed = business_seconds_closed(spans, "__s", "__e", overrides, sessions)
    return timed.select(
        *keep, "metric_code", "metric_name", "start_field", "end_field",
        F.when(ok, F.date_format("start_ts", "yyyy-MM-dd HH:mm:ss")).otherwise(F.col("start_text")).alias("start_time"),
        F.when(ok, F.date_format("end_ts", "yyyy-MM-dd HH:mm:ss")).otherwise(F.col("end_text")).alias("end_time"),
        F.when(ok, F.floor(F.timestamp_diff("SECOND", F.col("start_ts"), F.col("end_ts")) / 60)).cast("long").alias("raw_minutes"),
        F.when(ok, F.floor(F.col("business_seconds") / 60)).cast("long").alias("business_minutes"),
        "status")


def status_counts(rows: DataFrame, by: Sequence[str] = ("metric_code",)) -> DataFrame:
    """Outcome counts (A5)."""
    return rows.groupBy(*by, "status").agg(F.count(F.lit(1)).alias("n"))


# -- closed form: no day table, no join --------------------------------------------------

def _weekdays_inclusive(a: Column, b: Column) -> Column:
    """Mon-Fri days in [a, b] (0 when b < a), by arithmetic on the day count and weekday."""
    n = F.datediff(b, a) + 1
    w0 = F.weekday(a)  # 0 = Monday
    r = F.pmod(n, F.lit(7))
    last = w0 + r - 1
    extra = (F.greatest(F.lit(0), F.least(last, F.lit(4)) - w0 + 1) +
             F.greatest(F.lit(0), F.least(last, F.lit(11)) - F.greatest(w0, F.lit(7)) + 1))
    return F.when(n > 0, F.floor(n / 7) * 5 + extra).otherwise(F.lit(0))


def business_seconds_closed(spans: DataFrame, start: str, end: str, overrides: Mapping[str, bool] | None = None,
                            sessions=DEFAULT_SESSIONS) -> DataFrame:
    """Working seconds in [start, end) in closed form (J20), per row, without a day table:

        same day:   work(d0) * (P(end) - P(start))
        otherwise:  work(d0) * (W - P(start)) + work(d1) * P(end) + W * workdays strictly between

    with P(t) the session seconds before t on its day and W the session seconds of a workday.
    Workdays between are weekdays by arithmetic plus the overrides' corrections; the overrides
    are calendar config (a literal map and array, sized by the calendar file)."""
    import datetime as _d

    ses = [(_sec(a), _sec(b)) for a, b in sessions]
    w_day = sum(b - a for a, b in ses)
    ov = {(_d.date.fromisoformat(k) if isinstance(k, str) else k): bool(v) for k, v in (overrides or {}).items()}
    s, e = F.col(start), F.col(end)
    d0, d1 = F.to_date(s), F.to_date(e)

    def work(d):
        weekday = F.weekday(d) < 5
        if not ov:
            return weekday
        m = F.create_map(*[x for day, flag in ov.items() for x in (F.lit(day), F.lit(flag))])
        return F.coalesce(F.try_element_at(m, d), weekday)

    corrections = [(day, int(flag) - int(day.weekday() < 5)) for day, flag in ov.items()
                   if int(flag) != int(day.weekday() < 5)]
    between = _weekdays_inclusive(F.date_add(d0, 1), F.date_sub(d1, 1))
    if corrections:
        arr = F.array(*[F.struct(F.lit(day).alias("day"), F.lit(delta).alias("delta")) for day, delta in corrections])
        between = between + F.aggregate(F.filter(arr, lambda o: (o["day"] > d0) & (o["day"] < d1)),
                                        F.lit(0), lambda acc, o: acc + o["delta"])
    ps, pe = _partial(s, ses), _partial(e, ses)
    w0, w1 = work(d0).cast("long"), work(d1).cast("long")
    same = w0 * (pe - ps)
    multi = w0 * (F.lit(w_day) - ps) + w1 * pe + F.lit(w_day) * between.cast("long")
    secs = F.when(e <= s, F.lit(0)).when(d0 == d1, same).otherwise(multi)
    return spans.select("*", F.coalesce(secs, F.lit(0)).cast("long").alias("business_seconds"))
