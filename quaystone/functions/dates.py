"""Date / time parsing expressions. Everything is TIMESTAMP_NTZ (wall clock, no zone)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from quaystone.functions.text import _col, strip_all

# Placeholders that mean "no date" in contract extracts; none has the shape of a date of year 1 or later.
DATE_PLACEHOLDERS = ("/", "-", "0", "0.0", "0000-00-00", "0000-12-30")
DEFAULT_TZ = "Asia/Shanghai"

# Shapes of a date text: 8 digits, or an ISO date alone or with a time of any precision; never of year 0.
_DATE_TEXT = (r"\A(?!0000)[0-9]{4}(?:[0-9]{4}|[-/][0-9]{2}[-/][0-9]{2}(?:[ T][0-9]{2}:[0-9]{2}(?::[0-9]{2}(?:\.[0-9]{1,6})?)?)?)\z")


def _year_ok(d: Column) -> Column:
    return F.year(d) >= 1


def contract_date(c) -> Column:
    """Contract date text -> DATE.

    Placeholders and blanks -> NULL; 8 digits = yyyyMMdd; otherwise ISO text
    with '/' read as '-'. Year 0 is rejected.
    """
    return stripped_date(strip_all(c))


def stripped_date(s: Column) -> Column:
    """:func:`contract_date` of a stripped text: blanks and placeholders have neither shape."""
    compact = F.concat_ws("-", F.left(s, F.lit(4)), F.substring(s, 5, 2), F.substring(s, 7, 2))
    iso = F.when(F.length(s) == 8, compact).otherwise(F.replace(F.left(s, F.lit(10)), F.lit("/"), F.lit("-")))
    return F.when(s.rlike(_DATE_TEXT), iso.try_cast("date"))


def merge_date_text(c) -> Column:
    """Merge-step date: parsable text -> 'yyyyMMdd', anything else kept as trimmed text.

    Accepts 8 digits (yyyyMMdd) and y-M-d dates with '-' or '/', optionally followed by a time
    after ' ' or 'T'."""
    s = F.coalesce(strip_all(c), F.lit(""))
    return merge_date(s, date_part(s))


def date_part(s: Column) -> Column:
    """A stripped date text up to a ' ' or 'T', with '/' read as '-'."""
    return F.substring_index(F.substring_index(F.replace(s, F.lit("/"), F.lit("-")), " ", 1), "T", 1)


def merge_date(s: Column, part: Column) -> Column:
    """:func:`merge_date_text` of a stripped text and its :func:`date_part`. 8 digits stay as they are, whether they are a date
    or not. The usual shape is cast; a formatter, slow where it refuses a text, reads the others that have a '-'."""
    usual = part.rlike(r"\A[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}\z")
    cast = part.try_cast("date")
    other = F.try_to_date(part, "yyyy-M-d")
    text = F.when((F.length(part) < 8) | ~part.contains("-"), F.lit(None)) \
        .when(usual, F.when(_year_ok(cast), F.replace(cast.cast("string"), F.lit("-"), F.lit("")))) \
        .otherwise(F.when(_year_ok(other), F.date_format(other, "yyyyMMdd")))
    return F.coalesce(text, s)


def snapshot_date_text(c) -> Column:
    """Snapshot date = first 8 characters of the trimmed text ('20260713165231' -> '20260713')."""
    s = strip_all(c)
    return F.when(s != "", F.substring(s, 1, 8))


def epoch_to_ntz(seconds, tz: str = DEFAULT_TZ) -> Column:
    """Unix seconds -> wall-clock TIMESTAMP_NTZ in ``tz`` (independent of the session zone)."""
    base = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    utc = F.timestamp_add("SECOND", _col(seconds).cast("long"), base)
    return F.convert_timezone(F.lit("UTC"), F.lit(tz), utc)


def unix_text_to_display(c, tz: str = DEFAULT_TZ) -> Column:
    """Digits-only text other than '0' -> 'yyyy-MM-dd HH:mm:ss' in ``tz``; anything else kept, also texts
    of more than 12 digits: the last second of the year 9999 has 12."""
    s = strip_all(c)
    ok = s.rlike(r"^\d+$") & (s != "0") & (F.length(s) <= 12)
    return F.when(ok, F.date_format(epoch_to_ntz(s, tz), "yyyy-MM-dd HH:mm:ss")).otherwise(_col(c))


def entity_datetime(c, tz: str = DEFAULT_TZ) -> Column:
    """Entity update time: 10 or 13 digits = epoch seconds or milliseconds, other digit runs NULL;
    else 'yyyy-M-d H:m:s', 'yyyy-M-dTH:m:s' (first 19 characters) or 'yyyy-M-d' (first 10)."""
    s = F.regexp_replace(strip_all(c), "/", "-")
    epoch = F.when(s.rlike(r"^\d{10}(\d{3})?$"), epoch_to_ntz(F.substring(s, 1, 10), tz))
    head19, head10 = F.substring(s, 1, 19), F.substring(s, 1, 10)
    parsed = F.coalesce(
        epoch,
        F.try_to_timestamp(head19, F.lit("yyyy-M-d H:m:s")).cast("timestamp_ntz"),
        F.try_to_timestamp(head19, F.lit("yyyy-M-d'T'H:m:s")).cast("timestamp_ntz"),
        F.try_to_timestamp(head10, F.lit("yyyy-M-d")).cast("timestamp_ntz"),
    )
    return F.when(F.year(parsed) >= 1, parsed)


def strict_datetime(c) -> Column:
    """Ticket datetime: '0'/blank -> NULL; whole text must be 'yyyy-MM-dd HH:mm:ss' or 'yyyy-MM-dd'."""
    s = strip_all(c)
    parsed = F.coalesce(
        F.when(s.rlike(r"^\d{4}-\d{1,2}-\d{1,2} \d{1,2}:\d{1,2}:\d{1,2}$"),
               F.try_to_timestamp(s, F.lit("yyyy-M-d H:m:s"))),
        F.when(s.rlike(r"^\d{4}-\d{1,2}-\d{1,2}$"), F.try_to_timestamp(s, F.lit("yyyy-M-d"))),
    ).cast("timestamp_ntz")
    return F.when((s != "0") & (F.year(parsed) >= 1), parsed)


def metric_datetime(c, legacy: bool = True) -> Column:
    """Metric field time: '/' read as '-', then the first 19 / 16 / 10 characters as
    'yyyy-MM-dd HH:mm:ss' / 'yyyy-MM-dd HH:mm' / 'yyyy-MM-dd', then ISO.

    With ``legacy`` an ISO 'T' text is read through the 10-character form, i.e. as
    midnight, like the original parser; ``legacy=False`` reads the time part.
    """
    s = F.regexp_replace(strip_all(c), "/", "-")
    fmt = lambda n, p: F.when(F.substring(s, 1, n).rlike(
        {19: r"^\d{4}-\d{1,2}-\d{1,2} \d{1,2}:\d{1,2}:\d{1,2}$",
         16: r"^\d{4}-\d{1,2}-\d{1,2} \d{1,2}:\d{1,2}$",
         10: r"^\d{4}-\d{1,2}-\d{1,2}$"}[n]),
        F.try_to_timestamp(F.substring(s, 1, n), F.lit(p)))
    forms = [fmt(19, "yyyy-M-d H:m:s"), fmt(16, "yyyy-M-d H:m")]
    iso_t = F.when(s.rlike(r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}(:\d{2})?$"),
                   F.try_to_timestamp(s, F.lit("yyyy-MM-dd'T'HH:mm[:ss]")))
    if legacy:
        forms += [fmt(10, "yyyy-M-d"), iso_t]
    else:
        forms += [iso_t, fmt(10, "yyyy-M-d")]
    parsed = F.coalesce(*forms).cast("timestamp_ntz")
    return F.when(F.year(parsed) >= 1, parsed)


def month_label(ts) -> Column:
    """'YYYY-MM' of a timestamp."""
    return F.date_format(_col(ts), "yyyy-MM")


def month_columns(ts, prefix: str = "create") -> list[Column]:
    t = _col(ts)
    return [F.year(t).alias(f"{prefix}_year"), F.month(t).alias(f"{prefix}_month"),
            month_label(t).alias(f"{prefix}_month_label")]


def period_bounds(year: int, month: int) -> dict:
    """Year start and the first day after the month end, this year and the prior year.

    Driver-side constants for predicates (not data)."""
    import datetime as _dt
    if not 1 <= month <= 12:
        raise ValueError("month must be within 1..12")

    def after(y):
        return _dt.date(y + 1, 1, 1) if month == 12 else _dt.date(y, month + 1, 1)

    return {
        "current_start": _dt.date(year, 1, 1), "current_end": after(year),
        "prior_start": _dt.date(year - 1, 1, 1), "prior_end": after(year - 1),
    }


def ntz_literal(value) -> Column:
    """A TIMESTAMP_NTZ literal from a datetime / date / text, independent of any time zone
    (a Python datetime passed to ``lit`` would go through the OS zone)."""
    import datetime as _d
    if isinstance(value, Column):
        return value.cast("timestamp_ntz")
    if isinstance(value, _d.datetime):
        text = value.isoformat(sep=" ")
    elif isinstance(value, _d.date):
        text = value.isoformat() + " 00:00:00"
    else:
        text = str(value)
    return F.lit(text).cast("timestamp_ntz")
