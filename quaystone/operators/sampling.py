"""Sampling, listing and month-window operators."""

from __future__ import annotations

import datetime as _dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def stratified_sample(df: DataFrame, strata: Sequence[str], id_col: str, n: int, seed: str = "0") -> DataFrame:
    """Repeatable sample of ``n`` rows per stratum (W4); a stratum with <= n rows is kept whole.

    Rows are ranked by md5(seed ':' stratum ':' id), so the sample is independent of partitioning
    and task order. The rank is a per-stratum window: a stratum holding a large share of the
    rows is sorted in one task, but only the top ``n`` survive (Spark plans a group limit)."""
    stratum = F.concat_ws("|", *[F.col(s).cast("string") for s in strata])
    key = F.md5(F.concat_ws(":", F.lit(seed), stratum, F.col(id_col).cast("string")))
    w = Window.partitionBy(*strata).orderBy(key, F.col(id_col))
    return df.withColumn("sample_rank", F.row_number().over(w).cast("long")).where(F.col("sample_rank") <= n)


def counts_per(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Row count per key (A10)."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("row_count"))


def month_year_rollup(df: DataFrame, year: str, month: str) -> DataFrame:
    """Counts per (year, month), per year and overall (A9): a ROLLUP."""
    return df.rollup(year, month).agg(F.count(F.lit(1)).alias("row_count"))


def top_k(df: DataFrame, order: Sequence[Column], k: int) -> DataFrame:
    """Latest k rows by the given order (L1/L2): Spark plans a TakeOrderedAndProject."""
    return df.orderBy(*order).limit(k)


def newest_per_id(df: DataFrame, id_col: str, time_col: str) -> DataFrame:
    """Newest row per id (S13 point lookup generalised to every id), via max_by aggregation."""
    return (df.groupBy(id_col).agg(F.max_by(F.struct(*[F.col(c) for c in df.columns]), F.struct(F.col(time_col))).alias("__r"))
            .select("__r.*"))


def in_year(time_col: str, year: int) -> Column:
    """Rows of one year as a range on the raw column, so that it reaches the scan."""
    return in_range(time_col, _dt.date(year, 1, 1), _dt.date(year + 1, 1, 1))


def in_month(time_col: str, month: str) -> Column:
    """Rows of one 'yyyy-MM' month as a range on the raw column."""
    first = _dt.date.fromisoformat(f"{month}-01")
    return in_range(time_col, first, _dt.date(first.year + first.month // 12, first.month % 12 + 1, 1))


def in_range(time_col: str, first: _dt.date, until: _dt.date) -> Column:
    at = [F.lit(f"{d.isoformat()} 00:00:00").cast("timestamp_ntz") for d in (first, until)]
    return (F.col(time_col) >= at[0]) & (F.col(time_col) < at[1])


def month_scan(df: DataFrame, time_col: str, id_col: str, month: str, limit: int | None = None) -> DataFrame:
    """Rows of one month ordered by time and id (S12/L2), the first ``limit`` of them when given."""
    rows = df.where(in_month(time_col, month)).orderBy(time_col, id_col)
    return rows if limit is None else rows.limit(limit)


def rows_of_id(df: DataFrame, id_col: str, value, time_col: str, ties: Sequence[str] = ()) -> DataFrame:
    """Newest row of one id (S13): the id reaches the scan; a row without a time comes last; of equal times the
    greatest ``ties``."""
    order = [F.col(c).desc_nulls_last() for c in (time_col, *ties)]
    return df.where(F.col(id_col) == F.lit(value)).orderBy(*order).limit(1)


def snapshot_scan(df: DataFrame, date: str, date_col: str = "create_date") -> DataFrame:
    """Rows of one snapshot (S10); an empty snapshot is an error (checked with a bounded read)."""
    rows = df.where(F.col(date_col) == date)
    if rows.isEmpty():
        raise ValueError(f"snapshot {date} is empty")
    return rows


def latest_snapshot(df: DataFrame, date_col: str = "create_date") -> DataFrame:
    """Rows of the latest snapshot date (S11); 'yyyyMMdd' text so lexical max = latest.
    The latest date is read first, so that the filter on it reaches the scan and the rows of other dates
    are neither joined nor shuffled; without any date there are no rows."""
    latest = df.agg(F.max(date_col)).first()[0]
    return df.where(F.col(date_col) == F.lit(latest))


def completeness(df: DataFrame, keys: Sequence[str], declared: str, read_flag: str) -> DataFrame:
    """Declared total vs rows read per key (S3): partial when fewer rows were read."""
    agg = df.groupBy(*keys).agg(F.max(declared).alias("declared_count"),
                                F.count_if(F.col(read_flag)).alias("read_count"))
    return agg.withColumn("is_partial", F.col("read_count") < F.col("declared_count"))


def file_date(name: Column) -> Column:
    """'20yy-m-d' inside a file name -> 'yyyyMMdd' ('' when absent)."""
    y = F.regexp_extract(name, r"(20\d{2})-(\d{1,2})-(\d{1,2})", 1)
    m = F.regexp_extract(name, r"(20\d{2})-(\d{1,2})-(\d{1,2})", 2)
    d = F.regexp_extract(name, r"(20\d{2})-(\d{1,2})-(\d{1,2})", 3)
    return F.when(y != "", F.concat(y, F.lpad(m, 2, "0"), F.lpad(d, 2, "0"))).otherwise(F.lit(""))


def refresh_window(month_start: Column, today: _dt.date, daily_months: int = 3, cut_days: int = 90) -> Column:
    """Which refresh a month gets (S20): 'daily' for the current month and ``daily_months``
    before it; 'monthly' for older months of the same year that ended at least ``cut_days``
    before ``today``; else 'none'."""
    cur = _dt.date(today.year, today.month, 1)
    first_daily = F.add_months(F.lit(cur), -daily_months)
    cut = F.lit(today - _dt.timedelta(days=cut_days))
    month_end = F.date_sub(F.add_months(month_start, 1), 1)
    return (F.when((month_start >= first_daily) & (month_start <= F.lit(cur)), "daily")
            .when((F.year(month_start) == today.year) & (month_start < first_daily) & (month_end <= cut), "monthly")
            .otherwise("none"))


def distinct_ids(df: DataFrame, kinds: Sequence[tuple[str, Column]]) -> DataFrame:
    """Distinct referenced ids per entity kind (A8); blank and '0' dropped. A kind may occur with
    several columns; an array column gives each of its elements (an id list: ``tickets.split_id_list``)."""
    kinds = list(kinds.items()) if isinstance(kinds, dict) else list(kinds)
    names = [f"__id{i}" for i in range(len(kinds))]
    flat = df.select(*[c.alias(n) for n, (_, c) in zip(names, kinds)])
    lists = [F.col(n) if flat.schema[n].dataType.typeName() == "array" else F.array(n) for n in names]

    def pairs_of(kind: str, ids: Column) -> Column:
        ids = F.coalesce(ids.cast("array<string>"), F.array().cast("array<string>"))
        return F.transform(ids, lambda v: F.struct(F.lit(kind).alias("kind"), v.alias("id")))

    pairs = F.flatten(F.array(*[pairs_of(kind, ids) for ids, (kind, _) in zip(lists, kinds)]))
    ex = flat.select(F.explode(pairs).alias("p")).select("p.kind", F.trim("p.id").alias("id"))
    return ex.where(F.col("id").isNotNull() & ~F.col("id").isin("", "0")).distinct()


def first_n_per(df: DataFrame, by: Sequence[str], order: Sequence[Column], n: int) -> DataFrame:
    """First ``n`` rows per group along ``order`` (L3 row cap per month); Spark applies the
    limit per group before the shuffle (WindowGroupLimit)."""
    w = Window.partitionBy(*by).orderBy(*order)
    return df.withColumn("row_in_group", F.row_number().over(w).cast("long")).where(F.col("row_in_group") <= n)
