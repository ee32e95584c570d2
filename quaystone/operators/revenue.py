"""Monthly service-revenue summary: per-platform metrics, targets, total row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quaystone.functions.codes import map_literal  # noqa: F401  (re-export convenience)
from quaystone.functions.dates import period_bounds
from quaystone.functions.numbers import growth_rate, rate, round_units
from quaystone.functions.text import strip_all
from quaystone.session import checkpoint_dir

# Eligibility of a contract line for the revenue metrics.
ELIGIBLE_VALUES = {
    "is_public_cloud": "否",
    "contract_category": "运维合同",
    "other_business_type": "非税票据",
    "invalid_contract_type": "有效",
}
NO_ESTIMATE_VALUE = ("is_estimated_ops", "否")
TOTAL_LABEL = "合计"

METRICS = (
    "recognized_revenue",
    "recognized_revenue_excluding_estimate",
    "prior_year_recognized_revenue",
    "contracts_on_hand_amount",
    "prior_year_contracts_on_hand_amount",
    "signing_completed_amount",
    "prior_year_signing_amount",
)

SUMMARY_COLUMNS = (
    "stat_year", "stat_month", "sales_platform", "revenue_target", "recognized_revenue",
    "revenue_completion_rate", "contracts_on_hand_amount", "prior_year_contracts_on_hand_amount",
    "contracts_on_hand_yoy_amount", "contracts_on_hand_yoy_rate",
    "recognized_revenue_excluding_estimate", "prior_year_recognized_revenue",
    "recognized_revenue_yoy_amount", "recognized_revenue_yoy_rate", "signing_completed_amount",
    "prior_year_signing_amount", "signing_yoy_amount", "signing_yoy_rate",
)


def _eligible(no_estimate: bool) -> Column:
    cond = F.lit(True)
    for column, value in ELIGIBLE_VALUES.items():
        cond = cond & (F.col(column) == value)
    if no_estimate:
        cond = cond & (F.col(NO_ESTIMATE_VALUE[0]) == NO_ESTIMATE_VALUE[1])
    return F.coalesce(cond, F.lit(False))


def _metric_terms(year: int, month: int) -> dict[str, Column]:
    b = period_bounds(year, month)
    base, noest = _eligible(False), _eligible(True)
    applied = F.col("contract_apply_date")
    cur_end, pri_end = F.lit(b["current_end"]), F.lit(b["prior_end"])
    cur_start, pri_start = F.lit(b["current_start"]), F.lit(b["prior_start"])

    def term(cond, col):
        return F.when(F.coalesce(cond, F.lit(False)), F.coalesce(F.col(col), F.lit(0))).otherwise(F.lit(0))

    return {
        "recognized_revenue": term(base, "cur_year_revenue"),
        "recognized_revenue_excluding_estimate": term(noest, "cur_year_revenue"),
        "prior_year_recognized_revenue": term(noest, "prev_year_revenue"),
        "contracts_on_hand_amount": term(noest & (applied < cur_end), "cur_year_adjusted_amort"),
        "prior_year_contracts_on_hand_amount": term(noest & (applied < pri_end), "prev_year_adjusted_amort"),
        "signing_completed_amount": term(noest & (applied >= cur_start) & (applied < cur_end), "product_amount"),
        "prior_year_signing_amount": term(noest & (applied >= pri_start) & (applied < pri_end), "product_amount"),
    }


def metric_sums(snapshot: DataFrame, keys: list[str], year: int, month: int) -> DataFrame:
    """Unrounded conditional sums of the seven metrics per ``keys``.

    Exact DECIMAL sums are associative, so a caller may sum these partial sums again
    at a coarser key (pre-aggregation below a join) before rounding.
    """
    terms = _metric_terms(year, month)
    return snapshot.groupBy(*keys).agg(*[F.sum(t).alias(name) for name, t in terms.items()])


def valid_platform(df: DataFrame, column: str = "sales_platform") -> DataFrame:
    return df.where(F.col(column).isNotNull() & (F.trim(F.col(column)) != ""))


def round_metrics(sums: DataFrame, keys: list[str]) -> DataFrame:
    """Sum partial sums per ``keys`` and round every metric to whole units."""
    return sums.groupBy(*keys).agg(*[round_units(F.sum(m)).alias(m) for m in METRICS])


def revenue_metrics(snapshot: DataFrame, year: int, month: int,
                    platform: str = "sales_platform", platforms: DataFrame | None = None) -> DataFrame:
    """Seven conditional sums per platform on one snapshot, rounded to units (A1).

    With ``platforms`` the lines have no platform but the key columns of that table (all but ``platform``): they are
    summed per key first, so that the join sees a row per key and not one per line."""
    if platforms is None:
        rows = valid_platform(snapshot, platform).withColumn(platform, strip_all(platform))
        return round_metrics(metric_sums(rows, [platform], year, month), [platform])
    keys = [c for c in platforms.columns if c != platform]
    named = valid_platform(platforms, platform).withColumn(platform, strip_all(platform))
    return round_metrics(metric_sums(snapshot, keys, year, month).join(named, keys), [platform])


def build_revenue_rows(targets: DataFrame, metrics: DataFrame, year: int, month: int,
                       snapshot_date: Column | str | None = None) -> DataFrame:
    """Target-driven left join (J16): every target platform gets a row; missing metrics are 0;
    excluding-estimate falls back to recognised revenue when the metric row is absent."""
    t = targets.select(F.col("sales_platform"), round_units("revenue_target").alias("revenue_target"))
    m = metrics.select("sales_platform", *[F.col(c).alias(f"m_{c}") for c in METRICS])
    j = t.join(m, "sales_platform", "left")

    def amt(c):
        return round_units(F.coalesce(F.col(f"m_{c}"), F.lit(0)))

    rr = amt("recognized_revenue")
    rre = round_units(F.coalesce(F.col("m_recognized_revenue_excluding_estimate"),
                                 F.col("m_recognized_revenue"), F.lit(0)))
    pr = amt("prior_year_recognized_revenue")
    oh, poh = amt("contracts_on_hand_amount"), amt("prior_year_contracts_on_hand_amount")
    sg, psg = amt("signing_completed_amount"), amt("prior_year_signing_amount")
    cols = [
        F.lit(year).alias("stat_year"), F.lit(month).alias("stat_month"), F.col("sales_platform"),
        F.col("revenue_target"), rr.alias("recognized_revenue"),
        rate(rr, F.col("revenue_target")).alias("revenue_completion_rate"),
        oh.alias("contracts_on_hand_amount"), poh.alias("prior_year_contracts_on_hand_amount"),
        round_units(oh - poh).alias("contracts_on_hand_yoy_amount"),
        growth_rate(oh, poh).alias("contracts_on_hand_yoy_rate"),
        rre.alias("recognized_revenue_excluding_estimate"), pr.alias("prior_year_recognized_revenue"),
        round_units(rre - pr).alias("recognized_revenue_yoy_amount"),
        growth_rate(rre, pr).alias("recognized_revenue_yoy_rate"),
        sg.alias("signing_completed_amount"), psg.alias("prior_year_signing_amount"),
        round_units(sg - psg).alias("signing_yoy_amount"),
        growth_rate(sg, psg).alias("signing_yoy_rate"),
    ]
    if snapshot_date is not None:
        cols.append((F.lit(snapshot_date) if isinstance(snapshot_date, str) else snapshot_date)
                    .alias("erp_create_date"))
    return j.select(*cols)


def with_total_rows(summary: DataFrame) -> DataFrame:
    """Detail rows (sort_order 1) plus one total row per (year, month) (sort_order 0), totals first.

    One grouping-sets aggregation gives both levels, so the summary and the contract lines below it
    are computed once. Amounts are summed; ratios are recomputed from the summed amounts at either
    level, NULL on a zero denominator."""
    period = ["stat_year", "stat_month"]
    sums = [round_units(F.sum(c)).alias(c) for c in SUMMARY_COLUMNS if c.endswith(("amount", "revenue", "target", "estimate"))]
    dated = [F.max("erp_create_date").alias("erp_create_date")] if "erp_create_date" in summary.columns else []
    both = summary.groupingSets([[*period, "sales_platform"], period], *period, "sales_platform").agg(
        *sums, *dated, F.grouping("sales_platform").alias("__total"))
    derived = {
        "sales_platform": F.when(F.col("__total") == 1, F.lit(TOTAL_LABEL)).otherwise(F.col("sales_platform")),
        "revenue_completion_rate": rate("recognized_revenue", "revenue_target"),
        "contracts_on_hand_yoy_rate": growth_rate("contracts_on_hand_amount", "prior_year_contracts_on_hand_amount"),
        "recognized_revenue_yoy_rate": growth_rate("recognized_revenue_excluding_estimate", "prior_year_recognized_revenue"),
        "signing_yoy_rate": growth_rate("signing_completed_amount", "prior_year_signing_amount"),
    }
    rows = both.select(*[derived[c].alias(c) if c in derived else F.col(c) for c in summary.columns],
                       (1 - F.col("__total")).cast("int").alias("sort_order"))
    return rows.orderBy(*period, "sort_order", "sales_platform")


def unmapped_platforms(metrics: DataFrame, targets: DataFrame) -> DataFrame:
    """Metric platforms that have no target (J17), sorted."""
    return (metrics.select("sales_platform")
            .join(targets.select("sales_platform"), "sales_platform", "left_anti")
            .orderBy("sales_platform"))


def target_problems(raw: DataFrame) -> DataFrame:
    """Per (year, month, platform): rows and NULL targets, only where a problem exists
    (a platform listed twice or a NULL target). Total rows and blank platforms are skipped (A12)."""
    rows = (raw.withColumn("sales_platform", F.nullif(strip_all("sales_platform"), F.lit("")))
            .where(F.col("sales_platform").isNotNull() & (F.col("sales_platform") != TOTAL_LABEL)))
    return (rows.groupBy("year", "month", "sales_platform")
            .agg(F.count(F.lit(1)).alias("row_count"),
                 F.count_if(F.col("revenue_target").isNull()).alias("null_targets"))
            .where("row_count > 1 OR null_targets > 0"))


def load_targets(raw: DataFrame, year: int, month: int) -> DataFrame:
    """Usable targets for one period; raises when a target is NULL, duplicated, or none exist.

    The check pulls at most 20 aggregated problem rows (bounded by platforms)."""
    checkpoint_dir(raw.sparkSession)
    period = raw.where((F.col("year") == year) & (F.col("month") == month)).checkpoint()  # read three times
    problems = target_problems(period).limit(20).collect()
    if problems:
        raise ValueError(f"bad targets for {year}-{month:02d}: {[tuple(p) for p in problems]}")
    rows = (period.withColumn("sales_platform", F.nullif(strip_all("sales_platform"), F.lit("")))
            .where(F.col("sales_platform").isNotNull() & (F.col("sales_platform") != TOTAL_LABEL))
            .select("sales_platform", "revenue_target"))
    if rows.isEmpty():
        raise ValueError(f"no targets for {year}-{month:02d}")
    return rows


def round_units_col(name: str):
    """Column ``name`` rounded to whole units (HALF_UP), keeping its name."""
    return round_units(name).alias(name)
