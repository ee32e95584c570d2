"""Registered queries: allocation and the monthly revenue summary."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quaystone.operators import allocation, revenue
from quaystone.plans import sqlparts as sp
from quaystone.plans.jobs import revenue_summary
from quaystone.plans.tables import (
    CURRENT_PERIOD, PRIOR_PERIOD, STAT_MONTH, STAT_YEAR, contract_lines, platform_targets,
    supplier_platform, table,
)
from quaystone.session import checkpoint_dir

RATE_COLUMNS = ("revenue_completion_rate", "contracts_on_hand_yoy_rate",
                "recognized_revenue_yoy_rate", "signing_yoy_rate")


def allocated_lines(spark: SparkSession, sf_dir: str, lines: DataFrame | None = None, keep: Sequence[str] = ()) -> DataFrame:
    lines = contract_lines(spark, sf_dir, lines, keep)
    out = allocation.add_allocation_columns(
        lines, start="service_start", end="service_end", amount="product_amount",
        apply_year="apply_year", prior_period=PRIOR_PERIOD, current_period=CURRENT_PERIOD)
    return out.withColumn("cur_year_revenue", F.col("cur_year_calc_amort")) \
              .withColumn("prev_year_revenue", F.col("prev_year_calc_amort"))


def q_period_allocation(spark, sf_dir):
    a = allocated_lines(spark, sf_dir)
    return a.select("l_orderkey", "l_linenumber", "contract_days", "prev_year_calc_amort",
                    "prev_year_adjusted_amort", "cur_year_calc_amort", "cur_year_adjusted_amort")


def platform_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per-platform metrics. Lines are first summed per supplier (exact decimals), so the
    join to the platform dimension sees one row per supplier instead of one per line."""
    per_supplier = revenue.metric_sums(allocated_lines(spark, sf_dir), ["l_suppkey"], STAT_YEAR, STAT_MONTH)
    plat = revenue.valid_platform(supplier_platform(spark, sf_dir))
    joined = per_supplier.join(plat, per_supplier.l_suppkey == plat.s_suppkey)
    return revenue.round_metrics(joined, ["sales_platform"])


def q_allocation_by_platform(spark, sf_dir):
    return platform_metrics(spark, sf_dir)


def _rates_as_double(df: DataFrame) -> DataFrame:
    return df.select(*[F.col(c).cast("double").alias(c) if c in RATE_COLUMNS else F.col(c) for c in df.columns])


def summary_rows(spark, sf_dir, targets=None) -> DataFrame:
    targets = targets if targets is not None else platform_targets(spark, sf_dir)
    return revenue.build_revenue_rows(targets, platform_metrics(spark, sf_dir), STAT_YEAR, STAT_MONTH)


def q_revenue_with_total(spark, sf_dir):
    return _rates_as_double(revenue.with_total_rows(summary_rows(spark, sf_dir)))


def q_target_vs_actual(spark, sf_dir):
    return _rates_as_double(summary_rows(spark, sf_dir))


def q_unmapped_platforms(spark, sf_dir):
    targets = platform_targets(spark, sf_dir).where(F.col("n_nationkey") < 20)
    return revenue.unmapped_platforms(platform_metrics(spark, sf_dir), targets)


def raw_targets_from_lines(spark, sf_dir) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    return li.select(
        F.year("l_shipdate").alias("year"), F.month("l_shipdate").alias("month"),
        F.concat("l_returnflag", "l_linestatus").alias("sales_platform"),
        F.when(F.col("l_quantity") != 1, F.col("l_extendedprice")).alias("revenue_target"))


def q_duplicate_targets(spark, sf_dir):
    return revenue.target_problems(raw_targets_from_lines(spark, sf_dir))


def q_monthly_summary_upsert(spark, sf_dir):
    """Upsert re-computed summary rows (targets revised for nations 0-9) into the stored
    summary on (stat_year, stat_month, sales_platform) (M6; the M1 pattern)."""
    from quaystone.operators.history import snapshot_upsert
    targets = platform_targets(spark, sf_dir)
    checkpoint_dir(spark)
    metrics = platform_metrics(spark, sf_dir).checkpoint()  # read twice
    stored = revenue.build_revenue_rows(targets, metrics, STAT_YEAR, STAT_MONTH)
    revised = targets.withColumn("revenue_target", F.when(
        F.col("n_nationkey") < 10, F.round(F.col("revenue_target") * F.lit(1.1).cast("decimal(2,1)"), 0))
        .otherwise(F.col("revenue_target")).cast("decimal(18,0)"))
    changes = revenue.build_revenue_rows(revised, metrics, STAT_YEAR, STAT_MONTH).withColumn("__o", F.lit(1))
    keys = ["stat_year", "stat_month", "sales_platform"]
    values = [c for c in stored.columns if c not in keys]
    return _rates_as_double(snapshot_upsert(stored, changes, keys, "__o", values))


TARGET_HEADER = ["年", "月", "营销平台", "收入目标值"]


def target_cells(spark, sf_dir):
    """A target sheet as raw cells: 12 note rows, the header, then one row per
    (year, month, nation) with the order value as target text and a total row per month."""
    o = table(spark, sf_dir, "orders").select("o_orderdate", "o_custkey", "o_totalprice")
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    n = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    per = (o.join(c, o.o_custkey == c.c_custkey).join(n, F.col("c_nationkey") == n.n_nationkey)
           .groupBy(F.year("o_orderdate").alias("y"), F.month("o_orderdate").alias("m"), "n_nationkey", "n_name")
           .agg(F.sum(F.col("o_totalprice").cast("decimal(18,2)")).alias("t")))
    data = per.select(((F.col("y") * 100 + F.col("m")) * 100 + F.col("n_nationkey") + 100).cast("long").alias("row_no"),
                      F.array(F.col("y").cast("string"), F.col("m").cast("string"), F.col("n_name"),
                              F.format_number("t", 2)).alias("cells"))
    totals = per.groupBy("y", "m").agg(F.sum("t").alias("t")).select(
        ((F.col("y") * 100 + F.col("m")) * 100 + 99 + 100).cast("long").alias("row_no"),
        F.array(F.col("y").cast("string"), F.col("m").cast("string"), F.lit("合计"), F.format_number("t", 2)).alias("cells"))
    notes = spark.range(12).select(F.col("id").alias("row_no"), F.array(F.lit("说明"), F.lit(""), F.lit(""), F.lit("")).alias("cells"))
    header = spark.range(1).select(F.lit(12).cast("long").alias("row_no"), F.array(*[F.lit(h) for h in TARGET_HEADER]).alias("cells"))
    return notes.unionByName(header).unionByName(data).unionByName(totals)


def q_target_sheet(spark, sf_dir):
    from quaystone.functions.numbers import parse_decimal_text
    from quaystone.operators.contracts import read_cells
    sheet = read_cells(target_cells(spark, sf_dir), TARGET_HEADER, max_rows=None)
    raw = sheet.select(F.col("年").try_cast("int").alias("year"), F.col("月").try_cast("int").alias("month"),
                       F.col("营销平台").alias("sales_platform"),
                       parse_decimal_text("收入目标值").cast("decimal(18,2)").alias("revenue_target"))
    ok = raw.join(revenue.target_problems(raw).select("year", "month", "sales_platform"),
                  ["year", "month", "sales_platform"], "left_anti")
    return ok.where(F.col("sales_platform") != revenue.TOTAL_LABEL) \
        .select("year", "month", "sales_platform", revenue.round_units_col("revenue_target"))


def _revenue_job(spark, sf_dir):
    """G6 on two snapshots of the contract lines, the newer one whole; targets for the first twenty nations only, with a total row."""
    # the lines carry their date from the scan on, so the latest date is sought without the orders
    li = table(spark, sf_dir, "lineitem")
    dated = li.withColumn("create_date", F.lit("20260713")).unionByName(
        li.where("l_linenumber = 1").withColumn("create_date", F.lit("20260601")))
    snapshot = allocated_lines(spark, sf_dir, dated, keep=["create_date"])
    platforms = supplier_platform(spark, sf_dir).withColumnRenamed("s_suppkey", "l_suppkey")
    targets = platform_targets(spark, sf_dir).where("n_nationkey < 20").select(
        F.lit(STAT_YEAR).alias("year"), F.lit(STAT_MONTH).alias("month"), F.concat(F.lit(" "), F.col("sales_platform")).alias("sales_platform"),
        "revenue_target")
    total = targets.groupBy("year", "month").agg(F.sum("revenue_target").cast("decimal(18,0)").alias("revenue_target")).select(
        "year", "month", F.lit(revenue.TOTAL_LABEL).alias("sales_platform"), "revenue_target")
    return revenue_summary(targets.unionByName(total), snapshot, STAT_YEAR, STAT_MONTH, platforms=platforms)


def q_revenue_summary(spark, sf_dir):
    return _rates_as_double(_revenue_job(spark, sf_dir)["with_total"])


def q_revenue_unmapped(spark, sf_dir):
    return _revenue_job(spark, sf_dir)["unmapped"]


QUERIES = {
    "revenue_summary": q_revenue_summary,
    "revenue_unmapped": q_revenue_unmapped,
    "target_sheet": q_target_sheet,
    "monthly_summary_upsert": q_monthly_summary_upsert,
    "period_allocation": q_period_allocation,
    "allocation_by_platform": q_allocation_by_platform,
    "revenue_with_total": q_revenue_with_total,
    "target_vs_actual": q_target_vs_actual,
    "unmapped_platforms": q_unmapped_platforms,
    "duplicate_targets": q_duplicate_targets,
}

_SUMMARY = f"""
summary AS (
  SELECT 1998 AS stat_year, 6 AS stat_month, t.sales_platform, t.revenue_target,
    COALESCE(m.recognized_revenue, 0) AS rr,
    COALESCE(m.recognized_revenue_excluding_estimate, m.recognized_revenue, 0) AS rre,
    COALESCE(m.prior_year_recognized_revenue, 0) AS pr,
    COALESCE(m.contracts_on_hand_amount, 0) AS oh,
    COALESCE(m.prior_year_contracts_on_hand_amount, 0) AS poh,
    COALESCE(m.signing_completed_amount, 0) AS sg,
    COALESCE(m.prior_year_signing_amount, 0) AS psg
  FROM platform_targets t LEFT JOIN platform_metrics m ON t.sales_platform = m.sales_platform
),
summary_rows AS (
  SELECT stat_year, stat_month, sales_platform, revenue_target,
    CAST(rr AS DECIMAL(18,0)) AS recognized_revenue,
    {sp.rate_sql('rr', 'revenue_target')} AS revenue_completion_rate,
    CAST(oh AS DECIMAL(18,0)) AS contracts_on_hand_amount,
    CAST(poh AS DECIMAL(18,0)) AS prior_year_contracts_on_hand_amount,
    CAST(oh - poh AS DECIMAL(18,0)) AS contracts_on_hand_yoy_amount,
    {sp.growth_sql('oh', 'poh')} AS contracts_on_hand_yoy_rate,
    CAST(rre AS DECIMAL(18,0)) AS recognized_revenue_excluding_estimate,
    CAST(pr AS DECIMAL(18,0)) AS prior_year_recognized_revenue,
    CAST(rre - pr AS DECIMAL(18,0)) AS recognized_revenue_yoy_amount,
    {sp.growth_sql('rre', 'pr')} AS recognized_revenue_yoy_rate,
    CAST(sg AS DECIMAL(18,0)) AS signing_completed_amount,
    CAST(psg AS DECIMAL(18,0)) AS prior_year_signing_amount,
    CAST(sg - psg AS DECIMAL(18,0)) AS signing_yoy_amount,
    {sp.growth_sql('sg', 'psg')} AS signing_yoy_rate
  FROM summary
)"""

_TOTAL = f"""
SELECT *, 1 AS sort_order FROM summary_rows
UNION ALL
SELECT stat_year, stat_month, '合计' AS sales_platform,
  CAST(SUM(revenue_target) AS DECIMAL(18,0)) AS revenue_target,
  CAST(SUM(recognized_revenue) AS DECIMAL(18,0)) AS recognized_revenue,
  {sp.rate_sql('SUM(recognized_revenue)', 'SUM(revenue_target)')} AS revenue_completion_rate,
  CAST(SUM(contracts_on_hand_amount) AS DECIMAL(18,0)) AS contracts_on_hand_amount,
  CAST(SUM(prior_year_contracts_on_hand_amount) AS DECIMAL(18,0)) AS prior_year_contracts_on_hand_amount,
  CAST(SUM(contracts_on_hand_yoy_amount) AS DECIMAL(18,0)) AS contracts_on_hand_yoy_amount,
  {sp.growth_sql('SUM(contracts_on_hand_amount)', 'SUM(prior_year_contracts_on_hand_amount)')} AS contracts_on_hand_yoy_rate,
  CAST(SUM(recognized_revenue_excluding_estimate) AS DECIMAL(18,0)) AS recognized_revenue_excluding_estimate,
  CAST(SUM(prior_year_recognized_revenue) AS DECIMAL(18,0)) AS prior_year_recognized_revenue,
  CAST(SUM(recognized_revenue_yoy_amount) AS DECIMAL(18,0)) AS recognized_revenue_yoy_amount,
  {sp.growth_sql('SUM(recognized_revenue_excluding_estimate)', 'SUM(prior_year_recognized_revenue)')} AS recognized_revenue_yoy_rate,
  CAST(SUM(signing_completed_amount) AS DECIMAL(18,0)) AS signing_completed_amount,
  CAST(SUM(prior_year_signing_amount) AS DECIMAL(18,0)) AS prior_year_signing_amount,
  CAST(SUM(signing_yoy_amount) AS DECIMAL(18,0)) AS signing_yoy_amount,
  {sp.growth_sql('SUM(signing_completed_amount)', 'SUM(prior_year_signing_amount)')} AS signing_yoy_rate,
  0 AS sort_order
FROM summary_rows GROUP BY stat_year, stat_month
"""

_REVISED_TARGETS = """
platform_targets AS (
  SELECT sales_platform, n_nationkey,
    CAST(CASE WHEN n_nationkey < 10 THEN round(revenue_target * CAST(1.1 AS DECIMAL(2,1)), 0) ELSE revenue_target END AS DECIMAL(18,0)) AS revenue_target
  FROM stored_targets)"""

_UPSERT_SUMMARY = (sp.with_(sp.CONTRACT_LINES, sp.PLATFORM_METRICS, sp.PLATFORM_TARGETS.replace("platform_targets AS", "stored_targets AS"),
                            _REVISED_TARGETS, _SUMMARY) + """,
stored AS (
  SELECT 1998 AS stat_year, 6 AS stat_month, t.sales_platform, t.revenue_target,
    CAST(COALESCE(m.recognized_revenue, 0) AS DECIMAL(18,0)) AS rr
  FROM stored_targets t LEFT JOIN platform_metrics m ON t.sales_platform = m.sales_platform)
SELECT s.stat_year, s.stat_month, s.sales_platform, s.revenue_target, s.recognized_revenue,
  s.revenue_completion_rate, s.contracts_on_hand_amount, s.prior_year_contracts_on_hand_amount,
  s.contracts_on_hand_yoy_amount, s.contracts_on_hand_yoy_rate, s.recognized_revenue_excluding_estimate,
  s.prior_year_recognized_revenue, s.recognized_revenue_yoy_amount, s.recognized_revenue_yoy_rate,
  s.signing_completed_amount, s.prior_year_signing_amount, s.signing_yoy_amount, s.signing_yoy_rate,
  CASE WHEN o.revenue_target = s.revenue_target
            AND o.rr IS NOT DISTINCT FROM s.recognized_revenue THEN 'unchanged' ELSE 'updated' END AS outcome
FROM summary_rows s JOIN stored o ON s.sales_platform = o.sales_platform""")

_SOME_TARGETS = ("all_targets AS", "platform_targets AS (SELECT * FROM all_targets WHERE n_nationkey < 20)")

SQL = {
    "revenue_summary": sp.with_(sp.CONTRACT_LINES, sp.PLATFORM_METRICS, sp.PLATFORM_TARGETS.replace("platform_targets AS", _SOME_TARGETS[0]),
                                _SOME_TARGETS[1], _SUMMARY) + _TOTAL,
    "revenue_unmapped": sp.with_(sp.CONTRACT_LINES, sp.PLATFORM_METRICS,
                                 sp.PLATFORM_TARGETS.replace("platform_targets AS", _SOME_TARGETS[0]), _SOME_TARGETS[1]) + """
SELECT sales_platform FROM platform_metrics WHERE sales_platform NOT IN (SELECT sales_platform FROM platform_targets) ORDER BY 1""",
    "target_sheet": """
SELECT CAST(year(o_orderdate) AS INTEGER) AS year, CAST(month(o_orderdate) AS INTEGER) AS month, n_name AS sales_platform,
  CAST(round(SUM(CAST(o_totalprice AS DECIMAL(18,2))), 0) AS DECIMAL(18,0)) AS revenue_target
FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
GROUP BY 1, 2, 3""",
    "monthly_summary_upsert": _UPSERT_SUMMARY,
    "period_allocation": sp.with_(sp.CONTRACT_LINES, sp.ALLOCATED) + """
SELECT l_orderkey, l_linenumber, contract_days, prev_year_calc_amort, prev_year_adjusted_amort,
       cur_year_calc_amort, cur_year_adjusted_amort FROM allocated""",
    "allocation_by_platform": sp.with_(sp.CONTRACT_LINES, sp.PLATFORM_METRICS) + """
SELECT * FROM platform_metrics""",
    "revenue_with_total": sp.with_(sp.CONTRACT_LINES, sp.PLATFORM_METRICS, sp.PLATFORM_TARGETS, _SUMMARY) + _TOTAL,
    "target_vs_actual": sp.with_(sp.CONTRACT_LINES, sp.PLATFORM_METRICS, sp.PLATFORM_TARGETS, _SUMMARY) + """
SELECT * FROM summary_rows""",
    "unmapped_platforms": sp.with_(sp.CONTRACT_LINES, sp.PLATFORM_METRICS, sp.PLATFORM_TARGETS) + """
SELECT m.sales_platform FROM platform_metrics m
WHERE NOT EXISTS (SELECT 1 FROM platform_targets t WHERE t.n_nationkey < 20 AND t.sales_platform = m.sales_platform)
ORDER BY 1""",
    "duplicate_targets": """
WITH t AS (
  SELECT CAST(year(l_shipdate) AS INTEGER) AS year, CAST(month(l_shipdate) AS INTEGER) AS month,
         NULLIF(trim(l_returnflag || l_linestatus), '') AS sales_platform,
         CASE WHEN l_quantity <> 1 THEN l_extendedprice END AS revenue_target
  FROM lineitem)
SELECT year, month, sales_platform, COUNT(*) AS row_count,
       CAST(COUNT(*) FILTER (WHERE revenue_target IS NULL) AS BIGINT) AS null_targets
FROM t WHERE sales_platform IS NOT NULL AND sales_platform <> '合计'
GROUP BY year, month, sales_platform
HAVING COUNT(*) > 1 OR COUNT(*) FILTER (WHERE revenue_target IS NULL) > 0""",
}
