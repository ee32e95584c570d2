"""DuckDB twins of the stand-ins in ``tables`` (used only by oracle SQL)."""

# Contract lines: same columns as tables.contract_lines, plus the allocation columns for the
# periods 1997 and 1998 computed with exact integer cents (round half up).
CONTRACT_LINES = """
contract_lines AS (
  SELECT l.l_orderkey, l.l_linenumber, l.l_partkey, l.l_suppkey,
         CAST(l.l_shipdate AS DATE) AS service_start,
         CAST(l.l_shipdate AS DATE) + CAST(l.l_quantity * 7 AS INTEGER) AS service_end,
         CAST(l.l_extendedprice AS DECIMAL(18,2)) AS product_amount,
         CAST(round(l.l_extendedprice * 100) AS BIGINT) AS amount_cents,
         l.l_discount AS share_ratio,
         CAST(o.o_orderdate AS DATE) AS contract_apply_date,
         year(o.o_orderdate) AS apply_year,
         CASE WHEN l.l_returnflag = 'R' THEN '是' ELSE '否' END AS is_public_cloud,
         CASE WHEN l.l_tax < 0.06 THEN '运维合同' ELSE '非运维合同' END AS contract_category,
         '非税票据' AS other_business_type,
         '有效' AS invalid_contract_type,
         CASE WHEN l.l_discount >= 0.08 THEN '是' ELSE '否' END AS is_estimated_ops
  FROM lineitem l LEFT JOIN orders o ON l.l_orderkey = o.o_orderkey
)"""


def _alloc(ps: str, pe: str) -> str:
    overlap = (f"greatest(0, least(service_end, DATE '{pe}') - greatest(service_start, DATE '{ps}') + 1)")
    return (f"CAST(CASE WHEN contract_days > 0 THEN CAST((2 * amount_cents * {overlap} + contract_days)"
            f" // (2 * contract_days) AS DECIMAL(20,0)) * CAST(0.01 AS DECIMAL(3,2)) ELSE 0 END AS DECIMAL(18,2))")


ALLOCATED = f"""
alloc0 AS (
  SELECT *, CAST(service_end - service_start + 1 AS INTEGER) AS contract_days FROM contract_lines
),
alloc1 AS (
  SELECT *, {_alloc('1997-01-01', '1997-12-31')} AS prev_year_calc_amort,
            {_alloc('1998-01-01', '1998-12-31')} AS cur_year_calc_amort
  FROM alloc0
),
allocated AS (
  SELECT *,
    CAST(CASE WHEN apply_year = 1998 THEN 0 ELSE prev_year_calc_amort END AS DECIMAL(18,2)) AS prev_year_adjusted_amort,
    CAST(CASE WHEN apply_year = 1998 AND prev_year_calc_amort > 0 THEN cur_year_calc_amort + prev_year_calc_amort
              ELSE cur_year_calc_amort END AS DECIMAL(18,2)) AS cur_year_adjusted_amort,
    prev_year_calc_amort AS prev_year_revenue,
    cur_year_calc_amort AS cur_year_revenue
  FROM alloc1
)"""

SUPPLIER_PLATFORM = """
supplier_platform AS (
  SELECT s.s_suppkey, n.n_name AS sales_platform FROM supplier s JOIN nation n ON s.s_nationkey = n.n_nationkey
)"""

# Seven metrics for stat year 1998, month 6.
_BASE = ("is_public_cloud = '否' AND contract_category = '运维合同' AND other_business_type = '非税票据'"
         " AND invalid_contract_type = '有效'")
_NOEST = _BASE + " AND is_estimated_ops = '否'"


def _m(cond: str, col: str, name: str) -> str:
    return (f"CAST(round(SUM(CASE WHEN {cond} THEN COALESCE({col}, 0) ELSE 0 END), 0) AS DECIMAL(18,0)) AS {name}")


METRIC_SELECT = ",\n  ".join([
    _m(_BASE, "cur_year_revenue", "recognized_revenue"),
    _m(_NOEST, "cur_year_revenue", "recognized_revenue_excluding_estimate"),
    _m(_NOEST, "prev_year_revenue", "prior_year_recognized_revenue"),
    _m(_NOEST + " AND contract_apply_date < DATE '1998-07-01'", "cur_year_adjusted_amort", "contracts_on_hand_amount"),
    _m(_NOEST + " AND contract_apply_date < DATE '1997-07-01'", "prev_year_adjusted_amort",
       "prior_year_contracts_on_hand_amount"),
    _m(_NOEST + " AND contract_apply_date >= DATE '1998-01-01' AND contract_apply_date < DATE '1998-07-01'",
       "product_amount", "signing_completed_amount"),
    _m(_NOEST + " AND contract_apply_date >= DATE '1997-01-01' AND contract_apply_date < DATE '1997-07-01'",
       "product_amount", "prior_year_signing_amount"),
])

PLATFORM_METRICS = f"""
{ALLOCATED.strip()},
{SUPPLIER_PLATFORM.strip()},
platform_metrics AS (
  SELECT p.sales_platform,
  {METRIC_SELECT}
  FROM allocated a JOIN supplier_platform p ON a.l_suppkey = p.s_suppkey
  WHERE p.sales_platform IS NOT NULL AND trim(p.sales_platform) <> ''
  GROUP BY p.sales_platform
)"""

PLATFORM_TARGETS = """
platform_targets AS (
  SELECT n.n_name AS sales_platform, n.n_nationkey,
         CAST(round(SUM(CAST(o.o_totalprice AS DECIMAL(18,2))) * CAST(0.1 AS DECIMAL(2,1)), 0) AS DECIMAL(18,0)) AS revenue_target
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey JOIN nation n ON c.c_nationkey = n.n_nationkey
  GROUP BY n.n_name, n.n_nationkey
)"""


def rate_sql(n: str, d: str) -> str:
    return f"CASE WHEN {d} = 0 THEN NULL ELSE CAST(round(CAST({n} AS DOUBLE) / CAST({d} AS DOUBLE), 6) AS DOUBLE) END"


def growth_sql(n: str, d: str) -> str:
    return f"CASE WHEN {d} = 0 THEN NULL ELSE CAST(round(CAST({n} AS DOUBLE) / CAST({d} AS DOUBLE) - 1, 6) AS DOUBLE) END"


def with_(*parts: str) -> str:
    return "WITH " + ",\n".join(p.strip() for p in parts)
