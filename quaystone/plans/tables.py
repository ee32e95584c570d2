"""Reading the driver's tables and the stand-ins built on them.

Stand-ins (one definition, mirrored by the SQL twins in ``oracle``):
  contract line = lineitem (+ apply date from its order), platform = nation of the supplier,
  ticket = orders, contact = customer, company = nation, group = region,
  attribute rows = events, text lines = documents.
"""

from __future__ import annotations

import datetime as _dt
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quaystone.functions.numbers import MONEY
from quaystone.session import checkpoint_dir

# Statistic periods used by the contract queries.
PRIOR_PERIOD = (_dt.date(1997, 1, 1), _dt.date(1997, 12, 31))
CURRENT_PERIOD = (_dt.date(1998, 1, 1), _dt.date(1998, 12, 31))
STAT_YEAR, STAT_MONTH = 1998, 6


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new folder for a query's own files in the shared checkpoint folder."""
    return f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex[:10]}"


def contract_lines(spark: SparkSession, sf_dir: str, lines: DataFrame | None = None, keep: Sequence[str] = ()) -> DataFrame:
    """lineitem as contract lines: service [ship date, ship date + 7*quantity days],
    amount = extended price, share = discount, apply date = the order's date, and the
    text flags the revenue metrics test. With ``lines``, those lines of lineitem, with their ``keep`` columns."""
    li = table(spark, sf_dir, "lineitem") if lines is None else lines
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    start = F.col("l_shipdate").cast("date")
    return (
        li.join(orders, li.l_orderkey == orders.o_orderkey, "left")
        .select(
            "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
            start.alias("service_start"),
            F.date_add(start, (F.col("l_quantity") * 7).cast("int")).alias("service_end"),
            F.col("l_extendedprice").cast(MONEY).alias("product_amount"),
            F.col("l_discount").alias("share_ratio"),
            F.col("o_orderdate").cast("date").alias("contract_apply_date"),
            F.year("o_orderdate").alias("apply_year"),
            F.when(F.col("l_returnflag") == "R", "是").otherwise("否").alias("is_public_cloud"),
            F.when(F.col("l_tax") < 0.06, "运维合同").otherwise("非运维合同").alias("contract_category"),
            F.lit("非税票据").alias("other_business_type"),
            F.lit("有效").alias("invalid_contract_type"),
            F.when(F.col("l_discount") >= 0.08, "是").otherwise("否").alias("is_estimated_ops"),
            *keep,
        )
    )


def supplier_platform(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(s_suppkey, sales_platform): supplier -> nation name. nation has a fixed 25 rows."""
    s = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    n = table(spark, sf_dir, "nation").select("n_nationkey", F.col("n_name").alias("sales_platform"))
    return s.join(n, s.s_nationkey == n.n_nationkey).select("s_suppkey", "sales_platform")


def platform_targets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Targets per platform: a tenth of the nation's order value, whole units."""
    o = table(spark, sf_dir, "orders").select("o_custkey", "o_totalprice")
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    n = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    per_nation = (o.join(c, o.o_custkey == c.c_custkey)
                  .groupBy("c_nationkey")
                  .agg(F.sum(F.col("o_totalprice").cast(MONEY)).alias("total")))
    return (per_nation.join(n, per_nation.c_nationkey == n.n_nationkey)
            .select(F.col("n_name").alias("sales_platform"),
                    F.round(F.col("total") * F.lit(0.1).cast("decimal(2,1)"), 0)
                    .cast("decimal(18,0)").alias("revenue_target"),
                    F.col("n_nationkey")))
