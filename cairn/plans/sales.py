"""Sales analytics over the star schema.

Plan shape, chosen for 100 TB rather than for the test size:

1. ``lineitem`` joins ``orders`` on the order key. This is the one join of two
   fact-sized inputs; it is a sort-merge join whose skew (one order with a
   huge share of lines) AQE splits.
2. The joined lines are aggregated per customer *before* any other join
   (eager aggregation). Catalyst never pushes an aggregate below a join, so
   this is written by hand. Every measure of the rollup is a sum or a count,
   so per-customer partials add up exactly; the partial aggregate runs
   map-side, so a customer holding a third of all lines costs one row per
   map task in the shuffle.
3. The per-customer rows (customer-sized, not lineitem-sized) join
   ``customer``; ``nation`` and ``region`` have a fixed row count and are
   broadcast.
4. The final rollup groups by (region, segment); top-N customers reuse the
   same per-customer frame.

Money is summed exactly with integer split accumulators
(``money.split_sum``): long arithmetic in the hot aggregation, the exact
decimal rebuilt on the output rows only.

Semantics kept from the source job: ``order_count`` counts *line items*
(``count(o_orderkey)`` after the join to lineitem), and ``avg_order_value``
is likewise weighted by lines. The driver tables have no receipt / commit
dates, so a line is late when ``l_shipdate > o_orderdate + 60 days``.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cairn.functions import money
from cairn.operators.relational import dimension, everyone, filter_optional_equal, top_n_per_group
from cairn.session import read_table

LATE_AFTER_DAYS = 60


def is_late() -> F.Column:
    return F.when(F.col("l_shipdate") > F.col("o_orderdate") + F.expr(f"INTERVAL {LATE_AFTER_DAYS} DAYS"),
                  1).otherwise(0)


def customer_rollup(spark: SparkSession, root: str, target_segment: str | None = "ALL",
                    min_order_date: str | dt.date | None = None) -> DataFrame:
    """Per-customer partial measures with region, segment and name attached."""
    orders = read_table(spark, root, "orders").select(
        "o_orderkey", "o_custkey", "o_orderdate", "o_totalprice")
    if min_order_date is not None:
        orders = orders.filter(F.col("o_orderdate") >= F.lit(str(min_order_date)).cast("timestamp_ntz"))
    customer = filter_optional_equal(
        read_table(spark, root, "customer").select("c_custkey", "c_name", "c_nationkey", "c_mktsegment"),
        "c_mktsegment", target_segment)
    if not everyone(target_segment):  # the segment's orders only, before the fact join
        wanted = customer.select(F.col("c_custkey").alias("o_custkey"))
        orders = orders.join(wanted, "o_custkey", "left_semi")
    lineitem = read_table(spark, root, "lineitem").select(
        "l_orderkey", "l_extendedprice", "l_discount", "l_shipdate")
    lines = lineitem.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
    per_customer = lines.groupBy("o_custkey").agg(
        F.count("o_orderkey").alias("n_lines"),
        *money.split_sum(money.net_units(), "net"),            # 1e-4 units
        *money.split_sum(money.discount_units(), "disc"),      # 1e-4 units
        *money.split_sum(money.cents("o_totalprice"), "ov"),   # 1e-2 units
        F.sum(is_late()).alias("late"),
    )
    nation = dimension(read_table(spark, root, "nation").select("n_nationkey", "n_regionkey"), "nation")
    region = dimension(read_table(spark, root, "region").select("r_regionkey", "r_name"), "region")
    return (per_customer
            .join(customer, F.col("o_custkey") == F.col("c_custkey"))
            .join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
            .join(region, F.col("n_regionkey") == F.col("r_regionkey"))
            .select("r_name", "c_mktsegment", "c_name", "n_lines", "net_hi", "net_lo", "disc_hi", "disc_lo",
                    "ov_hi", "ov_lo", "late"))


def segment_summary(rollup: DataFrame) -> DataFrame:
    """A3: one row per (region, market segment)."""
    agg = rollup.groupBy("r_name", "c_mktsegment").agg(
        F.sum("n_lines").alias("n"),
        *money.resum("net"), *money.resum("disc"), *money.resum("ov"),
        F.sum("late").alias("late"),
    )
    return agg.select(
        F.col("r_name").alias("region"),
        F.col("c_mktsegment").alias("market_segment"),
        F.col("n").cast("bigint").alias("order_count"),
        money.to_money(money.exact("net", 4)).alias("net_revenue"),
        money.to_money(money.exact("disc", 4)).alias("discount_given"),
        money.ratio(money.exact("ov", 2), F.col("n"), 2).alias("avg_order_value"),
        money.ratio(F.col("late"), F.col("n"), 4).alias("late_ship_rate"),
    )


def top_customers(rollup: DataFrame, top_n: int) -> DataFrame:
    """Top-N customers by net revenue per (region, segment), RANK with
    ties kept."""
    per_name = (rollup.groupBy("r_name", "c_mktsegment", "c_name").agg(*money.resum("net"))
                      .select("r_name", "c_mktsegment", "c_name",
                              money.to_money(money.exact("net", 4)).alias("net_revenue")))
    ranked = top_n_per_group(per_name, ["r_name", "c_mktsegment"],
                             [F.col("net_revenue").desc()], top_n, "revenue_rank")
    return ranked.select(
        F.col("r_name").alias("region"),
        F.col("c_mktsegment").alias("market_segment"),
        F.col("c_name").alias("customer_name"),
        "net_revenue", "revenue_rank")
