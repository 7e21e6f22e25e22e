"""Registered sales queries."""

from __future__ import annotations

from cairn.plans import sales
from cairn.plans.registry import register
from cairn.plans.sales_job import refresh_sales_analytics
from cairn.sources import files, writers

_STAR = """
FROM lineitem
JOIN orders   ON l_orderkey = o_orderkey
JOIN customer ON o_custkey = c_custkey
JOIN nation   ON c_nationkey = n_nationkey
JOIN region   ON n_regionkey = r_regionkey
"""

_SUMMARY_COLS = """
SELECT r_name AS region, c_mktsegment AS market_segment,
       CAST(count(o_orderkey) AS BIGINT) AS order_count,
       CAST(CAST(sum(CAST(l_extendedprice AS DECIMAL(12,2)) * (1 - CAST(l_discount AS DECIMAL(4,2))))
            AS DECIMAL(18,2)) AS DOUBLE) AS net_revenue,
       CAST(CAST(sum(CAST(l_extendedprice AS DECIMAL(12,2)) * CAST(l_discount AS DECIMAL(4,2)))
            AS DECIMAL(18,2)) AS DOUBLE) AS discount_given,
       round(CAST(sum(CAST(o_totalprice AS DECIMAL(12,2))) AS DOUBLE) / count(*), 2) AS avg_order_value,
       round(CAST(sum(CASE WHEN l_shipdate > o_orderdate + INTERVAL 60 DAY THEN 1 ELSE 0 END) AS DOUBLE)
             / count(*), 4) AS late_ship_rate
"""


@register("sales_summary", oracle=_SUMMARY_COLS + _STAR + "GROUP BY r_name, c_mktsegment")
def sales_summary(spark, root):
    return sales.segment_summary(sales.customer_rollup(spark, root, "ALL", None))


@register("sales_summary_building", oracle=_SUMMARY_COLS + _STAR + """
WHERE o_orderdate >= TIMESTAMP '1997-01-01' AND upper(c_mktsegment) = upper('building')
GROUP BY r_name, c_mktsegment""")
def sales_summary_building(spark, root):
    """P14 + A3: the parametrised call of the source job (segment given in
    another case, orders since 1997)."""
    return sales.segment_summary(sales.customer_rollup(spark, root, "building", "1997-01-01"))


@register("late_rate", oracle="""
SELECT r_name AS region,
       round(CAST(sum(CASE WHEN l_shipdate > o_orderdate + INTERVAL 60 DAY THEN 1 ELSE 0 END) AS DOUBLE)
             / count(*), 4) AS late_ship_rate
""" + _STAR + "GROUP BY r_name")
def late_rate(spark, root):
    """A4: rate = average of a 0/1 flag, per region."""
    from pyspark.sql import functions as F
    from cairn.functions import money
    r = sales.customer_rollup(spark, root, "ALL", None)
    agg = r.groupBy("r_name").agg(F.sum("late").alias("late"), F.sum("n_lines").alias("n"))
    return agg.select(F.col("r_name").alias("region"),
                      money.ratio(F.col("late"), F.col("n"), 4).alias("late_ship_rate"))


_TOP = """
WITH per_name AS (
  SELECT r_name, c_mktsegment, c_name,
         CAST(CAST(sum(CAST(l_extendedprice AS DECIMAL(12,2)) * (1 - CAST(l_discount AS DECIMAL(4,2))))
              AS DECIMAL(18,2)) AS DOUBLE) AS net_revenue
  """ + _STAR + """ {where}
  GROUP BY r_name, c_mktsegment, c_name
), ranked AS (
  SELECT *, CAST(rank() OVER (PARTITION BY r_name, c_mktsegment ORDER BY net_revenue DESC) AS BIGINT)
            AS revenue_rank
  FROM per_name
)
SELECT r_name AS region, c_mktsegment AS market_segment, c_name AS customer_name,
       net_revenue, revenue_rank
FROM ranked WHERE revenue_rank <= {n}
"""


@register("top_customers", oracle=_TOP.format(where="", n=5))
def top_customers(spark, root):
    return sales.top_customers(sales.customer_rollup(spark, root, "ALL", None), 5)


@register("top_customers_building", oracle=_TOP.format(
    where="WHERE o_orderdate >= TIMESTAMP '1997-01-01' AND upper(c_mktsegment) = 'BUILDING'", n=5))
def top_customers_building(spark, root):
    return sales.top_customers(sales.customer_rollup(spark, root, "BUILDING", "1997-01-01"), 5)


def _refreshed(spark, root) -> str:
    """Where the job has stored its tables: all segments, then one again since 1997."""
    dst = files.shared_folder(spark, "sales-job")
    refresh_sales_analytics(spark, root, dst)
    refresh_sales_analytics(spark, root, dst, "BUILDING", "1997-01-01", 3)
    return dst


@register("sales_refresh", oracle=_SUMMARY_COLS + _STAR + """
WHERE upper(c_mktsegment) <> 'BUILDING' OR o_orderdate >= TIMESTAMP '1997-01-01'
GROUP BY r_name, c_mktsegment""")
def sales_refresh(spark, root):
    """D3: the stored summary after a run for all segments and one that merges
    a segment's rows since 1997 into it."""
    return writers.read_current(spark, f"{_refreshed(spark, root)}/sales_summary").drop("refreshed_at")


@register("sales_refresh_audit", oracle=f"""
WITH everyone AS ({_TOP.format(where="", n=5)}),
building AS ({_TOP.format(where="WHERE o_orderdate >= TIMESTAMP '1997-01-01' AND upper(c_mktsegment) = 'BUILDING'", n=3)})
SELECT 'ALL' AS market_segment, CAST(NULL AS DATE) AS min_order_date,
       (SELECT count(*) FROM (SELECT DISTINCT r_name, c_mktsegment {_STAR})) AS segment_rows,
       (SELECT count(*) FROM everyone) AS customer_rows, 'SUCCESS' AS status
UNION ALL
SELECT 'BUILDING', DATE '1997-01-01',
       (SELECT count(*) FROM (SELECT DISTINCT r_name, c_mktsegment {_STAR}
                              WHERE o_orderdate >= TIMESTAMP '1997-01-01' AND upper(c_mktsegment) = 'BUILDING')),
       (SELECT count(*) FROM building), 'SUCCESS'""")
def sales_refresh_audit(spark, root):
    """D3: the audit rows of both runs, with what each wrote."""
    return spark.read.parquet(f"{_refreshed(spark, root)}/refresh_audit").drop("run_id", "run_ts")
