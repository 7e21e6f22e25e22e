"""Registered feature, UDF and source queries (M1, A9 / M4, D1, D2 / J6 /
F18, D4, S4, S5, S10)."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F
from pyspark.sql import types as T

from cairn.functions import scalars, udfs
from cairn.plans import features
from cairn.plans.registry import register
from cairn.session import read_table, table_path
from cairn.sources import readers

_FEATURES_SQL = """
WITH o AS (
  SELECT o_orderkey AS order_id, o_custkey AS customer_id,
         strptime(strftime(o_orderdate, '%Y-%m-%d %H:%M:%S'), '%Y-%m-%d %H:%M:%S') AS order_ts,
         o_orderpriority AS courier, o_totalprice FROM orders),
l AS (
  SELECT l_orderkey AS order_id, count(*) AS package_weight_kg, count(DISTINCT l_suppkey) AS handoffs,
         sum(CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END) AS prior_delays, max(l_shipdate) AS last_ship
  FROM lineitem GROUP BY l_orderkey),
d AS (SELECT * FROM o JOIN l USING (order_id)),
f AS (
  SELECT order_id, o_totalprice / 1000 AS distance_km, CAST(package_weight_kg AS DOUBLE) AS package_weight_kg,
         CASE WHEN courier = '1-URGENT' THEN 0 WHEN courier = '2-HIGH' THEN 1 ELSE 2 END AS priority_code,
         CAST(handoffs AS BIGINT) AS handoffs, CAST(prior_delays AS BIGINT) AS prior_delays,
         CAST(hour(order_ts) AS BIGINT) AS departure_hour, CAST(dayofweek(order_ts) AS BIGINT) AS departure_dow,
         CASE WHEN dayofweek(order_ts) IN (0, 6) THEN 1 ELSE 0 END AS is_weekend,
         CASE WHEN hour(order_ts) >= 17 AND hour(order_ts) <= 20 THEN 1 ELSE 0 END AS is_peak,
         CAST(count(*) OVER (PARTITION BY courier) AS BIGINT) AS courier_total_orders,
         CAST(row_number() OVER (PARTITION BY customer_id ORDER BY order_ts, order_id) AS BIGINT)
           AS customer_order_seq,
         date_diff('second', order_ts, last_ship) / CAST(60.0 AS DOUBLE) AS delivery_delay_minutes
  FROM d)
"""


@register("delivery_features", oracle=_FEATURES_SQL + "SELECT * FROM f")
def delivery_features(spark, root):
    """M1: feature table (join, parsed time, calendar, codes, window
    features)."""
    return features.delivery_features(spark, root)


@register("regression_metrics", oracle=_FEATURES_SQL + """,
p AS (SELECT delivery_delay_minutes AS y,
             avg(delivery_delay_minutes) OVER (PARTITION BY priority_code) AS yhat FROM f),
m AS (SELECT avg(y) AS mean FROM p)
SELECT round(avg(abs(y - yhat)), 2) AS mae,
       round(1 - sum((y - yhat) * (y - yhat)) / sum((y - mean) * (y - mean)), 6) AS r2
FROM p, m""")
def regression_metrics(spark, root):
    """MAE and R^2 of a predictor (the mean delay of the order's
    priority class, an aggregate joined back) against the label."""
    f = features.delivery_features(spark, root)
    means = f.groupBy("priority_code").agg(F.avg(features.LABEL).alias("yhat"))
    pred = f.join(means, "priority_code")
    return features.regression_metrics(pred, features.LABEL, "yhat")


@register("order_tier", oracle="""
SELECT event_id, value, CASE WHEN value IS NULL THEN 'UNKNOWN' WHEN value >= 250 THEN 'GOLD'
                             WHEN value >= 100 THEN 'SILVER' ELSE 'BRONZE' END AS tier FROM events""")
def order_tier(spark, root):
    """Amount to GOLD / SILVER / BRONZE / UNKNOWN."""
    e = read_table(spark, root, "events")
    return e.select("event_id", "value", scalars.order_tier(F.col("value")).alias("tier"))


def _tagged(spark, root):
    c = read_table(spark, root, "customer")
    n = F.broadcast(read_table(spark, root, "nation"))  # fixed 25 rows
    tags = F.concat(F.col("c_mktsegment"), F.lit(","),
                    F.when(F.col("c_acctbal") > 5000, "vip").otherwise(""), F.lit(", "), F.col("n_name"))
    return (c.join(n, F.col("c_nationkey") == F.col("n_nationkey"))
             .select(F.col("c_custkey").alias("customer_id"), tags.alias("tags")))


_TAGS_SQL = """
WITH t AS (
  SELECT c_custkey AS customer_id,
         c_mktsegment || ',' || CASE WHEN c_acctbal > 5000 THEN 'vip' ELSE '' END || ', ' || n_name AS tags
  FROM customer JOIN nation ON c_nationkey = n_nationkey),
s AS (SELECT customer_id, trim(unnest(string_split(tags, ','))) AS tag FROM t)
SELECT customer_id, tag FROM s WHERE tag <> ''"""


@register("lateral_split_tags", oracle=_TAGS_SQL)
def lateral_split_tags(spark, root):
    """Comma tags to rows (strip blanks, drop empties), as a
    native generator."""
    return udfs.explode_tags(_tagged(spark, root), "tags")


@register("lateral_split_tags_udtf", oracle=_TAGS_SQL)
def lateral_split_tags_udtf(spark, root):
    """The same through the Python table function called LATERAL from
    SQL, as the source registers it."""
    view = f"cairn_tags_{uuid.uuid4().hex[:8]}"
    _tagged(spark, root).createOrReplaceTempView(view)
    udfs.register_split_tags(spark)
    return spark.sql(f"SELECT v.customer_id, t.tag FROM {view} v, LATERAL split_tags(v.tags) t")


@register("tax_batched", oracle="""
SELECT event_id, value, CAST(round(CAST(value AS DECIMAL(12,2)) * 1.08, 2) AS DOUBLE) AS amount_with_tax
FROM events""")
def tax_batched(spark, root):
    """A remote per-row function called once per Arrow batch (the tax
    service stand-in: amount * 1.08, half-up to cents)."""
    e = read_table(spark, root, "events").select("event_id", "value")
    return udfs.call_batched(e, ["value"], "amount_with_tax", T.DoubleType(), udfs.tax_service())


# fixed values: order status names
_STATUS = [("F", "FINISHED"), ("O", "OPEN"), ("P", "PENDING")]


@register("inline_values", oracle="""
WITH s(status, description) AS (VALUES ('F', 'FINISHED'), ('O', 'OPEN'), ('P', 'PENDING'))
SELECT status, description, CAST(count(*) AS BIGINT) AS order_count
FROM orders JOIN s ON o_orderstatus = status GROUP BY status, description""")
def inline_values(spark, root):
    """An inline VALUES table joined to a table (broadcast: it is a
    literal of fixed size)."""
    s = readers.inline_rows(spark, _STATUS, "status string, description string")
    o = read_table(spark, root, "orders")
    return (o.groupBy(F.col("o_orderstatus").alias("status")).agg(F.count(F.lit(1)).alias("order_count"))
             .join(F.broadcast(s), "status").select("status", "description", "order_count"))


_TARGET = T.StructType([
    T.StructField("ORDER_ID", T.LongType()), T.StructField("Customer_Key", T.LongType()),
    T.StructField("AMOUNT", T.DecimalType(12, 2)), T.StructField("COMMENT", T.StringType())])


@register("parquet_by_name", oracle="""
SELECT o_orderkey AS ORDER_ID, o_custkey AS Customer_Key, CAST(o_totalprice AS DECIMAL(12,2)) AS AMOUNT,
       CAST(NULL AS VARCHAR) AS COMMENT FROM orders""")
def parquet_by_name(spark, root):
    """Parquet matched to a declared schema by case-insensitive name;
    the absent column is NULL, extra source columns are ignored."""
    t = T.StructType([T.StructField("o_orderkey".upper(), T.LongType()),
                      T.StructField("O_CUSTKEY", T.LongType()),
                      T.StructField("o_TotalPrice", T.DecimalType(12, 2)),
                      T.StructField("comment", T.StringType())])
    df = readers.read_parquet_by_name(spark, table_path(root, "orders"), t)
    return df.toDF("ORDER_ID", "Customer_Key", "AMOUNT", "COMMENT")


@register("load_lineage", oracle="SELECT o_orderkey, 'orders.parquet' AS source_file FROM orders")
def load_lineage(spark, root):
    """Rows with their source file (the load time column is checked in
    unit tests; it is not comparable across engines)."""
    df = readers.with_lineage(read_table(spark, root, "orders").select("o_orderkey"))
    return df.select("o_orderkey", "source_file")
