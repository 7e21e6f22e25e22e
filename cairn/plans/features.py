"""Feature building for the delivery-delay model (M1), on the driver tables.

Stand-ins for the source's delivery tables: courier <- order priority,
customer <- o_custkey, order time <- o_orderdate (formatted to text and
parsed back, as the source parses its timestamp strings), distance <- order
value / 1000, weight <- line count, label <- days from order to the latest
ship date of its lines.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cairn.functions import scalars
from cairn.operators.ordered import row_number_within
from cairn.session import read_table

FEATURES = ["distance_km", "package_weight_kg", "priority_code", "handoffs", "prior_delays",
            "departure_hour", "departure_dow", "is_weekend", "is_peak",
            "courier_total_orders", "customer_order_seq"]
LABEL = "delivery_delay_minutes"


def delivery_features(spark: SparkSession, root: str) -> DataFrame:
    orders = read_table(spark, root, "orders").select(
        F.col("o_orderkey").alias("order_id"), F.col("o_custkey").alias("customer_id"),
        F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss").alias("order_ts_text"),
        F.col("o_orderpriority").alias("courier"), "o_totalprice")
    # logistics side: one row per order from its lines (partial aggregate)
    lines = read_table(spark, root, "lineitem").groupBy(F.col("l_orderkey").alias("order_id")).agg(
        F.count(F.lit(1)).alias("package_weight_kg"),
        F.countDistinct("l_suppkey").alias("handoffs"),
        F.sum(F.when(F.col("l_returnflag") == "R", 1).otherwise(0)).alias("prior_delays"),
        F.max("l_shipdate").alias("last_ship"))
    df = orders.join(lines, ["order_id"], "inner")                       # J3: USING order_id
    ts = scalars.parse_timestamp(F.col("order_ts_text"))                 # F6
    df = df.withColumn("order_ts", ts)
    df = df.select("*", *scalars.calendar_columns(F.col("order_ts")))    # F7, F8
    df = df.withColumn("priority_code", scalars.encode(F.col("courier"), ["1-URGENT", "2-HIGH"], 2))  # P6
    # Volume per courier as an aggregate joined back (a courier holding a
    # third of all orders is partially aggregated, not windowed in one task)
    vol = df.groupBy("courier").agg(F.count(F.lit(1)).alias("courier_total_orders"))
    df = df.join(vol, "courier")
    # Position in the customer's history, ties broken by the key (the
    # skew-safe row number: a hot customer does not sit in one task)
    df = row_number_within(df, ["customer_id"], [F.col("order_ts"), F.col("order_id")], "customer_order_seq",
                           step=F.date_format("order_ts", "yyyyMM"))
    delay = (F.unix_timestamp("last_ship") - F.unix_timestamp("order_ts")) / 60.0
    return df.select("order_id",
                     (F.col("o_totalprice") / 1000).alias("distance_km"),
                     F.col("package_weight_kg").cast("double").alias("package_weight_kg"),
                     "priority_code", F.col("handoffs").cast("bigint").alias("handoffs"),
                     F.col("prior_delays").cast("bigint").alias("prior_delays"),
                     "departure_hour", "departure_dow", "is_weekend", "is_peak",
                     "courier_total_orders", "customer_order_seq", delay.alias(LABEL))


def regression_metrics(pred: DataFrame, label: str, prediction: str) -> DataFrame:
    """Mean absolute error and R^2 as one pass of aggregates: the
    total sum of squares is n times the population variance of the label."""
    error = F.col(label) - F.col(prediction)
    sums = pred.agg(F.avg(F.abs(error)).alias("mae"), F.sum(error * error).alias("sse"),
                    F.count(label).alias("n"), F.var_pop(label).alias("spread"))
    return sums.select(F.round("mae", 2).alias("mae"),
                       F.round(F.lit(1.0) - F.col("sse") / (F.col("n") * F.col("spread")), 6).alias("r2"))
