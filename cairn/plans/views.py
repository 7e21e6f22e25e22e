"""Views as stored queries (temp views), resolved fresh at each use."""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from cairn.session import read_table


def order_summary_view(spark: SparkSession, root: str, name: str = "v_order_summary") -> str:
    """Standard view: orders joined to customers (and country) under clean
    names."""
    o = read_table(spark, root, "orders")
    c = read_table(spark, root, "customer")
    n = F.broadcast(read_table(spark, root, "nation"))  # fixed 25 rows
    (o.join(c, o["o_custkey"] == c["c_custkey"])
      .join(n, F.col("c_nationkey") == F.col("n_nationkey"))
      .select(F.col("o_orderkey").alias("order_id"), F.col("c_name").alias("customer_name"),
              F.col("n_name").alias("country"), F.col("o_orderstatus").alias("status"),
              F.col("o_totalprice").alias("amount"), F.col("o_orderdate").alias("order_ts"))
      .createOrReplaceTempView(name))
    return name


def contact_view(spark: SparkSession, root: str, name: str = "v_customer_contact_secure") -> str:
    """Projection view exposing id, name and country only. Hiding the view
    text from its readers is a catalog feature and is not built."""
    c = read_table(spark, root, "customer")
    n = F.broadcast(read_table(spark, root, "nation"))
    (c.join(n, F.col("c_nationkey") == F.col("n_nationkey"))
      .select(F.col("c_custkey").alias("customer_id"), F.col("c_name").alias("name"),
              F.col("n_name").alias("country"))
      .createOrReplaceTempView(name))
    return name
