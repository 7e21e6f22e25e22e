"""Connected components of an edge list, as rounds of joins and aggregates.

Each round passes the smallest label to neighbours and to the old label's own
vertex, then shortens label chains by one jump, so the number of rounds grows
with the logarithm of a component's diameter. Every round is written to the
shared folder. Labels and links stay in Spark; the driver sees one sum a round.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cairn.llm.common import staged


def connected(edges: DataFrame, name: str = "component") -> DataFrame:
    """``edges`` (a, b: long) to (id, component): the least id reachable, for
    every id that has an edge. Repeated and reversed edges are fine."""
    both = staged(edges.select("a", "b").union(edges.select("b", "a")).filter("a <> b").distinct(), "edges")
    labels = staged(both.groupBy(F.col("a").alias("id")).agg(F.min("b").alias("low"))
                    .select("id", F.least("id", "low").alias("label")), "labels")
    total = None
    while True:
        near = (both.join(labels.withColumnRenamed("id", "b"), "b")
                .groupBy(F.col("a").alias("id")).agg(F.min("label").alias("low")))
        met = labels.join(near, "id")
        offers = labels.union(met.select("id", "low")).union(met.select("label", "low"))
        lower = staged(offers.groupBy("id").agg(F.min("label").alias("label")), "labels")
        jump = lower.select(F.col("id").alias("label"), F.col("label").alias("next"))
        labels = staged(lower.join(jump, "label").select("id", F.least("label", "next").alias("label")), "labels")
        now = labels.agg(F.sum(F.col("label").cast("decimal(38,0)"))).first()[0]
        if now == total:
            return labels.withColumnRenamed("label", name)
        total = now
