"""Order-dependent computations without a single-partition window.

``Window.orderBy`` with no partition key moves every row to one task. The
helpers here first aggregate to distinct values and write those in ``BUCKETS``
ranges with about as many values each: the edges are quantiles that Spark
samples for a range partitioning, whatever the type and however the values
crowd. Sums over earlier ranges, a row per range, are then added to a running
sum inside each. The distinct values are computed once and read back from the
shared folder; nothing is collected and no Python runs.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cairn.sources import files

BUCKETS = 64


def in_ranges(values: DataFrame, v: str, buckets: int | None = None) -> DataFrame:
    """``values`` (distinct, non-NULL ``v``) with ``_bucket``, the range that a
    value lies in, written to the shared folder. A larger number is a range of
    larger values. There are at least as many ranges as shuffle partitions, so
    that a range stays a fraction of a task's work at any size."""
    n = buckets or max(BUCKETS, int(values.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    return files.staged(values.repartitionByRange(n, v).withColumn("_bucket", F.spark_partition_id()), "ranges")


def with_sums_before(values: DataFrame, v: str, sums: Sequence[str], buckets: int | None = None) -> DataFrame:
    """``values`` (distinct, non-NULL ``v``) with ``_bucket`` and, for each
    column of ``sums``, ``before_<column>``: its total over all smaller values."""
    placed = in_ranges(values, v, buckets)
    earlier = Window.orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)  # over a row per range
    totals = placed.groupBy(F.col("_bucket").alias("_b")).agg(*(F.sum(s).cast("bigint").alias(s) for s in sums))
    starts = totals.select("_b", *(F.coalesce(F.sum(s).over(earlier), F.lit(0)).alias(f"_start_{s}") for s in sums))
    inside = Window.partitionBy("_bucket").orderBy(v).rowsBetween(Window.unboundedPreceding, -1)
    local = placed.withColumns({f"_in_{s}": F.coalesce(F.sum(s).over(inside), F.lit(0)) for s in sums})
    joined = local.join(starts, F.col("_bucket") == F.col("_b"))
    return joined.select(*values.columns, "_bucket", *((F.col(f"_start_{s}") + F.col(f"_in_{s}")).cast("bigint").alias(f"before_{s}") for s in sums))


def rank_global(df: DataFrame, order_cols: Sequence[str], descending: bool = True, rank_col: str = "rank") -> DataFrame:
    """RANK over the whole set by one column, NULLs last. Equal values are
    one row with a count before anything is ordered, so a value held by a
    third of the rows costs no more than any other; the rank is joined back."""
    (v,) = order_cols
    counts = df.filter(F.col(v).isNotNull()).groupBy(v).agg(F.count(F.lit(1)).alias("_n"))
    ranked = files.staged(with_sums_before(counts, v, ["_n"]).select(F.col(v).alias("_v"), "_n", "before__n"), "ranks")
    known = F.coalesce(ranked.agg(F.sum("_n")).scalar(), F.lit(0))
    ahead = known - F.col("before__n") - F.col("_n") if descending else F.col("before__n")
    return (df.join(ranked, F.col(v) == F.col("_v"), "left")
              .withColumn(rank_col, (F.coalesce(ahead, known) + 1).cast("bigint")).drop("_v", "_n", "before__n"))


def row_number_within(df: DataFrame, partition_cols: Sequence[str], order: Sequence[Column], out: str = "row_number",
                      step: Column | None = None) -> DataFrame:
    """ROW_NUMBER() OVER (PARTITION BY keys ORDER BY ...) for hot keys.

    ``step`` is a coarse monotone function of the first order column (a
    month, say): rows are numbered within (key, step), and the counts of the
    key's earlier steps, a row per key and step, are added. A key that holds
    a third of all rows is spread over its steps. Without ``step`` a key is
    numbered in one task."""
    if step is None:
        return df.withColumn(out, F.row_number().over(Window.partitionBy(*partition_cols).orderBy(*order)).cast("bigint"))
    stepped = df.withColumn("_step", step)
    keys = [*partition_cols, "_step"]
    counts = stepped.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    earlier = Window.partitionBy(*partition_cols).orderBy("_step").rowsBetween(Window.unboundedPreceding, -1)
    before = counts.select(*(F.col(c).alias(f"_k_{c}") for c in keys), F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"))
    local = stepped.withColumn("_nth", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    same = reduce(lambda a, b: a & b, (F.col(c).eqNullSafe(F.col(f"_k_{c}")) for c in keys))
    return (local.join(before, same).withColumn(out, (F.col("_before") + F.col("_nth")).cast("bigint"))
                 .drop("_step", "_nth", "_before", *(f"_k_{c}" for c in keys)))
