"""Relational building blocks that need more than one DataFrame call.

Plain projections, filters, joins and aggregates are used directly from the
DataFrame API in the plans; this module holds the pieces with a scale
argument behind them: optional filters, bounded dimension broadcasts, ranked
top-N per group. The global RANK is in ``cairn.operators.ordered``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Dimension tables whose row count is fixed by the data model, independent of
# the scale factor (TPC-H: 25 nations, 5 regions). Broadcasting them is always
# safe; anything else goes through AQE's runtime size check instead.
BOUNDED_DIMENSIONS = {"nation": 25, "region": 5}


def dimension(df: DataFrame, name: str) -> DataFrame:
    """Mark a fixed-cardinality dimension for a broadcast hash join."""
    if name not in BOUNDED_DIMENSIONS:
        raise ValueError(f"{name!r} has no fixed size bound; let AQE decide")
    return F.broadcast(df)


def everyone(value: str | None) -> bool:
    """Does an optional filter's value ask for all rows?"""
    return value is None or str(value).upper() == "ALL"


def filter_optional_equal(df: DataFrame, column: str, value: str | None) -> DataFrame:
    """Case-insensitive equality, skipped when value is None or 'ALL'."""
    if everyone(value):
        return df
    return df.filter(F.upper(F.col(column)) == F.upper(F.lit(value)))


def top_n_per_group(df: DataFrame, partition_by: Sequence[str], order_by: Sequence[Column],
                    n: int, rank_col: str = "rank") -> DataFrame:
    """RANK within each group, keep rank <= n (ties kept, so a group may
    return more than n rows). Catalyst turns the filter into a
    WindowGroupLimit on both sides of the exchange, so each map task ships at
    most the top rows of each group; a group holding a third of all rows
    costs one bounded heap per task, not a full sort of that group."""
    w = Window.partitionBy(*partition_by).orderBy(*order_by)
    return (df.withColumn(rank_col, F.rank().over(w))
              .filter(F.col(rank_col) <= n)
              .withColumn(rank_col, F.col(rank_col).cast("bigint")))

