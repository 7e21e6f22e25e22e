"""Predicates whose SQL meaning is easy to get wrong at scale."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def not_in_subquery(outer: DataFrame, outer_key: str, inner: DataFrame, inner_key: str) -> DataFrame:
    """``outer_key NOT IN (SELECT inner_key FROM inner)`` with SQL's
    three-valued meaning:

    * empty subquery: every outer row survives (NULL keys too);
    * subquery holding a NULL: nothing survives;
    * otherwise: rows whose key is non-NULL and absent from the subquery.

    Spark plans a literal ``NOT IN`` as a null-aware anti join, which needs
    the subquery side broadcast and degrades to a nested-loop join when it is
    large. Here the two counts that decide the case are a scalar subquery of
    the plan (no job while the query is built), and the join is a plain
    shuffled ``left_anti`` that scales with both sides. A NULL key never
    equals a subquery key, so the filter alone decides about it.
    """
    none = inner.select(F.count(F.lit(1)) == 0).scalar()
    no_null = inner.select(F.count(F.when(F.col(inner_key).isNull(), 1)) == 0).scalar()
    keys = inner.select(F.col(inner_key).alias("_nin_key"))
    return (outer.filter(none | (no_null & F.col(outer_key).isNotNull()))
                 .join(keys, F.col(outer_key) == F.col("_nin_key"), "left_anti"))


def delete_predicate(pred: Column) -> Column:
    """K7: a DELETE removes rows where the predicate is TRUE; NULL keeps."""
    return ~F.coalesce(pred, F.lit(False))
