"""User functions: scalar UDF, table function, batched remote calls (D1, D2,
D4).

The query paths use built-in expressions where the logic allows (the tier
function is a CASE, the tag splitter is split + filter + explode), so they
stay in the JVM. Python registration helpers exist for SQL callers, and the
batched-call operator is the one place where Python is the point: it ships
Arrow batches to a user function (a model, a remote service) and gets one
value per row back in the same order.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from decimal import Decimal

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.functions import udtf

from cairn.functions import scalars


def register_order_tier(spark: SparkSession, name: str = "order_tier") -> None:
    """D1 for SQL callers: a SQL-bodied function (inlined by the analyzer,
    no Python at run time)."""
    spark.sql(f"""
        CREATE OR REPLACE TEMPORARY FUNCTION {name}(amount DOUBLE) RETURNS STRING
        RETURN CASE WHEN amount IS NULL THEN 'UNKNOWN' WHEN amount >= 250 THEN 'GOLD'
                    WHEN amount >= 100 THEN 'SILVER' ELSE 'BRONZE' END""")


@udtf(returnType="tag: string")
class SplitTags:
    """Comma-separated tags in, one row per non-empty trimmed tag out."""

    def eval(self, tags: str | None):
        if tags is None:
            return
        for t in tags.split(","):
            t = t.strip()
            if t:
                yield (t,)


def register_split_tags(spark: SparkSession, name: str = "split_tags") -> None:
    """D2 for SQL: ``SELECT ... FROM t, LATERAL split_tags(t.tags)``."""
    spark.udtf.register(name, SplitTags)


def explode_tags(df: DataFrame, tags_col: str, out: str = "tag") -> DataFrame:
    """D2 / J6 / F18 natively: split, strip, drop empties, one row per tag
    (a generator: narrow, no shuffle)."""
    return df.select(*[c for c in df.columns if c != tags_col],
                     F.explode(scalars.split_tags(F.col(tags_col))).alias(out))


def call_batched(df: DataFrame, in_cols: Sequence[str], out_col: str, out_type: T.DataType,
                 make_fn: Callable[[], Callable[[pd.DataFrame], pd.Series]]) -> DataFrame:
    """Call a batch function once per Arrow batch.

    ``make_fn`` runs once per task (open a session / client there); the
    function it returns gets a pandas frame of ``in_cols`` and returns one
    value per row, in order. Only ``in_cols`` go to Python; every other
    column stays in the JVM as it is. Batch size is
    ``spark.sql.execution.arrow.maxRecordsPerBatch``. A failed task is
    retried by Spark, so the remote call must be idempotent."""

    def run(batches):
        fn = make_fn()
        for pdf in batches:
            res = fn(pdf)
            if len(res) != len(pdf):
                raise ValueError("batch function returned a different number of rows")
            yield pd.Series(res)

    run.__annotations__ = {"batches": Iterator[pd.DataFrame], "return": Iterator[pd.Series]}
    return df.withColumn(out_col, F.pandas_udf(run, out_type)(F.struct(*in_cols)))


def tax_service(rate: str = "0.08") -> Callable[[], Callable[[pd.DataFrame], pd.Series]]:
    """Stand-in for the remote tax service: amount * (1 + rate), half-up to
    cents, in integers of a hundredth of a cent for the whole batch."""
    places = max(0, -Decimal(rate).as_tuple().exponent)
    factor, unit = int((1 + Decimal(rate)) * 10**places), 100 * 10**places

    def make():
        def fn(pdf: pd.DataFrame) -> pd.Series:
            amounts = pd.to_numeric(pdf.iloc[:, 0]).astype(float)
            known = amounts.fillna(0.0)
            units = (known.abs() * 10_000).round().astype("int64")
            # whole cents and the rest apart, so that no product outgrows 64 bits
            cents = units // unit * factor + (units % unit * factor + unit // 2) // unit
            return (cents.astype(float) / 100).where(known >= 0, -cents.astype(float) / 100).where(amounts.notna())
        return fn

    return make
