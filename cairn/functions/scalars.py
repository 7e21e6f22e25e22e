"""Scalar column functions.

All are built-in Spark expressions, so they stay inside whole-stage codegen;
none crosses into Python.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def iff(cond: Column, a, b) -> Column:
    """IFF(cond, a, b)."""
    return F.when(cond, a).otherwise(b)


def encode(c: Column, values: Sequence[str], default: int) -> Column:
    """Encode text to its position in ``values``, else ``default``."""
    out = None
    for i, v in enumerate(values):
        out = F.when(c == v, i) if out is None else out.when(c == v, i)
    return out.otherwise(default) if out is not None else F.lit(default)


def order_tier(amount: Column) -> Column:
    """GOLD at 250 and up, SILVER at 100 and up, BRONZE below, UNKNOWN
    for NULL."""
    # fixed values: tier names and cut-offs of the source function
    return (F.when(amount.isNull(), "UNKNOWN")
             .when(amount >= 250, "GOLD")
             .when(amount >= 100, "SILVER")
             .otherwise("BRONZE"))


def sentiment_label(score: Column) -> Column:
    """>= 0.3 POSITIVE, <= -0.3 NEGATIVE, else (and NULL) NEUTRAL."""
    return (F.when(score >= 0.3, "POSITIVE")
             .when(score <= -0.3, "NEGATIVE")
             .otherwise("NEUTRAL"))


def priority_band(score: Column) -> Column:
    """< -0.3 HIGH, < 0.3 MEDIUM, else (and NULL) LOW. At exactly
    -0.3 the label is NEGATIVE and the priority MEDIUM."""
    return (F.when(score < -0.3, "HIGH")
             .when(score < 0.3, "MEDIUM")
             .otherwise("LOW"))


def mask_email_greedy(email: Column) -> Column:
    """G1 mask: everything up to the last @ becomes ****."""
    return F.regexp_replace(email, r".+@", "****@")


def mask_email_local(email: Column) -> Column:
    """G5 mask: the local part up to the first @ becomes ****."""
    return F.regexp_replace(email, r"^[^@]+", "****")


def mask_phone(phone: Column) -> Column:
    """G1: a fully masked phone number; a missing one is masked too, so that
    a reader cannot tell who has none."""
    return F.lit("***-****")


def demo_email(name: Column, key: Column) -> Column:
    """A deterministic address derived from driver columns, so masking can
    be checked on every customer row."""
    return F.concat(F.lower(F.replace(name, F.lit("#"), F.lit("."))), F.lit("@shop"),
                    (key % 3).cast("string"), F.lit(".com"))


def parse_timestamp(text: Column, fmt: str = "yyyy-MM-dd HH:mm:ss") -> Column:
    """TO_TIMESTAMP(text, 'YYYY-MM-DD HH24:MI:SS') without a zone."""
    return F.to_timestamp_ntz(text, F.lit(fmt))


def day_of_week(ts: Column) -> Column:
    """day of week with 0 = Sunday .. 6 = Saturday (Spark's
    ``dayofweek`` is 1 = Sunday)."""
    return (F.dayofweek(ts) - 1).cast("bigint")


def calendar_columns(ts: Column, prefix: str = "departure") -> list[Column]:
    """Hour, day of week, weekend flag, peak-hour flag (17..20
    inclusive)."""
    hour = F.hour(ts).cast("bigint")
    dow = day_of_week(ts)
    return [hour.alias(f"{prefix}_hour"), dow.alias(f"{prefix}_dow"),
            iff(dow.isin(0, 6), 1, 0).alias("is_weekend"),
            iff((hour >= 17) & (hour <= 20), 1, 0).alias("is_peak")]


def split_tags(text: Column) -> Column:
    """split on commas, strip blanks, drop empty pieces; NULL gives an
    empty array."""
    parts = F.transform(F.split(F.coalesce(text, F.lit("")), ","), lambda x: F.trim(x))
    return F.filter(parts, lambda x: x != "")


def tax(amount: Column, rate: float = 0.08) -> Column:
    """D4 tax formula: amount * (1 + rate), half-up to cents."""
    return F.round(amount.cast("decimal(12,2)") * F.lit(1 + rate).cast("decimal(4,2)"), 2).cast("double")
