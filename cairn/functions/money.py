"""Exact money arithmetic on double-typed source columns.

Source prices are doubles holding exact cents. Summing doubles gives a result
that depends on the order of addition, so it differs between partitionings,
between runs with AQE re-planning, and between engines. Casting to decimal
first makes every sum exact and order-independent; the final value is cast
back to DOUBLE so the output type is the same in every engine.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

PRICE = "decimal(12,2)"
RATE = "decimal(4,2)"
TOTAL = "decimal(18,2)"


def price(c: str | Column) -> Column:
    return F.col(c).cast(PRICE) if isinstance(c, str) else c.cast(PRICE)


def rate(c: str | Column) -> Column:
    return F.col(c).cast(RATE) if isinstance(c, str) else c.cast(RATE)


def net_line(price_col: str = "l_extendedprice", disc_col: str = "l_discount") -> Column:
    """price * (1 - discount), exact."""
    return price(price_col) * (F.lit(1) - rate(disc_col))


def discount_line(price_col: str = "l_extendedprice", disc_col: str = "l_discount") -> Column:
    """price * discount, exact: the money given away."""
    return price(price_col) * rate(disc_col)


def to_money(sum_col: Column) -> Column:
    """A decimal sum rounded half-up to cents, as DOUBLE."""
    return sum_col.cast(TOTAL).cast("double")


def ratio(num: Column, den: Column, digits: int) -> Column:
    """round(num / den, digits) computed in double from exact parts; used for
    averages and rates instead of ``avg`` on decimals."""
    return F.round(num.cast("double") / den.cast("double"), digits)


# ---------------------------------------------------------------- fast exact sums
#
# Decimal sums whose result precision exceeds 18 digits keep a BigDecimal
# object per group in the aggregation buffer, about 3x slower than long
# sums. For hot paths, values are carried as integers in fixed units and
# each sum is split into two long accumulators: hi = units div 10^6 and
# lo = units mod 10^6. A line's units stay below 2^53 (prices below 10^7 in
# 1e-4 units times 10^2), so the split is exact in double arithmetic; both
# accumulators stay far from overflow up to about 9e12 rows per group
# (lo < 10^6 per row). The exact decimal is rebuilt only at the end, on
# the few output rows. In ANSI mode an overflow would fail loudly.

SPLIT = 1_000_000


def cents(c: str | Column) -> Column:
    """A money value as integer hundredths, rounded as ``price`` rounds it:
    near a half cent by the decimal cast itself, else in double arithmetic."""
    x = F.col(c) if isinstance(c, str) else c
    size = F.abs(x) * 100
    near_half = F.abs(size - F.floor(size) - 0.5) < 1e-6
    return F.when(near_half, (price(x) * 100).cast("bigint")).otherwise((F.signum(x) * F.floor(size + 0.5)).cast("bigint"))


def net_units(price_col: str = "l_extendedprice", disc_col: str = "l_discount") -> Column:
    """price * (1 - discount) in 1e-4 units, exact."""
    return cents(price_col) * (F.lit(100) - cents(disc_col))


def discount_units(price_col: str = "l_extendedprice", disc_col: str = "l_discount") -> Column:
    """price * discount in 1e-4 units, exact."""
    return cents(price_col) * cents(disc_col)


def split_sum(units: Column, name: str) -> list[Column]:
    """Aggregate expressions summing ``units`` as (name_hi, name_lo)."""
    lo = F.pmod(units, F.lit(SPLIT))
    hi = ((units - lo) / SPLIT).cast("bigint")
    return [F.sum(hi).alias(f"{name}_hi"), F.sum(lo).alias(f"{name}_lo")]


def resum(name: str) -> list[Column]:
    """Re-aggregate split sums at a coarser grouping."""
    return [F.sum(f"{name}_hi").alias(f"{name}_hi"), F.sum(f"{name}_lo").alias(f"{name}_lo")]


def exact(name: str, scale: int) -> Column:
    """The exact decimal value of a split sum kept in 10^-scale units."""
    whole = (F.col(f"{name}_hi").cast("decimal(38,0)") * F.lit(SPLIT).cast("decimal(38,0)")
             + F.col(f"{name}_lo").cast("decimal(38,0)"))
    return whole * F.lit(10 ** -scale).cast(f"decimal({scale},{scale})") if scale else whole
