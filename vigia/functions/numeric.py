"""Rounding, means and clamping as column expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F, types as T


def round_half_up(value: Column, digits: int = 2) -> Column:
    """Spark's ROUND: half up on the decimal text of the number."""
    return F.round(value, digits)


def round_ties_up(value: Column, digits: int = 2) -> Column:
    """Binary half-up for values >= 0; every SQL engine agrees on it."""
    scale = float(10**digits)
    return F.floor(value * F.lit(scale) + F.lit(0.5)).cast("double") / F.lit(scale)


def exact_sum(column: str, dtype: T.DataType) -> Column:
    """SUM that neither overflows early nor depends on row order.

    SUM(DECIMAL(p, s)) has ten digits more than p: for DECIMAL(5,2) it ends at
    10^13, about 10^11 rows.  Eight digits give a sum of 18, the most Spark
    adds as a BIGINT; wider inputs take all 38 and are never narrowed.
    """
    if isinstance(dtype, T.DecimalType):
        digits = 8 if dtype.precision <= 8 else max(28, dtype.precision)
        return F.sum(F.col(column).cast(T.DecimalType(digits, dtype.scale)))
    return F.sum(column)


def mean(column: str, dtype: T.DataType) -> Column:
    """AVG as DOUBLE; exact types are summed exactly and divided once."""
    rows = F.count(column)
    if isinstance(dtype, T.DecimalType) and dtype.precision <= 8:
        unit = F.lit(10**dtype.scale)
        total = (exact_sum(column, dtype) * unit).cast("bigint")
        return total.cast("double") / (rows * unit).cast("double")
    if isinstance(dtype, (T.ByteType, T.ShortType, T.IntegerType)):
        return F.sum(column).cast("double") / rows.cast("double")
    return F.avg(F.col(column).cast("double"))


def clamp(value: Column, cap: int | float | None = None) -> Column:
    """max(0, min(cap, value))."""
    bounded = value if cap is None else F.least(F.lit(cap), value)
    return F.greatest(F.lit(0), bounded)
