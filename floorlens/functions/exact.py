"""Decimal arithmetic that rounds half away from zero, once, at the stated scale."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Wide enough for 10^18 currency units or 4-decimal ratios; narrow enough that a quotient keeps
# 12 or more decimals before it is rounded.
AMOUNT = "decimal(22,4)"


def _col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def ratio(numerator: Column | str, denominator: Column | str, scale: int = 4) -> Column:
    """numerator / denominator as a decimal, NULL where the denominator is zero."""
    bottom = _col(denominator).cast(AMOUNT)
    quotient = _col(numerator).cast(AMOUNT) / F.nullif(bottom, F.lit(0).cast(AMOUNT))
    return quotient.cast(f"decimal(18,{scale})")


def percent(part: Column | str, whole: Column | str, scale: int = 2) -> Column:
    top = _col(part).cast(AMOUNT) * F.lit(100)
    bottom = F.nullif(_col(whole).cast(AMOUNT), F.lit(0).cast(AMOUNT))
    return (top / bottom).cast(f"decimal(18,{scale})")


def mean(value: Column | str, scale: int = 2) -> Column:
    """Aggregate: exact mean of the non-null values."""
    return ratio(F.sum(value), F.count(value), scale)


def mean_over(value: Column | str, window, scale: int = 2) -> Column:
    return ratio(F.sum(value).over(window), F.count(value).over(window), scale)


def count_if(condition: Column) -> Column:
    """Aggregate: number of rows where the condition holds (0 for an all-false group)."""
    return F.sum(F.when(condition, 1).otherwise(0))


def sum_if(condition: Column, value: Column | str) -> Column:
    return F.sum(F.when(condition, _col(value)).otherwise(F.lit(0)))


def zero_if_null(name: str) -> Column:
    return F.coalesce(F.col(name), F.lit(0)).alias(name)


def near(value: Column | str, places: int = 2) -> Column:
    """Float rounding: nearest, halves to even."""
    factor = F.lit(float(10**places))
    return F.rint(_col(value).cast("double") * factor) / factor
