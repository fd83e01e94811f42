"""Null rules that every feature keeps: no NaN, no infinity, no division by zero."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def safe_div(num: Column, den: Column) -> Column:
    """Quotient; null where the denominator is 0 or null."""
    return num / F.nullif(den, F.lit(0.0))


def finite(x: Column) -> Column:
    """Null for NaN and infinities."""
    return F.when(~F.isnan(x) & (F.abs(x) != float("inf")), x)


def flag(cond: Column) -> Column:
    """1 or 0; a null condition is 0."""
    return F.coalesce(cond, F.lit(False)).cast("int")


def r6(x: Column) -> Column:
    """Accumulated values are rounded last, to 6 places; a negative zero becomes 0."""
    return F.round(x, 6) + F.lit(0.0)
