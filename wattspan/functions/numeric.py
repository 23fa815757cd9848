"""Numeric column expressions."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def lenient_double(value: Column) -> Column:
    """Parse to double; unreadable values and NaN become NULL."""
    parsed = value.try_cast("double")
    return F.when(~F.isnan(parsed), parsed)


def row_mean(columns: Sequence[Column]) -> Column:
    """Mean across columns of one row, skipping NULLs; NULL when all are."""
    total = reduce(lambda a, b: a + b, [F.coalesce(c, F.lit(0.0)) for c in columns])
    present = reduce(lambda a, b: a + b, [c.isNotNull().cast("int") for c in columns])
    return F.try_divide(total, present.cast("double"))


def fahrenheit_to_celsius(value: Column) -> Column:
    return (value - 32.0) * 5.0 / 9.0


def ratio_or_null(top: Column, bottom: Column, floor: float = 0.0) -> Column:
    """top / bottom where bottom > floor, else NULL."""
    return F.when(bottom > floor, top / bottom)
