"""Whole-number arithmetic on BIGINT columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _column(value: Column | int) -> Column:
    return value if isinstance(value, Column) else F.lit(value)


def whole_div(a: Column | int, b: Column | int) -> Column:
    """a / b without the fraction, exact for every BIGINT."""
    return F.call_function("div", _column(a), _column(b))


def ceil_div(a: Column | int, b: Column | int) -> Column:
    """The smallest whole number not below a / b, for a >= 0 and b > 0."""
    a, b = _column(a), _column(b)
    return whole_div(a + b - 1, b)
