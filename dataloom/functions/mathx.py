"""Numeric columns with the reference's rules (null on divide by zero, Java
copySign / scalb / IEEE remainder, half-even ROUND_TO)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def divide(a: Column, b: Column) -> Column:
    """a / b; division by zero gives null (Spark ANSI would throw)."""
    return F.try_divide(a, b)


def int_divide(a: Column, b: Column) -> Column:
    """int / int stays int (truncated); zero divisor gives null."""
    return F.when(b == 0, F.lit(None)).otherwise(F.try_divide(a, b).cast("long"))


def round_half_up(x: Column) -> Column:
    """ROUND: floor(x + 0.5) as a long."""
    return F.floor(x + F.lit(0.5))


def round_to(x: Column, digits: int, mode: str = "half_even") -> Column:
    """ROUND_TO(x, digits[, mode]); default half-even = ``bround``.

    Rounds the decimal value of x (as the reference rounds the decimal text of
    the double), so ties like 3994.45 resolve the same everywhere.
    """
    d = x.cast("decimal(38,10)")
    return (F.bround(d, digits) if mode == "half_even" else F.round(d, digits)).cast("double")


def copy_sign(x: Column, y: Column) -> Column:
    """Magnitude of x with the sign of y (+0 counts as positive)."""
    return F.when(y >= 0, F.abs(x)).otherwise(-F.abs(x))


def scalb(x: Column, n: Column) -> Column:
    return x * F.pow(F.lit(2.0), n)


def ieee_remainder(x: Column, y: Column) -> Column:
    return x - y * F.rint(x / y)


def max2(a: Column, b: Column) -> Column:
    """MAX of two values; null if either is null (greatest alone skips nulls)."""
    return F.when(a.isNull() | b.isNull(), F.lit(None)).otherwise(F.greatest(a, b))


def min2(a: Column, b: Column) -> Column:
    return F.when(a.isNull() | b.isNull(), F.lit(None)).otherwise(F.least(a, b))
