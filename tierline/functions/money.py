"""Exact money arithmetic.

Bronze money is DOUBLE. Summing doubles depends on the order rows meet,
which differs between runs and partitionings. Every money aggregate here
goes through DECIMAL(12,2) (exact, order-independent) and is turned back
into DOUBLE only at the end, so results are reproducible at any scale.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MONEY = "decimal(12,2)"


def money(c) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast(MONEY)


def line_value(price="price", quantity="quantity") -> Column:
    """price * quantity, exact (DECIMAL)."""
    q = F.col(quantity) if isinstance(quantity, str) else quantity
    return money(price) * q


PART = 10 ** 9  # cents that a part of a value counts up to


def value_parts(value: Column) -> list[Column]:
    """A line's value in cents as three longs: units, PARTs and PARTs of PARTs, each with the value's sign.

    Summing longs costs a fraction of summing wide decimals; ``parts_value`` of the sums is the exact sum.
    """
    whole, parts = (value * 100).cast("decimal(33,0)"), []
    for _ in range(2):
        least = whole % F.lit(PART).cast("decimal(10,0)")
        parts.append(least.cast("bigint"))
        whole = ((whole - least) / F.lit(PART).cast("decimal(10,0)")).cast("decimal(33,0)")
    return [*parts, whole.cast("bigint")]


def parts_value(*sums: Column) -> Column:
    """The value (DECIMAL) that parts or their sums stand for."""
    units, more, most = (c.cast("decimal(19,0)") for c in sums)
    one = F.lit(PART).cast("decimal(10,0)")
    return (((most * one).cast("decimal(29,0)") + more) * one + units).cast("decimal(38,0)") * F.lit("0.01").cast("decimal(2,2)")


def as_double(c: Column) -> Column:
    return c.cast("double")


def ratio(numerator: Column, denominator: Column) -> Column:
    """double(numerator) / double(denominator); NULL when the denominator is 0 or NULL."""
    return F.try_divide(numerator.cast("double"), F.nullif(denominator, F.lit(0)).cast("double"))
