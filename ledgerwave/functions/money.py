"""Amounts: currency scale, exact sums, safe ratios."""

from __future__ import annotations

from pyspark.sql import Column, functions as F
from pyspark.sql.types import DecimalType

# Sums run in decimal so that the result depends neither on row order nor on
# the number of partitions; results leave as double.
MONEY = DecimalType(20, 2)
MONEY_SQL = MONEY.simpleString()


def scaled(value: Column, scale: Column) -> Column:
    """Amounts reported in thousands, brought to units."""
    return F.when(scale == "MIL", value * 1000).otherwise(value)


def exact(value: Column) -> Column:
    return value.cast(MONEY)


def sum_amount(value: Column) -> Column:
    """Null-skipping exact sum, as double; null when nothing was summed."""
    return F.sum(exact(value)).cast("double")
