"""Null-preserving derivations: a missing input gives null, never 0."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Payments a year by frequency (fixed values).
PAYMENTS_A_YEAR = {"monthly": 12, "quarterly": 4, "annual": 1}


def unit_price(price: Column, area: Column) -> Column:
    """Price by square metre, unrounded; null where price is null or area is null or 0."""
    return price / F.nullif(area, F.lit(0.0))


def plan_total(down: Column, amount: Column, frequency: Column, years: Column) -> Column:
    """Down payment plus every instalment; null unless all four are known."""
    a_year = F.lit(None).cast("double")
    for name, n in PAYMENTS_A_YEAR.items():
        a_year = F.when(frequency == name, F.lit(float(n))).otherwise(a_year)
    return down + amount * a_year * years
