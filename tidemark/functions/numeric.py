"""Numeric helpers shared by every aggregate.

Ratios of exact numbers (DECIMAL sums, counts) are rounded half away from zero in whole
numbers, so a tie such as -0.125 gives -0.13 whatever a DOUBLE would make of it.  Only
values that are DOUBLE by nature (a mean of means, a difference of rounded figures) go
through ``round2``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

EXACT = "decimal(28,2)"


def round_ratio(num: Column, den: Column, factor: int = 1, places: int = 2) -> Column:
    """num * factor / den to ``places`` digits, half away from zero; NULL when den is 0 or NULL.

    Both are exact to 2 dp.  The quotient is whole: the remainder is taken off before dividing.
    """
    n, d = num.cast(EXACT), F.nullif(den.cast(EXACT), F.lit(0))
    over, under = F.abs(n) * F.lit(2 * factor * 10 ** places) + F.abs(d), F.abs(d) * 2
    steps = (over - over % under) / under
    return F.when((n < 0) != (d < 0), -steps).otherwise(steps).cast("double") / 10 ** places


def round2(x: Column) -> Column:
    """A DOUBLE to 2 dp, half away from zero."""
    x = x.cast("double")
    return F.signum(x) * F.floor(F.abs(x) * 100 + 0.5) / 100


def pct(num: Column, den: Column, places: int = 2) -> Column:
    """100 * num / den, rounded; NULL when den is 0."""
    return round_ratio(num, den, 100, places)


def mean_exact(total: Column, n: Column) -> Column:
    """Mean from an exact sum and a count, rounded to 2 dp."""
    return round_ratio(total, n)


def pct_or_zero(num: Column, den: Column) -> Column:
    """Per-row percent: 0 when den == 0, NULL when an input is NULL, else rounded."""
    return F.when(den == 0, F.lit(0.0)).otherwise(pct(num, den))


def as_money(x: Column, precision: int = 18) -> Column:
    """DOUBLE with 2 dp -> exact DECIMAL(p,2) (for exact sums of rounded values)."""
    return x.cast(f"decimal({precision},2)")


def nan_to_null(c: Column) -> Column:
    """NaN and +/-Inf become NULL (JSON-safe output)."""
    return F.when(F.isnan(c) | (F.abs(c) == float("inf")), F.lit(None)).otherwise(c)
