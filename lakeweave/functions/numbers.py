"""Arithmetic with results that do not depend on the engine or the summation order."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def round_half_up(x: Column, places: int = 2) -> Column:
    """Round the double itself (not its decimal text), halves away from zero, as SQL ROUND does.

    ``y - y % 1`` is an exact floor in double arithmetic, so values of any size neither
    overflow nor turn into decimals. Where the scaled value is no finite number (inf, NaN), x is its own rounding.
    """
    scale = float(10**places)
    y = F.abs(x) * F.lit(scale)
    fraction = y % F.lit(1.0)
    whole = (y - fraction) + F.when(fraction >= F.lit(0.5), F.lit(1.0)).otherwise(F.lit(0.0))
    rounded = F.signum(x) * (whole / F.lit(scale))
    return F.when(F.isnan(fraction), x).otherwise(rounded)


def stable_sum(x: Column, places: int = 6) -> Column:
    """SUM of doubles without the last-bit noise that the order of partial sums leaves behind."""
    return round_half_up(F.sum(x), places)


def growth(current: Column, previous: Column) -> Column:
    """Percent change with two decimals; NULL when there is no base or the base is 0."""
    cur, prev = current.cast("double"), previous.cast("double")
    return F.when(prev != 0, round_half_up((cur - prev) * F.lit(100.0) / prev, 2))
