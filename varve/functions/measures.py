"""Rounding, ratios and conditional aggregates."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from varve.functions.cells import column

# Beyond this magnitude a double has no digits left to round at the second decimal.
_EXACT_DECIMAL_BOUND = 1e15
MOST_DIGITS = 12


def round_half_up(c: Column | str, digits: int) -> Column:
    """Round half up through a decimal with six places more than ``digits``, eight at least.

    A sum of doubles differs in its last bits with the order in which partitions arrive. The
    decimal step removes that noise first, so a tie rounds the same way on every run. It is a
    rounding of its own: a value nearer to a tie than the decimal's last place rounds up. NaN,
    infinities and values of 1e15 and more are rounded as doubles. More than ``MOST_DIGITS``
    digits do not fit the decimal and are an error.
    """
    if digits > MOST_DIGITS:
        raise ValueError(f"at most {MOST_DIGITS} digits can be rounded, not {digits}")
    places = max(8, digits + 6)
    c = column(c).cast("double")
    exact = F.round(c.cast(f"decimal({20 + places},{places})"), digits).cast("double")
    return F.when(F.abs(c) < _EXACT_DECIMAL_BOUND, exact).otherwise(F.round(c, digits))


def safe_ratio(a: Column | str, b: Column | str, digits: int) -> Column:
    """``a / b`` rounded; NULL where ``b`` is 0 or either side is NULL."""
    return round_half_up(column(a) / F.nullif(column(b), F.lit(0.0)), digits)


def null_count(c: Column | str) -> Column:
    """Rows where the value is NULL. NaN is a value."""
    return F.count(F.lit(1)) - F.count(column(c))


def count_where(predicate: Column) -> Column:
    """Rows where the predicate is TRUE; a NULL predicate counts 0. NULL when there are no rows."""
    return F.sum(F.when(predicate, F.lit(1)).otherwise(F.lit(0)))


def nan_count(c: Column | str) -> Column:
    """Rows where the value is NaN; a NULL value counts 0."""
    return count_where(F.isnan(column(c)))


def mean_where(predicate: Column, c: Column | str) -> Column:
    """Mean over the rows where the predicate is TRUE."""
    return F.avg(F.when(predicate, column(c)))
