"""Data-quality reports."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from varve.functions.measures import (
    count_where,
    mean_where,
    nan_count,
    null_count,
    round_half_up,
)


def quality_report(
    df: DataFrame,
    nulls: Sequence[str] = (),
    nans: Sequence[str] = (),
    extents: Sequence[str] = (),
    distinct: Sequence[str] = (),
    where: Mapping[str, Column] | None = None,
    means: Mapping[str, str | tuple[Column, str]] | None = None,
    digits: int = 2,
) -> DataFrame:
    """One row that describes the whole table, from one pass over it.

    ``total_rows``; then ``nulls_x``, ``nans_x``, ``min_x``/``max_x`` and ``distinct_x`` for
    the listed columns; then a count per predicate in ``where`` and a rounded mean per entry of
    ``means``, whose value is a column or a (predicate, column) pair. Distinct counts are exact.
    """
    items = [F.count(F.lit(1)).alias("total_rows")]
    items += [null_count(c).alias(f"nulls_{c}") for c in nulls]
    items += [nan_count(c).alias(f"nans_{c}") for c in nans]
    for c in extents:
        items += [F.min(c).alias(f"min_{c}"), F.max(c).alias(f"max_{c}")]
    items += [F.count_distinct(c).alias(f"distinct_{c}") for c in distinct]
    items += [count_where(p).alias(name) for name, p in (where or {}).items()]
    for name, what in (means or {}).items():
        mean = F.avg(what) if isinstance(what, str) else mean_where(*what)
        items.append(round_half_up(mean, digits).alias(name))
    return df.agg(*items)
