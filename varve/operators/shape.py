"""Projection, row filters, stamps and row limits. None of these shuffles except ``top_k``."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def project(df: DataFrame, spec: Mapping[str, Column | str]) -> DataFrame:
    """One select from a declared ``{output name: expression}``; unlisted columns are pruned."""
    return df.select(
        *[(F.col(c) if isinstance(c, str) else c).alias(name) for name, c in spec.items()]
    )


def drop_units_row(df: DataFrame, column: str, marker: str) -> DataFrame:
    """Remove the units line under a header, known by ``marker`` in ``column``.

    Rows where ``column`` is NULL go as well, since ``NULL != marker`` is not true. The column
    must be text: on a typed column the comparison would have to parse the marker.
    """
    return df.where(F.col(column) != F.lit(marker))


def drop_out_of_domain(df: DataFrame, measure: str) -> DataFrame:
    """Remove rows whose measure is NaN, which marks a place outside the domain.

    Works on text (any text that casts to NaN) and on doubles. NULL measures go as well.
    """
    c = F.col(measure)
    if dict(df.dtypes)[measure] == "string":
        return df.where((c != F.lit("NaN")) & (F.lower(F.trim(c)) != "nan"))
    return df.where(c.isNotNull() & ~F.isnan(c))


def stamp(
    df: DataFrame, name: str = "ingest_date", run_date: dt.date | str | None = None
) -> DataFrame:
    """Add the date of the run; give ``run_date`` to make a run repeatable."""
    when = F.current_date() if run_date is None else F.lit(str(run_date)).cast("date")
    return df.withColumn(name, when)


def top_k(df: DataFrame, by: str, k: int, ties: Sequence[str] = ()) -> DataFrame:
    """The ``k`` rows with the largest ``by``, NULLs last; ``ties`` decide between equals.

    Every task keeps only its own best ``k`` rows, so no full sort takes place. The result is
    unique when ``by`` and ``ties`` together are.
    """
    order = [F.col(by).desc_nulls_last(), *[F.col(t).asc_nulls_first() for t in ties]]
    return df.orderBy(*order).limit(k)


def sample_rows(df: DataFrame, n: int = 10) -> DataFrame:
    """Any ``n`` rows, to look at; which ones is not defined."""
    return df.limit(n)
