"""Distinct counts and quantiles that can be stored per day and united over any span."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, DataType, IntegerType, LongType, StringType

_DISTINCT = "_distinct"
_QUANTILES = "_quantiles"
_HASHED = (IntegerType, LongType, StringType, BinaryType)


def sketch_by(
    df: DataFrame,
    keys: Sequence[str],
    distinct: Sequence[str] = (),
    quantiles: Sequence[str] = (),
    rows: str = "rows",
    distinct_bits: int = 12,
    quantile_size: int = 200,
) -> DataFrame:
    """One row per key: its rows, ``<c>_distinct`` for each column of ``distinct`` and
    ``<c>_quantiles`` for each of ``quantiles``, as binary sketches to be stored.

    A sketch has a bounded size whatever the rows of its key, and is built in each task before the
    shuffle. With the defaults a distinct count's standard error is 1.6 % (``1.04 / sqrt(2 **
    distinct_bits)``) and a quantile's rank is off by 1.7 % at most in 99 of 100 cases. NULL counts
    in neither, NaN not in quantiles. Without keys there is one row, for an empty table as well.
    """
    found = [F.count(F.lit(1)).alias(rows)]
    for c in distinct:
        found.append(F.hll_sketch_agg(_hashable(df.schema[c].dataType, F.col(c)), distinct_bits).alias(c + _DISTINCT))
    for c in quantiles:
        value = F.col(c).cast("double")
        known = F.when(~F.isnan(value), value)
        found.append(F.kll_sketch_agg_double(known, quantile_size).alias(c + _QUANTILES))
    return df.groupBy(*keys).agg(*found)


def _hashable(kind: DataType, c: Column) -> Column:
    return c if isinstance(kind, _HASHED) else c.cast("string")


def unite_sketches(sketches: DataFrame, keys: Sequence[str], rows: str = "rows") -> DataFrame:
    """Rows of :func:`sketch_by` united by ``keys``, some of theirs or none.

    A value seen on two days counts once in their union, which sums of daily counts cannot give.
    Only sketches are read, one per key and day. Columns that are neither keys nor sketches go.
    """
    found = [F.sum(rows).cast("long").alias(rows)]
    for c in sketches.columns:
        if c.endswith(_DISTINCT) and c not in keys:
            found.append(F.hll_union_agg(c).alias(c))
        elif c.endswith(_QUANTILES) and c not in keys:
            found.append(F.kll_merge_agg_double(c).alias(c))
    return sketches.groupBy(*keys).agg(*found)


def read_sketches(sketches: DataFrame, quantiles: Mapping[str, float]) -> DataFrame:
    """``sketches`` with estimates in place of sketches: ``<c>_distinct`` as a number, and
    ``<c>_<name>`` for each name and rank of ``quantiles``, NULL where no value is known."""
    found = []
    for c in sketches.columns:
        if c.endswith(_DISTINCT):
            found.append(F.coalesce(F.hll_sketch_estimate(c), F.lit(0)).cast("long").alias(c))
        elif c.endswith(_QUANTILES):
            filled = F.when(F.kll_sketch_get_n_double(c) > 0, F.col(c))
            for name, rank in quantiles.items():
                value = F.kll_sketch_get_quantile_double(filled, F.lit(float(rank)))
                found.append(value.alias(f"{c.removesuffix(_QUANTILES)}_{name}"))
        else:
            found.append(F.col(c))
    return sketches.select(*found)
