"""Full outer alignment of several sources on one key."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import add

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_OWNER = "_null_owner"
_SOURCE = "_source_bits"
_BITS = 60  # in one number


def align(sources: Sequence[DataFrame], key: str, detail: DataFrame | None = None) -> DataFrame:
    """One row per key with the columns of every source; NULL where a source lacks the key.

    Gives the rows of a chain of full outer joins on the coalesced key: a NULL key matches
    nothing, so each source's NULL row stays a row of its own. Apart from ``key`` the frames
    must not share column names.

    No source may repeat a key, the NULL key included; ``groupBy(key)`` sees to that, and a
    repeat fails the query. All sources then meet in one grouping, without the sort and shuffle
    that a join costs at each link. ``detail`` is the one frame that may repeat keys: each of
    its rows receives the aligned columns, and keys it lacks follow.
    """
    merged = _merge(sources, key)
    if detail is None:
        return merged
    # Left and anti join together give the full outer join, but both can broadcast the aligned
    # rows while they are few, and both let Spark split a key with very many detail rows.
    matched = detail.join(merged, key, "left")
    unmatched = merged.join(detail.select(key).distinct(), key, "left_anti")
    return matched.unionByName(unmatched, allowMissingColumns=True)


def _merge(sources: Sequence[DataFrame], key: str) -> DataFrame:
    words = [f"{_SOURCE}{n}" for n in range((len(sources) - 1) // _BITS + 1)]
    # The owner keeps the NULL keys of different sources in different groups.
    tagged = [
        source.withColumns(
            {
                _OWNER: F.when(F.col(key).isNull(), F.lit(i)),
                **{w: F.lit(1 << i % _BITS if n == i // _BITS else 0).cast("bigint") for n, w in enumerate(words)},
            }
        )
        for i, source in enumerate(sources)
    ]
    stacked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tagged)
    values = [c for source in sources for c in source.columns if c != key]
    merged = stacked.groupBy(key, _OWNER).agg(
        *[F.first(c, ignorenulls=True).alias(c) for c in values],
        (F.count(F.lit(1)) == reduce(add, [F.bit_count(F.bit_or(w)) for w in words])).alias("_once"),
    )
    repeated = F.raise_error(F.lit(f"align: a source repeats a value of {key}"))
    checked = merged.where(F.when(F.col("_once"), F.lit(True)).otherwise(repeated.cast("boolean")))
    return checked.select(key, *values)
