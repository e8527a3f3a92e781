"""Union of several histories without repeats."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def merge_history(
    frames: Sequence[DataFrame],
    columns: Sequence[str],
    rename: Mapping[str, str] | None = None,
    key: Sequence[str] | None = None,
) -> DataFrame:
    """The distinct rows of all frames over ``columns``.

    ``rename`` maps names that differ between frames to the common one. By default a row is a
    repeat only if every column agrees, the stamp of the run included; with ``key`` one row
    per key is kept, the smallest in column order, so that the choice is the same on every run.
    Repeats collapse inside each task before the shuffle, however many there are of one row.
    """
    rename = rename or {}
    aligned = [
        frame.withColumnsRenamed({a: b for a, b in rename.items() if a in frame.columns}).select(
            *columns
        )
        for frame in frames
    ]
    merged = reduce(lambda a, b: a.unionByName(b), aligned)
    if key is None:
        return merged.distinct()
    rest = [c for c in columns if c not in key]
    if not rest:
        return merged.distinct()
    kept = merged.groupBy(*key).agg(F.min(F.struct(*rest)).alias("_row"))
    return kept.select(*key, "_row.*").select(*columns)


def diff_runs(before: DataFrame, after: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """The rows that two runs hold in different numbers, with ``n_before`` and ``n_after``.

    Rows are compared over ``columns``, by default those of ``before``; NULLs are equal. Only 128
    bits of each row and a signed count are shuffled, summed in each task first; the rows
    themselves are fetched for the bits whose counts differ. Two different rows with equal bits,
    one chance in 10^19 among ten billion rows, would be taken for one.
    """
    columns = list(columns or before.columns)
    # A NULL leaves a hash as it is, so the places of the NULLs are hashed too.
    nulls = F.concat(*[F.isnull(c).cast("int").cast("string") for c in columns])
    bits = F.struct(
        F.xxhash64(nulls, *columns).alias("one"), F.xxhash64(F.lit(7), *reversed(columns), nulls).alias("two")
    )
    rows = [f.select(*columns).withColumn("_bits", bits) for f in (before, after)]
    counts = [
        f.select("_bits", F.lit(int(k == 0)).alias("_b"), F.lit(int(k == 1)).alias("_a"))
        for k, f in enumerate(rows)
    ]
    changed = (
        counts[0]
        .unionByName(counts[1])
        .groupBy("_bits")
        .agg(F.sum("_b").alias("n_before"), F.sum("_a").alias("n_after"))
        .where("n_before != n_after")
    )
    # One row stands for all that are equal; it comes from either run.
    fetched = rows[0].unionByName(rows[1]).join(changed, "_bits")
    return fetched.select(*columns, "n_before", "n_after").distinct()
