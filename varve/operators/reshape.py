"""Wide to long, and intervals to pieces. Both are generators: no shuffle."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def to_long(
    df: DataFrame,
    ids: Sequence[str],
    measures: Mapping[str, str],
    name: str,
    value: str,
    drop_nulls: bool = True,
    order: str | None = None,
) -> DataFrame:
    """One row per (``ids``, label) from ``measures`` = ``{label: column}``.

    Month names sort as text; ``order`` adds the label's place in ``measures``, counted from 1.
    """
    labelled = df.select(*ids, *[F.col(c).alias(text) for text, c in measures.items()])
    long = labelled.unpivot(list(ids), list(measures), name, value)
    if drop_nulls:
        long = long.where(F.col(value).isNotNull())
    if order:
        places = F.array(*[F.lit(text) for text in measures])
        long = long.withColumn(order, F.array_position(places, F.col(name)).cast("int"))
    return long


def split_intervals(
    df: DataFrame,
    start: str,
    end: str,
    days: int = 150,
    piece_start: str = "piece_start",
    piece_end: str = "piece_end",
) -> DataFrame:
    """Cut each ``[start, end]`` of dates into pieces ``[s, min(s + days, end)]``.

    Both ends of a piece belong to it, so the next piece starts ``days + 1`` days later. A last
    piece of one day is kept, where a loop that stops at ``start < end`` would lose it. Rows
    with a missing bound, or with ``start`` after ``end``, give no piece.
    """
    length = F.datediff(F.col(end), F.col(start))
    steps = F.when(length >= 0, F.sequence(F.lit(0), length, F.lit(days + 1)))
    return (
        df.withColumn("_step", F.explode(steps))
        .withColumn(piece_start, F.date_add(F.col(start), F.col("_step")))
        .withColumn(piece_end, F.least(F.date_add(F.col(piece_start), days), F.col(end)))
        .drop("_step")
    )
