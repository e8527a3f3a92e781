"""Joins and frames along time, for keys of any length of history.

A key's rows are cut into blocks of time. What a block needs from before it, the last row of earlier
blocks or the end of the block before, is carried into it, so every block is worked out by itself
and a key that holds a third of all rows is spread over as many groups as it has blocks. Choose the
width of a block so that the rows of a key in it fit a task: what cannot be cut is one instant.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, TimestampNTZType, TimestampType

MICROSECONDS = {"second": 10**6, "minute": 60 * 10**6, "hour": 3600 * 10**6, "day": 86400 * 10**6}


def _position(df: DataFrame, column: str) -> Column:
    """Time as a whole number: days of a date, microseconds of a timestamp, else the number itself."""
    kind = df.schema[column].dataType
    if isinstance(kind, DateType):
        return F.unix_date(column).cast("bigint")
    if isinstance(kind, TimestampNTZType):
        return F.unix_micros(F.to_utc_timestamp(F.col(column).cast("timestamp"), F.current_timezone()))
    if isinstance(kind, TimestampType):
        return F.unix_micros(column)
    return F.col(column).cast("bigint")


def _block_of(at: Column | str, width: int) -> Column:
    """The number of the block; the division is of a multiple, so it is exact."""
    at = F.col(at) if isinstance(at, str) else at
    return ((at - F.pmod(at, F.lit(width))) / width).cast("bigint")


def as_of_join(
    left: DataFrame,
    right: DataFrame,
    on: Sequence[str],
    left_time: str,
    right_time: str,
    block: int,
    tolerance: int | None = None,
) -> DataFrame:
    """Every row of ``left`` with the last row of ``right`` of the same key at or before its time.

    The columns of ``right`` but for the key follow those of ``left``; they are NULL where there is
    no such row, where the key or the time of the left row is NULL, and where the match is older
    than ``tolerance``. Of right rows with one key and time the largest, in column order, counts;
    right rows without a key or a time never do. ``block`` and ``tolerance`` are in days for dates,
    in microseconds for timestamps (see ``MICROSECONDS``), else in the numbers of the column.

    Each left row gives one row. Per key one row per block, not the history, is sorted to find
    what is carried; the rest happens within a key's block.
    """
    keys = [f"_key{i}" for i in range(len(on))]
    taken = [c for c in right.columns if c not in on]
    clash = set(taken) & set(left.columns)
    if clash:
        raise ValueError(f"columns on both sides: {sorted(clash)}")
    found = F.struct(F.col("_at"), F.struct(*taken).alias("row"))
    known = [F.col(k).alias(n) for k, n in zip(on, keys, strict=True)]
    nothing = F.lit(None)

    asked = left.select(*known, _position(left, left_time).alias("_at"), F.struct("*").alias("_left"))
    asked = asked.withColumn("_block", _block_of("_at", block))
    given = right.select(*known, _position(right, right_time).alias("_at"), *taken)
    given = given.where(" AND ".join(f"{c} IS NOT NULL" for c in [*keys, "_at"]))
    given = given.select(*keys, "_at", _block_of("_at", block).alias("_block"), found.alias("_found"))
    row_type = given.schema["_found"].dataType

    # One row per key and block: its last right row, and whether it has left rows.
    last = given.groupBy(*keys, "_block").agg(F.max("_found").alias("_last"))
    wanted = asked.groupBy(*keys, "_block").agg(F.lit(True).alias("_asked"))
    summary = last.withColumn("_asked", F.lit(False)).unionByName(
        wanted.withColumn("_last", nothing.cast(row_type))
    )
    summary = summary.groupBy(*keys, "_block").agg(F.max("_last").alias("_last"), F.max("_asked").alias("_asked"))
    before = Window.partitionBy(*keys).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    carried = summary.withColumn("_found", F.last("_last", ignorenulls=True).over(before))
    carried = carried.where("_asked AND _found IS NOT NULL").select(
        *keys, F.col("_found._at").alias("_at"), "_block", "_found"
    )

    no_left, no_right = nothing.cast(asked.schema["_left"].dataType), nothing.cast(row_type)
    rows = (
        given.unionByName(carried)
        .withColumn("_left", no_left)
        .unionByName(asked.withColumn("_found", no_right))
        .withColumn("_asks", F.col("_left").isNotNull())
    )
    order = ["_at", "_asks", "_found"]  # at one instant right rows come first, the largest last
    within = Window.partitionBy(*keys, "_block").orderBy(*order)
    rows = rows.withColumn("_match", F.last("_found", ignorenulls=True).over(within)).where("_asks")
    if tolerance is not None:
        near = F.col("_at") - F.col("_match._at") <= tolerance
        rows = rows.withColumn("_match", F.when(near, F.col("_match")))
    picked = [F.col("_match.row").getField(c).alias(c) for c in taken]
    return rows.select(*[F.col("_left").getField(c).alias(c) for c in left.columns], *picked)


def range_join(
    points: DataFrame,
    intervals: DataFrame,
    time: str,
    start: str,
    end: str,
    block: int,
    on: Sequence[str] = (),
) -> DataFrame:
    """Pairs of a point and an interval with ``start <= time < end`` and equal keys.

    An interval is repeated for every block it touches, a point stands in one, so pairs are found
    by equality of the block; take ``block`` about as long as an interval. Rows with a NULL time,
    bound or key, and empty intervals, have no pair. Columns of both sides follow each other;
    ``on`` comes once. Units are those of :func:`as_of_join`.
    """
    clash = (set(points.columns) & set(intervals.columns)) - set(on)
    if clash:
        raise ValueError(f"columns on both sides: {sorted(clash)}")
    at, low, high = _position(points, time), _position(intervals, start), _position(intervals, end)
    placed = points.withColumn("_at", at).where("_at IS NOT NULL").withColumn("_block", _block_of("_at", block))
    spans = intervals.withColumns({"_low": low, "_high": high}).where("_low < _high")
    touched = F.sequence(_block_of("_low", block), _block_of(F.col("_high") - 1, block))
    spans = spans.withColumn("_block", F.explode(touched))
    joined = placed.join(spans, [*on, "_block"]).where("_low <= _at AND _at < _high")
    return joined.drop("_at", "_block", "_low", "_high")


def moving_mean(
    df: DataFrame,
    key: Sequence[str],
    time: str,
    value: str,
    width: int,
    block: int,
    name: str = "moving_mean",
    least: int = 1,
) -> DataFrame:
    """``df`` with the mean of ``value`` over the ``width`` units of time that end at each row.

    The frame is one of time, not of rows: a day without a row, or with a NULL value, is left out
    of the mean and does not lengthen the frame. Fewer than ``least`` values give NULL; so does a
    NULL time. Rows of one key and time see each other. Units are those of :func:`as_of_join`.

    Each block gets the rows of the last ``width`` units before it as well; ``block`` should be
    several times ``width``, since these rows are repeated.
    """
    if not 0 < width <= block:
        raise ValueError("width must be positive and no longer than a block")
    placed = df.withColumn("_at", _position(df, time)).withColumn("_block", _block_of("_at", block))
    # The last rows of a block stand in the next one too, to be looked at only.
    ends_near = F.col("_at") >= (F.col("_block") + 1) * block - (width - 1)
    own = F.array(F.struct(F.col("_block"), F.lit(False).alias("_halo")))
    both = F.array(
        F.struct(F.col("_block"), F.lit(False).alias("_halo")),
        F.struct((F.col("_block") + 1).alias("_block"), F.lit(True).alias("_halo")),
    )
    dealt = placed.withColumn("_in", F.explode(F.when(ends_near, both).otherwise(own)))
    dealt = dealt.withColumns({"_block": F.col("_in._block"), "_halo": F.col("_in._halo")}).drop("_in")
    frame = Window.partitionBy(*key, "_block").orderBy("_at").rangeBetween(-(width - 1), 0)
    enough = (F.count(value).over(frame) >= least) & F.col("_at").isNotNull()
    mean = F.when(enough, F.avg(value).over(frame))
    return dealt.withColumn(name, mean).where("NOT _halo").drop("_at", "_block", "_halo")


def anomaly(
    df: DataFrame, key: Sequence[str], period: Column, value: str, name: str = "anomaly"
) -> DataFrame:
    """``df`` with the difference of ``value`` to its key's mean over all rows of the same period.

    ``period`` is, for example, the month of the year. Means are grouped with a step in every
    task and joined back, which Spark can split on a hot key, where a window per key cannot be.
    NULL values count in no mean and have a NULL difference; rows with a NULL key or period stay,
    with a NULL difference.
    """
    rows = df.withColumn("_period", period)
    means = rows.groupBy(*key, "_period").agg(F.avg(value).alias("_mean"))
    joined = rows.join(means, [*key, "_period"], "left")
    return joined.select(*df.columns, (F.col(value) - F.col("_mean")).alias(name))
