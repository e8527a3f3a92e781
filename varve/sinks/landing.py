"""Landing raw records by day."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def land_records(
    df: DataFrame,
    path: str,
    run_date: dt.date | str | None = None,
    date_column: str | None = None,
) -> None:
    """Write records as JSON lines under ``path/ingest_date=YYYY-MM-DD``.

    A landing replaces the days it holds and leaves the others, so it can be repeated. The day
    is ``run_date`` for all rows, today by default, and then each task writes one file. With
    ``date_column`` every row goes to its own day; the rows are first spread by day, where
    Spark splits a day too large for one task and packs small ones.
    """
    if date_column is not None:
        landed = df.withColumn("ingest_date", F.col(date_column).cast("date"))
        landed = landed.hint("rebalance", "ingest_date")
    else:
        day = F.current_date() if run_date is None else F.lit(str(run_date)).cast("date")
        landed = df.withColumn("ingest_date", day)
    (
        landed.write.partitionBy("ingest_date")
        .mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .json(path)
    )
