"""Landed records as a stream of files."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from varve.sources.files import require_files


def stream_landings(
    spark: SparkSession,
    path: str,
    schema: StructType | str,
    key: Sequence[str],
    time: str,
    delay: str,
    target: str,
    checkpoint: str,
    day: str = "day",
    files_per_batch: int = 1000,
) -> int:
    """Append the records landed under ``path`` since the last call to the Parquet table ``target``.

    Records (JSON lines) are taken file by file, and of records with the same ``key`` the first
    stays, also across landings: a repeat is dropped if its ``time`` is within ``delay`` of the
    latest time met, and older records are late and dropped too. So the state holds the keys of
    the last ``delay`` only. ``target`` is partitioned by ``day``, the date of ``time``. Returns the
    number of records that the call read.

    ``checkpoint`` keeps what was read and the state; a call that fails goes on there, and nothing
    is written twice. It reads all files that are there and returns, to be called after each
    landing. Records whose ``time`` is NULL, or that are no record, are dropped.
    """
    require_files(spark, path, "*")
    arrived = (
        spark.readStream.schema(schema)
        .option("maxFilesPerTrigger", files_per_batch)
        .option("recursiveFileLookup", True)
        .json(path)
    )
    fresh = (
        arrived.where(F.col(time).isNotNull())
        .withWatermark(time, delay)
        .dropDuplicatesWithinWatermark(list(key))
        .withColumn(day, F.col(time).cast("date"))
    )
    run = (
        fresh.writeStream.format("parquet")
        .partitionBy(day)
        .option("path", target)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )
    run.awaitTermination()
    return sum(progress["numInputRows"] for progress in run.recentProgress)
