"""The events table with its value as dirty text, for Spark and for DuckDB.

The test tables hold no missing or malformed cells, so each event type stands for one kind:
a trace code, a missing cell, a sentinel, or a number with a decimal comma.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from workload.registry import table


def comma_text(c: Column) -> Column:
    return F.replace(c.cast("string"), F.lit("."), F.lit(","))


def dirty_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = F.col("event_type")
    raw = (
        F.when(kind == "error", "Ip")
        .when(kind == "signup", F.lit(None))
        .when(kind == "view", "Varias")
        .otherwise(comma_text(F.col("value")))
    )
    return table(spark, sf_dir, "events").withColumn("raw", raw)


DIRTY_SQL = """
(SELECT *, CASE event_type WHEN 'error' THEN 'Ip' WHEN 'signup' THEN NULL WHEN 'view' THEN 'Varias'
                           ELSE replace(CAST(value AS VARCHAR), '.', ',') END AS raw
 FROM events)
"""
