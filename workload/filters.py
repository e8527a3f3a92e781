"""Row filters, top-k, samples and ingest counts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from varve.functions import locale_double, trace_flag, trace_value
from varve.operators import (
    drop_out_of_domain,
    drop_units_row,
    filter_keywords,
    sample_rows,
    top_k,
)
from varve.session import scratch_path
from varve.sinks import observed
from workload.dirty import DIRTY_SQL, dirty_events
from workload.registry import query, table


def _event_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as a file gives them: text, with the line of units under the header."""
    events = table(spark, sf_dir, "events").select(
        F.col("event_id").cast("string").alias("id"),
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss").alias("time"),
        F.col("value").cast("string").alias("value"),
    )
    units = spark.range(1).select(
        F.lit("number").alias("id"), F.lit("UTC").alias("time"), F.lit("degree_C").alias("value")
    )
    return units.unionByName(events)


@query("""
SELECT CAST(event_id AS VARCHAR) AS id, strftime(ts, '%Y-%m-%dT%H:%M:%S') AS time,
       CAST(value AS VARCHAR) AS value
FROM events
""")
def units_row_drop(spark: SparkSession, sf_dir: str) -> DataFrame:
    return drop_units_row(_event_file(spark, sf_dir), "time", "UTC")


@query("""
SELECT CAST(count(*) + 1 AS BIGINT) AS rows_read, CAST(count(*) AS BIGINT) AS rows_kept,
       CAST(3 AS INTEGER) AS columns_read
FROM events
""")
def ingest_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The counts that the write of an ingest takes along."""
    raw = _event_file(spark, sf_dir)
    source, read = observed(raw)
    kept, written = observed(drop_units_row(source, "time", "UTC"))
    kept.write.parquet(scratch_path(spark, "ingest"))
    return spark.range(1).select(
        F.lit(read.get["rows"]).cast("long").alias("rows_read"),
        F.lit(written.get["rows"]).cast("long").alias("rows_kept"),
        F.lit(len(raw.columns)).alias("columns_read"),
    )


@query("SELECT event_id, value AS medida FROM events WHERE event_type <> 'error'")
def nan_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    measure = F.when(F.col("event_type") == "error", F.lit(float("nan"))).otherwise(F.col("value"))
    cells = table(spark, sf_dir, "events").select("event_id", measure.alias("medida"))
    return drop_out_of_domain(cells, "medida")


@query(f"""
SELECT event_id, CAST(ts AS DATE) AS fecha, mm, inapreciable
FROM (SELECT event_id, ts, raw = 'Ip' AS inapreciable,
             CASE WHEN raw = 'Ip' THEN CAST(0 AS DOUBLE)
                  ELSE TRY_CAST(replace(raw, ',', '.') AS DOUBLE) END AS mm
      FROM {DIRTY_SQL})
WHERE inapreciable = false AND mm > 0 AND year(ts) BETWEEN 2015 AND 2024
""")
def range_and_flag_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    typed = dirty_events(spark, sf_dir).select(
        "event_id",
        F.col("ts").cast("date").alias("fecha"),
        trace_value("raw").alias("mm"),
        trace_flag("raw").alias("inapreciable"),
    )
    wet = (F.col("inapreciable") == F.lit(False)) & (F.col("mm") > 0)
    return typed.where(wet & F.year("fecha").between(2015, 2024))


@query(f"""
SELECT DISTINCT raw AS residuo, CAST(TRY_CAST(replace(raw, ',', '.') AS DOUBLE) AS DOUBLE) AS importe
FROM {DIRTY_SQL}
WHERE TRY_CAST(replace(raw, ',', '.') AS DOUBLE) IS NULL
""")
def residual_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    typed = dirty_events(spark, sf_dir).select(
        F.col("raw").alias("residuo"), locale_double("raw").alias("importe")
    )
    return typed.where(F.col("importe").isNull()).distinct()


@query("""
SELECT p_partkey, p_name FROM part
WHERE upper(p_name) LIKE '%ANVIL%' OR upper(p_name) LIKE '%RING%'
""")
def keyword_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = table(spark, sf_dir, "part").select("p_partkey", "p_name")
    return filter_keywords(names, "p_name", ["Anvil", "ring"])


_LINE = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate"]


@query(f"""
SELECT l_extendedprice, {", ".join(_LINE)} FROM lineitem
ORDER BY l_extendedprice DESC, {", ".join(_LINE)} LIMIT 10
""")
def topk_extremes(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem").select("l_extendedprice", *_LINE)
    return top_k(lines, "l_extendedprice", 10, ties=_LINE)


@query("SELECT CAST(least(10, count(*)) AS BIGINT) AS sampled FROM orders")
def unordered_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    sample = sample_rows(table(spark, sf_dir, "orders"), 10)
    return sample.agg(F.count("o_orderkey").alias("sampled"))
