"""Entity rollups, distinct counts, period means and quality reports."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from varve.functions import locale_double, mean_where, round_half_up, trace_flag, trace_value
from varve.operators import distinct_entities, entity_rollup
from varve.operators import quality_report as report
from workload.dirty import DIRTY_SQL, dirty_events
from workload.registry import query, table


def _shipments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey", F.year("l_shipdate").alias("anio"), "l_returnflag", "l_quantity"
    )


@query("""
SELECT CAST(anio AS INTEGER) AS anio, l_returnflag, CAST(count(*) AS BIGINT) AS entidades,
       CAST(sum(CASE WHEN maximo >= 45 THEN 1 ELSE 0 END) AS BIGINT) AS intensas
FROM (SELECT l_orderkey, year(l_shipdate) AS anio, l_returnflag, max(l_quantity) AS maximo
      FROM lineitem GROUP BY 1, 2, 3)
GROUP BY 1, 2
""")
def entity_rollup_by_region(spark: SparkSession, sf_dir: str) -> DataFrame:
    return entity_rollup(
        _shipments(spark, sf_dir),
        entity_keys=["l_orderkey", "anio", "l_returnflag"],
        group_keys=["anio", "l_returnflag"],
        measure="l_quantity",
        threshold=45,
        entities="entidades",
        intense="intensas",
    )


@query("""
SELECT CAST(anio AS INTEGER) AS anio, CAST(count(*) AS BIGINT) AS entidades,
       CAST(sum(CASE WHEN maximo >= 45 THEN 1 ELSE 0 END) AS BIGINT) AS intensas
FROM (SELECT l_orderkey, year(l_shipdate) AS anio, max(l_quantity) AS maximo FROM lineitem GROUP BY 1, 2)
GROUP BY 1
""")
def entity_rollup_global(spark: SparkSession, sf_dir: str) -> DataFrame:
    return entity_rollup(
        _shipments(spark, sf_dir),
        entity_keys=["l_orderkey", "anio"],
        group_keys=["anio"],
        measure="l_quantity",
        threshold=45,
        entities="entidades",
        intense="intensas",
    )


@query("""
SELECT l_returnflag, l_linestatus, CAST(count(DISTINCT l_orderkey) AS BIGINT) AS entidades
FROM lineitem GROUP BY 1, 2
""")
def distinct_entities_by_region(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem")
    return distinct_entities(lines, "l_orderkey", ["l_returnflag", "l_linestatus"], "entidades")


@query("""
SELECT CAST(count(*) AS BIGINT) AS total, CAST(min(year(o_orderdate)) AS INTEGER) AS anio_min,
       CAST(max(year(o_orderdate)) AS INTEGER) AS anio_max,
       CAST(round(CAST(avg(CASE WHEN year(o_orderdate) BETWEEN 1995 AND 1996 THEN o_totalprice END)
                       AS DECIMAL(28,8)), 2) AS DOUBLE) AS media_antigua,
       CAST(round(CAST(avg(CASE WHEN year(o_orderdate) >= 2000 THEN o_totalprice END)
                       AS DECIMAL(28,8)), 2) AS DOUBLE) AS media_reciente
FROM orders
""")
def period_means(spark: SparkSession, sf_dir: str) -> DataFrame:
    year = F.year("o_orderdate")
    return table(spark, sf_dir, "orders").agg(
        F.count(F.lit(1)).alias("total"),
        F.min(year).alias("anio_min"),
        F.max(year).alias("anio_max"),
        round_half_up(mean_where(year.between(1995, 1996), "o_totalprice"), 2).alias(
            "media_antigua"
        ),
        round_half_up(mean_where(year >= 2000, "o_totalprice"), 2).alias("media_reciente"),
    )


@query(f"""
SELECT CAST(count(*) AS BIGINT) AS total_rows,
       CAST(count(*) - count(importe) AS BIGINT) AS nulls_importe,
       CAST(count(*) - count(valor) AS BIGINT) AS nulls_valor,
       CAST(sum(CASE WHEN isnan(medida) THEN 1 ELSE 0 END) AS BIGINT) AS nans_medida,
       min(fecha) AS min_fecha, max(fecha) AS max_fecha,
       CAST(count(DISTINCT user_id) AS BIGINT) AS distinct_user_id,
       CAST(sum(CASE WHEN inapreciable THEN 1 ELSE 0 END) AS BIGINT) AS inapreciables,
       CAST(round(CAST(avg(importe) AS DECIMAL(28,8)), 2) AS DOUBLE) AS media_importe,
       CAST(round(CAST(avg(CASE WHEN inapreciable = false THEN valor END) AS DECIMAL(28,8)), 2)
            AS DOUBLE) AS media_medible
FROM (SELECT user_id, CAST(ts AS DATE) AS fecha, raw = 'Ip' AS inapreciable,
             TRY_CAST(replace(raw, ',', '.') AS DOUBLE) AS importe,
             CASE WHEN raw = 'Ip' THEN CAST(0 AS DOUBLE)
                  ELSE TRY_CAST(replace(raw, ',', '.') AS DOUBLE) END AS valor,
             CASE WHEN event_type = 'error' THEN CAST('NaN' AS DOUBLE) ELSE value END AS medida
      FROM {DIRTY_SQL})
""")
def quality_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    outside = F.col("event_type") == "error"
    typed = dirty_events(spark, sf_dir).select(
        "user_id",
        F.col("ts").cast("date").alias("fecha"),
        locale_double("raw").alias("importe"),
        trace_value("raw").alias("valor"),
        trace_flag("raw").alias("inapreciable"),
        F.when(outside, F.lit(float("nan"))).otherwise(F.col("value")).alias("medida"),
    )
    return report(
        typed,
        nulls=["importe", "valor"],
        nans=["medida"],
        extents=["fecha"],
        distinct=["user_id"],
        where={"inapreciables": F.col("inapreciable")},
        means={
            "media_importe": "importe",
            "media_medible": (F.col("inapreciable") == F.lit(False), "valor"),
        },
    )
