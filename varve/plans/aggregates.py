"""Clean tables to the aggregate tables that dashboards read."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from varve.functions import round_half_up
from varve.operators import align, entity_rollup, episode_vs_baseline, merge_history, to_long
from varve.plans import layouts


def monthly_long(gistemp: DataFrame, with_month_number: bool = False) -> DataFrame:
    """(anio, mes, anomalia_c), one row per month that has a value."""
    months = {mes: f"anomalia_{mes.lower()}" for mes in layouts.MESES}
    order = "mes_num" if with_month_number else None
    return to_long(gistemp, ["anio"], months, "mes", "anomalia_c", order=order)


def regional_counts(tracks: DataFrame) -> DataFrame:
    """Storms per season and basin, and the intense ones. A storm that crosses counts in each."""
    counts = entity_rollup(
        tracks,
        entity_keys=["id_tormenta", "temporada", "cuenca_desc"],
        group_keys=["temporada", "cuenca_desc"],
        measure="categoria_saffir_simpson",
        threshold=layouts.INTENSE_CATEGORY,
        entities="num_tormentas",
        intense="num_tormentas_intensas",
    )
    return counts.withColumnRenamed("temporada", "anio")


def yearly_summary(
    gistemp: DataFrame, oisst: DataFrame, tracks: DataFrame, stations: DataFrame
) -> DataFrame:
    """One row per year with the measures of four sources, NULL where one has none; by year.

    Three sources are grouped by year first, so they hold each year once and meet in one
    grouping. The wide temperature table is not grouped and may repeat a year; as it has a row
    per year only, one full outer join brings it in, and every source is read once.
    """
    sea = oisst.groupBy("anio").agg(
        round_half_up(F.avg("temp_superficial_c"), 2).alias("sst_mediterraneo_c")
    )
    storms = entity_rollup(
        tracks,
        entity_keys=["id_tormenta", "temporada"],
        group_keys=["temporada"],
        measure="categoria_saffir_simpson",
        threshold=layouts.INTENSE_CATEGORY,
        entities="num_ciclones_global",
        intense="num_ciclones_intensos_global",
    ).withColumnRenamed("temporada", "anio")
    climate = stations.groupBy(F.year("fecha").alias("anio")).agg(
        round_half_up(F.avg("temp_media_c"), 2).alias("temp_media_espana_c"),
        round_half_up(F.sum("precipitacion_mm"), 1).alias("precipitacion_total_espana_mm"),
    )
    air = gistemp.select("anio", F.col("anomalia_media_anual").alias("anomalia_temp_global_c"))
    return air.join(align([sea, storms, climate], "anio"), "anio", "full").orderBy("anio")


def episode_against_normal(
    episode: DataFrame, stations: DataFrame, baseline_filter: Column | None = None
) -> DataFrame:
    """Rain of the episode against the daily mean of the same stations, largest ratio first."""
    return episode_vs_baseline(
        episode,
        stations,
        key="indicativo",
        label="nombre",
        measure="precipitacion_mm",
        baseline_filter=baseline_filter,
        total="precipitacion_total_dana_mm",
        peak="precipitacion_maxima_un_dia_mm",
        mean="precipitacion_media_diaria_mm",
        times="veces_sobre_lo_normal",
    )


def unified_history(
    stations: DataFrame, episode: DataFrame, key: list[str] | None = None
) -> DataFrame:
    """The distinct rows of both station tables over their common columns."""
    return merge_history(
        [stations, episode],
        layouts.HISTORY_COLUMNS,
        rename={"fecha_proceso_datos": "ingest_date"},
        key=key,
    )
