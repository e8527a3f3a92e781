"""Raw text tables to typed tables. Each is one projection: no shuffle, unused columns pruned."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from varve.functions import (
    HOUR_MINUTE,
    guard,
    label,
    locale_double,
    safe,
    strict_date,
    trace_flag,
    trace_value,
)
from varve.operators import drop_out_of_domain, project, stamp
from varve.plans import layouts

RunDate = dt.date | str | None


def _doubles(sources: Mapping[str, str]) -> dict[str, Column]:
    return {name: safe(F.col(f"`{raw}`"), "double") for name, raw in sources.items()}


def _locale_doubles(sources: Mapping[str, str]) -> dict[str, Column]:
    return {name: locale_double(raw) for name, raw in sources.items()}


def _hours(sources: Mapping[str, str]) -> dict[str, Column]:
    return {name: guard(raw, HOUR_MINUTE) for name, raw in sources.items()}


def clean_gistemp(raw: DataFrame) -> DataFrame:
    """Yearly anomalies, one column per month and season. ``D-N`` is dropped."""
    months = {
        f"anomalia_{mes.lower()}": month
        for mes, month in zip(layouts.MESES, layouts.MONTHS, strict=True)
    }
    return project(
        raw,
        {
            "anio": safe("Year", "int"),
            **_doubles(months),
            **_doubles(layouts.GISTEMP_PERIODS),
            "ingest_date": F.col("ingest_date"),
        },
    )


def clean_oisst(raw: DataFrame) -> DataFrame:
    """Daily sea temperature; land cells (``NaN``) are outside the domain and left out.

    The land filter compares the raw text, so it reaches the scan.
    """
    moment = safe("time", "timestamp")
    return project(
        drop_out_of_domain(raw, "sst"),
        {
            "fecha_hora": moment,
            "fecha": moment.cast("date"),
            "anio": F.year(moment),
            "mes": F.month(moment),
            **_doubles(layouts.OISST_MEASURES),
            "ingest_date": F.col("ingest_date"),
        },
    )


def clean_tracks(raw: DataFrame, run_date: RunDate = None) -> DataFrame:
    """Cyclone observations: 18 typed columns out of 150 or more, and the stamp."""
    typed = project(
        raw,
        {
            "id_tormenta": "SID",
            "temporada": safe("SEASON", "int"),
            "numero_orden": safe("NUMBER", "int"),
            "cuenca_cod": "BASIN",
            "cuenca_desc": label("BASIN", layouts.BASINS, layouts.UNKNOWN_BASIN),
            "subcuenca": "SUBBASIN",
            "nombre": "NAME",
            "fecha_hora": safe("ISO_TIME", "timestamp"),
            "naturaleza": "NATURE",
            **_doubles(
                {
                    "latitud": "LAT",
                    "longitud": "LON",
                    "viento_wmo_kt": "WMO_WIND",
                    "presion_wmo_hpa": "WMO_PRES",
                    "viento_usa_kt": "USA_WIND",
                    "presion_usa_hpa": "USA_PRES",
                }
            ),
            "categoria_saffir_simpson": safe("USA_SSHS", "int"),
            **_doubles(
                {"distancia_costa_km": "DIST2LAND", "distancia_en_landfall_km": "LANDFALL"}
            ),
        },
    )
    return stamp(typed, "ingest_date", run_date)


def _place(city: bool) -> dict[str, Column | str]:
    named = {"indicativo": "indicativo", "nombre": "nombre", "provincia": "provincia"}
    city_column = {"ciudad_objetivo": "ciudad_objetivo"} if city else {}
    return {
        "fecha": strict_date("fecha"),
        **named,
        **city_column,
        "altitud_m": safe("altitud", "int"),
    }


def _weather() -> dict[str, Column | str]:
    # Wind keeps the number the source gives, in m/s, under the name the table promises.
    return {
        **_locale_doubles(layouts.STATION_TEMPERATURES),
        "precipitacion_mm": trace_value("prec"),
        "precipitacion_inapreciable": trace_flag("prec"),
        "direccion_viento_cod": safe("dir", "int"),
        **_locale_doubles(layouts.STATION_WINDS),
        **_locale_doubles(layouts.STATION_PRESSURES),
        **_doubles(layouts.STATION_HUMIDITIES),
        **_hours(layouts.STATION_HOURS),
    }


def clean_stations(raw: DataFrame, run_date: RunDate = None) -> DataFrame:
    """Daily station climate, 25 columns. A date that does not parse fails the run."""
    typed = project(
        raw, {**_place(city=True), **_weather(), **_hours(layouts.STATION_HUMIDITY_HOURS)}
    )
    return stamp(typed, "fecha_proceso_datos", run_date)


def clean_episode(
    raw: DataFrame, run_date: RunDate = None, province: str = layouts.EPISODE_PROVINCE
) -> DataFrame:
    """The storm episode in one province, 22 columns, under the rules of ``clean_stations``."""
    inside = raw.where(F.col("provincia") == province)
    return stamp(project(inside, {**_place(city=False), **_weather()}), "ingest_date", run_date)
