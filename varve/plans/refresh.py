"""One run over all sources: files to raw tables, to clean tables, to aggregate tables."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Iterable, Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from varve.operators import drop_units_row, stamp
from varve.plans import aggregates, clean, layouts
from varve.sinks import comments_from_dictionary, observed, save_table
from varve.sources import landing_texts, read_embedded_table, read_records, read_strings, undeclared_keys

SCHEMAS = ("bronze", "silver", "gold")


@dataclass(frozen=True)
class Inputs:
    """Where the landed files are. ``dictionary`` documents the station fields."""

    gistemp: str
    oisst: str
    tracks: str
    stations: str
    episode: str
    dictionary: Iterable[Mapping[str, str]] = ()


TABLE_COMMENTS = {
    "bronze.nasa_gistemp_raw": "Anomalías globales por mes y estación, como texto de la fuente",
    "bronze.noaa_oisst_raw": "Temperatura diaria del mar por celda, como texto de la fuente",
    "bronze.noaa_ibtracs_raw": "Observaciones de ciclones, todas las columnas como texto",
    "bronze.aemet_climatologia_raw": "Registros diarios por estación del día de carga, como texto",
    "bronze.aemet_dana_raw": "Registros del episodio de lluvia del día de carga, como texto",
    "silver.nasa_gistemp_clean": "Anomalías mensuales y estacionales, una columna por mes",
    "silver.noaa_oisst_clean": "Temperatura diaria del mar, sin celdas de tierra",
    "silver.noaa_ibtracs_clean": "Observaciones de ciclones, columnas principales con tipo",
    "silver.aemet_climatologia_clean": "Clima diario por estación, con tipo",
    "silver.aemet_dana_clean": "Clima diario del episodio de lluvia, con tipo",
    "gold.temp_global_mensual": "Anomalía por año y mes, en filas",
    "gold.ciclones_por_cuenca_anual": "Tormentas por temporada y cuenca",
    "gold.resumen_anual": "Una fila por año con las cuatro fuentes; NULL donde falta una",
    "gold.dana_vs_normal": "Lluvia del episodio frente a la media diaria de cada estación",
    "gold.hist_meteo_esp": "Filas distintas de clima y episodio",
}

COLUMN_COMMENTS = {
    "bronze.nasa_gistemp_raw": {
        "Year": "Año de la fila",
        "J-D": "Media de enero a diciembre (unidad: °C)",
        "D-N": "Media de diciembre a noviembre (unidad: °C)",
        "DJF": "Media del invierno boreal (unidad: °C)",
        "MAM": "Media de la primavera boreal (unidad: °C)",
        "JJA": "Media del verano boreal (unidad: °C)",
        "SON": "Media del otoño boreal (unidad: °C)",
    },
    "bronze.noaa_oisst_raw": {
        "time": "Instante de la medida, en UTC",
        "zlev": "Profundidad (unidad: m)",
        "latitude": "Latitud de la celda (unidad: grados norte)",
        "longitude": "Longitud de la celda (unidad: grados este)",
        "sst": "Temperatura de la superficie; NaN en tierra (unidad: °C)",
        "anom": "Diferencia con la media de referencia (unidad: °C)",
        "err": "Error estimado (unidad: °C)",
    },
    "bronze.noaa_ibtracs_raw": {
        "SID": "Identificador de la tormenta",
        "SEASON": "Temporada",
        "BASIN": "Código de la cuenca",
        "ISO_TIME": "Instante de la observación, en UTC",
        "LAT": "Latitud del centro (unidad: grados)",
        "LON": "Longitud del centro (unidad: grados)",
        "USA_WIND": "Viento sostenido (unidad: nudos)",
        "USA_PRES": "Presión en el centro (unidad: hPa)",
        "USA_SSHS": "Categoría, de -1 a 5",
        "DIST2LAND": "Distancia a la costa (unidad: km)",
    },
    "silver.nasa_gistemp_clean": {
        "anomalia_media_anual": "Media de enero a diciembre (unidad: °C)",
    },
    "silver.noaa_oisst_clean": {
        "temp_superficial_c": "Temperatura de la superficie del mar (unidad: °C)",
        "anomalia_c": "Diferencia con la media de referencia (unidad: °C)",
    },
    "silver.noaa_ibtracs_clean": {
        "categoria_saffir_simpson": "De -1 (depresión) a 5",
        "cuenca_desc": "Nombre de la cuenca",
    },
    "silver.aemet_climatologia_clean": {
        "temp_media_c": "Temperatura media del día (unidad: °C)",
        "precipitacion_mm": "Lluvia del día; la inapreciable cuenta 0 (unidad: mm)",
        "precipitacion_inapreciable": "TRUE con lluvia inapreciable, NULL sin dato",
        "viento_media_kmh": "Sin convertir: la fuente lo da en m/s, pese al nombre",
        "viento_racha_kmh": "Sin convertir: la fuente lo da en m/s, pese al nombre",
    },
}


CORRUPT = "_corrupt_record"
LANDING_DAY = "ingest_date"


@dataclass(frozen=True)
class TableRun:
    """What a run did to one table."""

    rows: int
    rows_read: int
    undocumented: list[str]
    corrupt: int = 0
    undeclared: list[str] = field(default_factory=list)


def refresh(
    spark: SparkSession,
    inputs: Inputs,
    run_date: dt.date | str | None = None,
    save: Callable[..., list[str]] = save_table,
) -> dict[str, TableRun]:
    """Rebuild every table in the schemas bronze, silver and gold of the current catalog.

    Each layer reads the stored tables of the one before, so nothing is computed twice and a
    failed run can start again at any table. Per table the result holds the rows written, the
    rows read before a units line was dropped, the documented names that are no columns, and the
    texts that were no JSON record, which are left out; rows are counted by the writes themselves.
    Of records landed by day (folders ``ingest_date=…``) only those of ``run_date`` are read; if
    that landing is not there, nothing is written at all. Keys of the records that no column takes
    are named in the result. ``save`` writes the tables: with ``publish_table`` each changes in one
    step, and its readers and a failed run keep the one before.
    """
    if run_date is None:  # one date for the whole run, even past midnight
        run_date = spark.range(1).select(F.current_date()).first()[0]
    landings = {path: landing_texts(spark, path, run_date) for path in (inputs.stations, inputs.episode)}
    for schema in SCHEMAS:
        spark.sql(f"CREATE SCHEMA IF NOT EXISTS {schema}")
    done: dict[str, TableRun] = {}

    def store(
        name: str,
        df: DataFrame,
        column_comments: Mapping[str, str] | None = None,
        units: tuple[str, str] | None = None,
        undeclared: list[str] | None = None,
    ) -> DataFrame:
        comments = column_comments or COLUMN_COMMENTS.get(name)
        broken = {"corrupt": F.col(CORRUPT).isNotNull()} if CORRUPT in df.columns else {}
        source, read = observed(df, **broken)
        if broken:
            source = source.where(F.col(CORRUPT).isNull()).drop(CORRUPT)
        kept, written = observed(drop_units_row(source, *units) if units else source)
        missing = save(kept, name, TABLE_COMMENTS.get(name), comments)
        counts = read.get
        rows, lost = written.get["rows"], counts.get("corrupt", 0)
        done[name] = TableRun(rows, counts["rows"], missing, lost, undeclared or [])
        return spark.table(name)

    def stamped(df: DataFrame) -> DataFrame:
        return stamp(df, run_date=run_date)

    def records(path: str, schema: str) -> DataFrame:
        read = read_records(spark, path, schema, corrupt=CORRUPT)
        if LANDING_DAY not in read.columns:
            return read
        return read.where(F.col(LANDING_DAY) == F.lit(str(run_date)).cast("date")).drop(LANDING_DAY)

    def unread(path: str, schema: str) -> list[str]:
        keys = undeclared_keys(landings[path], schema).agg(F.sort_array(F.collect_list("key")))
        return keys.first()[0]

    gistemp_raw = store(
        "bronze.nasa_gistemp_raw",
        stamped(read_embedded_table(spark, inputs.gistemp, layouts.GISTEMP_COLUMNS)),
    )
    oisst_raw = store(
        "bronze.noaa_oisst_raw",
        stamped(read_strings(spark, inputs.oisst, layouts.OISST_COLUMNS)),
        units=layouts.OISST_UNITS,
    )
    tracks_raw = store(
        "bronze.noaa_ibtracs_raw",
        stamped(read_strings(spark, inputs.tracks)),
        units=layouts.TRACKS_UNITS,
    )
    fields = ", ".join(f"{name} STRING" for name in layouts.STATION_FIELDS)
    station_fields = f"{fields}, ciudad_objetivo STRING"
    dictionary = comments_from_dictionary(inputs.dictionary)
    stations_raw = store(
        "bronze.aemet_climatologia_raw",
        records(inputs.stations, station_fields),
        dictionary,
        undeclared=unread(inputs.stations, station_fields),
    )
    episode_raw = store(
        "bronze.aemet_dana_raw",
        records(inputs.episode, fields),
        dictionary,
        undeclared=unread(inputs.episode, fields),
    )

    gistemp = store("silver.nasa_gistemp_clean", clean.clean_gistemp(gistemp_raw))
    oisst = store("silver.noaa_oisst_clean", clean.clean_oisst(oisst_raw))
    tracks = store("silver.noaa_ibtracs_clean", clean.clean_tracks(tracks_raw, run_date))
    stations = store(
        "silver.aemet_climatologia_clean", clean.clean_stations(stations_raw, run_date)
    )
    episode = store("silver.aemet_dana_clean", clean.clean_episode(episode_raw, run_date))

    store("gold.temp_global_mensual", aggregates.monthly_long(gistemp))
    store("gold.ciclones_por_cuenca_anual", aggregates.regional_counts(tracks))
    store("gold.resumen_anual", aggregates.yearly_summary(gistemp, oisst, tracks, stations))
    store("gold.dana_vs_normal", aggregates.episode_against_normal(episode, stations))
    store("gold.hist_meteo_esp", aggregates.unified_history(stations, episode))
    return done
