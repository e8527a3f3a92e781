"""The climate tables end to end, on small files with each source's quirks."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from varve.operators import quality_report
from varve.plans import (
    Inputs,
    clean_episode,
    clean_oisst,
    clean_stations,
    clean_tracks,
    episode_against_normal,
    layouts,
    monthly_long,
    refresh,
    unified_history,
)

RUN = "2024-11-06"

GISTEMP = """Some title line
Year,Jan,Feb,Mar,Apr,May,Jun,Jul,Aug,Sep,Oct,Nov,Dec,J-D,D-N,DJF,MAM,JJA,SON
1880,-.18,-.24,-.09,-.16,-.10,-.21,-.18,-.10,-.15,-.23,-.22,-.17,-.17,***,***,-.12,-.16,-.20
2016,1.17,1.37,1.35,1.10,.95,.80,.84,1.02,.90,.89,.92,.87,1.01,1.04,1.22,1.13,.89,.90
2026,1.10,***,***,***,***,***,***,***,***,***,***,***,***,***,1.15,***,***,***

Year,Jan,Feb
1999,9,9
"""

OISST = """time,zlev,latitude,longitude,sst,anom,err
UTC,m,degrees_north,degrees_east,degree_C,degree_C,degree_C
2024-01-01T12:00:00Z,0.0,39.125,0.125,14.5,0.3,0.1
2024-01-01T12:00:00Z,0.0,40.125,-3.125,NaN,NaN,NaN
2024-01-02T12:00:00Z,0.0,39.125,0.125,,,
2024-01-03T12:00:00Z,0.0,39.125,0.125,15.25,0.4,0.1
"""

TRACK_COLUMNS = [
    "SID", "SEASON", "NUMBER", "BASIN", "SUBBASIN", "NAME", "ISO_TIME", "NATURE", "LAT", "LON",
    "WMO_WIND", "WMO_PRES", "USA_WIND", "USA_PRES", "USA_SSHS", "DIST2LAND", "LANDFALL", "EXTRA",
]

TRACKS = [
    (" ", "Year", " ", " ", "kts", "1"),
    ("S1", "2020", "NA", "2020-08-01 00:00:00", "90", "2"),
    ("S1", "2020", "NA", "2020-08-01 06:00:00", "115", "4"),
    ("S2", "2020", "EP", "2020-09-01 00:00:00", "40", "-1"),
    ("S2", "2020", "WP", "2020-09-02 00:00:00", "120", "4"),
    ("S3", "2020", "XX", "bad", " ", " "),
    ("S4", "", "SI", "2021-01-01 00:00:00", "50", "0"),
]


def track_file():
    out = [",".join(TRACK_COLUMNS)]
    for sid, season, basin, time, wind, category in TRACKS:
        cells = dict.fromkeys(TRACK_COLUMNS, " ") | {
            "SID": sid, "SEASON": season, "BASIN": basin, "ISO_TIME": time, "USA_WIND": wind,
            "USA_SSHS": category, "LAT": "10.5", "NUMBER": "3",
        }
        out.append(",".join(cells[c] for c in TRACK_COLUMNS))
    return "\n".join(out) + "\n"


def day(fecha, indicativo="A1", provincia="VALENCIA", **cells):
    return {
        "fecha": fecha, "indicativo": indicativo, "nombre": f"EST {indicativo}",
        "provincia": provincia, "altitud": "11", **cells,
    }


STATIONS = [
    day("2024-10-01", tmed="18,4", prec="Ip", horatmin="Varias", hrMedia="60", velmedia="3,5"),
    day("2024-10-02", tmed="19,0", prec="1,5", horatmin="06:40"),
    day("2024-10-03", horatmin="7:05"),
    day("2024-10-04", tmed="18,8", prec="Acum", horatmin="99:99"),
    day("2024-10-29", tmed="17,0", prec="185,0", horatmin="05:00"),
    day("2024-10-01", indicativo="D0", prec="0,0"),
    day("2024-10-29", indicativo="D0", prec="0,0"),
]
EPISODE = [
    day("2024-10-29", tmed="17,0", prec="185,0", horatmin="05:00"),
    day("2024-10-30", tmed="16,0", prec="20,0"),
    day("2024-10-29", indicativo="D0", prec="0,0"),
    day("2024-10-29", indicativo="Z9", provincia="OTRA", prec="20,0"),
]
DICTIONARY = [
    {"id": "altitud", "descripcion": "Altitud de la estación", "unidad": "m"},
    {"id": "no_existe", "descripcion": "Campo ausente"},
]


@pytest.fixture(scope="module")
def built(spark, tmp_path_factory):
    base = tmp_path_factory.mktemp("inputs")

    def put(name, file, text):
        (base / name).mkdir()
        (base / name / file).write_text(text)
        return str(base / name)

    cities = [{**r, "ciudad_objetivo": "VALENCIA"} for r in STATIONS]
    inputs = Inputs(
        gistemp=put("gistemp", "GLB.Ts+dSST.csv", GISTEMP),
        oisst=put("oisst", "oisst.csv", OISST),
        tracks=put("tracks", "ibtracs.csv", track_file()),
        stations=put("stations", "climatologia_raw.json", json.dumps(cities)),
        episode=put("episode", "dana_raw.json", json.dumps(EPISODE)),
        dictionary=DICTIONARY,
    )
    return refresh(spark, inputs, RUN)


def test_every_table_exists(spark, built):
    assert {n.split(".")[0] for n in built} == {"bronze", "silver", "gold"}
    assert len(built) == 15
    assert all(spark.catalog.tableExists(name) for name in built)


def test_dictionary_fields_that_do_not_exist_are_reported(built):
    assert built["bronze.aemet_climatologia_raw"].undocumented == ["no_existe"]
    assert built["silver.aemet_climatologia_clean"].undocumented == []


def test_rows_are_counted_before_and_after_the_units_line(spark, built):
    tracks = built["bronze.noaa_ibtracs_raw"]
    assert (tracks.rows_read, tracks.rows) == (7, 5)
    assert (built["bronze.noaa_oisst_raw"].rows_read, built["bronze.noaa_oisst_raw"].rows) == (5, 4)
    assert {name: run.rows for name, run in built.items()} == {
        name: spark.table(name).count() for name in built
    }


def test_comments_reach_the_catalog(spark, built):
    got = {r["col_name"]: r["comment"] for r in spark.sql("DESCRIBE TABLE bronze.aemet_climatologia_raw").collect()}
    assert got["altitud"] == "Altitud de la estación (unidad: m)"
    got = {r["col_name"]: r["comment"] for r in spark.sql("DESCRIBE TABLE bronze.noaa_oisst_raw").collect()}
    assert got["zlev"] == "Profundidad (unidad: m)"


def test_gistemp(spark, built):
    raw, clean = spark.table("bronze.nasa_gistemp_raw"), spark.table("silver.nasa_gistemp_clean")
    assert raw.columns == [*layouts.GISTEMP_COLUMNS, "ingest_date"] and raw.count() == 3
    assert len(clean.columns) == 19
    assert clean.columns[:3] == ["anio", "anomalia_ene", "anomalia_feb"]
    assert clean.columns[13:] == [
        "anomalia_media_anual", "anomalia_invierno", "anomalia_primavera", "anomalia_verano",
        "anomalia_otonio", "ingest_date",
    ]
    row = clean.where("anio = 2026").first()
    assert row["anomalia_ene"] == 1.10 and row["anomalia_feb"] is None
    assert row["anomalia_invierno"] == 1.15


def test_monthly_series(spark, built):
    long = spark.table("gold.temp_global_mensual")
    assert long.columns == ["anio", "mes", "anomalia_c"] and long.count() == 25
    numbered = monthly_long(spark.table("silver.nasa_gistemp_clean"), with_month_number=True)
    assert numbered.where("mes = 'Dic'").first()["mes_num"] == 12


def test_early_and_recent_means(spark, built):
    early = (F.col("anio").between(1880, 1900), "anomalia_media_anual")
    recent = (F.col("anio") >= 2015, "anomalia_media_anual")
    got = quality_report(
        spark.table("silver.nasa_gistemp_clean"), extents=["anio"], means={"early": early, "recent": recent}
    ).first()
    assert got.asDict() == {"total_rows": 3, "min_anio": 1880, "max_anio": 2026, "early": -0.17, "recent": 1.01}


def test_oisst(spark, built):
    clean = spark.table("silver.noaa_oisst_clean")
    assert clean.columns == [
        "fecha_hora", "fecha", "anio", "mes", "latitud", "longitud", "temp_superficial_c",
        "anomalia_c", "margen_error_c", "ingest_date",
    ]
    got = quality_report(
        clean, nulls=["temp_superficial_c"], nans=["temp_superficial_c"], extents=["fecha"],
        means={"mean": "temp_superficial_c"},
    ).first()
    assert got.asDict() == {
        "total_rows": 2, "nulls_temp_superficial_c": 0, "nans_temp_superficial_c": 0,
        "min_fecha": dt.date(2024, 1, 1), "max_fecha": dt.date(2024, 1, 3), "mean": 14.88,
    }


def test_tracks(spark, built):
    assert spark.table("bronze.noaa_ibtracs_raw").count() == 5
    clean = spark.table("silver.noaa_ibtracs_clean")
    assert len(clean.columns) == 19 and clean.columns[-1] == "ingest_date"
    odd = clean.where("id_tormenta = 'S3'").first()
    assert odd["cuenca_desc"] == "Desconocida" and odd["fecha_hora"] is None
    assert odd["categoria_saffir_simpson"] is None and odd["viento_usa_kt"] is None
    assert clean.where("cuenca_cod = 'NA'").first()["cuenca_desc"] == "Atlántico Norte"


def test_storms_by_basin(spark, built, rows):
    assert rows(spark.table("gold.ciclones_por_cuenca_anual")) == [
        (2020, "Atlántico Norte", 1, 1),
        (2020, "Desconocida", 1, 0),
        (2020, "Pacífico Este", 1, 0),
        (2020, "Pacífico Oeste (tifones)", 1, 1),
    ]


def test_stations(spark, built):
    clean = spark.table("silver.aemet_climatologia_clean")
    assert len(clean.columns) == 25 and clean.columns[4] == "ciudad_objetivo"
    assert clean.columns[-1] == "fecha_proceso_datos"
    days = {r["fecha"].day: r for r in clean.where("indicativo = 'A1'").collect()}
    measured = {
        d: (r["temp_media_c"], r["precipitacion_mm"], r["precipitacion_inapreciable"], r["hora_temp_min"])
        for d, r in days.items()
    }
    assert measured == {
        1: (18.4, 0.0, True, None),
        2: (19.0, 1.5, False, "06:40"),
        3: (None, None, None, None),
        4: (18.8, None, False, "99:99"),
        29: (17.0, 185.0, False, "05:00"),
    }
    assert days[1]["humedad_media_pct"] == 60.0 and days[1]["viento_media_kmh"] == 3.5


def test_episode_keeps_one_province(spark, built):
    clean = spark.table("silver.aemet_dana_clean")
    assert len(clean.columns) == 22 and set(clean.columns) == set(layouts.HISTORY_COLUMNS)
    assert {r["indicativo"] for r in clean.collect()} == {"A1", "D0"}


def test_yearly_summary_has_gaps(spark, built, rows):
    summary = spark.table("gold.resumen_anual")
    assert summary.columns == [
        "anio", "anomalia_temp_global_c", "sst_mediterraneo_c", "num_ciclones_global",
        "num_ciclones_intensos_global", "temp_media_espana_c", "precipitacion_total_espana_mm",
    ]
    assert rows(summary) == [
        (1880, -0.17, None, None, None, None, None),
        (2016, 1.01, None, None, None, None, None),
        (2020, None, None, 3, 2, None, None),
        (2024, None, 14.88, None, None, 18.3, 186.5),
        (2026, None, None, None, None, None, None),
    ]


def test_episode_against_normal(spark, built, rows):
    table = spark.table("gold.dana_vs_normal")
    assert rows(table) == [
        ("EST A1", 205.0, 185.0, 62.17, 3.0),
        ("EST D0", 0.0, 0.0, 0.0, None),
    ]
    october = episode_against_normal(
        spark.table("silver.aemet_dana_clean"),
        spark.table("silver.aemet_climatologia_clean"),
        baseline_filter=F.dayofmonth("fecha") < 20,
    )
    assert october.where("nombre = 'EST A1'").first()["veces_sobre_lo_normal"] == 246.7


def test_history_is_distinct_rows_of_both(spark, built):
    history = spark.table("gold.hist_meteo_esp")
    assert history.columns == layouts.HISTORY_COLUMNS
    assert history.count() == len(STATIONS) + 1
    keyed = unified_history(
        spark.table("silver.aemet_climatologia_clean"),
        spark.table("silver.aemet_dana_clean"),
        key=["fecha", "indicativo"],
    )
    assert keyed.count() == len(STATIONS) + 1


def test_only_the_days_own_landing_is_loaded(spark, tmp_path):
    def put(name, text, file="x.csv"):
        (tmp_path / name).mkdir(parents=True)
        (tmp_path / name / file).write_text(text)
        return str(tmp_path / name)

    for day_, records in (("2024-11-05", STATIONS[:3]), (RUN, STATIONS)):
        put(f"stations/ingest_date={day_}", json.dumps(records), "x.json")
        put(f"episode/ingest_date={day_}", json.dumps(EPISODE), "x.json")
    inputs = Inputs(
        gistemp=put("gistemp", GISTEMP), oisst=put("oisst", OISST), tracks=put("tracks", track_file()),
        stations=str(tmp_path / "stations"), episode=str(tmp_path / "episode"),
    )
    runs = refresh(spark, inputs, RUN)
    assert runs["bronze.aemet_climatologia_raw"].rows == len(STATIONS)
    assert runs["bronze.aemet_dana_raw"].rows == len(EPISODE)
    assert "ingest_date" not in spark.table("bronze.aemet_climatologia_raw").columns
    year = spark.table("gold.resumen_anual").where("anio = 2024").first()
    assert year["precipitacion_total_espana_mm"] == 186.5

    # A landing that is not there stops the run before the first table is written.
    before = {t: spark.table(t).collect() for t in ("bronze.nasa_gistemp_raw", "silver.aemet_dana_clean", "gold.resumen_anual")}
    (tmp_path / "gistemp" / "x.csv").write_text(GISTEMP.replace("1880", "1881"))
    with pytest.raises(FileNotFoundError, match="2031-01-01"):
        refresh(spark, inputs, "2031-01-01")
    assert {t: spark.table(t).collect() for t in before} == before

    # Keys without a column are named.
    more = [{**r, "nuevo": 1, "Fecha2": None} for r in STATIONS[:1]] + STATIONS[1:]
    put("stations/ingest_date=2024-12-01", json.dumps(more), "x.json")
    put("episode/ingest_date=2024-12-01", json.dumps(EPISODE), "x.json")
    runs = refresh(spark, inputs, "2024-12-01")
    assert runs["bronze.aemet_climatologia_raw"].undeclared == ["Fecha2", "nuevo"]
    assert runs["bronze.aemet_dana_raw"].undeclared == []


def test_a_run_that_publishes_keeps_the_old_tables_until_the_new_ones_are_whole(spark, tmp_path, built):
    from varve.plans.refresh import SCHEMAS
    from varve.sinks import publish_table

    def put(name, text, file="x.csv"):
        (tmp_path / name).mkdir(parents=True, exist_ok=True)
        (tmp_path / name / file).write_text(text)
        return str(tmp_path / name)

    stored = {t: spark.table(t).collect() for t in ("gold.resumen_anual", "gold.dana_vs_normal")}
    inputs = Inputs(
        gistemp=put("gistemp", GISTEMP), oisst=put("oisst", OISST), tracks=put("tracks", track_file()),
        stations=put("stations", json.dumps(STATIONS), "x.json"), episode=put("episode", json.dumps(EPISODE), "x.json"),
    )
    names = {s: [t.name for t in spark.catalog.listTables(s)] for s in SCHEMAS}
    saved = {f"{s}.{t}": str(tmp_path / "saved" / s / t) for s in SCHEMAS for t in names[s]}
    for table, path in saved.items():
        spark.table(table).write.parquet(path)
        spark.sql(f"DROP TABLE {table}")
    try:
        refresh(spark, inputs, RUN, save=publish_table)
        assert spark.table("gold.dana_vs_normal").collect() == stored["gold.dana_vs_normal"]
        put("stations", json.dumps([{**STATIONS[0], "fecha": "no date"}]), "x.json")
        with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
            refresh(spark, inputs, RUN, save=publish_table)
        assert spark.table("silver.aemet_climatologia_clean").count() == len(STATIONS)
        assert spark.table("gold.dana_vs_normal").collect() == stored["gold.dana_vs_normal"]
    finally:
        for table, path in saved.items():
            spark.sql(f"DROP VIEW IF EXISTS {table}")
            spark.read.parquet(path).write.mode("overwrite").saveAsTable(table)


def raw_stations(spark, *records):
    fields = [*layouts.STATION_FIELDS, "ciudad_objetivo"]
    schema = ", ".join(f"{f} string" for f in fields)
    return spark.createDataFrame([tuple(r.get(f) for f in fields) for r in records], schema)


def test_a_bad_date_fails_the_run(spark):
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        clean_stations(raw_stations(spark, day("bad-date"))).collect()


def test_unparsed_seasons_stay_one_null_year(spark):
    cells = [{c: None for c in TRACK_COLUMNS} | {"SID": s, "SEASON": "x"} for s in ("S1", "S2")]
    raw = spark.createDataFrame([tuple(c[k] for k in TRACK_COLUMNS) for c in cells], ", ".join(f"{c} string" for c in TRACK_COLUMNS))
    assert [r["temporada"] for r in clean_tracks(raw, RUN).collect()] == [None, None]


def test_filters_on_raw_text_reach_the_scan(spark, built):
    episode = clean_episode(spark.table("bronze.aemet_dana_raw"), RUN)
    sea = clean_oisst(spark.table("bronze.noaa_oisst_raw"))
    assert "EqualTo(provincia,VALENCIA)" in episode._jdf.queryExecution().toString()
    assert "Not(EqualTo(sst,NaN))" in sea._jdf.queryExecution().toString()
