"""Raw layouts and the names the clean tables must carry. Fixed values, as the sources give them."""

from __future__ import annotations

MONTHS = ["Jan", "Feb", "Mar", "Apr", "May", "Jun", "Jul", "Aug", "Sep", "Oct", "Nov", "Dec"]
MESES = ["Ene", "Feb", "Mar", "Abr", "May", "Jun", "Jul", "Ago", "Sep", "Oct", "Nov", "Dic"]

GISTEMP_COLUMNS = ["Year", *MONTHS, "J-D", "D-N", "DJF", "MAM", "JJA", "SON"]

GISTEMP_PERIODS = {
    "anomalia_media_anual": "J-D",
    "anomalia_invierno": "DJF",
    "anomalia_primavera": "MAM",
    "anomalia_verano": "JJA",
    "anomalia_otonio": "SON",
}

OISST_COLUMNS = ["time", "zlev", "latitude", "longitude", "sst", "anom", "err"]
OISST_UNITS = ("time", "UTC")

OISST_MEASURES = {
    "latitud": "latitude",
    "longitud": "longitude",
    "temp_superficial_c": "sst",
    "anomalia_c": "anom",
    "margen_error_c": "err",
}

TRACKS_UNITS = ("SEASON", "Year")

BASINS = {
    "NA": "Atlántico Norte",
    "WP": "Pacífico Oeste (tifones)",
    "EP": "Pacífico Este",
    "NI": "Índico Norte",
    "SI": "Índico Sur",
    "SP": "Pacífico Sur",
    "SA": "Atlántico Sur",
}
UNKNOWN_BASIN = "Desconocida"
INTENSE_CATEGORY = 3

STATION_FIELDS = [
    "fecha", "indicativo", "nombre", "provincia", "altitud",
    "tmed", "prec", "tmin", "tmax",
    "dir", "velmedia", "racha", "horaracha", "horatmax", "horatmin",
    "hrMax", "hrMedia", "hrMin", "horaHrMax", "horaHrMin",
    "presMax", "presMin", "horaPresMax", "horaPresMin",
    "pintMax", "horaPIntMax", "sol",
]

STATION_TEMPERATURES = {"temp_media_c": "tmed", "temp_min_c": "tmin", "temp_max_c": "tmax"}
STATION_WINDS = {"viento_media_kmh": "velmedia", "viento_racha_kmh": "racha"}
STATION_PRESSURES = {"presion_max_hpa": "presMax", "presion_min_hpa": "presMin"}
STATION_HUMIDITIES = {
    "humedad_media_pct": "hrMedia",
    "humedad_max_pct": "hrMax",
    "humedad_min_pct": "hrMin",
}
STATION_HOURS = {
    "hora_temp_min": "horatmin",
    "hora_temp_max": "horatmax",
    "hora_racha_max": "horaracha",
}
STATION_HUMIDITY_HOURS = {"hora_humedad_max": "horaHrMax", "hora_humedad_min": "horaHrMin"}

EPISODE_PROVINCE = "VALENCIA"

# The columns the climate and the episode table have in common.
HISTORY_COLUMNS = [
    "fecha", "indicativo", "nombre", "provincia", "altitud_m",
    "temp_media_c", "temp_min_c", "temp_max_c",
    "precipitacion_mm", "precipitacion_inapreciable",
    "direccion_viento_cod", "viento_media_kmh", "viento_racha_kmh",
    "presion_max_hpa", "presion_min_hpa",
    "humedad_media_pct", "humedad_max_pct", "humedad_min_pct",
    "hora_temp_min", "hora_temp_max", "hora_racha_max", "ingest_date",
]
