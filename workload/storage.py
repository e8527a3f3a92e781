"""Round trips through files and tables in the shared folder."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from varve.functions import safe, strict_date
from varve.operators import project
from varve.session import scratch_path
from varve.sinks import comments_from_dictionary, land_records, save_table
from varve.sources import read_embedded_table, read_records, read_strings, read_typed
from workload.registry import query, table

_TEXT = ["event_id", "user_id", "event_type", "value", "props", "fecha"]


def _text_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    day = F.date_format("ts", "yyyy-MM-dd").alias("fecha")
    raw = [F.col(c).cast("string").alias(c) for c in _TEXT[:-1]]
    return table(spark, sf_dir, "events").select(*raw, day)


def _typed() -> dict[str, Column | str]:
    return {
        "event_id": safe("event_id", "bigint"),
        "user_id": safe("user_id", "bigint"),
        "event_type": "event_type",
        "value": safe("value", "double"),
        "props": "props",
    }


_PLAIN_SQL = "SELECT event_id, user_id, event_type, value, props, CAST(ts AS DATE) AS {day} FROM events"


@query(_PLAIN_SQL.format(day="ingest_date"))
def landing_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "landing")
    land_records(_text_events(spark, sf_dir), path, date_column="fecha")
    schema = ", ".join(f"{c} STRING" for c in _TEXT) + ", ingest_date DATE"
    landed = read_records(spark, path, schema)
    return project(landed, {**_typed(), "ingest_date": "ingest_date"})


@query(_PLAIN_SQL.format(day="fecha"))
def csv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "csv")
    _text_events(spark, sf_dir).write.option("header", True).csv(path)
    text = read_strings(spark, path, _TEXT)
    return project(text, {**_typed(), "fecha": strict_date("fecha")})


@query("SELECT event_id, user_id, event_type, value, props, CAST(ts AS DATE) AS fecha FROM events")
def typed_csv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "csv")
    _text_events(spark, sf_dir).write.option("header", True).csv(path)
    schema = (
        "event_id BIGINT, user_id BIGINT, event_type STRING, value DOUBLE, props STRING, fecha DATE"
    )
    return read_typed(spark, path, schema)


@query("""
SELECT CAST(year(ts) AS VARCHAR) AS "Year", CAST(event_id AS VARCHAR) AS id, event_type AS kind FROM events
""")
def embedded_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tables in text files of up to 5,000 rows: plain ones, some with their columns in another
    order, some with a byte order mark."""
    path = scratch_path(spark, "embedded")
    year = F.year("ts").cast("string")
    group = F.floor(F.col("event_id") / 5000).cast("int")
    cells = F.when(group % 3 == 1, F.concat_ws(",", year, "event_type", "event_id"))
    rows = table(spark, sf_dir, "events").select(
        group.alias("g"),
        F.col("event_id").alias("place"),
        cells.otherwise(F.concat_ws(",", year, "event_id", "event_type")).alias("line"),
    )
    title = F.when(F.col("g") % 3 == 0, F.lit("Some title"))
    header = F.when(F.col("g") % 3 == 1, "Year,kind,id").when(F.col("g") % 3 == 2, "\ufeffYear,id,kind")
    lines = [(-2, title), (-1, header.otherwise("Year,id,kind"))]
    lines += [(2**60 + i, F.lit(line)) for i, line in enumerate(["", "Year,id", "1999,x"])]
    around = F.array(*[F.struct(F.lit(at).cast("long").alias("place"), line.alias("line")) for at, line in lines])
    around = rows.select("g").distinct().select("g", F.inline(around)).where("line IS NOT NULL")
    ordered = rows.unionByName(around).repartition("g").sortWithinPartitions("g", "place")
    ordered.select("g", "line").write.partitionBy("g").text(path)
    return read_embedded_table(spark, path, ["Year", "id", "kind"], glob="*.txt")


@query("""
SELECT CAST(count(*) AS BIGINT) AS registros, CAST(count(*) FILTER (event_id % 10 = 0) AS BIGINT) AS rotos,
       CAST(sum(event_id) FILTER (event_id % 10 <> 0) AS BIGINT) AS suma
FROM events
""")
def corrupt_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every tenth record is cut off in the middle."""
    path = scratch_path(spark, "records")
    record = F.to_json(F.struct("event_id", "event_type"))
    cut = F.when(F.col("event_id") % 10 == 0, F.substring(record, 1, 12)).otherwise(record)
    table(spark, sf_dir, "events").select(cut.alias("value")).write.text(path)
    read = read_records(spark, path, "event_id BIGINT, event_type STRING", corrupt="roto")
    return read.agg(
        F.count(F.lit(1)).alias("registros"),
        F.count("roto").alias("rotos"),
        F.sum("event_id").alias("suma"),
    )


_DICTIONARY = [
    {"id": "event_id", "descripcion": "Número del evento"},
    {"id": "event_type", "descripcion": "Tipo 'corto' del evento"},
    {"id": "value", "descripcion": "Valor medido", "unidad": "mm"},
    {"id": "sol", "descripcion": "Campo ausente", "unidad": "horas"},
]


@query("""
SELECT 'event_id' AS columna, 'Número del evento' AS comentario, CAST(count(event_id) AS BIGINT) AS valores
FROM events
UNION ALL SELECT 'event_type', 'Tipo ''corto'' del evento', CAST(count(event_type) AS BIGINT) FROM events
UNION ALL SELECT 'value', 'Valor medido (unidad: mm)', CAST(count(value) AS BIGINT) FROM events
""")
def comment_carry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The comments a stored table carries, each with the number of values it describes."""
    path = scratch_path(spark, "documented")
    name = "documented_" + path.split("/")[-2].replace("-", "_")
    events = table(spark, sf_dir, "events").select("event_id", "event_type", "value")
    save_table(events, name, "Eventos", comments_from_dictionary(_DICTIONARY), path=path)
    stored = spark.table(name)
    comments = {f.name: f.metadata["comment"] for f in stored.schema if "comment" in f.metadata}
    spark.sql(f"DROP TABLE {name}")  # its files stay under the scratch path
    counted = spark.read.parquet(path).agg(*[F.count(c).alias(c) for c in comments])
    rows = counted.unpivot([], list(comments), "columna", "valores")
    texts = F.create_map(*[F.lit(x) for pair in comments.items() for x in pair])
    return rows.select("columna", texts[F.col("columna")].alias("comentario"), "valores")
