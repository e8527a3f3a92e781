"""Records without a declared schema, histories, versions, differences, totals and streams."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from varve.operators import diff_runs, entity_totals
from varve.session import scratch_path
from varve.sinks import land_records, merge_landing, publish_table
from varve.sources import infer_records, record_keys
from varve.streaming import stream_landings
from workload.registry import query, table


def _records() -> Column:
    """An event as a JSON text: one key is null at times, one of two kinds, one in one event only."""
    event_id, kind = F.col("event_id").cast("string"), F.col("event_type")
    value = F.when(kind == "error", "null").otherwise(F.col("value").cast("string"))
    mixed = F.when(kind == "view", '"x"').otherwise(event_id)
    rare = F.when(F.col("event_id") == 7, F.lit(',"raro":{"x":[1.5]}')).otherwise("")
    return F.concat(
        F.lit('{"event_id":'), event_id, F.lit(',"props":'), "props", F.lit(',"valor":'), value,
        F.lit(',"mixto":'), mixed, rare, F.lit("}"),
    )


@query("""
SELECT 'event_id' AS key, CAST(count(*) AS BIGINT) AS records, CAST(0 AS BIGINT) AS nulls, 'BIGINT' AS type FROM events
UNION ALL SELECT 'props', count(*), 0, 'STRUCT<k: BIGINT>' FROM events
UNION ALL SELECT 'valor', count(*), count(*) FILTER (event_type = 'error'), 'DOUBLE' FROM events
UNION ALL SELECT 'mixto', count(*), 0, 'STRING' FROM events
UNION ALL SELECT 'raro', count(*), 0, 'STRUCT<x: ARRAY<DOUBLE>>' FROM events WHERE event_id = 7
""")
def key_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return record_keys(table(spark, sf_dir, "events").select(_records().alias("value")))


@query("""
SELECT event_id, CASE WHEN event_type <> 'error' THEN value END AS valor,
    CAST(regexp_extract(props, '[0-9]+') AS BIGINT) AS k,
    CASE WHEN event_type = 'view' THEN 'x' ELSE CAST(event_id AS VARCHAR) END AS mixto,
    CASE WHEN event_id = 7 THEN 1.5::DOUBLE END AS raro
FROM events
""")
def inferred_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "records")
    table(spark, sf_dir, "events").select(_records().alias("value")).write.text(path)
    read = infer_records(spark, path)
    rare = F.element_at("raro.x", 1).alias("raro")
    return read.select("event_id", "valor", F.col("props.k").alias("k"), "mixto", rare)


@query("""
SELECT event_id, CAST(ts AS DATE) AS dia, CAST(CASE WHEN event_id % 5 = 0 AND day(ts) <= 10 THEN 2 ELSE 1 END AS INTEGER) AS carga,
    CASE WHEN event_id % 5 = 0 AND day(ts) <= 10 THEN -value ELSE value END AS valor
FROM events
""")
def merged_landings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three landings: all events, corrections of some days, and a late repeat of older rows."""
    path = scratch_path(spark, "history")
    events = table(spark, sf_dir, "events")

    def land(rows: DataFrame, landed: int, value: Column) -> None:
        day = F.col("ts").cast("date").alias("dia")
        landing = rows.select("event_id", day, F.lit(landed).alias("carga"), value.alias("valor"))
        merge_landing(landing, path, ["event_id"], "dia", "carga")

    land(events, 1, F.col("value"))
    early = events.where(F.dayofmonth("ts") <= 10)
    land(early.where("event_id % 5 = 0"), 2, -F.col("value"))
    land(early.where("event_id % 10 = 0"), 1, F.col("value"))
    return spark.read.schema("event_id BIGINT, carga INT, valor DOUBLE, dia DATE").parquet(path)


@query("""
SELECT event_type, CAST(count(*) AS BIGINT) AS eventos FROM events
WHERE event_type <> 'error' GROUP BY event_type
""")
def published_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table published twice, the second time from its own rows."""
    path = scratch_path(spark, "published")
    name = "published_" + path.split("/")[-2].replace("-", "_")
    counts = table(spark, sf_dir, "events").groupBy("event_type").agg(F.count(F.lit(1)).alias("eventos"))
    publish_table(counts, name, "Eventos por tipo", path=path)
    publish_table(spark.table(name).where("event_type <> 'error'"), name, "Sin errores", path=path)
    read = spark.table(name)
    spark.sql(f"DROP VIEW {name}")  # its files stay under the scratch path
    return read


_RUN_SQL = "SELECT user_id, event_type, {value} AS valor FROM events WHERE {where}"
_ONE = _RUN_SQL.format(value="CAST(value AS INTEGER)", where="event_id % 7 <> 0")
_TWO = _RUN_SQL.format(
    value="CASE WHEN event_id % 11 = 0 THEN NULL ELSE CAST(value AS INTEGER) END", where="event_id % 13 <> 0"
)


@query(f"""
WITH one AS ({_ONE}), two AS ({_TWO}),
    runs AS (SELECT *, 1 AS b, 0 AS a FROM one UNION ALL SELECT *, 0, 1 FROM two)
SELECT user_id, event_type, valor, CAST(sum(b) AS BIGINT) AS n_before, CAST(sum(a) AS BIGINT) AS n_after
FROM runs GROUP BY ALL HAVING sum(b) <> sum(a)
""")
def changed_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    value = F.bround("value").cast("int")
    one = events.where("event_id % 7 <> 0").select("user_id", "event_type", value.alias("valor"))
    two = events.where("event_id % 13 <> 0")
    two = two.select("user_id", "event_type", F.when(F.col("event_id") % 11 != 0, value).alias("valor"))
    return diff_runs(one, two)


@query("""
SELECT anio, prioridad, CAST(2 - GROUPING(anio) - GROUPING(prioridad) AS INTEGER) AS nivel,
    CAST(count(DISTINCT o_custkey) AS BIGINT) AS clientes,
    CAST(count(DISTINCT CASE WHEN o_totalprice >= 400000 THEN o_custkey END) AS BIGINT) AS grandes
FROM (SELECT *, CAST(year(o_orderdate) AS INTEGER) AS anio,
          CASE WHEN o_orderpriority <> '5-LOW' THEN o_orderpriority END AS prioridad FROM orders)
GROUP BY ROLLUP (anio, prioridad)
""")
def customers_with_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers per year and priority, with totals; the lowest priority is a group without a value."""
    priority = F.when(F.col("o_orderpriority") != "5-LOW", F.col("o_orderpriority"))
    orders = table(spark, sf_dir, "orders").withColumns({"anio": F.year("o_orderdate"), "prioridad": priority})
    return entity_totals(
        orders, ["o_custkey"], ["anio", "prioridad"], "o_totalprice", 400_000, "clientes", "grandes", "nivel"
    )


@query("""
SELECT event_type, CAST(ts AS DATE) AS dia, CAST(count(*) AS BIGINT) AS eventos, round(max(value), 2) AS maximo
FROM events GROUP BY ALL
""")
def streamed_landings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two landings read as a stream; the second one repeats a third of the first."""
    root = scratch_path(spark, "stream")
    fields = "event_id BIGINT, event_type STRING, value DOUBLE, ts TIMESTAMP"
    events = table(spark, sf_dir, "events").select(
        "event_id", "event_type", "value", F.col("ts").cast("timestamp").alias("ts")
    )
    for run_date, rows in (("2024-02-01", events.where("event_id % 2 = 0")), ("2024-02-02", events.where("event_id % 2 = 1 OR event_id % 6 = 0"))):
        land_records(rows, f"{root}/landing", run_date=run_date)
        stream_landings(
            spark, f"{root}/landing", fields, ["event_id"], "ts", "40 days",
            f"{root}/table", f"{root}/checkpoint", day="dia",
        )
    read = spark.read.schema(f"{fields}, dia DATE").parquet(f"{root}/table")
    return read.groupBy("event_type", "dia").agg(
        F.count(F.lit(1)).alias("eventos"), F.round(F.max("value"), 2).alias("maximo")
    )
