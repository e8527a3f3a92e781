"""Functions on text cells."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from varve.functions import (
    HOUR_MINUTE,
    guard,
    label,
    locale_double,
    null_token,
    round_half_up,
    safe,
    strict_date,
    trace_flag,
    trace_value,
)
from varve.operators import project, stamp
from workload.dirty import DIRTY_SQL, dirty_events
from workload.registry import query, table


@query("""
SELECT event_id AS evento, user_id AS usuario, event_type AS tipo, value AS importe,
       CAST(ts AS DATE) AS dia
FROM events
""")
def typed_projection(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = table(spark, sf_dir, "events").select(
        F.col("event_id").cast("string").alias("EVENT"),
        F.col("user_id").cast("string").alias("USER"),
        F.col("event_type").alias("KIND"),
        F.col("value").cast("string").alias("VALUE"),
        F.date_format("ts", "yyyy-MM-dd").alias("DAY"),
    )
    return project(
        text,
        {
            "evento": safe("EVENT", "bigint"),
            "usuario": safe("USER", "bigint"),
            "tipo": "KIND",
            "importe": safe("VALUE", "double"),
            "dia": strict_date("DAY"),
        },
    )


@query("""
SELECT event_id,
       TRY_CAST(CASE event_type WHEN 'error' THEN 'Ip' WHEN 'signup' THEN ' '
                                ELSE CAST(value AS VARCHAR) END AS DOUBLE) AS como_double,
       TRY_CAST(CASE event_type WHEN 'view' THEN 'Varias' WHEN 'signup' THEN NULL
                                ELSE ' ' || CAST(user_id AS VARCHAR) || ' ' END AS INTEGER) AS como_int,
       TRY_CAST(CASE event_type WHEN 'click' THEN 'sin hora'
                                ELSE strftime(ts, '%Y-%m-%d %H:%M:%S') END AS TIMESTAMP) AS como_hora
FROM events
""")
def safe_cast_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = F.col("event_type")
    number = F.when(kind == "error", "Ip").when(kind == "signup", " ")
    whole = F.when(kind == "view", "Varias").when(kind == "signup", F.lit(None))
    moment = F.when(kind == "click", "sin hora")
    text = table(spark, sf_dir, "events").select(
        "event_id",
        number.otherwise(F.col("value").cast("string")).alias("number"),
        whole.otherwise(F.concat(F.lit(" "), F.col("user_id"), F.lit(" "))).alias("whole"),
        moment.otherwise(F.date_format("ts", "yyyy-MM-dd HH:mm:ss")).alias("moment"),
    )
    return project(
        text,
        {
            "event_id": "event_id",
            "como_double": safe("number", "double"),
            "como_int": safe("whole", "int"),
            "como_hora": safe("moment", "timestamp").cast("timestamp_ntz"),
        },
    )


@query(f"""
SELECT event_id, TRY_CAST(replace(raw, ',', '.') AS DOUBLE) AS importe FROM {DIRTY_SQL}
""")
def locale_decimal(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dirty_events(spark, sf_dir).select("event_id", locale_double("raw").alias("importe"))


@query(f"""
SELECT event_id,
       CASE WHEN raw = 'Ip' THEN CAST(0 AS DOUBLE)
            ELSE TRY_CAST(replace(raw, ',', '.') AS DOUBLE) END AS valor,
       raw = 'Ip' AS inapreciable
FROM {DIRTY_SQL}
""")
def trace_code(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dirty_events(spark, sf_dir).select(
        "event_id", trace_value("raw").alias("valor"), trace_flag("raw").alias("inapreciable")
    )


@query("""
SELECT event_id, CASE WHEN regexp_full_match(hora, '[0-9]{2}:[0-9]{2}') THEN hora END AS hora
FROM (SELECT event_id, CASE event_type WHEN 'view' THEN 'Varias' WHEN 'click' THEN '7:05'
                                       ELSE strftime(ts, '%H:%M') END AS hora
      FROM events)
""")
def pattern_guard(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = F.col("event_type")
    hour = F.when(kind == "view", "Varias").when(kind == "click", "7:05")
    text = table(spark, sf_dir, "events").select(
        "event_id", hour.otherwise(F.date_format("ts", "HH:mm")).alias("hora")
    )
    return text.select("event_id", guard("hora", HOUR_MINUTE).alias("hora"))


@query("""
SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN 'Terminado' WHEN 'O' THEN 'Abierto'
                                      ELSE 'Desconocido' END AS estado
FROM orders
""")
def code_label(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = {"F": "Terminado", "O": "Abierto"}
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", label("o_orderstatus", labels, "Desconocido").alias("estado")
    )


@query("""
SELECT o_orderkey, CAST(o_orderdate AS DATE) AS fecha,
       CAST(year(o_orderdate) AS INTEGER) AS anio, CAST(month(o_orderdate) AS INTEGER) AS mes
FROM orders
""")
def date_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = table(spark, sf_dir, "orders").select(
        "o_orderkey", F.date_format("o_orderdate", "yyyy-MM-dd").alias("texto")
    )
    dated = text.select("o_orderkey", strict_date("texto").alias("fecha"))
    return dated.select(
        "*", F.year("fecha").alias("anio"), F.month("fecha").alias("mes")
    )


@query("""
SELECT event_id, CASE WHEN event_type <> 'error' THEN CAST(value AS VARCHAR) END AS texto
FROM events
""")
def sentinel_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.when(F.col("event_type") == "error", "***").otherwise(F.col("value").cast("string"))
    raw = table(spark, sf_dir, "events").select("event_id", text.alias("raw"))
    return raw.select("event_id", null_token("raw", "***").alias("texto"))


@query("SELECT c_custkey, c_name, DATE '2024-11-05' AS ingest_date FROM customer")
def stamped_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_name")
    return stamp(customers, run_date="2024-11-05")


@query("""
SELECT event_id, CAST(round(CAST(value AS DECIMAL(28,8)), 0) AS DOUBLE) AS entero,
       CAST(round(CAST(value AS DECIMAL(28,8)), 2) AS DOUBLE) AS dos,
       CAST(round(CAST(value / 7 AS DECIMAL(36,16)), 10) AS DOUBLE) AS diez
FROM events
""")
def rounded_digits(spark: SparkSession, sf_dir: str) -> DataFrame:
    value = F.col("value")
    return table(spark, sf_dir, "events").select(
        "event_id",
        round_half_up(value, 0).alias("entero"),
        round_half_up(value, 2).alias("dos"),
        round_half_up(value / 7, 10).alias("diez"),
    )
