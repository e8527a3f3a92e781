"""As-of and range joins, moving means and anomalies on events."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from varve.functions import round_half_up
from varve.operators import MICROSECONDS, anomaly, as_of_join, moving_mean, range_join
from workload.registry import query, table

# The test orders are decades older than the events, so their days are moved among these.
_ORDERS_SQL = """
(SELECT o_custkey AS user_id, max(o_orderkey) AS pedido, o_at
 FROM (SELECT o_custkey, o_orderkey, TIMESTAMP '2024-01-01' + INTERVAL 1 HOUR * (o_orderkey % 700) AS o_at FROM orders)
 GROUP BY o_custkey, o_at)
"""


def _moved_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    hours = F.make_dt_interval(hours=(F.col("o_orderkey") % 700).cast("int"))
    return table(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("user_id"),
        F.col("o_orderkey").alias("pedido"),
        (F.lit("2024-01-01").cast("timestamp_ntz") + hours).alias("o_at"),
    )


@query(f"""
SELECT event_id, e.user_id, pedido, o_at FROM events e
ASOF LEFT JOIN {_ORDERS_SQL} o ON e.user_id = o.user_id AND e.ts >= o.o_at
""")
def last_order_before(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").select("event_id", "user_id", "ts")
    joined = as_of_join(
        events, _moved_orders(spark, sf_dir), ["user_id"], "ts", "o_at", block=2 * MICROSECONDS["day"]
    )
    return joined.drop("ts")


@query(f"""
SELECT event_id, CASE WHEN ts - o_at <= INTERVAL 36 HOUR THEN pedido END AS pedido FROM events e
ASOF LEFT JOIN {_ORDERS_SQL} o ON e.user_id = o.user_id AND e.ts >= o.o_at
""")
def recent_order_before(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").select("event_id", "user_id", "ts")
    joined = as_of_join(
        events,
        _moved_orders(spark, sf_dir),
        ["user_id"],
        "ts",
        "o_at",
        block=MICROSECONDS["day"],
        tolerance=36 * MICROSECONDS["hour"],
    )
    return joined.select("event_id", "pedido")


@query("""
SELECT s_suppkey, event_type, CAST(count(*) AS BIGINT) AS eventos
FROM events JOIN (
    SELECT s_suppkey, TIMESTAMP '2024-01-01' + INTERVAL 1 HOUR * (s_suppkey * 7 % 700) AS desde,
        TIMESTAMP '2024-01-01' + INTERVAL 1 HOUR * (s_suppkey * 7 % 700 + s_suppkey % 9) AS hasta
    FROM supplier
) ON ts >= desde AND ts < hasta
GROUP BY ALL
""")
def events_in_shifts(spark: SparkSession, sf_dir: str) -> DataFrame:
    first = F.lit("2024-01-01").cast("timestamp_ntz")
    hour = F.col("s_suppkey") * 7 % 700
    shifts = table(spark, sf_dir, "supplier").select(
        "s_suppkey",
        (first + F.make_dt_interval(hours=hour.cast("int"))).alias("desde"),
        (first + F.make_dt_interval(hours=(hour + F.col("s_suppkey") % 9).cast("int"))).alias("hasta"),
    )
    events = table(spark, sf_dir, "events").select("event_type", "ts")
    pairs = range_join(events, shifts, "ts", "desde", "hasta", block=4 * MICROSECONDS["hour"])
    return pairs.groupBy("s_suppkey", "event_type").agg(F.count(F.lit(1)).alias("eventos"))


def _daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A day's highest value per user; days without errors have no row, errors alone no value."""
    value = F.when(F.col("event_type") != "error", F.col("value"))
    events = table(spark, sf_dir, "events").withColumn("dia", F.col("ts").cast("date"))
    return events.groupBy("user_id", "dia").agg(F.max(value).alias("maximo"))


_DAILY_SQL = """
(SELECT user_id, CAST(ts AS DATE) AS dia, max(value) FILTER (event_type <> 'error') AS maximo
 FROM events GROUP BY ALL)
"""


@query(f"""
SELECT user_id, dia, maximo, CAST(round(CAST(CASE WHEN count(maximo) OVER semana >= 3
    THEN avg(maximo) OVER semana END AS DECIMAL(28, 8)), 3) AS DOUBLE) AS media_movil
FROM {_DAILY_SQL}
WINDOW semana AS (PARTITION BY user_id ORDER BY dia RANGE BETWEEN INTERVAL 6 DAYS PRECEDING AND CURRENT ROW)
""")
def weekly_moving_mean(spark: SparkSession, sf_dir: str) -> DataFrame:
    daily = _daily(spark, sf_dir)
    mean = moving_mean(daily, ["user_id"], "dia", "maximo", width=7, block=10, name="media_movil", least=3)
    return mean.withColumn("media_movil", round_half_up("media_movil", 3))


@query(f"""
SELECT user_id, dia, CAST(round(CAST(maximo - avg(maximo) OVER (PARTITION BY user_id, dayofweek(dia))
    AS DECIMAL(28, 8)), 3) AS DOUBLE) AS anomalia
FROM {_DAILY_SQL}
""")
def weekday_anomaly(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = anomaly(_daily(spark, sf_dir), ["user_id"], F.dayofweek("dia"), "maximo", "anomalia")
    return found.select("user_id", "dia", round_half_up("anomalia", 3).alias("anomalia"))
