"""Stored sketches and nested records."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from varve.operators import explode_elements, read_paths, read_sketches, sketch_by, unite_sketches
from varve.session import scratch_path
from workload.registry import query, table


@query("""
SELECT event_type, CAST(count(*) AS BIGINT) AS registros, TRUE AS usuarios_cerca, TRUE AS mediana_cerca,
       TRUE AS decil_cerca
FROM events WHERE CAST(ts AS DATE) >= DATE '2024-01-05' GROUP BY event_type
""")
def sketched_span(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Users and quantiles of a span of days from the days' stored sketches, held against the exact
    ones: users within 5 %, ranks within 2 %."""
    path = scratch_path(spark, "sketches")
    events = table(spark, sf_dir, "events").withColumn("dia", F.to_date("ts"))
    sketch_by(events, ["event_type", "dia"], ["user_id"], ["value"], "registros").write.parquet(path)
    span = spark.read.parquet(path).where("dia >= DATE'2024-01-05'")
    united = unite_sketches(span, ["event_type"], "registros")
    estimates = read_sketches(united, {"p50": 0.5, "p90": 0.9})
    rows = events.where("dia >= DATE'2024-01-05'").select("event_type", "user_id", "value")
    users = rows.groupBy("event_type").agg(F.count_distinct("user_id").alias("usuarios"))
    ranks = rows.join(estimates, "event_type").groupBy("event_type").agg(
        *[
            F.avg((F.col("value") < F.col(f"value_{p}")).cast("int")).alias(f"bajo_{p}")
            for p in ("p50", "p90")
        ],
        *[
            F.avg((F.col("value") <= F.col(f"value_{p}")).cast("int")).alias(f"hasta_{p}")
            for p in ("p50", "p90")
        ],
    )

    def near(p: str, rank: float):
        return (F.col(f"bajo_{p}") <= rank + 0.02) & (F.col(f"hasta_{p}") >= rank - 0.02)

    return (
        estimates.join(users, "event_type")
        .join(ranks, "event_type")
        .select(
            "event_type",
            "registros",
            (F.abs(F.col("user_id_distinct") - F.col("usuarios")) <= 0.05 * F.col("usuarios")).alias("usuarios_cerca"),
            near("p50", 0.5).alias("mediana_cerca"),
            near("p90", 0.9).alias("decil_cerca"),
        )
    )


@query("""
SELECT event_id, CAST(i AS INTEGER) AS posicion, k + i AS k, CASE WHEN i % 2 = 0 THEN event_type END AS tipo, roto
FROM (
    SELECT event_id, event_type, CAST(regexp_extract(props, '"k": ([0-9]+)', 1) AS BIGINT) AS k, event_id % 11 = 0 AS roto,
           unnest(CASE WHEN event_id % 11 = 0 OR event_id % 5 = 0 OR event_id % 4 = 0 THEN [NULL]
                       ELSE range(event_id % 4) END) AS i
    FROM events
)
""")
def nested_elements(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records with no, one or several elements, without the array, and cut off in the middle."""
    k = F.get_json_object("props", "$.k").cast("long")
    elements = F.transform(
        F.sequence(F.lit(1), F.col("event_id") % 4),
        lambda i: F.struct((k + i - 1).alias("k"), F.when(i % 2 == 1, F.col("event_type")).alias("tipo")),
    )
    held = F.when(F.col("event_id") % 5 != 0, F.when(F.col("event_id") % 4 > 0, elements).otherwise(F.array().cast("array<struct<k:bigint,tipo:string>>")))
    text = F.to_json(F.struct("event_id", F.struct(held.alias("partes")).alias("dato")))
    text = F.when(F.col("event_id") % 11 == 0, F.substring(text, 1, 12)).otherwise(text)
    records = table(spark, sf_dir, "events").select("event_id", text.alias("registro"))
    paths = {"k": ("$.k", "bigint"), "tipo": ("$.tipo", "string")}
    return explode_elements(records, "registro", "$.dato.partes", paths, "posicion", "roto").drop("registro")


@query("""
SELECT event_id, CAST(regexp_extract(props, '"k": ([0-9]+)', 1) AS BIGINT) AS k, CAST(NULL AS BIGINT) AS otro
FROM events
""")
def nested_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").select("event_id", "props")
    return read_paths(events, "props", {"k": ("$.k", "bigint"), "otro": ("$.o.tro", "bigint")}).drop("props")
