"""Embedded tables, wide to long, intervals to pieces."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from varve.functions import day_bound, mean_where, round_half_up
from varve.operators import split_intervals, to_long
from varve.sources import (
    extract_from_lines,
    extract_from_texts,
    file_report,
    file_report_from_lines,
    mark_lines,
)
from workload.registry import query, table

_FIELDS = ["Year", "event_id", "kind", "value", "props"]


def _user_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of one file per user: a title, a header, the user's events, then a second table.

    The place of a line is (section, event), a value of the row itself. A part of a file is a
    range of event numbers, so it holds a limited number of lines however busy the user is.
    """
    events = table(spark, sf_dir, "events")
    user = F.col("user_id").cast("string").alias("file")
    value = F.when(F.col("event_type") == "error", "***").otherwise(F.col("value").cast("string"))
    props = F.concat(F.lit('"'), F.replace("props", F.lit('"'), F.lit('""')), F.lit('"'))
    record = F.concat_ws(",", F.year("ts"), "event_id", "event_type", value, props)
    rows = events.select(
        user,
        F.expr("event_id div 100000").alias("part"),
        F.struct(F.lit(2).alias("section"), F.col("event_id").alias("event")).alias("pos"),
        record.alias("line"),
    )
    frame = [
        (0, "Events of one user"),
        (1, ",".join(_FIELDS)),
        (3, ""),
        (4, "Year,event_id"),
        (5, "1999,9"),
    ]
    sections = F.array(
        *[F.struct(F.lit(s).alias("section"), F.lit(t).alias("line")) for s, t in frame]
    )
    framing = (
        events.select(user)
        .distinct()
        .select("file", F.explode(sections).alias("frame"))
        .select(
            "file",
            F.lit(-1).cast("bigint").alias("part"),
            F.struct("frame.section", F.lit(0).cast("bigint").alias("event")).alias("pos"),
            "frame.line",
        )
    )
    return mark_lines(rows.unionByName(framing))


@query("""
SELECT CAST(user_id AS VARCHAR) AS file, CAST(year(ts) AS VARCHAR) AS "Year",
       CAST(event_id AS VARCHAR) AS event_id, event_type AS kind,
       CASE WHEN event_type <> 'error' THEN CAST(value AS VARCHAR) END AS value, props
FROM events
""")
def embedded_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_from_lines(_user_files(spark, sf_dir), _FIELDS)


@query("""
SELECT CAST(user_id AS VARCHAR) AS file, true AS has_header, CAST(count(*) AS BIGINT) AS table_rows
FROM events GROUP BY user_id
""")
def embedded_table_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return file_report_from_lines(_user_files(spark, sf_dir))


def _event_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The text of one small file per event: two rows of its table, then another table.

    Type signup lacks the first header, so the other table is found instead; type view ends its
    lines the other way; type error names its columns in another order.
    """
    kind = F.col("event_type")
    quoted = F.concat(F.lit('"'), F.replace("props", F.lit('"'), F.lit('""')), F.lit('"'))
    value = F.col("value").cast("string")
    header = (
        F.when(kind == "signup", "no header here")
        .when(kind == "error", " Year,props,value")
        .otherwise("Year,value,props")
    )

    def record(first: Column) -> Column:
        return F.when(kind == "error", F.concat_ws(",", first, quoted, value)).otherwise(
            F.concat_ws(",", first, value, quoted)
        )

    year = F.year("ts").cast("string")
    lines = F.array(
        F.lit("One event"), header, record(year), record(F.lit("1900")), F.lit(""),
        F.lit("Year,value"), F.lit("1999,9"),
    )
    ending = F.when(kind == "view", "\r\n").otherwise("\n")
    text = F.array_join(F.transform(lines, lambda x: F.concat(x, ending)), "")
    return table(spark, sf_dir, "events").select(
        F.col("event_id").cast("string").alias("file"), text.alias("text")
    )


_TEXT_ROWS_SQL = """
SELECT CAST(event_id AS VARCHAR) AS file, "Year", CAST(value AS VARCHAR) AS value, props
FROM events, (SELECT unnest([0, 1]) AS place),
     LATERAL (SELECT CASE place WHEN 0 THEN CAST(year(ts) AS VARCHAR) ELSE '1900' END AS "Year")
WHERE event_type <> 'signup'
UNION ALL
SELECT CAST(event_id AS VARCHAR), '1999', '9', NULL FROM events WHERE event_type = 'signup'
"""


@query(_TEXT_ROWS_SQL)
def embedded_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_from_texts(_event_texts(spark, sf_dir), ["Year", "value", "props"])


@query("""
SELECT CAST(event_id AS VARCHAR) AS file, true AS has_header,
       CAST(CASE WHEN event_type = 'signup' THEN 1 ELSE 2 END AS BIGINT) AS table_rows
FROM events
""")
def embedded_texts_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return file_report(_event_texts(spark, sf_dir))


@query("""
WITH wide AS (
  SELECT CAST(year(l_shipdate) AS INTEGER) AS anio, l_returnflag,
         sum(l_quantity) AS cantidad, max(l_extendedprice) AS precio,
         round(CAST(avg(l_discount) AS DECIMAL(28,8)), 4) AS descuento,
         round(CAST(avg(CASE WHEN l_returnflag = 'R' THEN l_tax END) AS DECIMAL(28,8)), 4) AS impuesto
  FROM lineitem GROUP BY ALL)
SELECT anio, l_returnflag, medida, CAST(valor AS DOUBLE) AS valor, CAST(orden AS INTEGER) AS orden
FROM (SELECT anio, l_returnflag, 'Cantidad' AS medida, CAST(cantidad AS DOUBLE) AS valor, 1 AS orden FROM wide
      UNION ALL SELECT anio, l_returnflag, 'Precio', CAST(precio AS DOUBLE), 2 FROM wide
      UNION ALL SELECT anio, l_returnflag, 'Descuento', CAST(descuento AS DOUBLE), 3 FROM wide
      UNION ALL SELECT anio, l_returnflag, 'Impuesto', CAST(impuesto AS DOUBLE), 4 FROM wide)
WHERE valor IS NOT NULL
""")
def unpivot_measures(spark: SparkSession, sf_dir: str) -> DataFrame:
    returned = F.col("l_returnflag") == "R"
    wide = (
        table(spark, sf_dir, "lineitem")
        .groupBy(F.year("l_shipdate").alias("anio"), "l_returnflag")
        .agg(
            F.sum("l_quantity").alias("cantidad"),
            F.max("l_extendedprice").alias("precio"),
            round_half_up(F.avg("l_discount"), 4).alias("descuento"),
            round_half_up(mean_where(returned, "l_tax"), 4).alias("impuesto"),
        )
    )
    measures = {
        "Cantidad": "cantidad",
        "Precio": "precio",
        "Descuento": "descuento",
        "Impuesto": "impuesto",
    }
    return to_long(wide, ["anio", "l_returnflag"], measures, "medida", "valor", order="orden")


@query("""
WITH spans AS (
  SELECT o_custkey, CAST(min(o_orderdate) AS DATE) AS first_day, CAST(max(o_orderdate) AS DATE) AS last_day
  FROM orders GROUP BY o_custkey),
pieces AS (
  SELECT o_custkey, first_day, last_day,
         unnest(generate_series(0, date_diff('day', first_day, last_day), 151)) AS step
  FROM spans)
SELECT o_custkey, first_day, last_day,
       strftime(first_day + CAST(step AS INTEGER), '%Y-%m-%d') || 'T00:00:00UTC' AS piece_start,
       strftime(least(first_day + CAST(step AS INTEGER) + 150, last_day), '%Y-%m-%d')
         || 'T23:59:59UTC' AS piece_end
FROM pieces
""")
def interval_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    spans = (
        table(spark, sf_dir, "orders")
        .groupBy("o_custkey")
        .agg(
            F.min("o_orderdate").cast("date").alias("first_day"),
            F.max("o_orderdate").cast("date").alias("last_day"),
        )
    )
    return split_intervals(spans, "first_day", "last_day").withColumns(
        {"piece_start": day_bound("piece_start"), "piece_end": day_bound("piece_end", True)}
    )
