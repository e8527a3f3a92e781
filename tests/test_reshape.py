import datetime as dt

from pyspark.sql import functions as F

from tests.conftest import physical_plan
from varve.operators import split_intervals, to_long

DAY = dt.timedelta(days=1)


def wide(spark):
    return spark.createDataFrame(
        [(1880, -0.18, None, 0.1), (1881, None, None, 0.2)], "anio int, ene double, feb double, mar double"
    )


def test_to_long_drops_nulls(spark, rows):
    long = to_long(wide(spark), ["anio"], {"Ene": "ene", "Feb": "feb", "Mar": "mar"}, "mes", "v")
    assert rows(long) == [(1880, "Ene", -0.18), (1880, "Mar", 0.1), (1881, "Mar", 0.2)]


def test_to_long_keeps_nulls_and_orders_labels(spark, rows):
    labels = {"Ene": "ene", "Feb": "feb", "Mar": "mar"}
    long = to_long(wide(spark), ["anio"], labels, "mes", "v", drop_nulls=False, order="n")
    assert long.count() == 6
    assert {(m, n) for _, m, _, n in rows(long)} == {("Ene", 1), ("Feb", 2), ("Mar", 3)}
    assert "Exchange" not in physical_plan(long)


def test_cells_and_rows_agree(spark):
    df = spark.range(500).select(
        F.col("id").alias("k"),
        *[F.when(F.col("id") % n != 0, F.col("id") * 1.0).alias(f"m{n}") for n in (2, 3, 5)],
    )
    cells = df.agg(F.count("m2") + F.count("m3") + F.count("m5")).first()[0]
    assert to_long(df, ["k"], {f"m{n}": f"m{n}" for n in (2, 3, 5)}, "m", "v").count() == cells


def pieces(spark, start, end, days=150):
    df = spark.createDataFrame([(start, end)], "s date, e date")
    out = split_intervals(df, "s", "e", days).orderBy("piece_start")
    return [(r["piece_start"], r["piece_end"]) for r in out.collect()]


def test_pieces_tile_the_interval(spark):
    start = dt.date(2024, 1, 1)
    for length in (0, 1, 149, 150, 151, 152, 302, 400):
        end = start + length * DAY
        got = pieces(spark, start, end)
        assert got[0][0] == start and got[-1][1] == end
        assert all(b - a <= 150 * DAY for a, b in got)
        assert all(after[0] - before[1] == DAY for before, after in zip(got, got[1:], strict=False))


def test_a_last_piece_of_one_day_is_kept(spark):
    start = dt.date(2024, 1, 1)
    assert pieces(spark, start, start + 151 * DAY)[-1] == (start + 151 * DAY, start + 151 * DAY)


def test_no_piece_without_a_proper_interval(spark):
    day = dt.date(2024, 1, 1)
    assert pieces(spark, day, day - DAY) == []
    assert pieces(spark, day, None) == []
