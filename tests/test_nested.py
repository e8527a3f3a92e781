import pytest
from pyspark.sql import functions as F

from tests.conftest import physical_plan
from varve.operators import explode_elements, read_paths, read_sketches, sketch_by, unite_sketches

RECORDS = [
    (1, '{"a": {"b": 7}, "items": [{"x": 1, "y": "p"}, {"y": 2}, null, 5]}'),
    (2, '{"a": {"b": "text"}, "items": []}'),
    (3, '{"items": {"x": 1}}'),
    (4, "{cut"),
    (5, None),
    (6, ""),
    (1, '{"a": {"b": 7}, "items": [{"x": 1, "y": "p"}, {"y": 2}, null, 5]}'),
]


def test_typed_paths(spark, rows):
    df = spark.createDataFrame(RECORDS, "id int, text string")
    got = read_paths(df, "text", {"b": ("$.a.b", "int"), "y": ("$.items[1].y", "string")}, "broken").drop("text")
    assert rows(got) == sorted(
        [(1, 7, "2", False)] * 2
        + [(2, None, None, False), (3, None, None, False), (4, None, None, True), (5, None, None, False), (6, None, None, True)]
    )
    assert read_paths(df.where("false"), "text", {"b": ("$.a.b", "int")}).count() == 0


def test_elements_keep_their_place_and_records_without_stay(spark, rows):
    df = spark.createDataFrame(RECORDS, "id int, text string")
    paths = {"x": ("$.x", "int"), "y": ("$.y", "string")}
    got = explode_elements(df, "text", "$.items", paths, corrupt="broken").drop("text")
    elements = [(1, 0, 1, "p", False), (1, 1, None, "2", False), (1, 2, None, None, False), (1, 3, None, None, False)]
    without = [(i, None, None, None, i in (4, 6)) for i in range(2, 7)]
    assert rows(got) == sorted(elements * 2) + without
    assert "Exchange" not in physical_plan(got)


def test_united_sketches_count_a_value_of_two_days_once(spark):
    df = spark.range(40_000).select(
        (F.col("id") % 4).alias("day"),
        F.when(F.col("id") % 3 > 0, "hot").otherwise("cold").alias("k"),
        (F.col("id") % 5000).alias("user"),
        F.when(F.col("id") % 7 == 0, F.lit(float("nan"))).when(F.col("id") % 11 > 0, F.col("id") / 40_000).alias("v"),
        F.lit("x").alias("rows_"),
    )
    days = sketch_by(df, ["k", "day"], ["user", "v"], ["v"])
    total = read_sketches(unite_sketches(days, []), {"low": 0.1, "mid": 0.5}).first()
    assert total["rows"] == 40_000
    assert total["user_distinct"] == pytest.approx(5000, rel=0.05)
    assert total["v_low"] == pytest.approx(0.1, abs=0.02) and total["v_mid"] == pytest.approx(0.5, abs=0.02)
    by_key = {r["k"]: r for r in read_sketches(unite_sketches(days, ["k"]), {"mid": 0.5}).collect()}
    exact = {r["k"]: r["n"] for r in df.groupBy("k").agg(F.count_distinct("user").alias("n")).collect()}
    assert all(by_key[k]["user_distinct"] == pytest.approx(n, rel=0.05) for k, n in exact.items())


def test_sketches_of_nothing(spark):
    df = spark.createDataFrame([("a", None, None), ("a", None, float("nan")), ("b", "1", 2.0)], "k string, u string, v double")
    got = {r["k"]: tuple(r)[1:] for r in read_sketches(sketch_by(df, ["k"], ["u"], ["v"]), {"p": 0.5}).collect()}
    assert got == {"a": (2, 0, None), "b": (1, 1, 2.0)}
    empty = sketch_by(df.where("false"), [], ["u"], ["v"])
    assert tuple(read_sketches(empty, {"p": 0.5}).first()) == (0, 0, None)
    assert sketch_by(df.where("false"), ["k"], ["u"], ["v"]).count() == 0


def test_hot_key_is_sketched_before_the_shuffle(spark):
    plan = physical_plan(sketch_by(spark.range(100).withColumn("k", F.lit(1)), ["k"], ["id"], ["id"]))
    assert plan.count("Aggregate(") == 2 and "partial_hll" in plan
