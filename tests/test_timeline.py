import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from varve.operators import MICROSECONDS, anomaly, as_of_join, moving_mean, range_join


def latest(given, key, at):
    rows = [(t, v) for k, t, v in given if k is not None and k == key and t is not None and at is not None and t <= at]
    return max(rows, default=None)


@pytest.mark.parametrize("block", [1, 7, 1000])
def test_as_of_agrees_with_a_search(spark, block):
    rng = random.Random(block)
    keys = [None, "a", "b", "c", "a"]
    asked = [(i, rng.choice(keys), rng.choice([None, *range(-20, 60)])) for i in range(300)]
    given = [(rng.choice(keys), rng.choice([None, *range(0, 50)]), rng.randint(0, 9)) for _ in range(60)]
    left = spark.createDataFrame(asked, "id int, k string, t int")
    right = spark.createDataFrame(given, "k string, u int, v int")
    got = as_of_join(left, right, ["k"], "t", "u", block)
    assert got.columns == ["id", "k", "t", "u", "v"]
    wanted = {i: (latest(given, k, t) or (None, None)) for i, k, t in asked}
    assert {r["id"]: (r["u"], r["v"]) for r in got.collect()} == wanted and got.count() == 300
    near = as_of_join(left, right, ["k"], "t", "u", block, tolerance=3)
    for r in near.collect():
        u, v = wanted[r["id"]]
        assert (r["u"], r["v"]) == ((u, v) if u is not None and r["t"] - u <= 3 else (None, None))


def test_as_of_times_and_clashes(spark):
    at = dt.datetime(2024, 1, 1, 12)
    left = spark.createDataFrame([("a", at), ("a", at - dt.timedelta(days=40))], "k string, ts timestamp_ntz")
    right = spark.createDataFrame([("a", at, 1), ("a", at - dt.timedelta(days=30), 2)], "k string, at timestamp_ntz, v int")
    got = as_of_join(left, right, ["k"], "ts", "at", MICROSECONDS["day"])
    assert sorted((r["ts"], r["v"]) for r in got.collect()) == [(at - dt.timedelta(days=40), None), (at, 1)]
    with pytest.raises(ValueError, match="both sides"):
        as_of_join(left, right.withColumnRenamed("v", "ts"), ["k"], "ts", "at", 1)
    empty = as_of_join(left, right.where("false"), ["k"], "ts", "at", MICROSECONDS["day"])
    assert [r["v"] for r in empty.collect()] == [None, None]
    assert as_of_join(left.where("false"), right, ["k"], "ts", "at", MICROSECONDS["day"]).count() == 0


def test_range_join_agrees_with_a_search(spark):
    rng = random.Random(3)
    points = [(i, rng.choice("ab"), rng.choice([None, *range(-10, 40)])) for i in range(200)]
    spans = [(j, rng.choice("ab"), rng.randint(-12, 40), rng.choice([None, *range(-12, 45)])) for j in range(40)]
    p = spark.createDataFrame(points, "i int, k string, t int")
    s = spark.createDataFrame(spans, "j int, k string, x int, y int")
    for on in ([], ["k"]):
        other = s if on else s.drop("k")
        got = sorted((r["i"], r["j"]) for r in range_join(p, other, "t", "x", "y", 5, on).collect())
        assert got == sorted(
            (i, j) for i, k, t in points for j, q, x, y in spans
            if t is not None and y is not None and x <= t < y and (not on or k == q)
        )


@pytest.mark.parametrize("block", [7, 8, 100])
def test_moving_mean_agrees_with_a_search(spark, block):
    rng = random.Random(block)
    rows = [(i, rng.choice(["a", "b", None]), rng.choice([None, *range(0, 60)]), rng.choice([None, 1.0, 2.0, 4.0])) for i in range(200)]
    df = spark.createDataFrame(rows, "id int, k string, t int, v double")
    got = moving_mean(df, ["k"], "t", "v", 7, block, least=2)
    assert got.columns == [*df.columns, "moving_mean"]
    found = {r["id"]: r["moving_mean"] for r in got.collect()}
    assert len(found) == 200
    for i, k, t, _ in rows:
        seen = [v for _, q, u, v in rows if q == k and t is not None and u is not None and t - 7 < u <= t and v is not None]
        assert found[i] == (pytest.approx(sum(seen) / len(seen)) if len(seen) >= 2 else None)
    with pytest.raises(ValueError):
        moving_mean(df, ["k"], "t", "v", 9, 8)


def test_anomaly(spark, rows):
    df = spark.createDataFrame([("a", 1, 2.0), ("a", 1, 4.0), ("a", 2, 9.0), ("a", 1, None), (None, 1, 3.0)], "k string, m int, v double")
    assert rows(anomaly(df, ["k"], F.col("m"), "v").select("k", "v", "anomaly")) == [
        (None, 3.0, None), ("a", None, None), ("a", 2.0, -1.0), ("a", 4.0, 1.0), ("a", 9.0, 0.0)
    ]
