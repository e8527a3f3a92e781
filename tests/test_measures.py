import math

import pytest

from pyspark.sql import functions as F

from varve.functions import (
    count_where,
    mean_where,
    nan_count,
    null_count,
    round_half_up,
    safe_ratio,
)

NAN = float("nan")


def one(df, *columns):
    return tuple(df.agg(*columns).first())


def test_null_nan_and_conditional_counts(spark):
    df = spark.createDataFrame([(1.0, True), (None, None), (NAN, False), (4.0, True)], "x double, p boolean")
    got = one(df, null_count("x"), nan_count("x"), count_where(F.col("p")), mean_where(F.col("p"), "x"))
    assert got == (1, 1, 2, 2.5)


def test_conditional_count_of_nothing_is_null(spark):
    df = spark.createDataFrame([], "p boolean")
    assert one(df, count_where(F.col("p")), F.count_if("p")) == (None, 0)


def test_nan_poisons_a_mean(spark):
    df = spark.createDataFrame([(1.0,), (NAN,)], "x double")
    assert all(math.isnan(v) for v in one(df, F.avg("x"), F.max("x"), F.sum("x")))


def test_rounding_is_half_up_and_free_of_summation_noise(spark):
    noisy = 123.44999999999999
    values = [1.005, 2.5, -1.005, noisy, None]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, x double")
    got = [tuple(r) for r in df.orderBy("i").select(round_half_up("x", 2), round_half_up("x", 1)).collect()]
    assert got == [(1.01, 1.0), (2.5, 2.5), (-1.01, -1.0), (123.45, 123.5), (None, None)]


def test_rounding_keeps_nan_infinity_and_magnitude(spark):
    df = spark.createDataFrame([(0, NAN), (1, float("inf")), (2, 3e22)], "i int, x double")
    nan, inf, huge = [r[0] for r in df.orderBy("i").select(round_half_up("x", 2)).collect()]
    assert math.isnan(nan) and math.isinf(inf) and huge == 3e22


def test_ratio_by_zero_is_null(spark):
    df = spark.createDataFrame([(0, 10.0, 4.0), (1, 1.0, 0.0), (2, None, 1.0)], "i int, a double, b double")
    assert [r[0] for r in df.orderBy("i").select(safe_ratio("a", "b", 1)).collect()] == [2.5, None, None]


def test_many_digits(spark):
    df = spark.createDataFrame([(0.12345678912, 1.0, 1e10)], "x double, a double, b double")
    got = df.select(round_half_up("x", 10), safe_ratio("a", "b", 12)).first()
    assert tuple(got) == (0.1234567891, 1e-10)
    with pytest.raises(ValueError):
        round_half_up("x", 13)
