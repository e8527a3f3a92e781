from functools import reduce

import pytest
from pyspark.sql import functions as F

from tests.conftest import physical_plan
from varve.operators import align


def frame(spark, name, pairs):
    return spark.createDataFrame(pairs, f"anio int, {name} double")


def full_outer_chain(frames):
    def link(left, right):
        right = right.withColumnRenamed("anio", "other")
        joined = left.join(right, F.col("anio") == F.col("other"), "full_outer")
        return joined.withColumn("anio", F.coalesce("anio", "other")).drop("other")

    return reduce(link, frames)


def test_gaps_on_every_side(spark, rows):
    a = frame(spark, "a", [(2000, 1.0), (2001, 2.0)])
    b = frame(spark, "b", [(2001, 20.0)])
    c = frame(spark, "c", [(2001, 200.0), (2005, 300.0)])
    assert rows(align([a, b, c], "anio")) == [
        (2000, 1.0, None, None),
        (2001, 2.0, 20.0, 200.0),
        (2005, None, None, 300.0),
    ]


def test_null_keys_never_match(spark, rows):
    a = frame(spark, "a", [(None, 1.0), (2001, 2.0)])
    b = frame(spark, "b", [(None, 9.0), (2001, 3.0)])
    got = rows(align([a, b], "anio"))
    assert got == rows(full_outer_chain([a, b]))
    assert len([r for r in got if r[0] is None]) == 2


def test_agrees_with_a_chain_of_joins(spark, rows):
    ids = spark.range(400)
    frames = [
        ids.where(F.col("id") % n != 0).select(
            F.when(F.col("id") > n, F.col("id")).cast("int").alias("anio"),
            (F.col("id") * n).cast("double").alias(f"v{n}"),
        ).groupBy("anio").agg(F.max(f"v{n}").alias(f"v{n}"))
        for n in (2, 3, 5, 7)
    ]
    assert rows(align(frames, "anio")) == rows(full_outer_chain(frames))


def test_detail_may_repeat_keys(spark, rows):
    detail = frame(spark, "d", [(2000, 1.0), (2000, 2.0), (None, 3.0), (1999, 4.0)])
    a = frame(spark, "a", [(2000, 10.0), (2002, 11.0), (None, 12.0)])
    b = frame(spark, "b", [(2000, 20.0)])
    got = align([a, b], "anio", detail=detail)
    assert got.columns == ["anio", "d", "a", "b"]
    assert rows(got) == rows(full_outer_chain([detail, a, b]))


def test_a_repeated_key_fails(spark):
    a = frame(spark, "a", [(2000, 1.0), (2000, 2.0)])
    b = frame(spark, "b", [(2000, 1.0)])
    with pytest.raises(Exception, match="a source repeats a value of anio"):
        align([a, b], "anio").collect()


def test_sources_meet_without_a_join(spark):
    ids = spark.range(100)
    frames = [ids.groupBy((F.col("id") % 7).alias("k")).agg(F.max("id").alias(n)) for n in "abc"]
    assert "Join" not in physical_plan(align(frames, "k"))


def test_more_sources_than_a_number_has_bits(spark):
    frames = [spark.createDataFrame([(1, i), (i, i)] if i != 1 else [(1, i)], f"k int, v{i} int") for i in range(70)]
    got = {r["k"]: r for r in align(frames, "k").collect()}
    assert len(got) == 70 and all(got[1][f"v{i}"] == i for i in range(70)) and got[69]["v69"] == 69
    frames[65] = frames[65].unionByName(frames[65])
    with pytest.raises(Exception, match="repeats a value"):
        align(frames, "k").collect()
