from pyspark.sql import functions as F

from varve.operators import diff_runs, merge_history

COLUMNS = ["day", "id", "mm", "ingest"]


def frames(spark):
    a = spark.createDataFrame(
        [("d1", "A", 1.0, "r1"), ("d1", "A", 1.0, "r1"), ("d2", "A", None, "r1")],
        "day string, id string, mm double, processed string",
    )
    b = spark.createDataFrame(
        [("d1", "A", 1.0, "r1"), ("d2", "A", None, "r2")], "day string, id string, mm double, ingest string"
    )
    return [a, b]


RENAME = {"processed": "ingest"}


def test_repeats_must_agree_on_the_stamp_too(spark, rows):
    got = merge_history(frames(spark), COLUMNS, RENAME)
    assert rows(got) == [("d1", "A", 1.0, "r1"), ("d2", "A", None, "r1"), ("d2", "A", None, "r2")]


def test_merging_again_changes_nothing(spark, rows):
    once = merge_history(frames(spark), COLUMNS, RENAME)
    assert rows(merge_history([once, once], COLUMNS)) == rows(once)


def test_key_keeps_one_row_each(spark, rows):
    got = merge_history(frames(spark), COLUMNS, RENAME, key=["day", "id"])
    assert rows(got) == [("d1", "A", 1.0, "r1"), ("d2", "A", None, "r1")]


def test_rows_that_two_runs_hold_in_different_numbers(spark, rows):
    schema = "a string, b string, c int"
    before = [("x", None, 1), ("x", None, 1), ("ab", "c", 2), ("same", "same", 0), (None, "x", 1)]
    after = [("x", None, 1), ("a", "bc", 2), ("same", "same", 0), (None, "x", 1), (None, None, None), (None, None, None)]
    one, two = (spark.createDataFrame(r, schema).repartition(3) for r in (before, after))
    assert rows(diff_runs(one, two)) == sorted(
        [("a", "bc", 2, 0, 1), ("ab", "c", 2, 1, 0), ("x", None, 1, 2, 1), (None, None, None, 0, 2)],
        key=lambda r: [(v is not None, str(type(v)), repr(v)) for v in r],
    )
    assert diff_runs(one, one).collect() == [] and diff_runs(one.where("false"), two.where("false")).count() == 0
    assert rows(diff_runs(one, two, ["c"])) == [(None, 0, 2), (1, 3, 2)]


def test_few_bits_of_equal_rows_are_shuffled(spark):
    from tests.conftest import physical_plan

    df = spark.range(10).select("id", F.repeat(F.lit("x"), 1000).alias("wide"))
    plan = physical_plan(diff_runs(df, df))
    assert "partial_sum" in plan
