import datetime as dt
import math

from pyspark.sql import functions as F

from tests.conftest import physical_plan
from varve.operators import drop_out_of_domain, drop_units_row, project, sample_rows, stamp, top_k


def test_project_prunes_and_renames(spark):
    df = spark.createDataFrame([("1", "x", "y")], "A string, B string, C string")
    out = project(df, {"a": F.col("A").cast("int"), "b": "B"})
    assert out.columns == ["a", "b"] and tuple(out.first()) == (1, "x")


def test_units_row_goes_and_null_goes_with_it(spark, rows):
    df = spark.createDataFrame([("S0", "Year"), ("S1", "2020"), ("S4", None)], "sid string, season string")
    assert rows(drop_units_row(df, "season", "Year")) == [("S1", "2020")]


def test_out_of_domain_on_text_and_doubles(spark, rows):
    text = spark.createDataFrame([("14.5",), ("NaN",), (None,)], "sst string")
    assert rows(drop_out_of_domain(text, "sst")) == [("14.5",)]
    number = spark.createDataFrame([(14.5,), (math.nan,), (None,)], "sst double")
    assert rows(drop_out_of_domain(number, "sst")) == [(14.5,)]


def test_stamp_is_repeatable(spark):
    df = spark.range(1)
    assert stamp(df, run_date="2024-11-05").first()["ingest_date"] == dt.date(2024, 11, 5)
    assert stamp(df, run_date=dt.date(2024, 11, 5)).first()["ingest_date"] == dt.date(2024, 11, 5)
    assert stamp(df, "day").schema["day"].dataType.simpleString() == "date"


def test_top_k_puts_nulls_last_and_breaks_ties(spark):
    df = spark.createDataFrame([(1, 5.0), (2, None), (3, 9.0), (0, 5.0)], "id int, x double")
    out = top_k(df, "x", 3, ties=["id"])
    assert [r["id"] for r in out.collect()] == [3, 0, 1]
    assert "TakeOrderedAndProject" in physical_plan(out)


def test_sample(spark):
    assert sample_rows(spark.range(100), 7).count() == 7
    assert sample_rows(spark.range(3), 7).count() == 3
