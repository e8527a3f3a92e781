from pyspark.sql import functions as F

from tests.conftest import physical_plan
from varve.operators import quality_report


def test_report_counts_each_kind_of_missing(spark):
    nan = float("nan")
    df = spark.createDataFrame(
        [(1, 14.5, True), (2, nan, None), (2, None, False), (3, 15.5, None)], "id int, x double, flag boolean"
    )
    got = quality_report(
        df,
        nulls=["x", "flag"],
        nans=["x"],
        extents=["id"],
        distinct=["id"],
        where={"flagged": F.col("flag")},
        means={"mean_real": (~F.isnan("x"), "x"), "mean_id": "id"},
    )
    assert got.first().asDict() == {
        "total_rows": 4, "nulls_x": 1, "nulls_flag": 2, "nans_x": 1, "min_id": 1, "max_id": 3,
        "distinct_id": 3, "flagged": 1, "mean_real": 15.0, "mean_id": 2.0,
    }
    assert physical_plan(got).count("Scan ExistingRDD") == 1


def test_nulls_and_values_add_up(spark):
    df = spark.range(1000).select(F.when(F.col("id") % 3 == 0, F.col("id")).alias("x"))
    got = quality_report(df, nulls=["x"], where={"present": F.col("x").isNotNull()}).first()
    assert got["nulls_x"] + got["present"] == got["total_rows"] == 1000
