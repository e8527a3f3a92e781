import datetime as dt
import glob
import os

import pytest
from pyspark.sql import functions as F

from tests.test_tables import described, table_comment
from varve.sinks import merge_landing, publish_table, published_path, save_table


def test_a_published_table_changes_in_one_step(spark, rows):
    one = spark.createDataFrame([(1, "x"), (2, "y")], "id int, `a-b` string")
    assert publish_table(one, "step", "First", {"ID": "It's the id", "sol": "none"}) == ["sol"]
    assert rows(spark.table("step")) == [(1, "x"), (2, "y")]
    assert described(spark, "step")["id"] == "It's the id" and table_comment(spark, "step") == "First"
    first, begun = published_path(spark, "step"), spark.table("step")
    publish_table(spark.table("step").where("id = 1").withColumn("new", F.lit(7)), "step", "Second")
    assert rows(spark.table("step")) == [(1, "x", 7)] and table_comment(spark, "step") == "Second"
    assert rows(begun) == [(1, "x"), (2, "y")]  # a query that has begun keeps its version
    assert published_path(spark, "step") != first and os.path.isdir(first.removeprefix("file:"))


def test_a_write_that_fails_leaves_the_old_table(spark, rows):
    publish_table(spark.createDataFrame([(1,)], "id int"), "whole", "Old", {"id": "old id"})
    broken = spark.range(0, 1000, 1, 4).select(
        F.when(F.col("id") == 900, F.raise_error(F.lit("halfway")).cast("int")).otherwise(F.col("id").cast("int")).alias("id")
    )
    with pytest.raises(Exception, match="halfway"):
        publish_table(broken, "whole", "New", {"id": "new id"})
    assert rows(spark.table("whole")) == [(1,)]
    assert table_comment(spark, "whole") == "Old" and described(spark, "whole")["id"] == "old id"


def test_a_stored_table_is_not_published_over(spark):
    save_table(spark.range(1), "kept_as_it_is")
    with pytest.raises(ValueError, match="stored"):
        publish_table(spark.range(2), "kept_as_it_is")
    assert published_path(spark, "kept_as_it_is") is None and published_path(spark, "not_there") is None


SCHEMA = "station string, day date, value double, landed int, note string"


def landing(spark, landed, *rows):
    made = [(s, dt.date.fromisoformat(d) if d else None, v, landed, n) for s, d, v, n in rows]
    return spark.createDataFrame(made, SCHEMA)


def files(path):
    return {f: os.stat(f).st_mtime_ns for f in glob.glob(f"{path}/*/*.parquet")}


def test_three_landings_with_corrections(spark, tmp_path, rows):
    path = str(tmp_path / "history")
    merge = lambda df: merge_landing(df, path, ["station"], "day", "landed")
    one = landing(spark, 1, ("a", "2024-01-01", 1.0, "x"), ("b", "2024-01-01", 2.0, "x"), ("a", "2024-01-02", 3.0, "x"))
    two = landing(spark, 2, ("a", "2024-01-02", 4.0, "y"), ("a", "2024-01-03", 5.0, None), (None, "2024-01-03", 0.0, "n"))
    assert sorted(merge(one)) == [dt.date(2024, 1, 1), dt.date(2024, 1, 2)]
    before = files(path)
    assert sorted(merge(two)) == [dt.date(2024, 1, 2), dt.date(2024, 1, 3)]
    after = files(path)
    untouched = {f for f in before if "2024-01-01" in f}
    assert untouched and all(after.get(f) == before[f] for f in untouched)
    assert not any("2024-01-02" in f and f in after for f in before)
    # Late: day 2 was corrected since, day 1 is new; an equal landing has its greatest row.
    late = landing(spark, 1, ("a", "2024-01-02", 9.0, "late"), ("c", "2024-01-01", 6.0, "z"), ("c", "2024-01-01", 7.0, "z"))
    merge(late)
    wanted = [
        (None, dt.date(2024, 1, 3), 0.0, 2, "n"),
        ("a", dt.date(2024, 1, 1), 1.0, 1, "x"),
        ("a", dt.date(2024, 1, 2), 4.0, 2, "y"),
        ("a", dt.date(2024, 1, 3), 5.0, 2, None),
        ("b", dt.date(2024, 1, 1), 2.0, 1, "x"),
        ("c", dt.date(2024, 1, 1), 7.0, 1, "z"),
    ]
    columns = ["station", "day", "value", "landed", "note"]
    assert rows(spark.read.schema(SCHEMA).parquet(path).select(*columns)) == wanted
    merge(late)  # repeated
    assert rows(spark.read.schema(SCHEMA).parquet(path).select(*columns)) == wanted
    assert merge(one.where("false")) == []


def test_a_failed_merge_leaves_the_history(spark, tmp_path, rows):
    path = str(tmp_path / "history")
    merge_landing(landing(spark, 1, ("a", "2024-01-01", 1.0, "x"), ("b", None, 2.0, "x")), path, ["station"], "day", "landed")
    before = files(path)
    bad = landing(spark, 2, ("a", "2024-01-01", 3.0, "y")).withColumn(
        "note", F.when(F.col("value") > 2, F.raise_error(F.lit("broken")).cast("string")).otherwise(F.col("note"))
    )
    with pytest.raises(Exception, match="broken"):
        merge_landing(bad, path, ["station"], "day", "landed")
    assert files(path) == before
    assert merge_landing(landing(spark, 2, ("b", None, 5.0, "n")), path, ["station"], "day", "landed") == [None]
    read = spark.read.schema(SCHEMA).parquet(path)
    assert rows(read.select("station", "day", "value")) == [("a", dt.date(2024, 1, 1), 1.0), ("b", None, 5.0)]
