import datetime as dt
import glob

import pytest
from pyspark.sql import functions as F

from varve.sinks import land_records
from varve.streaming import stream_landings

SCHEMA = "id INT, at TIMESTAMP, v STRING"


def records(spark, *rows):
    start = dt.datetime(2024, 1, 1)
    made = [(i, None if h is None else start + dt.timedelta(hours=h), v) for i, h, v in rows]
    return spark.createDataFrame(made, "id int, at timestamp, v string").coalesce(1)


def stream(spark, root):
    return stream_landings(spark, f"{root}/in", SCHEMA, ["id"], "at", "2 days", f"{root}/out", f"{root}/checkpoint")


def read(spark, root):
    return sorted((r["id"], r["v"]) for r in spark.read.parquet(f"{root}/out").collect())


def test_landings_arrive_once(spark, tmp_path):
    root = str(tmp_path)
    with pytest.raises(Exception, match="(?i)no \\*|not exist|path"):
        stream(spark, root)
    land_records(records(spark, (1, 0, "a"), (2, 1, "b"), (1, 2, "again"), (3, None, "no time")), f"{root}/in", "2024-01-01")
    assert stream(spark, root) == 4
    first = read(spark, root)
    assert [i for i, _ in first] == [1, 2] and first[1] == (2, "b")
    assert stream(spark, root) == 0 and read(spark, root) == first  # nothing new
    # A repeat within the delay, a new record, and one older than the delay behind the latest.
    land_records(records(spark, (2, 1, "repeat"), (4, 100, "c")), f"{root}/in", "2024-01-05")
    assert stream(spark, root) == 2
    land_records(records(spark, (5, 3, "late"), (6, 99, "d")), f"{root}/in", "2024-01-06")
    assert stream(spark, root) == 2
    assert [r for r in read(spark, root) if r not in first] == [(4, "c"), (6, "d")]
    assert {p.rsplit("=", 1)[1] for p in glob.glob(f"{root}/out/day=*")} == {"2024-01-01", "2024-01-05"}


def test_a_stream_agrees_with_the_batch(spark, tmp_path):
    root = str(tmp_path)
    days = [spark.range(k * 50, k * 50 + 80).select(F.col("id").cast("int"), (F.lit(1704067200) + F.col("id") * 60).cast("timestamp").alias("at"), F.lit("x").alias("v")) for k in range(3)]
    for k, day in enumerate(days):
        land_records(day, f"{root}/in", f"2024-01-0{k + 1}")
        stream(spark, root)
    batch = spark.read.schema(SCHEMA).option("recursiveFileLookup", True).json(f"{root}/in").dropDuplicates(["id"])
    assert read(spark, root) == sorted((r["id"], r["v"]) for r in batch.collect())
    assert len(read(spark, root)) == 180
