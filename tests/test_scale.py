"""Properties that must hold when one key holds a large share of all rows."""

import glob
import re

import pytest
from pyspark.sql import functions as F

from tests.conftest import physical_plan
from varve.operators import align, anomaly, as_of_join, merge_history, moving_mean, range_join
from varve.sinks import land_records
from varve.sources import extract_from_lines, mark_lines
from workload import REGISTRY

SF = "/root/testdata/sf0.001"


def _depth(line):
    return re.match(r"[\s:+|\-]*", line).end()


# These sort rows, but a key's rows in one block of time only; `_block` is that block.
BLOCKED = {"last_order_before", "recent_order_before", "weekly_moving_mean"}


@pytest.mark.parametrize("name", sorted(BLOCKED))
def test_windows_over_rows_are_cut_by_time(spark, name):
    """Every shuffle is by block too, or of rows that are one per key and block or fewer."""
    plan = physical_plan(REGISTRY[name].run(spark, SF)).splitlines()
    windows = [line for line in plan if re.search(r"\bWindow \[", line)]
    assert windows and "Exchange SinglePartition" not in "".join(plan)
    for i, line in enumerate(plan[:-1]):
        if "Exchange hashpartitioning" in line and "Reused" not in line:
            below = plan[i + 1]
            grouped = "partial_" in below or "functions=[]" in below
            summary = re.search(r"HashAggregate\(keys=\[.*_block|SortAggregate\(key=\[.*_block", below)
            assert "_block" in line or grouped or summary, line + below


@pytest.mark.parametrize("name", sorted(REGISTRY.keys() - BLOCKED))
def test_groups_are_reduced_before_they_are_shuffled(spark, name):
    """Every shuffle by key carries partial aggregates or distinct keys, or feeds a join itself."""
    plan = physical_plan(REGISTRY[name].run(spark, SF)).splitlines()
    assert not any(re.search(r"\bWindow\b", line) for line in plan)
    for i, line in enumerate(plan[:-1]):
        below = plan[i + 1]
        if "Exchange SinglePartition" in line:
            assert "partial_" in below or "LocalLimit" in below, below
        elif "Exchange hashpartitioning" in line and "Reused" not in line:
            above = [p for p in reversed(plan[:i]) if _depth(p) < _depth(line)]
            parents = [p for p in above if not re.search(r"\bSort\b|AQEShuffleRead|InputAdapter|WholeStage", p)]
            joined = bool(parents) and "Join" in parents[0]
            assert "partial_" in below or "functions=[]" in below or joined, below


@pytest.fixture
def small_partitions(spark):
    names = {
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64KB",
        "spark.sql.adaptive.coalescePartitions.minPartitionSize": "32KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "128KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    }
    for name, value in names.items():
        spark.conf.set(name, value)
    yield
    for name in names:
        spark.conf.unset(name)


def hot(n, rest):
    """A third of the ids on one value, the others spread."""
    return F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id") % rest + 1)


def test_a_hot_day_lands_in_several_files(spark, tmp_path, small_partitions):
    day = F.date_add(F.lit("2024-01-01").cast("date"), hot(0, 5).cast("int"))
    df = spark.range(0, 60_000, 1, 8).select(F.uuid().alias("x"), day.alias("day"))
    land_records(df, str(tmp_path / "l"), date_column="day")
    files = glob.glob(str(tmp_path / "l" / "ingest_date=2024-01-01" / "*.json"))
    assert len(files) > 4


def test_detail_with_a_hot_key_is_split(spark, small_partitions):
    # Payload wide enough for the hot partition to stand out.
    detail = spark.range(0, 60_000, 1, 8).select(
        hot(0, 400).alias("k"), F.repeat(F.uuid(), 4).alias("payload")
    )
    source = spark.range(0, 500).groupBy(F.col("id").alias("k")).agg(F.max("id").alias("m"))
    got = align([source], "k", detail=detail)
    assert got.agg(F.count("payload")).first()[0] == 60_000
    rows = got.where("payload IS NOT NULL")
    rows.collect()
    sizes = [r["count"] for r in rows.groupBy(F.spark_partition_id()).count().collect()]
    assert max(sizes) < 60_000 // 3


def test_copies_of_one_row_collapse_in_each_task(spark):
    df = spark.range(0, 30_000, 1, 8).select(hot(0, 5000).alias("k"), F.lit("x").alias("v"))
    merged = merge_history([df, df], ["k", "v"])
    assert merged.count() == df.distinct().count()
    keyed = merge_history([df, df], ["k", "v"], key=["k"])
    assert keyed.count() == merged.count()
    assert "partial_min" in physical_plan(keyed)


def test_a_hot_file_stays_spread(spark, small_partitions):
    ids = spark.range(0, 40_000, 1, 8)
    rows = ids.select(
        F.lit("hot").alias("file"),
        F.expr("id div 1000").alias("part"),
        (F.col("id") + 2).alias("pos"),
        F.concat(F.lit("2024,"), F.col("id"), F.lit(","), F.repeat(F.uuid(), 3)).alias("line"),
    )
    frame = spark.createDataFrame(
        [("hot", -1, 0, "title"), ("hot", -1, 1, "Year,id,text"), ("hot", -1, 50_000, "")],
        "file string, part bigint, pos bigint, line string",
    )
    table = extract_from_lines(mark_lines(rows.unionByName(frame)), ["Year", "id"])
    sizes = [r["count"] for r in table.groupBy(F.spark_partition_id()).count().collect()]
    assert sum(sizes) == 40_000 and max(sizes) <= 20_000


def largest_task(df):
    """The most rows of ``df`` that one task makes; all columns are made, none is pruned."""
    counts = [F.count(F.lit(1)).alias("n"), F.max(F.xxhash64(*df.columns)).alias("made")]
    return max(r["n"] for r in df.groupBy(F.spark_partition_id()).agg(*counts).collect())


def series(spark, n):
    """A third of the rows of key 0; wide rows, so that partitions stand out."""
    at = (F.col("id") * 7919 % 1000).alias("t")
    return spark.range(0, n, 1, 8).select(hot(0, 400).alias("k"), at, F.rand(3).alias("v"), F.repeat(F.uuid(), 4).alias("pad"))


def test_a_hot_key_is_cut_by_time(spark, small_partitions):
    spark.conf.set("spark.sql.shuffle.partitions", "32")
    try:
        left = series(spark, 60_000)
        right = series(spark, 30_000).select("k", F.col("t").alias("u"), F.col("v").alias("w"))
        joined = as_of_join(left, right, ["k"], "t", "u", block=20)
        assert joined.count() == 60_000 and largest_task(joined) < 60_000 // 8
        mean = moving_mean(left, ["k"], "t", "v", width=5, block=20)
        assert mean.count() == 60_000 and largest_task(mean) < 60_000 // 8
        pairs = range_join(left, right.select(F.col("u").alias("a"), (F.col("u") + 2).alias("b")).distinct(), "t", "a", "b", 4)
        assert largest_task(pairs) < pairs.count() // 4
        apart = anomaly(left, ["k"], F.col("t") % 2, "v")
        assert apart.count() == 60_000 and largest_task(apart) < 60_000 // 4
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
