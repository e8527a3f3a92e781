from pyspark.sql import functions as F

from tests.conftest import physical_plan
from varve.operators import distinct_entities, entity_rollup, entity_totals

TRACKS = [
    ("S1", 2020, "NA", 2),
    ("S1", 2020, "NA", 4),
    ("S2", 2020, "EP", -1),
    ("S2", 2020, "WP", 4),
    ("S3", 2020, "XX", None),
]


def tracks(spark):
    return spark.createDataFrame(TRACKS, "id string, season int, basin string, cat int")


def test_regional_counts_exceed_global_for_an_entity_that_crosses(spark, rows):
    regional = entity_rollup(tracks(spark), ["id", "season", "basin"], ["season", "basin"], "cat", 3)
    assert rows(regional) == [
        (2020, "EP", 1, 0), (2020, "NA", 1, 1), (2020, "WP", 1, 1), (2020, "XX", 1, 0),
    ]
    overall = entity_rollup(tracks(spark), ["id", "season"], ["season"], "cat", 3)
    assert rows(overall) == [(2020, 3, 2)]
    assert regional.agg(F.sum("entities")).first()[0] >= overall.first()["entities"]


def test_hot_entity_is_reduced_before_the_shuffle(spark):
    hot = spark.range(30_000).select(
        F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id")).alias("e"),
        (F.col("id") % 2).alias("g"),
        F.col("id").alias("m"),
    )
    out = entity_rollup(hot, ["e", "g"], ["g"], "m", 29_999)
    assert sorted(map(tuple, out.collect())) == [(0, 10_001, 0), (1, 10_001, 1)]
    assert "partial_max" in physical_plan(out) and "partial_count" in physical_plan(out)


def test_distinct_entities_descending(spark):
    got = distinct_entities(tracks(spark).union(tracks(spark)), "id", ["season"], "n")
    assert [tuple(r) for r in got.collect()] == [(2020, 3)]
    by_basin = distinct_entities(tracks(spark), "id", ["basin"], "n").collect()
    assert [r["n"] for r in by_basin] == sorted((r["n"] for r in by_basin), reverse=True)


def test_totals_count_an_entity_once(spark, rows):
    got = entity_totals(tracks(spark).withColumn("basin", F.nullif(F.col("basin"), F.lit("XX"))), ["id"], ["season", "basin"], "cat", 3)
    assert got.columns == ["season", "basin", "level", "entities", "intense"]
    assert rows(got) == [
        (None, None, 0, 3, 2), (2020, None, 1, 3, 2), (2020, None, 2, 1, 0),
        (2020, "EP", 2, 1, 0), (2020, "NA", 2, 1, 1), (2020, "WP", 2, 1, 1),
    ]
    assert entity_totals(tracks(spark).where("false"), ["id"], ["season"], "cat", 3).where("level > 0").count() == 0
