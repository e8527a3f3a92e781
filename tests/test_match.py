from pyspark.sql import functions as F

from tests.conftest import physical_plan
from varve.operators import filter_keywords, first_match, request_plan

STATIONS = [
    ("M2", "madrid, retiro", 7),
    ("M1", "MADRID AEROPUERTO", 3),
    ("V1", "Valencia", 5),
    ("X1", "CHIVA", 1),
    ("B1", "Barcelona-Valencia", 9),
]
CITIES = ["MADRID", "BARCELONA", "VALENCIA", "BILBAO"]


def stations(spark):
    return spark.createDataFrame(STATIONS, "indicativo string, nombre string, ord int")


def test_first_match_by_order_with_missing_keyword(spark, rows):
    got = first_match(stations(spark), "nombre", CITIES, order="ord")
    assert got.columns == ["keyword", "indicativo", "nombre", "ord"]
    assert [(k, i) for k, i, _, _ in rows(got)] == [
        ("BARCELONA", "B1"),
        ("BILBAO", None),
        ("MADRID", "M1"),
        ("VALENCIA", "V1"),
    ]


def test_unmatched_keywords_can_be_left_out(spark):
    got = first_match(stations(spark), "nombre", CITIES, order="ord", keep_unmatched=False)
    assert {r["keyword"] for r in got.collect()} == {"MADRID", "BARCELONA", "VALENCIA"}


def test_a_keyword_that_matches_most_rows_is_reduced_before_the_shuffle(spark):
    many = spark.range(20_000).select(
        F.col("id").alias("ord"),
        F.when(F.col("id") % 3 != 0, F.lit("calle Madrid")).otherwise(F.lit("otra")).alias("nombre"),
    )
    got = first_match(many, "nombre", ["MADRID"], order="ord")
    assert got.first()["ord"] == 1
    plan = physical_plan(got)
    assert "partial_min" in plan and "NestedLoop" not in plan and "Cartesian" not in plan


def test_keyword_filter_folds_case(spark, rows):
    got = filter_keywords(stations(spark), "nombre", ["CHIVA", "VALENCIA"]).select("indicativo")
    assert rows(got) == [("B1",), ("V1",), ("X1",)]


def test_request_plan_is_every_entity_with_every_piece(spark, rows):
    places = spark.createDataFrame([("A",), ("B",)], "id string")
    got = request_plan(places, "2024-01-01", "2024-06-30")
    assert rows(got.where("id = 'A'")) == [
        ("A", "2024-01-01T00:00:00UTC", "2024-05-30T23:59:59UTC"),
        ("A", "2024-05-31T00:00:00UTC", "2024-06-30T23:59:59UTC"),
    ]
    assert got.count() == 4
    assert "Exchange" not in physical_plan(got)


def test_case_of_keywords_and_missing_order(spark):
    df = spark.createDataFrame(
        [("Madrid", None, {"a": 1}), ("MADRID SUR", 2, {"a": 2})], "name string, ord int, m map<string,int>"
    )
    got = first_match(df, "name", ["madrid", "Bilbao"], "ord").collect()
    assert {r["keyword"]: r["name"] for r in got} == {"madrid": "MADRID SUR", "Bilbao": None}
    assert filter_keywords(df, "name", ["maDrid"]).count() == 2
