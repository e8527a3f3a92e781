import json

import pytest
from pyspark.sql import functions as F

from varve.sources import broken_records, infer_records, landing_texts, read_records, record_keys, schema_of_keys, undeclared_keys

LINES = [
    '{"a":1,"b":"x","n":null}',
    '{"a":2.5,"o":{"p":1,"q r":[1,2]}}',
    '[{"a":3,"z":true},{"b":null}, 5]',
    "bad",
    "",
    '{"o":{"p":"t","VARIANT":1,"OBJECT<":2}, "VOID":1}',
    '{"big":10000000000}',
    "{}",
    '{"m":1}',
    '{"m":"x"}',
    '{"e":{}}',
    '{"twice":1,"twice":2}',
    '{"odd `key`":1.25}',
]
KEYS = [
    ("VOID", 1, 0, "BIGINT"),
    ("a", 3, 0, "DOUBLE"),
    ("b", 2, 1, "STRING"),
    ("big", 1, 0, "BIGINT"),
    ("e", 1, 0, "STRING"),
    ("m", 2, 0, "STRING"),
    ("n", 1, 1, "STRING"),
    ("o", 2, 0, "STRUCT<`OBJECT<`: BIGINT, VARIANT: BIGINT, p: STRING, `q r`: ARRAY<BIGINT>>"),
    ("odd `key`", 1, 0, "DOUBLE"),
    ("z", 1, 0, "BOOLEAN"),
]


@pytest.fixture
def texts(spark):
    return spark.createDataFrame([(x,) for x in [*LINES, None]], "value string").repartition(3)


def test_keys_of_all_records(texts, rows):
    assert rows(record_keys(texts)) == sorted(KEYS)


def test_schema_of_no_record(texts):
    assert schema_of_keys(record_keys(texts.where("false"))).fields == []
    assert schema_of_keys(record_keys(texts.where("value IN ('bad', '', '{}')"))).fields == []


def test_broken_records(texts, rows):
    assert rows(broken_records(texts)) == [("bad",), ('{"twice":1,"twice":2}',)]


def test_undeclared_keys(texts, rows):
    got = undeclared_keys(texts, "A INT, b STRING, n STRING, o STRING, e STRING, `void` INT")
    assert [r[0] for r in rows(got)] == ["big", "m", "odd `key`", "z"]


def test_records_are_read_with_all_keys(spark, tmp_path):
    (tmp_path / "x.json").write_text("\n".join(LINES))
    got = infer_records(spark, str(tmp_path), corrupt="_bad")
    assert got.columns == [k[0] for k in KEYS] + ["_bad"]
    read = [r.asDict(recursive=True) for r in got.collect()]
    assert sorted(r["a"] for r in read if r["a"] is not None) == [1.0, 2.5]  # the array holds a number
    assert {r["m"] for r in read} == {None, "1", "x"}
    assert {"OBJECT<": 2, "VARIANT": 1, "p": "t", "q r": None} in [r["o"] for r in read]
    assert [r["odd `key`"] for r in read if r["odd `key`"]] == [1.25]


def test_records_over_several_lines(spark, tmp_path):
    (tmp_path / "x.json").write_text(json.dumps([{"a": 1}, {"b": [True]}], indent=2))
    got = infer_records(spark, str(tmp_path), multiline=True)
    assert [tuple(r) for r in got.collect()] == [(1, None), (None, [True])]


def test_one_key_in_very_many_records(spark):
    records = spark.range(0, 300_000, 1, 8).select(
        F.when(F.col("id") == 123_456, F.lit('{"a":1,"rare":{"x":null}}')).otherwise(F.lit('{"a":1}')).alias("value")
    )
    assert sorted(tuple(r) for r in record_keys(records).collect()) == [
        ("a", 300_000, 0, "BIGINT"), ("rare", 1, 0, "STRUCT<x: STRING>")
    ]


def test_missing_landings_are_an_error(spark, tmp_path, rows):
    with pytest.raises(FileNotFoundError):
        read_records(spark, str(tmp_path), "a INT")
    with pytest.raises(FileNotFoundError):
        infer_records(spark, str(tmp_path))
    day = tmp_path / "ingest_date=2024-11-05"
    day.mkdir()
    (day / "x.json").write_text('{"a":1}\n')
    with pytest.raises(FileNotFoundError, match="2024-11-06"):
        landing_texts(spark, str(tmp_path), "2024-11-06")
    assert rows(landing_texts(spark, str(tmp_path), "2024-11-05")) == [('{"a":1}',)]
    assert [f.name for f in infer_records(spark, str(tmp_path)).schema] == ["a", "ingest_date"]
    (tmp_path / "none.json").mkdir()
    (tmp_path / "none.json" / "x").write_text("{}\n")
    with pytest.raises(ValueError, match="no record"):
        infer_records(spark, str(tmp_path / "none.json"))
