import datetime as dt
import json

import pytest

from varve.operators import drop_units_row
from varve.sinks import land_records
from varve.sources import read_records, read_strings, read_typed


def test_csv_as_text_from_every_file(spark, tmp_path, rows):
    (tmp_path / "a.csv").write_text("id,season\nS0,Year\nS1,2020\n")
    (tmp_path / "b.csv").write_text("id,season\nS2,007\n")
    (tmp_path / "c.txt").write_text("id,season\nS3,2020\n")
    got = read_strings(spark, str(tmp_path))
    assert set(dict(got.dtypes).values()) == {"string"}
    assert rows(drop_units_row(got, "season", "Year")) == [("S1", "2020"), ("S2", "007")]
    assert rows(read_strings(spark, str(tmp_path), ["id", "season"])) == rows(got)


def test_a_different_header_is_an_error(spark, tmp_path):
    (tmp_path / "a.csv").write_text("season,id\n2020,S1\n")
    with pytest.raises(Exception, match="(?i)header"):
        read_strings(spark, str(tmp_path), ["id", "season"]).collect()


def test_typed_csv(spark, tmp_path, rows):
    (tmp_path / "a.csv").write_text("day,x\n2024-01-01,1.5\n2024-01-02,bad\n")
    got = read_typed(spark, str(tmp_path), "day DATE, x DOUBLE")
    assert rows(got) == [(dt.date(2024, 1, 1), 1.5), (dt.date(2024, 1, 2), None)]


def test_missing_files_are_an_error(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        read_typed(spark, str(tmp_path), "x INT")
    with pytest.raises(FileNotFoundError):
        read_strings(spark, str(tmp_path), ["x"])


def test_a_json_array_in_one_line(spark, tmp_path, rows):
    records = [{"fecha": "2024-10-01", "tmed": "18,4"}, {"fecha": "2024-10-02", "sol": "1"}]
    (tmp_path / "raw.json").write_text(json.dumps(records))
    schema = "fecha STRING, tmed STRING, prec STRING"
    wanted = [("2024-10-01", "18,4", None), ("2024-10-02", None, None)]
    assert rows(read_records(spark, str(tmp_path), schema)) == wanted
    (tmp_path / "raw.json").write_text(json.dumps(records, indent=2))
    assert rows(read_records(spark, str(tmp_path), schema, multiline=True)) == wanted


def test_a_landing_replaces_its_own_day_only(spark, tmp_path, rows):
    path = str(tmp_path / "landing")
    schema = "id STRING, ingest_date DATE"
    one, two = (spark.createDataFrame([(i,)], "id string") for i in ("one", "two"))
    land_records(one, path, run_date="2024-11-04")
    land_records(one, path, run_date="2024-11-05")
    land_records(two, path, run_date="2024-11-05")
    landed = read_records(spark, path, schema)
    assert rows(landed) == [("one", dt.date(2024, 11, 4)), ("two", dt.date(2024, 11, 5))]
    pruned = landed.where("ingest_date = DATE'2024-11-04'")
    assert len(pruned.collect()) == 1
    assert "PartitionFilters: [isnotnull(ingest_date" in pruned._jdf.queryExecution().toString()


def test_a_landing_by_day_of_the_record(spark, tmp_path, rows):
    path = str(tmp_path / "landing")
    df = spark.createDataFrame([("a", "2024-01-01"), ("b", "2024-01-02")], "id string, day string")
    land_records(df, path, date_column="day")
    assert rows(read_records(spark, path, "id STRING, ingest_date DATE")) == [
        ("a", dt.date(2024, 1, 1)),
        ("b", dt.date(2024, 1, 2)),
    ]


def test_another_order_of_columns_is_an_error(spark, tmp_path):
    (tmp_path / "a.csv").write_text("SID,SEASON\nS1,2020\n")
    (tmp_path / "b.csv").write_text("SEASON,SID\n2021,S2\n")
    with pytest.raises(Exception, match="(?i)header"):
        read_strings(spark, str(tmp_path)).collect()


def test_broken_records_fail_or_are_kept(spark, tmp_path):
    (tmp_path / "a.json").write_text('{"a": "1"}\n{"a": \n')
    with pytest.raises(Exception, match="(?i)malformed"):
        read_records(spark, str(tmp_path), "a STRING").collect()
    rows = read_records(spark, str(tmp_path), "a STRING", corrupt="bad").collect()
    assert sorted((r["a"] or "", r["bad"] or "") for r in rows) == [("", '{"a": '), ("1", "")]
