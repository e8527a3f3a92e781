import os

import pytest
from pyspark.sql import functions as F

from varve.session import scratch_path, shared_dir
from varve.sinks import (
    comments_from_dictionary,
    describe_field,
    document_table,
    observed,
    save_table,
)

DICTIONARY = [
    {"id": "tmed", "descripcion": "Temperatura 'media'", "unidad": "ºC"},
    {"id": "J-D", "descripcion": "Media anual"},
    {"id": "sol", "descripcion": "Insolación", "unidad": "horas"},
]


def described(spark, name):
    return {r["col_name"]: r["comment"] for r in spark.sql(f"DESCRIBE TABLE {name}").collect()}


def table_comment(spark, name):
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {name}").collect()
    return next(r["data_type"] for r in rows if r["col_name"] == "Comment")


def test_describe_field():
    assert describe_field("Altitud", "m") == "Altitud (unidad: m)"
    assert describe_field("Nombre") == "Nombre"


def test_save_replaces_and_documents(spark):
    comments = comments_from_dictionary(DICTIONARY)
    for value in (1.0, 2.0):
        df = spark.createDataFrame([(value, value)], "tmed double, `J-D` double")
        missing = save_table(df, "saved", "It's a table", comments)
    assert missing == ["sol"]
    assert spark.table("saved").collect()[0]["tmed"] == 2.0 and spark.table("saved").count() == 1
    got = described(spark, "saved")
    assert got["tmed"] == "Temperatura 'media' (unidad: ºC)" and got["J-D"] == "Media anual"
    assert table_comment(spark, "saved") == "It's a table"


def test_comments_find_their_columns_in_any_case(spark):
    df = spark.createDataFrame([(1.0, 2.0)], "Tmed double, other double")
    assert save_table(df, "cased", None, comments_from_dictionary(DICTIONARY)) == ["J-D", "sol"]
    assert described(spark, "cased")["Tmed"] == "Temperatura 'media' (unidad: ºC)"


def test_document_a_stored_table(spark):
    spark.createDataFrame([(1.0, 2.0)], "tmed double, other double").write.mode("overwrite").saveAsTable("later")
    missing = document_table(spark, "later", "Después", comments_from_dictionary(DICTIONARY))
    assert missing == ["J-D", "sol"]
    assert described(spark, "later")["tmed"] == "Temperatura 'media' (unidad: ºC)"
    assert table_comment(spark, "later") == "Después"


def test_rows_are_counted_by_the_write_itself(spark):
    df = spark.createDataFrame([("Year",), ("2020",), (None,)], "season string")
    counted, counter = observed(df, units=F.col("season") == "Year")
    counted.where("season != 'Year'").write.mode("overwrite").saveAsTable("counted")
    assert counter.get == {"rows": 3, "units": 1}


def test_scratch_is_in_the_shared_folder(spark):
    base = spark.conf.get("spark.checkpoint.dir")
    assert shared_dir(spark) == base
    first, second = scratch_path(spark, "x"), scratch_path(spark, "x")
    assert first.startswith(base) and first != second


class _Session:
    """The two settings that decide where scratch goes."""

    def __init__(self, **settings):
        self.conf = self
        self.settings = settings

    def get(self, name, default=None):
        return self.settings.get(name, default)


def test_only_a_local_session_may_leave_the_shared_folder_unnamed():
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_dir(_Session(**{"spark.master": "spark://somewhere"}))
    local = _Session(**{"spark.master": "local[4]"})
    assert os.path.isdir(shared_dir(local)) and shared_dir(local) == shared_dir(local)
