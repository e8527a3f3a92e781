"""Every registered query against its SQL in DuckDB, and the shape of its plan."""

import glob
import math
import os
import re

import duckdb
import pytest

import __spark_entry__ as entry_point
from tests.conftest import ROOT, physical_plan
from workload import REGISTRY

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")

TYPES = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "string": "VARCHAR",
    "double": "DOUBLE",
    "date": "DATE",
    "boolean": "BOOLEAN",
    "timestamp_ntz": "TIMESTAMP",
}


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for path in glob.glob(f"{SF}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return connection


def comparable(value):
    return "nan" if isinstance(value, float) and math.isnan(value) else repr(value)


@pytest.mark.parametrize("name", sorted(REGISTRY))
def test_query_agrees_with_its_sql(spark, duck, name):
    df = REGISTRY[name].run(spark, SF)
    plan = physical_plan(df)
    for node in ("CartesianProduct", "BroadcastNestedLoopJoin", "Python", "Pandas", "Arrow"):
        assert node not in plan
    result = duck.execute(REGISTRY[name].oracle)
    columns = [d[0] for d in result.description]
    assert sorted(columns) == sorted(df.columns)
    assert {d[0]: str(d[1]) for d in result.description} == {c: TYPES[t] for c, t in df.dtypes}
    wanted = sorted(tuple(comparable(v) for v in row) for row in result.fetchall())
    got = sorted(tuple(comparable(r[c]) for c in columns) for r in df.collect())
    assert got == wanted
    assert got


def test_entry_is_the_flagship(spark):
    df = entry_point.entry(spark)
    assert df.columns == [
        "anio", "precio_medio", "valor_medio", "num_entidades", "num_intensas", "devuelto",
    ]
    years = [r["anio"] for r in df.collect()]
    assert years == sorted(years) and len(years) == 8


def test_contract_dictionaries():
    queries, oracles = entry_point.queries(), entry_point.oracle_sql()
    assert REGISTRY.keys() <= queries.keys() and REGISTRY.keys() <= oracles.keys() <= queries.keys()
    assert all(name == "pipeline" or name.startswith("op") for name in queries.keys() - REGISTRY.keys())


def test_scans_read_only_the_columns_they_use(spark):
    plan = physical_plan(REGISTRY["yearly_cross_source"].run(spark, SF))
    schemas = re.findall(r"ReadSchema: struct<([^>]*)>", plan)
    assert sorted(len(s.split(",")) for s in schemas) == [2, 2, 3, 3]
    assert "EqualTo(l_returnflag,R)" in plan


def test_library_stays_on_the_executors():
    forbidden = re.compile(r"\.collect\(|toPandas|\.rdd\b|udf|mapInPandas|crossJoin|localCheckpoint")
    for path in glob.glob(f"{ROOT}/varve/**/*.py", recursive=True):
        if "/varve/llm/" in path:  # an optional package with its own tests
            continue
        assert not forbidden.search(open(path).read()), path
