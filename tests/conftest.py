from __future__ import annotations

import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from varve.session import build_session

    session = build_session(
        "tests",
        "local[4]",
        **{
            "spark.sql.shuffle.partitions": "4",
            "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse")),
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
            "spark.ui.showConsoleProgress": "false",
            "spark.log.level": "ERROR",
        },
    )
    yield session
    session.stop()


@pytest.fixture
def rows():
    """The rows of a DataFrame as a sorted list of tuples, NULLs first."""

    def collect(df):
        def order(row):
            return [(v is not None, str(type(v)), repr(v)) for v in row]

        return sorted((tuple(r) for r in df.collect()), key=order)

    return collect


def physical_plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()
