"""Registration of queries with their oracle."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

Run = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Query:
    run: Run
    oracle: str | None


REGISTRY: dict[str, Query] = {}


def query(oracle: str | None = None) -> Callable[[Run], Run]:
    """Register a query under its function's name, with the DuckDB SQL for the same rows."""

    def register(run: Run) -> Run:
        REGISTRY[run.__name__] = Query(run, oracle)
        return run

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
