"""Helpers that several operators share."""

from __future__ import annotations

import ctypes
import tempfile
import zipfile
from collections.abc import Iterator
from pathlib import Path

import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from varve.session import scratch_path

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once to the shared folder and read back.

    It cuts the lineage, so a lost executor costs no more than the tasks that read the table.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def ascii_lower(text: Column) -> Column:
    """A-Z to a-z; every other character, accented capitals included, stays."""
    return F.translate(text, UPPER, UPPER.lower())


def sized_broadcast(df: DataFrame, bytes_: int | None, limit: int) -> DataFrame:
    """``df`` with a broadcast hint if its measured size is within ``limit``, else as it is."""
    return F.broadcast(df) if (bytes_ or 0) <= limit else df


BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"
TEXTS_PER_BATCH = 1000


def ship_package(spark: SparkSession) -> None:
    """Sends this package to the Python workers, once per session, as ``--py-files`` would.

    Whole texts in batches of Spark's default of 10,000 rows take hundreds of MB in the executor
    and again in its workers, so a session that has not set the number of rows gets a smaller one.
    """
    if spark.conf.get(BATCH_ROWS) == "10000":
        spark.conf.set(BATCH_ROWS, TEXTS_PER_BATCH)
    context = spark.sparkContext
    if getattr(context, "_llm_package", None):
        return
    root = Path(__file__).resolve().parents[2]
    archive = Path(tempfile.mkdtemp(prefix="llm-package-")) / "llm_package.zip"
    with zipfile.ZipFile(archive, "w") as out:
        for source in sorted((root / "varve").rglob("*.py")):
            out.write(source, source.relative_to(root))
    context.addPyFile(str(archive))
    context._llm_package = str(archive)


def broadcast_file(spark: SparkSession, path: str) -> Broadcast:
    """The bytes of a vocabulary file (a few MB), read once by the driver."""
    with open(path, "rb") as file:
        return spark.sparkContext.broadcast(file.read())


def portions_of(texts: pa.Array, most: int) -> Iterator[list[str]]:
    """The texts of a batch (no NULLs), in runs of about ``most`` UTF-8 bytes, one text at least.

    Only one run is made into strings at a time, since a batch of long texts is much larger.
    """
    first, size = 0, 0
    for i, length in enumerate(pc.binary_length(texts).to_pylist()):
        if size and size + length > most:
            yield texts.slice(first, i - first).to_pylist()
            first, size = i, 0
        size += length
    if len(texts):
        yield texts.slice(first).to_pylist()


def release_memory() -> None:
    """Gives what a worker no longer uses back to the system.

    Workers live on between stages, and their allocators keep freed memory.
    """
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # only some C libraries have it
    if trim:
        trim(0)
