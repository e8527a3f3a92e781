"""CSV and JSON files, one or a directory of them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StringType, StructField, StructType


def require_files(spark: SparkSession, path: str, glob: str) -> None:
    """Raise FileNotFoundError where ``path`` holds no file that matches ``glob``.

    With a schema given, Spark would read such a directory as an empty table.
    """
    listing = spark.read.format("binaryFile").option("pathGlobFilter", glob).load(path)
    if listing.select("path").isEmpty():
        raise FileNotFoundError(f"no {glob} in {path}")


def read_strings(
    spark: SparkSession, path: str, columns: Sequence[str] | None = None, glob: str = "*.csv"
) -> DataFrame:
    """CSV with a header line, every column as text.

    ``path`` is a file or a directory; every file that matches ``glob`` is read. Without
    ``columns`` the names come from the first header. In both cases a file whose header differs
    is an error rather than a shifted table.
    """
    require_files(spark, path, glob)
    reader = spark.read.option("header", True).option("pathGlobFilter", glob)
    if columns is None:
        columns = reader.csv(path).columns
    schema = StructType([StructField(c, StringType()) for c in columns])
    return reader.schema(schema).option("enforceSchema", False).csv(path)


def read_typed(
    spark: SparkSession, path: str, schema: StructType | str, glob: str = "*.csv"
) -> DataFrame:
    """CSV with a header line and the given types; text that does not fit gives NULL.

    A units line under the header must be dropped from the text form (``read_strings`` and
    ``drop_units_row``), before any typing.
    """
    require_files(spark, path, glob)
    reader = spark.read.option("header", True).option("pathGlobFilter", glob)
    return reader.schema(schema).option("enforceSchema", False).csv(path)


def read_records(
    spark: SparkSession,
    path: str,
    schema: StructType | str,
    multiline: bool = False,
    corrupt: str | None = None,
) -> DataFrame:
    """JSON records: one object per line, or an array of objects in one line.

    Keys absent from a record give NULL; keys of a record that are not in ``schema`` are not read
    (``undeclared_keys`` reports them, ``infer_records`` reads all). Text that is no record fails
    the query; with ``corrupt`` it becomes a row of NULLs whose text is in the column of that name,
    to be counted. Directories named ``column=value`` add that column and are pruned by filters on
    it. An array printed over several lines needs ``multiline``, and one task then reads the whole
    file. A path without files is an error.
    """
    require_files(spark, path, "*")
    reader = spark.read.option("multiLine", multiline)
    if corrupt is None:
        return reader.schema(schema).option("mode", "FAILFAST").json(path)
    if isinstance(schema, str):
        schema = StructType.fromDDL(schema)
    schema = StructType([*schema.fields, StructField(corrupt, StringType())])
    return reader.schema(schema).option("columnNameOfCorruptRecord", corrupt).json(path)
