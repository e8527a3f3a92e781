"""Records whose keys are not known beforehand.

Every record is read as a variant, its keys are rows, and one aggregation with a step in each task
merges what the tasks saw of each key: how many records hold it, how often it is null, and the type
that covers all its values. So a key that stands in one record of a million is found, and what
reaches the driver is one row per key.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from varve.sources.files import read_records, require_files


def text_records(spark: SparkSession, path: str) -> DataFrame:
    """The lines of the files under ``path`` as ``value``, and the columns of its directories."""
    require_files(spark, path, "*")
    return spark.read.text(path)


def record_keys(texts: DataFrame, column: str = "value") -> DataFrame:
    """One row per key of the records: ``key``, ``records``, ``nulls``, ``type``.

    A text is one JSON object or an array of objects. ``type`` covers all values that are not
    null, with objects as structs and their keys merged at any depth: numbers widen, and kinds that
    do not go together (a number here, a text there) give STRING, as does a key that is always
    null. Texts that are no record (see :func:`broken_records`) and elements of an array that are
    no object have no keys. Keys differ by case.
    """
    spark = texts.sparkSession
    elements = _elements(texts, column)
    pairs = elements.lateralJoin(spark.tvf.variant_explode(F.col("_record").outer()))
    found = pairs.select(F.col("key"), F.col("value").alias("_value"))
    filled = F.when(~F.is_variant_null("_value"), F.col("_value"))
    return found.groupBy("key").agg(
        F.count(F.lit(1)).alias("records"),
        F.count_if(F.is_variant_null("_value")).alias("nulls"),
        _sql_type(F.schema_of_variant_agg(filled)).alias("type"),
    )


def _elements(texts: DataFrame, column: str) -> DataFrame:
    """The objects of all texts as ``_record``; an object passes as an array of itself."""
    text = F.trim(F.col(column))
    listed = F.when(text.startswith("["), text).otherwise(F.concat(F.lit("["), text, F.lit("]")))
    parsed = texts.select(F.try_parse_json(listed).alias("_parsed"))
    many = parsed.lateralJoin(texts.sparkSession.tvf.variant_explode(F.col("_parsed").outer()))
    return many.select(F.col("value").alias("_record")).where(
        F.schema_of_variant("_record").startswith("OBJECT")
    )


def broken_records(texts: DataFrame, column: str = "value") -> DataFrame:
    """The texts that are no JSON object or array; blank ones are left out."""
    kind = F.schema_of_variant(F.try_parse_json(F.col(column)))
    record = kind.startswith("OBJECT") | kind.startswith("ARRAY")
    return texts.where((F.trim(column) != "") & ~F.coalesce(record, F.lit(False)))


def _sql_type(sketch: Column) -> Column:
    """The type for the reader of records, from a variant's merged schema.

    Words in backquotes are names of keys and stay as they are.
    """
    plain = r"(?=(?:[^`]*`[^`]*`)*[^`]*$)"
    typed = F.regexp_replace(sketch, r"\bOBJECT<" + plain, "STRUCT<")
    typed = F.regexp_replace(typed, r"\bSTRUCT<>" + plain, "STRING")
    typed = F.regexp_replace(typed, r"\bDECIMAL\(\d+,\d+\)" + plain, "DOUBLE")
    return F.regexp_replace(typed, r"\b(VARIANT|VOID)\b(?!:)" + plain, "STRING")


def schema_of_keys(keys: DataFrame) -> StructType:
    """The schema with one column per row of :func:`record_keys`, in the keys' order.

    One row per key reaches the driver.
    """
    rows = keys.agg(F.sort_array(F.collect_list(F.struct("key", "type"))).alias("keys")).first()["keys"]
    fields = [f"`{r['key'].replace('`', '``')}` {r['type']}" for r in rows]
    return StructType.fromDDL(", ".join(fields)) if fields else StructType()


def undeclared_keys(texts: DataFrame, schema: StructType | str, column: str = "value") -> DataFrame:
    """The rows of :func:`record_keys` whose key is no column of ``schema``, in any case."""
    declared = StructType.fromDDL(schema) if isinstance(schema, str) else schema
    names = [f.name.lower() for f in declared.fields]
    keys = record_keys(texts, column)
    return keys.where(~F.lower("key").isin(names)) if names else keys


def infer_records(
    spark: SparkSession, path: str, multiline: bool = False, corrupt: str | None = None
) -> DataFrame:
    """JSON records under ``path`` with the union of all their keys as columns.

    All records are read once for the schema, then by :func:`read_records`, whose rules for text
    that is no record hold. Columns of directories named ``column=value`` follow. Records without
    any key, or no records, are an error. Keys that differ in case only need the session's
    ``spark.sql.caseSensitive``.
    """
    if multiline:
        require_files(spark, path, "*")
        texts = spark.read.text(path, wholetext=True)
    else:
        texts = text_records(spark, path)
    schema = schema_of_keys(record_keys(texts.select("value")))
    if not schema.fields:
        raise ValueError(f"no record with a key in {path}")
    return read_records(spark, path, schema, multiline, corrupt)


_NAME = re.compile(r"[A-Za-z_]\w*")


def landing_texts(spark: SparkSession, path: str, run_date: object, day: str = "ingest_date") -> DataFrame:
    """The lines of the landing of ``run_date`` under ``path``; all lines if it has no such folders.

    A landing that is not there is an error: read as no rows, it would empty every table behind it.
    """
    if not _NAME.fullmatch(day):
        raise ValueError(f"no column name: {day}")
    texts = text_records(spark, path)
    if day not in texts.columns:
        return texts.select("value")
    landed = texts.where(F.col(day) == F.lit(str(run_date)).cast("date"))
    if landed.isEmpty():
        raise FileNotFoundError(f"no landing {day}={run_date} in {path}")
    return landed.select("value")
