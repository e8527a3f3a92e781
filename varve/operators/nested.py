"""Fields and elements of nested JSON records whose form differs from record to record."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_RECORD = "_record"
_ELEMENT = "_element"


def typed_paths(record: Column, paths: Mapping[str, tuple[str, str]]) -> list[Column]:
    """One column per name, from (path, type) in a VARIANT; NULL where the path is absent or its
    value does not fit the type. A path is ``$.a.b[0]``."""
    return [F.try_variant_get(record, path, kind).alias(name) for name, (path, kind) in paths.items()]


def read_paths(
    df: DataFrame, column: str, paths: Mapping[str, tuple[str, str]], corrupt: str | None = None
) -> DataFrame:
    """``df`` with typed columns out of the JSON text in ``column``, which is parsed once.

    Text that is no JSON gives NULLs; ``corrupt`` names a column that is TRUE for it, and FALSE for
    a NULL, which is no record at all.
    """
    parsed = df.withColumn(_RECORD, F.try_parse_json(column))
    found = [*df.columns, *typed_paths(F.col(_RECORD), paths)]
    if corrupt:
        found.append((F.col(_RECORD).isNull() & F.col(column).isNotNull()).alias(corrupt))
    return parsed.select(*found)


def explode_elements(
    df: DataFrame,
    column: str,
    array: str,
    paths: Mapping[str, tuple[str, str]],
    position: str = "position",
    corrupt: str | None = None,
) -> DataFrame:
    """One row per element of the array at path ``array`` in the JSON text of ``column``, with its
    ``position`` from 0 and typed columns from paths within the element.

    A record without elements (NULL, no JSON, no such path, no array, an empty one) stays as one
    row whose position is NULL, so no record is lost and counting positions counts elements. An
    element that is null or no object keeps its position, with NULLs. Nothing is shuffled.
    """
    parsed = df.withColumn(_RECORD, F.try_parse_json(column))
    broken = F.col(_RECORD).isNull() & F.col(column).isNotNull()
    elements = F.try_variant_get(F.col(_RECORD), array, "array<variant>")
    exploded = parsed.select(
        *df.columns, broken.alias("_broken"), F.posexplode_outer(elements).alias(position, _ELEMENT)
    )
    found = [*df.columns, position, *typed_paths(F.col(_ELEMENT), paths)]
    return exploded.select(*found, *([F.col("_broken").alias(corrupt)] if corrupt else []))
