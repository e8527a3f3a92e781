"""Tables in the session catalog, with their documentation."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F


def describe_field(description: str, unit: str | None = None) -> str:
    """The comment text of a field."""
    return f"{description} (unidad: {unit})" if unit else description


def comments_from_dictionary(fields: Iterable[Mapping[str, str]]) -> dict[str, str]:
    """Column comments from a data dictionary of ``{id, descripcion, unidad}`` entries."""
    return {f["id"]: describe_field(f["descripcion"], f.get("unidad")) for f in fields}


def _literal(text: str) -> str:
    escaped = text.replace("\\", "\\\\").replace("'", "\\'")
    return f"'{escaped}'"


def _quoted(name: str) -> str:
    return ".".join("`" + part.replace("`", "``") + "`" for part in name.split("."))


def save_table(
    df: DataFrame,
    name: str,
    comment: str | None = None,
    column_comments: Mapping[str, str] | None = None,
    mode: str = "overwrite",
    path: str | None = None,
) -> list[str]:
    """Write ``df`` as the table ``name``, by default replacing it, comments included.

    Returns the commented names that are not columns of ``df``, in any case; they are skipped.
    Column comments travel with the schema, so they cost no further catalog call. ``path`` makes
    the table external.
    """
    column_comments = column_comments or {}
    texts = {name.lower(): text for name, text in column_comments.items()}
    for column in df.columns:
        if column.lower() in texts:
            # A name may hold dots or dashes, so it is replaced in place rather than parsed.
            metadata = {**df.schema[column].metadata, "comment": texts[column.lower()]}
            df = df.withMetadata(column, metadata)
    writer = df.write.mode(mode)
    if path is not None:
        writer = writer.option("path", path)
    writer.saveAsTable(name)
    if comment is not None:
        df.sparkSession.sql(f"COMMENT ON TABLE {_quoted(name)} IS {_literal(comment)}")
    columns = {c.lower() for c in df.columns}
    return [c for c in column_comments if c.lower() not in columns]


def document_table(
    spark: SparkSession,
    name: str,
    comment: str | None = None,
    column_comments: Mapping[str, str] | None = None,
) -> list[str]:
    """Comment a stored table without rewriting it; returns the names that are not its columns."""
    columns = {c.lower(): c for c in spark.table(name).columns}
    missing = []
    for column, text in (column_comments or {}).items():
        if column.lower() not in columns:
            missing.append(column)
            continue
        quoted = columns[column.lower()].replace("`", "``")
        spark.sql(f"ALTER TABLE {_quoted(name)} ALTER COLUMN `{quoted}` COMMENT {_literal(text)}")
    if comment is not None:
        spark.sql(f"COMMENT ON TABLE {_quoted(name)} IS {_literal(comment)}")
    return missing


def observed(df: DataFrame, **predicates: Column) -> tuple[DataFrame, Observation]:
    """``df`` and a counter of its rows, filled by whichever job reads the frame.

    Gives ``rows``, and one count per predicate. Reading the counts costs no job of its own, so
    an ingest is counted while it is written.
    """
    counter = Observation()
    counts = [F.count_if(p).alias(name) for name, p in predicates.items()]
    return df.observe(counter, F.count(F.lit(1)).alias("rows"), *counts), counter
