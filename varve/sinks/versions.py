"""Tables that change in one step, and histories that change only where a landing touches them."""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from varve.session import scratch_path
from varve.sinks.tables import _literal, _quoted


def published_path(spark: SparkSession, name: str) -> str | None:
    """The folder of the version that readers of the published table ``name`` get now."""
    if not spark.catalog.tableExists(name):
        return None
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {_quoted(name)}").where("col_name = 'View Text'")
    text = rows.first()
    # The path is the last name in the view's own statement, in backquotes.
    return text["data_type"].rstrip("`").rsplit("`", 1)[1] if text else None


def publish_table(
    df: DataFrame,
    name: str,
    comment: str | None = None,
    column_comments: Mapping[str, str] | None = None,
    path: str | None = None,
) -> list[str]:
    """Write ``df`` as a new version of ``name`` and switch to it when it is whole.

    A version is a folder of its own under ``path`` (by default under the warehouse); ``name`` is a
    view of one of them. One catalog call sets the version, the comment and the column comments,
    so a reader meets all of the old table or all of the new one, a query that has begun goes on
    over the old files, and a write that fails leaves everything as it was. Old versions stay
    until their folders are removed. ``df`` may read ``name`` itself.

    Returns the commented names that are no columns, as ``save_table`` does. A stored table of that
    name is an error, since a view cannot take its place.
    """
    spark = df.sparkSession
    if spark.catalog.tableExists(name) and published_path(spark, name) is None:
        raise ValueError(f"{name} is a stored table, not a published one")
    root = path or f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/versions/{name}"
    version = f"{root.rstrip('/')}/version={uuid.uuid4().hex}"
    df.write.parquet(version)
    texts = {column.lower(): text for column, text in (column_comments or {}).items()}
    columns = []
    for column in df.columns:
        text = texts.get(column.lower())
        quoted = "`" + column.replace("`", "``") + "`"
        columns.append(quoted + (f" COMMENT {_literal(text)}" if text else ""))
    about = f" COMMENT {_literal(comment)}" if comment is not None else ""
    # Columns by name: the files hold them in the order of the frame.
    spark.sql(
        f"CREATE OR REPLACE VIEW {_quoted(name)} ({', '.join(columns)}){about} "
        f"AS SELECT * FROM parquet.`{version}`"
    )
    names = {c.lower() for c in df.columns}
    return [c for c in column_comments or {} if c.lower() not in names]


def merge_landing(
    landing: DataFrame,
    path: str,
    key: Sequence[str],
    partition: str,
    order: str,
) -> list:
    """Bring the rows of ``landing`` into the history under ``path``; returns the touched partitions.

    The history is stored as Parquet in folders ``partition=value`` and holds one row per ``key``:
    the one with the greatest ``order`` (a landing day, say), and of equals the greatest in column
    order, so a landing can be repeated and late landings do not undo newer rows. Rows are compared
    by a grouping with a step in each task. Only partitions of which the landing has rows are read
    and rewritten; the files of all others stay as they are. ``partition`` must follow from the
    key: a row whose correction names another partition would stand in both.

    The merged partitions are first written aside and only then put in place, so a failure before
    that leaves the history as it was; after one in between, repeat the landing. NULLs in ``key``
    are one value. A landing without rows touches nothing. An empty ``path`` begins a history.
    """
    spark = landing.sparkSession
    if partition not in key:
        key = [*key, partition]
    columns = landing.columns
    rest = [c for c in columns if c not in key and c != order]
    found = landing.select(partition).distinct().agg(F.collect_list(F.struct(partition)).alias("found"))
    touched = [row[partition] for row in found.first()["found"]]
    if not touched:
        return []
    rows = landing
    if _has_files(spark, path):
        held = F.col(partition).isin([t for t in touched if t is not None])
        held = held | F.col(partition).isNull() if None in touched else held
        schema = landing.schema
        rows = spark.read.schema(schema).parquet(path).where(held).select(*columns).unionByName(landing)
    newest = F.max(F.struct(order, *rest)).alias("_row")
    merged = rows.groupBy(*key).agg(newest).select(*key, "_row.*").select(*columns)
    aside = scratch_path(spark, "merged")
    merged.write.parquet(aside)
    (
        spark.read.schema(merged.schema)
        .parquet(aside)
        .hint("rebalance", partition)
        .write.partitionBy(partition)
        .mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .parquet(path)
    )
    return touched


def _has_files(spark: SparkSession, path: str) -> bool:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    return files.exists(folder)
