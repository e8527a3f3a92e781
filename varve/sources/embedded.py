"""A table embedded in a text file: title lines above it, other tables below.

The table begins after the first line that starts with ``header_prefix`` and goes on while the
first field of a line, blanks aside, is all matched by ``first_field``. Columns are found by the
names in each file's own header, so files may order them differently. All values are text.

Two ways to the same rows:

* ``extract_from_texts`` holds one file per row and cuts the table out of its text: no shuffle.
  It suits the usual case of many files, each far smaller than a task's memory.
* ``extract_from_lines`` holds one line per row with its place in the file, so a file may be of
  any size and spread over many tasks. Only each file's two bounds are aggregated, and joins
  go by file and part, so that a file with a large share of all lines stays spread.

``read_embedded_table`` reads files, always by line. The whole-text form is for a column of short
texts, since it holds a text and its lines in one row.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from varve.functions.cells import null_token
from varve.session import scratch_path
from varve.sources.files import require_files

HEADER_PREFIX = "Year"
FIRST_FIELD = "[0-9]{4}"
NULL_TOKEN = "***"

_BLANKS = " \t\r\f\x0b"
_BLANK = r"[ \t\r\f\x0b]*"
_QUOTED_FIELDS = r',("(?:[^"]|"")*"|[^,]*)'


def _strip(c: Column) -> Column:
    return F.btrim(c, F.lit(_BLANKS))


def _row_start(first_field: str) -> str:
    return rf"{_BLANK}(?:{first_field}){_BLANK}(?:,|\n|\z)"


def _is_header(line: Column, prefix: str) -> Column:
    return F.startswith(_strip(line), F.lit(prefix))


def _is_row(line: Column, first_field: str) -> Column:
    return line.rlike("^" + _row_start(first_field))


def _unquote(field: Column) -> Column:
    inner = F.replace(F.substr(field, F.lit(2), F.length(field) - 2), F.lit('""'), F.lit('"'))
    return F.when(field.startswith('"'), inner).otherwise(field)


def _fields(line: Column) -> Column:
    # Every match of the quoted form starts at a comma, hence the one put in front.
    quoted = F.regexp_extract_all(F.concat(F.lit(","), line), F.lit(_QUOTED_FIELDS), F.lit(1))
    plain = F.split(line, ",", -1)
    return F.when(line.contains('"'), F.transform(quoted, _unquote)).otherwise(plain)


def _places(header: Column, columns: Sequence[str]) -> Column:
    """Per wanted column its index among the header's fields, -1 where the header lacks it."""
    names = F.transform(F.split(header, ",", -1), _strip)
    return F.array(*[(F.array_position(names, F.lit(c)) - 1).cast("int") for c in columns])


def _parse(df: DataFrame, columns: Sequence[str], token: str) -> DataFrame:
    """(file, places, line) to (file, ``columns``); a field a line lacks gives NULL."""
    split = df.select("file", "places", _fields(F.col("line")).alias("_fields"))
    values = [
        null_token(F.get("_fields", F.get("places", F.lit(i))), token).alias(c)
        for i, c in enumerate(columns)
    ]
    return split.select("file", *values)


def _cut(texts: DataFrame, header_prefix: str, first_field: str) -> DataFrame:
    """(file, text) to (file, lines): the header and the table's lines, NULL without a header.

    Both cuts split once at the first match, so the text is searched no further than needed.
    """
    text = F.col("text")
    # A byte order mark at the start is no part of the text, as for Spark's line reader.
    text = F.when(F.startswith(text, F.lit("\ufeff")), F.substring(text, 2, 2**31 - 1)).otherwise(text)
    unix = F.when(text.contains("\r"), F.regexp_replace(text, "\r\n?", "\n")).otherwise(text)
    to_header = rf"\n(?={_BLANK}{re.escape(header_prefix)})"
    past_table = rf"\n(?!{_row_start(first_field)})"
    from_header = F.get(F.split(F.concat(F.lit("\n"), unix), to_header, 2), F.lit(1))
    table = F.get(F.split(from_header, past_table, 2), F.lit(0))
    return texts.select("file", F.split(table, "\n", -1).alias("lines"))


def extract_from_texts(
    texts: DataFrame,
    columns: Sequence[str],
    header_prefix: str = HEADER_PREFIX,
    first_field: str = FIRST_FIELD,
    null_token: str = NULL_TOKEN,
) -> DataFrame:
    """(file, text), one row per file, to (file, ``columns``). A file without header gives none."""
    cut = _cut(texts, header_prefix, first_field)
    header = F.get("lines", F.lit(0))
    placed = cut.select(
        "file",
        _places(header, columns).alias("places"),
        F.slice("lines", F.lit(2), F.array_size("lines")).alias("rows"),
    )
    rows = placed.select("file", "places", F.explode("rows").alias("line"))
    return _parse(rows, columns, null_token)


def file_report(
    texts: DataFrame, header_prefix: str = HEADER_PREFIX, first_field: str = FIRST_FIELD
) -> DataFrame:
    """(file, text) to (file, has_header, table_rows); for short texts, as ``extract_from_texts``."""
    return _cut(texts, header_prefix, first_field).select(
        "file",
        F.col("lines").isNotNull().alias("has_header"),
        F.coalesce(F.array_size("lines") - 1, F.lit(0)).cast("long").alias("table_rows"),
    )


def mark_lines(
    lines: DataFrame, header_prefix: str = HEADER_PREFIX, first_field: str = FIRST_FIELD
) -> DataFrame:
    """Add ``is_header`` and ``is_row`` to (file, part, pos, line)."""
    line = F.col("line")
    return lines.withColumns(
        {"is_header": _is_header(line, header_prefix), "is_row": _is_row(line, first_field)}
    )


def table_bounds(marked: DataFrame) -> DataFrame:
    """Where each file's table lies, one row per file with a header and part of it.

    (file, part, header, head_pos, stop_pos): the place of the header and that of the first
    line past the table, NULL where the table runs to the end of the file. Only a line that is
    no row ends a table, even if a row begins like a header.
    """
    parts = marked.groupBy("file", "part").agg(
        F.min(F.when(F.col("is_header"), F.col("pos"))).alias("head_pos")
    )
    heads = parts.groupBy("file").agg(F.min("head_pos").alias("head_pos"))
    spread = parts.select("file", "part").join(heads.where("head_pos IS NOT NULL"), "file")
    # The header itself is among these lines, so a file whose table runs to its end stays.
    outside = marked.where(F.col("is_header") | ~F.col("is_row"))
    past = ~F.col("is_row") & (F.col("pos") > F.col("head_pos"))
    per_file = (
        outside.join(spread, ["file", "part"])
        .groupBy("file")
        .agg(
            F.max(F.when(F.col("pos") == F.col("head_pos"), F.col("line"))).alias("header"),
            F.min(F.when(past, F.col("pos"))).alias("stop_pos"),
        )
    )
    return spread.join(per_file, "file")


def _inside(marked: DataFrame, bounds: DataFrame) -> DataFrame:
    """The lines of each file's table, with what ``bounds`` says of the file."""
    inside = (F.col("pos") > F.col("head_pos")) & (
        F.col("stop_pos").isNull() | (F.col("pos") < F.col("stop_pos"))
    )
    rows = marked.where("is_row").select("file", "part", "pos", "line")
    return rows.join(bounds, ["file", "part"]).where(inside)


def extract_from_lines(
    marked: DataFrame,
    columns: Sequence[str],
    null_token: str = NULL_TOKEN,
    bounds: DataFrame | None = None,
) -> DataFrame:
    """(file, part, pos, line, is_header, is_row), as from ``mark_lines``, to (file, ``columns``).

    ``pos`` orders the lines of a file; ``part`` cuts a file into pieces of limited size. Both
    may be of any ordered type, and both must be stored or computed values, the same each time
    the input is read, since the bounds and the rows are read apart. ``bounds`` takes the
    result of ``table_bounds`` where it is already stored: Spark then knows its size, and
    while that is small sends it to the lines instead of shuffling them.
    """
    bounds = table_bounds(marked) if bounds is None else bounds
    # The header is read once per file and part, not once per line.
    placed = bounds.withColumn("places", _places(F.col("header"), columns)).drop("header")
    return _parse(_inside(marked, placed), columns, null_token)


def file_report_from_lines(marked: DataFrame) -> DataFrame:
    """(file, part, pos, line, is_header, is_row) to (file, has_header, table_rows)."""
    headers = marked.groupBy("file").agg(F.max("is_header").alias("has_header"))
    counts = _inside(marked, table_bounds(marked)).groupBy("file").agg(F.count(F.lit(1)).alias("table_rows"))
    return headers.join(counts, "file", "left").select(
        "file", "has_header", F.coalesce("table_rows", F.lit(0)).cast("long").alias("table_rows")
    )


def text_lines(spark: SparkSession, path: str, glob: str) -> DataFrame:
    """(file, part, pos, line) of the matching files.

    One task reads a split of a file from front to back, so the split's offset and the running
    id within the task order the lines of the file; the split is the part. Another read may
    cut the splits elsewhere, so store the lines before anything compares places.
    """
    split = F.col("_metadata.file_block_start")
    return (
        spark.read.option("pathGlobFilter", glob)
        .text(path)
        .select(
            F.col("_metadata.file_path").alias("file"),
            split.alias("part"),
            F.struct(
                split.alias("split"), F.monotonically_increasing_id().alias("line_no")
            ).alias("pos"),
            F.col("value").alias("line"),
        )
    )


def read_embedded_table(
    spark: SparkSession,
    path: str,
    columns: Sequence[str] | None = None,
    header_prefix: str = HEADER_PREFIX,
    first_field: str = FIRST_FIELD,
    null_token: str = NULL_TOKEN,
    glob: str = "*.csv",
    keep_file: bool = False,
    work_dir: str | None = None,
) -> DataFrame:
    """The embedded table of every matching file under ``path``.

    Every file, of any size, is read by line, and its lines are first stored with their places
    as Parquet under ``work_dir`` (a new folder in the shared folder if it is not given). That
    folder is the caller's to clear once the result has been used. Without ``columns`` the names
    are those of all files' headers, in the order in which they come first by file and field.
    ``keep_file`` adds the path each row came from.
    """
    require_files(spark, path, glob)
    work_dir = work_dir or scratch_path(spark, "embedded")
    marked = mark_lines(text_lines(spark, path, glob), header_prefix, first_field)
    marked.write.parquet(f"{work_dir}/lines")
    marked = spark.read.parquet(f"{work_dir}/lines")
    table_bounds(marked).write.parquet(f"{work_dir}/bounds")
    bounds = spark.read.parquet(f"{work_dir}/bounds")
    if columns is None:
        columns = _header_names(bounds)
    table = extract_from_lines(marked, columns, null_token, bounds)
    return table if keep_file else table.drop("file")


def _header_names(bounds: DataFrame) -> list[str]:
    """The distinct names of all headers; one value per column reaches the driver."""
    headers = bounds.groupBy("header").agg(F.min("file").alias("file"))
    names = headers.select("file", F.posexplode(F.split("header", ",", -1)).alias("at", "name"))
    first = names.groupBy(_strip(F.col("name")).alias("name")).agg(F.min(F.struct("file", "at")).alias("first"))
    ordered = F.sort_array(F.collect_list(F.struct("first", "name")))["name"]
    return first.where("name != ''").agg(ordered).first()[0]
