"""Functions on one text cell. All are built-in expressions, so they stay inside codegen."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the shape of a time of day. It checks the shape only, so 99:99 passes.
HOUR_MINUTE = "^[0-9]{2}:[0-9]{2}$"
# The code of a trace of rain, and the first and last second of a request's day.
TRACE = "Ip"
DAY_START, DAY_END = "T00:00:00UTC", "T23:59:59UTC"

NUMBERS = {"tinyint", "smallint", "int", "integer", "bigint", "long", "float", "double"}


def column(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def safe(c: Column | str, to: str) -> Column:
    """Cast of text that gives NULL where it does not parse.

    Surrounding blanks are ignored. ``NaN``, ``inf`` and ``1e3`` are valid doubles;
    ``18.4`` is not a valid int.

    A failing cast to a number raises and catches an error inside Spark, which costs tens of
    times what a good one does. Blank cells, which fill much of a dirty column, therefore skip
    the cast; so do, for numbers, cells with a comma or with a letter in front that begins no
    number. The tests are kept this short because a wide projection of longer ones grows past
    the method size the JVM compiles.
    """
    text = column(c)
    start = F.ltrim(text)
    if to.lower() in NUMBERS:
        hopeful = (start != "") & (start < "A") | start.rlike("^[nNiI]")
        return F.when(hopeful & ~text.contains(","), text.try_cast(to))
    return F.when(start != "", text.try_cast(to))


def strict_date(c: Column | str) -> Column:
    """Cast to date that fails the query on bad text (ANSI mode)."""
    return column(c).cast("date")


def locale_double(c: Column | str, decimal: str = ",") -> Column:
    """A number written with ``decimal`` as its decimal mark, NULL where it does not parse."""
    return safe(F.replace(column(c), F.lit(decimal), F.lit(".")), "double")


def trace_value(c: Column | str, token: str = TRACE, value: float = 0.0) -> Column:
    """``value`` for the trace code, else the number; a missing cell stays NULL."""
    return F.when(column(c) == token, F.lit(float(value))).otherwise(locale_double(c))


def trace_flag(c: Column | str, token: str = TRACE) -> Column:
    """TRUE for the trace code, FALSE for any other text, NULL for a missing cell."""
    return column(c) == token


def guard(c: Column | str, pattern: str) -> Column:
    """The text where it matches ``pattern``, else NULL."""
    return F.when(column(c).rlike(pattern), column(c))


def label(c: Column | str, labels: Mapping[str, str], default: str) -> Column:
    """The label of a code; ``default`` for an unlisted or missing code."""
    chain = F
    for code, text in labels.items():
        chain = chain.when(column(c) == code, F.lit(text))
    return chain.otherwise(F.lit(default)) if labels else F.lit(default)


def null_token(c: Column | str, token: str) -> Column:
    """NULL where the cell is exactly ``token``."""
    return F.nullif(column(c), F.lit(token))


def day_bound(c: Column | str, end_of_day: bool = False) -> Column:
    """First or last second of a day as text, in UTC: ``2024-01-31T23:59:59UTC``."""
    clock = DAY_END if end_of_day else DAY_START
    return F.concat(F.date_format(column(c), "yyyy-MM-dd"), F.lit(clock))
