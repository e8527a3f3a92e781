"""Keyword search in names, and the request plan of the entities found."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from varve.functions.cells import day_bound
from varve.operators.reshape import split_intervals


def filter_keywords(df: DataFrame, column: str, keywords: Sequence[str]) -> DataFrame:
    """Rows whose text contains any of the ``keywords``, whatever the case of either."""
    name = F.upper(F.col(column))
    return df.where(reduce(or_, [name.contains(F.upper(F.lit(k))) for k in keywords]))


def _keyword_array(keywords: Sequence[str]) -> Column:
    return F.array(*[F.lit(k) for k in keywords])


def first_match(
    df: DataFrame,
    column: str,
    keywords: Sequence[str],
    order: str,
    keep_unmatched: bool = True,
) -> DataFrame:
    """One row per keyword: the first row, by ``order``, whose text contains it.

    The result has the columns of ``df`` after ``keyword``; they are NULL for a keyword found
    nowhere, or such keywords are left out with ``keep_unmatched=False``. Case does not matter;
    ``keyword`` keeps its own. NULL comes last in ``order``, and rows with equal ``order`` are
    told apart by their other columns that have an order.

    The keywords are part of the query, so each row finds its own matches without a join. The
    first row is a minimum, which every task takes before the shuffle: a keyword that matches
    a large share of all rows costs one row per task.
    """
    maps = {f.name for f in df.schema.fields if "map<" in f.dataType.simpleString()}
    others = [c for c in df.columns if c != order and c not in maps]
    place = F.struct(F.col(order).isNull(), order, *others)
    name = F.upper(F.col(column))
    hits = F.filter(_keyword_array(keywords), lambda k: name.contains(F.upper(k)))
    found = (
        filter_keywords(df, column, keywords)
        .select(F.explode(hits).alias("keyword"), F.struct(*df.columns).alias("_row"), place.alias("_place"))
        .groupBy("keyword")
        .agg(F.min_by("_row", "_place").alias("_row"))
    )
    if keep_unmatched:
        wanted = df.sparkSession.range(1).select(
            F.explode(F.array_distinct(_keyword_array(keywords))).alias("keyword")
        )
        found = wanted.join(found, "keyword", "left")
    return found.select("keyword", *[F.col("_row")[c].alias(c) for c in df.columns])


def request_plan(
    entities: DataFrame,
    start: dt.date | str,
    end: dt.date | str,
    days: int = 150,
    request_start: str = "request_start",
    request_end: str = "request_end",
) -> DataFrame:
    """Every entity with every piece of ``[start, end]``, the bounds as request text.

    The pieces follow from the two dates alone, so each row generates them itself; there is no
    join and no shuffle.
    """
    spanned = entities.withColumns(
        {"_from": F.lit(str(start)).cast("date"), "_to": F.lit(str(end)).cast("date")}
    )
    pieces = split_intervals(spanned, "_from", "_to", days, request_start, request_end)
    return pieces.drop("_from", "_to").withColumns(
        {
            request_start: day_bound(request_start),
            request_end: day_bound(request_end, end_of_day=True),
        }
    )
