"""From observations to entities, then to counts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from varve.functions.measures import count_where


def entity_rollup(
    df: DataFrame,
    entity_keys: Sequence[str],
    group_keys: Sequence[str],
    measure: str,
    threshold: float,
    entities: str = "entities",
    intense: str = "intense",
) -> DataFrame:
    """Entities per group, and those whose largest ``measure`` reaches ``threshold``.

    Observations are first reduced to one row per entity and group; counting them directly
    would count an entity once per observation. An entity seen in two groups counts in both.
    Both steps aggregate before they shuffle, so an entity or a group with very many rows
    arrives as one row per task.
    """
    keys = list(dict.fromkeys([*entity_keys, *group_keys]))
    per_entity = df.groupBy(*keys).agg(F.max(measure).alias("_peak"))
    return per_entity.groupBy(*group_keys).agg(
        F.count(F.lit(1)).alias(entities),
        count_where(F.col("_peak") >= threshold).alias(intense),
    )


def distinct_entities(
    df: DataFrame, entity: str, group_keys: Sequence[str], name: str = "entities"
) -> DataFrame:
    """Exact number of different entities per group, largest first.

    The distinct count shuffles by group and entity together, so a large group is spread over
    tasks and only its partial counts meet.
    """
    counted = df.groupBy(*group_keys).agg(F.count_distinct(entity).alias(name))
    return counted.orderBy(F.col(name).desc(), *group_keys)


def entity_totals(
    df: DataFrame,
    entity_keys: Sequence[str],
    levels: Sequence[str],
    measure: str,
    threshold: float,
    entities: str = "entities",
    intense: str = "intense",
    level: str = "level",
) -> DataFrame:
    """:func:`entity_rollup` by all ``levels``, by all but the last, and so on, down to one total.

    ``level`` says by how many levels a row is grouped, so a total (level too low for the column,
    which is NULL) is told from a group whose own value is NULL. An entity of two groups counts
    once in their total, so totals are not sums. All levels come from one reading of the rows,
    which are grouped in each task first.
    """
    sets = [[*entity_keys, *levels[:k]] for k in range(len(levels), -1, -1)]
    sets = [list(dict.fromkeys(s)) for s in sets]
    keys = list(dict.fromkeys([*entity_keys, *levels]))
    dropped = F.bit_count(F.grouping_id())
    per_entity = df.groupingSets(sets, *keys).agg(F.max(measure).alias("_peak"), dropped.alias("_dropped"))
    clash = set(entity_keys) & set(levels)
    if clash:
        raise ValueError(f"levels among the entity's keys: {sorted(clash)}")
    return (
        per_entity.groupBy(*levels, "_dropped")
        .agg(
            F.count(F.lit(1)).alias(entities),
            count_where(F.col("_peak") >= threshold).alias(intense),
        )
        .select(*levels, (F.lit(len(levels)) - F.col("_dropped")).cast("int").alias(level), entities, intense)
    )
