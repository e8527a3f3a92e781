"""An episode against its baseline."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from varve.functions.measures import round_half_up, safe_ratio


def episode_vs_baseline(
    episode: DataFrame,
    baseline: DataFrame,
    key: str,
    label: str,
    measure: str,
    baseline_filter: Column | None = None,
    total: str = "episode_total",
    peak: str = "episode_max",
    mean: str = "baseline_mean",
    times: str = "times_baseline",
) -> DataFrame:
    """Per place: total and daily maximum of the episode, daily mean of the baseline, max / mean.

    The baseline is every row given, the episode's own days included, unless
    ``baseline_filter`` narrows it (to one calendar month, say). Both sides group by ``key`` and
    ``label`` but join on ``key`` alone, so a place with two labels in the baseline gives two
    rows. Sorted by the ratio, largest first; the ratio is NULL where the mean is 0.
    """
    if baseline_filter is not None:
        baseline = baseline.where(baseline_filter)
    # Both sides shrink to one row per place before they meet.
    normal = baseline.groupBy(key, label).agg(round_half_up(F.avg(measure), 2).alias(mean))
    event = episode.groupBy(key, label).agg(
        round_half_up(F.sum(measure), 1).alias(total),
        round_half_up(F.max(measure), 1).alias(peak),
    )
    return (
        event.join(normal.select(key, mean), key, "inner")
        .select(label, total, peak, mean, safe_ratio(peak, mean, 1).alias(times))
        .orderBy(F.col(times).desc_nulls_last())
    )
