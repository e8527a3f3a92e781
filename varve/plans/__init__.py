"""The climate tables: raw layouts, clean layer, aggregate layer, and the run over all of them."""

from varve.plans.aggregates import (
    episode_against_normal,
    monthly_long,
    regional_counts,
    unified_history,
    yearly_summary,
)
from varve.plans.clean import (
    clean_episode,
    clean_gistemp,
    clean_oisst,
    clean_stations,
    clean_tracks,
)
from varve.plans.refresh import Inputs, TableRun, refresh

__all__ = [
    "Inputs",
    "TableRun",
    "clean_episode",
    "clean_gistemp",
    "clean_oisst",
    "clean_stations",
    "clean_tracks",
    "episode_against_normal",
    "monthly_long",
    "refresh",
    "regional_counts",
    "unified_history",
    "yearly_summary",
]
