"""DataFrame operators. Each takes and returns DataFrames and starts no job."""

from varve.operators.align import align
from varve.operators.compare import episode_vs_baseline
from varve.operators.history import diff_runs, merge_history
from varve.operators.match import filter_keywords, first_match, request_plan
from varve.operators.nested import explode_elements, read_paths, typed_paths
from varve.operators.quality import quality_report
from varve.operators.reshape import split_intervals, to_long
from varve.operators.rollup import distinct_entities, entity_rollup, entity_totals
from varve.operators.shape import (
    drop_out_of_domain,
    drop_units_row,
    project,
    sample_rows,
    stamp,
    top_k,
)
from varve.operators.sketches import read_sketches, sketch_by, unite_sketches
from varve.operators.timeline import MICROSECONDS, anomaly, as_of_join, moving_mean, range_join

__all__ = [
    "MICROSECONDS",
    "align",
    "anomaly",
    "as_of_join",
    "diff_runs",
    "distinct_entities",
    "drop_out_of_domain",
    "drop_units_row",
    "entity_rollup",
    "entity_totals",
    "episode_vs_baseline",
    "explode_elements",
    "filter_keywords",
    "first_match",
    "merge_history",
    "moving_mean",
    "project",
    "quality_report",
    "range_join",
    "read_paths",
    "read_sketches",
    "request_plan",
    "sample_rows",
    "sketch_by",
    "split_intervals",
    "stamp",
    "to_long",
    "top_k",
    "typed_paths",
    "unite_sketches",
]
