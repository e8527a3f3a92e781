"""The library's operators run on the test tables, each beside the SQL it must agree with."""

from workload import cells, climate, counts, filters, joins, nested, reshape, storage, timeline, versions
from workload.registry import REGISTRY, Query

__all__ = [
    "REGISTRY",
    "Query",
    "cells",
    "climate",
    "counts",
    "filters",
    "joins",
    "nested",
    "reshape",
    "storage",
    "timeline",
    "versions",
]
