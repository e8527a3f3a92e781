"""Readers. Schemas are given, or inferred for records from every key of every record."""

from varve.sources.embedded import (
    extract_from_lines,
    extract_from_texts,
    file_report,
    file_report_from_lines,
    mark_lines,
    read_embedded_table,
    table_bounds,
    text_lines,
)
from varve.sources.files import read_records, read_strings, read_typed
from varve.sources.records import (
    broken_records,
    infer_records,
    landing_texts,
    record_keys,
    schema_of_keys,
    undeclared_keys,
)

__all__ = [
    "broken_records",
    "extract_from_lines",
    "extract_from_texts",
    "file_report",
    "file_report_from_lines",
    "infer_records",
    "landing_texts",
    "mark_lines",
    "read_embedded_table",
    "read_records",
    "read_strings",
    "read_typed",
    "record_keys",
    "schema_of_keys",
    "table_bounds",
    "text_lines",
    "undeclared_keys",
]
