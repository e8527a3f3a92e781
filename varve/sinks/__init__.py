"""Writers: documented tables, versions of tables, histories, and raw landings."""

from varve.sinks.landing import land_records
from varve.sinks.tables import (
    comments_from_dictionary,
    describe_field,
    document_table,
    observed,
    save_table,
)
from varve.sinks.versions import merge_landing, publish_table, published_path

__all__ = [
    "comments_from_dictionary",
    "describe_field",
    "document_table",
    "land_records",
    "merge_landing",
    "observed",
    "publish_table",
    "published_path",
    "save_table",
]
