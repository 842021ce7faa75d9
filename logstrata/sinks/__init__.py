"""Sinks: Parquet publish, catalog table, CSV export and publish manifest."""

from logstrata.sinks.files import (
    CSV_NULL,
    export_csv,
    publish_manifest,
    publish_parquet,
    read_csv_export,
    read_manifest,
)
from logstrata.sinks.tables import publish_table, register_table

__all__ = [
    "CSV_NULL",
    "export_csv",
    "publish_manifest",
    "publish_parquet",
    "read_csv_export",
    "read_manifest",
    "publish_table",
    "register_table",
]
