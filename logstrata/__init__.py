"""logstrata: HTTP access-log analytics on Spark DataFrames.

Layers: Bronze (raw lines) -> Silver (parsed fields) -> Gold (enriched
request table), published as Parquet and as a catalog table, with ready-made
analyses, a filtered request table, CSV export and an SQL-queryable step log.
Everything runs on Spark's built-in functions (no UDFs) and is ANSI-safe.
"""

from logstrata.operators import bronze_to_gold, bronze_to_silver, silver_to_gold
from logstrata.plans import run_analyses, run_ingest, run_pipeline
from logstrata.schemas import AUDIT_SCHEMA, GOLD_SCHEMA, SILVER_SCHEMA
from logstrata.session import get_session, scratch_path, shared_dir
from logstrata.sources import access_log_lines, read_logs

__all__ = [
    "bronze_to_gold",
    "bronze_to_silver",
    "silver_to_gold",
    "run_analyses",
    "run_ingest",
    "run_pipeline",
    "AUDIT_SCHEMA",
    "GOLD_SCHEMA",
    "SILVER_SCHEMA",
    "get_session",
    "scratch_path",
    "shared_dir",
    "access_log_lines",
    "read_logs",
]
