"""Structured Streaming entry points (incremental ingest of new log files)."""

from logstrata.streaming.ingest import run_incremental_ingest, start_incremental_ingest

__all__ = ["run_incremental_ingest", "start_incremental_ingest"]
