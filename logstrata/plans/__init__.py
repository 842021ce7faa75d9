"""End-to-end plans: ingest, analyses, step log, SQL over stored tables."""

from logstrata.plans.analysis import AnalysisReport, response_size_message, run_analyses
from logstrata.plans.audit import StepEvent, StepLog, read_step_log, settle_open_runs
from logstrata.plans.ingest import IngestResult, read_published_gold, run_ingest
from logstrata.plans.pipeline import PipelinePaths, PipelineResult, query_step_log, run_pipeline
from logstrata.plans.sql import error_steps_query, query_table, successful_steps_query

__all__ = [
    "AnalysisReport",
    "response_size_message",
    "run_analyses",
    "StepEvent",
    "StepLog",
    "read_step_log",
    "settle_open_runs",
    "IngestResult",
    "read_published_gold",
    "run_ingest",
    "PipelinePaths",
    "PipelineResult",
    "query_step_log",
    "run_pipeline",
    "error_steps_query",
    "query_table",
    "successful_steps_query",
]
