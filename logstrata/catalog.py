"""Registered queries: one callable ``(spark, sf_dir) -> DataFrame`` per operator.

Every query starts from the ``events`` table of ``sf_dir`` and derives the
access log from it with Spark (one line per event), so its work grows with
the table; nothing runs on a fixed, made-up input.  Outputs that have to be
written (text log, Parquet, table, CSV, manifest, step log) go to fresh
folders under the shared checkpoint folder (:func:`logstrata.session.scratch_path`).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from logstrata import constants as C
from logstrata.operators import layers
from logstrata.operators import metrics as M
from logstrata.operators.requests import request_table
from logstrata.plans.ingest import read_published_gold, run_ingest
from logstrata.plans.pipeline import PipelineResult, query_step_log, run_pipeline
from logstrata.plans.rollup import Rollup, touched_days, update_rollup
from logstrata.plans.sql import error_steps_query, successful_steps_query
from logstrata.session import scratch_path
from logstrata.sinks.files import export_csv, publish_parquet, read_csv_export, read_manifest
from logstrata.sinks.tables import publish_table, register_table
from logstrata.functions.predicates import has_endpoint, is_client_error
from logstrata.sources.events_log import access_log_lines
from logstrata.sources.tables import load_gold
from logstrata.sources.text import read_logs
from logstrata.streaming.ingest import run_incremental_ingest

# Fixed filter of the registered request-table query.
REQUEST_FILTER = {
    "method": ["GET", "POST"],
    "status_category": "Sucesso",
    "date_from": "2024-01-05",
    "date_to": "2024-01-20",
}

#: Days up to this one are in the first part of the log that the rollup queries keep state of.
ROLLUP_UNTIL = "2024-01-15"


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/events.parquet")


def bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    return access_log_lines(events(spark, sf_dir))


def silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    return layers.bronze_to_silver(bronze(spark, sf_dir))


def gold(spark: SparkSession, sf_dir: str) -> DataFrame:
    return layers.silver_to_gold(silver(spark, sf_dir))


def log_text(spark: SparkSession, sf_dir: str) -> str:
    """The events-derived access log written once as text files; returns the folder."""
    path = scratch_path(spark, "access-log-text")
    bronze(spark, sf_dir).write.mode("overwrite").text(path)
    return path


def pipeline_run(spark: SparkSession, sf_dir: str) -> PipelineResult:
    """One full run (ingest, analyses, step log) over the text log of ``sf_dir``."""
    return run_pipeline(spark, log_text(spark, sf_dir), table_name="access_log")


def published(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The Gold table that an ingest of the text log has published, read by name."""
    root = scratch_path(spark, "published")
    name = "access_log_" + root.rsplit("-", 1)[-1]
    run_ingest(spark, log_text(spark, sf_dir), f"{root}/gold", f"{root}/manifest", name)
    return load_gold(spark, table=name)


# ----------------------------------------------------------------- query bodies
def q_text_scan(spark, sf_dir):
    return read_logs(spark, log_text(spark, sf_dir))


def q_gold_from_text(spark, sf_dir):
    return layers.bronze_to_gold(read_logs(spark, log_text(spark, sf_dir)))


def q_endpoint_filter(spark, sf_dir):
    return published(spark, sf_dir).filter(has_endpoint())


def q_client_error_rows(spark, sf_dir):
    g = published(spark, sf_dir)
    return g.filter(is_client_error(g.columns))


def q_request_table_filtered(spark, sf_dir):
    return request_table(published(spark, sf_dir), **REQUEST_FILTER)


def q_parquet_publish(spark, sf_dir):
    path = scratch_path(spark, "gold-parquet")
    publish_parquet(q_gold_from_text(spark, sf_dir), path)
    return read_published_gold(spark, path)


def q_parquet_publish_by_date(spark, sf_dir):
    path = scratch_path(spark, "gold-by-date")
    publish_parquet(q_gold_from_text(spark, sf_dir), path, partition_by=["Date"])
    return read_published_gold(spark, path)


def q_table_publish(spark, sf_dir):
    path = scratch_path(spark, "gold-table")
    name = "access_log_" + path.rsplit("-", 1)[-1]
    publish_table(q_gold_from_text(spark, sf_dir), name, path)
    return load_gold(spark, table=name)


def q_table_publish_by_date(spark, sf_dir):
    path = scratch_path(spark, "gold-table-by-date")
    name = "access_log_" + path.rsplit("-", 1)[-1]
    publish_parquet(q_gold_from_text(spark, sf_dir), path, partition_by=["Date"])
    register_table(spark, name, path, partition_by=["Date"])
    return load_gold(spark, table=name)


def _moved(gold: DataFrame) -> DataFrame:
    """The same log a hundred days later."""
    return gold.withColumn("Date", F.date_add("Date", 100))


def q_parquet_republish_by_date(spark, sf_dir):
    path = scratch_path(spark, "gold-again")
    g = q_gold_from_text(spark, sf_dir)
    publish_parquet(_moved(g), path, partition_by=["Date"])
    publish_parquet(g, path, partition_by=["Date"])
    return read_published_gold(spark, path)


def q_table_republish_by_date(spark, sf_dir):
    path = scratch_path(spark, "gold-table-again")
    name = "access_log_" + path.rsplit("-", 1)[-1]
    g = q_gold_from_text(spark, sf_dir)
    publish_table(_moved(g), name, path, partition_by=["Date"])
    publish_table(g, name, path, partition_by=["Date"])
    return load_gold(spark, table=name)


def q_csv_export(spark, sf_dir):
    path = scratch_path(spark, "gold-csv")
    export_csv(q_gold_from_text(spark, sf_dir), path)
    return read_csv_export(spark, path)


def q_publish_manifest(spark, sf_dir):
    result = pipeline_run(spark, sf_dir)
    return read_manifest(spark, result.paths.manifest).select("row_count")


def q_audit_steps(spark, sf_dir):
    result = pipeline_run(spark, sf_dir)
    return query_step_log(spark, result, "SELECT PipelineStep, Status, RecordCount FROM logs_temp")


def _without_clock(query: str) -> str:
    return query.replace("SELECT *", "SELECT PipelineStep, Status, Message, RecordCount", 1)


def q_audit_success(spark, sf_dir):
    result = pipeline_run(spark, sf_dir)
    return query_step_log(spark, result, _without_clock(successful_steps_query()))


def q_audit_errors(spark, sf_dir):
    """A good run, then one whose source does not exist, in one step log: its failed steps, and what the good run loaded."""
    root = scratch_path(spark, "audit-errors")
    text = log_text(spark, sf_dir)
    result = run_pipeline(spark, text, root, table_name="access_log", log_mode="append")
    try:
        run_pipeline(spark, f"{text}-missing", root, table_name="access_log", log_mode="append")
    except AnalysisException:
        pass  # what is asked of it is the row it leaves
    loaded = f"(SELECT max(RecordCount) FROM logs_temp WHERE PipelineStep = '{C.STEP_TABLE}') AS Loaded"
    return query_step_log(spark, result, error_steps_query().replace("SELECT *", f"SELECT PipelineStep, Status, {loaded}", 1))


def q_streaming_ingest(spark, sf_dir):
    out = scratch_path(spark, "stream-gold")
    run_incremental_ingest(spark, log_text(spark, sf_dir), out, scratch_path(spark, "stream-checkpoint"))
    return read_published_gold(spark, out)


def q_gold_by_path(spark, sf_dir):
    """Three runs to one path, by date: a reader of the path gets the last of them, whole."""
    root, text = scratch_path(spark, "gold-by-path"), log_text(spark, sf_dir)
    name = "access_log_" + root.rsplit("-", 1)[-1]
    for _ in range(3):
        run_ingest(spark, text, f"{root}/gold", f"{root}/manifest", name, partition_by=["Date"])
    return load_gold(spark, path=f"{root}/gold")


def rollup(spark: SparkSession, sf_dir: str) -> Rollup:
    """Dashboard state of a log that came in two parts: the days up to ``ROLLUP_UNTIL``, then the others and the undated lines."""
    root, text = scratch_path(spark, "rollup"), log_text(spark, sf_dir)
    name = "access_log_" + root.rsplit("-", 1)[-1]
    run_ingest(spark, text, f"{root}/gold", f"{root}/manifest", name, partition_by=["Date"])
    gold = load_gold(spark, path=f"{root}/gold")
    early = F.col("Date") <= F.lit(ROLLUP_UNTIL).cast("date")
    update_rollup(spark, gold.where(early), f"{root}/rollup")
    update_rollup(spark, gold, f"{root}/rollup", touched_days(gold.where(~early | F.col("Date").isNull())))
    return Rollup.load(spark, f"{root}/rollup")


def _on_rollup(fn: Callable[[Rollup], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, sf_dir: fn(rollup(spark, sf_dir))


def _on_gold(fn: Callable[[DataFrame], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(published(spark, sf_dir))

    run.__name__ = f"q_{fn.__name__}"
    run.__doc__ = fn.__doc__
    return run


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    # sources and layers
    "text_scan": q_text_scan,
    "silver_parse": silver,
    "gold_enrich": gold,
    "gold_from_text": q_gold_from_text,
    # filters
    "endpoint_filter": q_endpoint_filter,
    "client_error_rows": q_client_error_rows,
    # the six analyses
    "top_ips": _on_gold(M.top_ips),
    "top_endpoints": _on_gold(M.top_endpoints),
    "distinct_ips": _on_gold(M.distinct_ips),
    "distinct_days": _on_gold(M.distinct_days),
    "response_size": _on_gold(M.response_size),
    "client_errors_by_weekday": _on_gold(M.client_errors_by_weekday),
    # dashboard metrics
    "total_requests": _on_gold(M.total_requests),
    "row_count": _on_gold(M.row_count),
    "mean_requests_per_day": _on_gold(M.mean_requests_per_day),
    "distinct_uris": _on_gold(M.distinct_uris),
    "requests_by_method": _on_gold(M.requests_by_method),
    "requests_by_status": _on_gold(M.requests_by_status),
    "requests_by_protocol": _on_gold(M.requests_by_protocol),
    "requests_by_date": _on_gold(M.requests_by_date),
    "worst_error_weekday": _on_gold(M.worst_error_weekday),
    "dashboard_summary": _on_gold(M.dashboard_summary),
    "dashboard_cube": _on_gold(M.dashboard_cube),
    "dashboard_breakdowns": _on_gold(M.dashboard_breakdowns),
    "dashboard_totals": _on_gold(M.dashboard_totals),
    "request_table_filtered": q_request_table_filtered,
    # sinks, read back
    "parquet_publish": q_parquet_publish,
    "parquet_publish_by_date": q_parquet_publish_by_date,
    "parquet_republish_by_date": q_parquet_republish_by_date,
    "table_publish": q_table_publish,
    "table_publish_by_date": q_table_publish_by_date,
    "table_republish_by_date": q_table_republish_by_date,
    "csv_export": q_csv_export,
    "publish_manifest": q_publish_manifest,
    "gold_by_path": q_gold_by_path,
    # dashboard from state kept by day, renewed for part of the days
    "rollup_summary": _on_rollup(Rollup.summary),
    "rollup_breakdowns": _on_rollup(Rollup.breakdowns),
    "rollup_top_ips": _on_rollup(Rollup.top_ips),
    "rollup_top_endpoints": _on_rollup(Rollup.top_endpoints),
    "rollup_response_size": _on_rollup(Rollup.response_size),
    # step log and SQL over it
    "audit_steps": q_audit_steps,
    "audit_success": q_audit_success,
    "audit_errors": q_audit_errors,
    # incremental ingest of new log files
    "streaming_ingest": q_streaming_ingest,
}
