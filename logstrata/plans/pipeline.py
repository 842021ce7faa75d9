"""The whole job: ingest (E1), analyses (E2) and the step log (K3)."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass
from typing import Any

from pyspark.sql import DataFrame, SparkSession

from logstrata.constants import SQL_VIEW_NAME
from logstrata.plans.analysis import AnalysisReport, run_analyses
from logstrata.plans.audit import StepLog, read_step_log
from logstrata.plans.ingest import IngestResult, run_ingest
from logstrata.plans.sql import query_frames
from logstrata.session import scratch_path
from logstrata.sources.tables import load_gold


@dataclass
class PipelinePaths:
    gold: str
    manifest: str
    table: str
    step_log: str

    @classmethod
    def under(cls, root: str) -> "PipelinePaths":
        root = root.rstrip("/")
        return cls(f"{root}/gold", f"{root}/manifest", f"{root}/table", f"{root}/step_log")


@dataclass
class PipelineResult:
    paths: PipelinePaths
    table_name: str
    ingest: IngestResult | None
    report: AnalysisReport | None
    log: StepLog


def run_pipeline(
    spark: SparkSession,
    source: str | Iterable[str],
    output_dir: str | None = None,
    table_name: str = "access_log",
    fmt: str = "parquet",
    log_mode: str = "overwrite",
    single_file: bool = False,
    partition_by: Sequence[str] | None = None,
    copy_table: bool = False,
    parallel_analyses: int = 1,
    max_records_per_file: int | None = None,
    split_bytes: int | None = None,
    sort_by: Sequence[str] | None = None,
    skip_by: dict[str, int] | None = None,
) -> PipelineResult:
    """Run E1 then E2 on ``source``; the step log is stored even on failure, and journalled for the case that the driver is killed.

    ``output_dir`` must be a shared location (default: a fresh folder under
    ``spark.checkpoint.dir``).  The table is the Gold Parquet registered in
    the catalog; ``copy_table=True`` (or a non-Parquet ``fmt``) writes a
    separate copy under ``output_dir/table`` instead.  The analyses read the
    published table by name, i.e. the columnar data, not the text;
    ``parallel_analyses`` > 1 runs them as concurrent jobs.
    """
    paths = PipelinePaths.under(output_dir or scratch_path(spark, "pipeline"))
    log = StepLog(spark=spark, path=paths.step_log)
    ingest = report = None
    try:
        ingest = run_ingest(
            spark,
            source,
            gold_path=paths.gold,
            manifest_path=paths.manifest,
            table_name=table_name,
            table_path=paths.table if (copy_table or fmt != "parquet") else None,
            log=log,
            fmt=fmt,
            single_file=single_file,
            partition_by=partition_by,
            max_records_per_file=max_records_per_file,
            split_bytes=split_bytes,
            sort_by=sort_by,
            skip_by=skip_by,
        )
        report = run_analyses(load_gold(spark, table=table_name), log, parallel=parallel_analyses)
    except BaseException as exc:
        # Store the log of the failed run (M4) without hiding why it failed.
        try:
            log.write(spark, paths.step_log, fmt=fmt, mode=log_mode)
        except Exception as log_exc:  # e.g. the table format is not installed
            exc.add_note(f"step log could not be stored at {paths.step_log}: {log_exc}")
        raise
    log.write(spark, paths.step_log, fmt=fmt, mode=log_mode)
    return PipelineResult(paths, table_name, ingest, report, log)


def query_step_log(spark: SparkSession, result: PipelineResult | str, query: str, fmt: str = "parquet", args: Mapping[str, Any] | list | None = None) -> DataFrame:
    """Q1 over the step log of a run, or over the one at a path; runs that were killed are in it as far as they came."""
    path = result if isinstance(result, str) else result.paths.step_log
    return query_frames(spark, {SQL_VIEW_NAME: lambda own: read_step_log(own, path, fmt)}, query, args)
