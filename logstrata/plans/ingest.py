"""Raw log text -> Gold Parquet files, publish manifest and catalog table.

The text is scanned exactly once.  Parse and enrichment are projections fused
into the Parquet write; the row count every step reports is observed on that
same write (``DataFrame.observe``) instead of a separate ``count()`` job; the
catalog table is the just-written Gold Parquet itself (registered, metadata
only) or, when another format or location is asked for, a copy made from
that Parquet (columnar, already parsed), never a second parse of the text.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from logstrata import constants as C
from logstrata.operators.layers import bronze_to_silver, silver_to_gold
from logstrata.plans.audit import StepLog
from logstrata.plans.sql import own_session
from logstrata.schemas import GOLD_COLUMNS, GOLD_SCHEMA
from logstrata.sinks.files import arranged, publish_manifest, write_files
from logstrata.sinks.tables import point_table, publish_table
from logstrata.sinks.versions import Versions
from logstrata.sources.text import read_logs


@dataclass
class IngestResult:
    row_count: int
    gold_path: str
    manifest_path: str
    table_name: str
    table_path: str
    counts: dict[str, int] = field(default_factory=dict)  # of lines, and of lines without a request, size or date


def observed_layers(gold: DataFrame, write) -> dict[str, int]:
    """Run ``write`` and return what each layer counts on the way: rows, and rows without a request, a size or a date."""
    obs = Observation(f"layers_{uuid.uuid4().hex[:8]}")
    write(gold.observe(
        obs, F.count(F.lit(1)).alias("rows"), F.count_if((F.col("Method") == "") & (F.col("URI") == "")).alias("no_request"),
        F.count_if(F.col("Bytes").isNull()).alias("no_size"), F.count_if(F.col("Date").isNull()).alias("no_date"),
    ))
    return {name: int(value) for name, value in obs.get.items()}


def observed_write(df: DataFrame, write) -> int:
    """Run ``write(df_with_observer)`` and return the number of rows written."""
    obs = Observation(f"rows_{uuid.uuid4().hex[:8]}")
    write(df.observe(obs, F.count(F.lit(1)).alias("rows")))
    return int(obs.get["rows"])


def _with_splits(spark: SparkSession, split_bytes: int | None) -> SparkSession:
    """``spark``, or a session like it that reads input in splits of ``split_bytes``; the caller's settings stay."""
    if not split_bytes:
        return spark
    own = own_session(spark)
    own.conf.set("spark.sql.files.maxPartitionBytes", str(int(split_bytes)))
    return own


def read_published_gold(spark: SparkSession, gold_path: str) -> DataFrame:
    """Gold Parquet with the contract schema and column order.

    The explicit schema skips footer inference and keeps ``Date`` in place
    when the files are partitioned by it.
    """
    return spark.read.schema(GOLD_SCHEMA).parquet(gold_path).select(*GOLD_COLUMNS)


def run_ingest(
    spark: SparkSession,
    source: str | Iterable[str],
    gold_path: str,
    manifest_path: str,
    table_name: str,
    table_path: str | None = None,
    log: StepLog | None = None,
    fmt: str = "parquet",
    single_file: bool = False,
    partition_by: Sequence[str] | None = None,
    max_records_per_file: int | None = None,
    split_bytes: int | None = None,
    sort_by: Sequence[str] | None = None,
    skip_by: dict[str, int] | None = None,
) -> IngestResult:
    """Text ``source`` to Gold files, table and manifest.

    Every run writes a version of its own under ``gold_path``
    (``load_gold(path=gold_path)`` reads the newest complete one); table and
    then manifest move to it once it is complete, so readers keep the previous
    data during the run and after a failed one.  A run that ends after a newer
    one does not replace it.  All but the last two versions are removed.
    ``split_bytes`` sets the size of the input splits, and so of the output
    files, for this run (the session's setting if not given);
    ``max_records_per_file`` bounds a file's rows; ``sort_by`` and ``skip_by``
    as in :func:`~logstrata.sinks.files.publish_parquet`.
    """
    log = log if log is not None else StepLog()
    versions = Versions(spark, gold_path)
    single = {"single_file": single_file, "partition_by": partition_by, "sort_by": sort_by}
    counts: dict[str, int] = {}

    def write(df: DataFrame) -> None:
        write_files(df, version.path, partition_by=partition_by, max_records_per_file=max_records_per_file, skip_by=skip_by)

    with versions.writing() as version:
        # Lines are read when Gold is written, so the read, the parse and the
        # enrichment have succeeded, and their counts are known, only after that.
        with log.step(C.STEP_READ, f"Reading access log {source}") as read_step:
            bronze = read_logs(_with_splits(spark, split_bytes), source)
            with log.step(C.STEP_SILVER, "Parsing lines into the Silver layer") as silver_step:
                silver = bronze_to_silver(bronze)
                with log.step(C.STEP_GOLD, "Enriching the Silver layer into Gold") as gold_step:
                    gold = silver_to_gold(silver)
                    with log.step(C.STEP_SAVE, f"Writing Gold Parquet to {version.path}"):
                        # The observer sits in the final (writing) stage, where each task's
                        # metrics count once even when tasks are retried; a shuffle for a
                        # single file or for partitions therefore comes before it.
                        counts = observed_layers(arranged(gold, **single), write)
                    gold_step.record_count, gold_step.message = counts["rows"], C.GOLD_MESSAGE.format(**counts)
                silver_step.record_count, silver_step.message = counts["rows"], C.SILVER_MESSAGE.format(**counts)
            rows = read_step.record_count = counts["rows"]
        versions.commit(version, row_count=rows)

    with log.step(C.STEP_TABLE, f"Publishing table {table_name}") as table_step:
        if table_path is None and fmt == "parquet":
            point_table(spark, table_name, versions, partition_by=partition_by)
            table_step.record_count = rows
        else:
            table_path = table_path or f"{gold_path.rstrip('/')}_{fmt}"
            published = read_published_gold(spark, version.path)
            table_step.record_count = observed_write(
                published,
                lambda df: publish_table(df, table_name, table_path, fmt=fmt, partition_by=partition_by),
            )

    with log.step(C.STEP_TRIGGER, f"Publishing manifest {manifest_path}"):
        publish_manifest(spark, manifest_path, version.path, rows)

    versions.prune()
    return IngestResult(rows, version.path, manifest_path, table_name, table_path or version.path, counts)
