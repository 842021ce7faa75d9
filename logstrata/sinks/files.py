"""K1, K4, K5: file outputs of the Gold request table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from logstrata.schemas import GOLD_SCHEMA, MANIFEST_SCHEMA
from logstrata.sinks.versions import Versions

# CSV marker for NULL.  With Spark's defaults (or an extra ``emptyValue``) an
# empty string and NULL become indistinguishable after a round trip, and Gold
# uses both ('' = field absent from the line, NULL = not a number / not a
# date).  A text that itself begins with a backslash gets one more, so none
# reads as the marker; blanks are kept, and a quote is doubled, so that a
# backslash is an ordinary character to the format.
CSV_NULL = "\\N"
_CSV_OPTIONS = {
    "header": True,
    "nullValue": CSV_NULL,
    "ignoreLeadingWhiteSpace": False,
    "ignoreTrailingWhiteSpace": False,
    "quote": '"',
    "escape": '"',
}


def _strings(df: DataFrame, change) -> DataFrame:
    return df.select(*[change(F.col(n)).alias(n) if kind == "string" else F.col(n) for n, kind in df.dtypes])


def arranged(df: DataFrame, single_file: bool = False, partition_by: Sequence[str] | None = None, sort_by: Sequence[str] | None = None) -> DataFrame:
    """``df`` as it goes to the files.

    A single file takes a shuffle to one partition *after* the parallel parse
    (``coalesce(1)`` would pull the whole scan and parse into a single task).
    Partitioned data are rebalanced by the partition columns: adaptive
    execution splits a hot day into parts of the advisory size and joins small
    ones, so a day has about size / advisory size files instead of one for
    each task that met it.  ``sort_by`` sorts the rows within each file.
    """
    if single_file:
        df = df.repartition(1)
    elif partition_by:
        df = df.hint("rebalance", *partition_by)
    return df.sortWithinPartitions(*(partition_by or ()), *sort_by) if sort_by else df


def write_files(
    df: DataFrame,
    path: str,
    fmt: str = "parquet",
    mode: str = "overwrite",
    partition_by: Sequence[str] | None = None,
    max_records_per_file: int | None = None,
    skip_by: dict[str, int] | None = None,
) -> None:
    """Write ``df`` as it is arranged.

    ``skip_by`` gives columns Parquet bloom filters (column -> distinct values
    expected in a row group), so a filter on a value that a row group does not
    hold skips it.
    """
    writer = df.write.mode(mode).format(fmt).option("partitionOverwriteMode", "static")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if max_records_per_file:
        writer = writer.option("maxRecordsPerFile", int(max_records_per_file))
    for column, distinct in (skip_by or {}).items():
        writer = writer.option(f"parquet.bloom.filter.enabled#{column}", "true").option(f"parquet.bloom.filter.expected.ndv#{column}", str(int(distinct)))
    writer.save(path)


def publish_parquet(
    df: DataFrame,
    path: str,
    mode: str = "overwrite",
    single_file: bool = False,
    partition_by: Sequence[str] | None = None,
    max_records_per_file: int | None = None,
    sort_by: Sequence[str] | None = None,
    skip_by: dict[str, int] | None = None,
) -> None:
    """K1: write ``df`` as Parquet (overwrite by default).

    By default every task writes its own file, so parsing and writing stay
    fully parallel; see :func:`arranged` for ``single_file``, ``partition_by``
    (``["Date"]`` lays the data out for partition pruning) and ``sort_by``, and
    :func:`write_files` for ``skip_by``.  An overwrite replaces everything at
    ``path``, whatever the session's partition overwrite mode is.
    """
    write_files(arranged(df, single_file, partition_by, sort_by), path, mode=mode, partition_by=partition_by, max_records_per_file=max_records_per_file, skip_by=skip_by)


def export_csv(df: DataFrame, path: str, mode: str = "overwrite", single_file: bool = False) -> None:
    """K5: CSV export of the (filtered) request table, with a header."""
    out = df.repartition(1) if single_file else df
    out = _strings(out, lambda c: F.when(c.startswith("\\"), F.concat(F.lit("\\"), c)).otherwise(c))
    out.write.mode(mode).options(**_CSV_OPTIONS).csv(path)


def read_csv_export(spark: SparkSession, path: str, schema=GOLD_SCHEMA) -> DataFrame:
    """Read a K5 export back with the Gold schema (no inference pass)."""
    stored = spark.read.schema(schema).options(**_CSV_OPTIONS).option("mode", "FAILFAST").csv(path)
    return _strings(stored, lambda c: F.when(c.startswith("\\"), F.substring(c, 2, 2_147_483_647)).otherwise(c))


def publish_manifest(spark: SparkSession, manifest_path: str, data_path: str, row_count: int, keep: int = 8) -> None:
    """K4: a one-row JSON marker saying "new data at ``data_path``".

    Published only after the data write succeeded, so a consumer that watches
    the folder (a refresh flow) never sees a half-written publish.  Each
    publish adds a file of its own, written aside and renamed; the one with
    the highest version counts, so there is always one to read and an older
    run never hides a newer one.  All but the last ``keep`` are removed.
    """
    versions = Versions(spark, manifest_path)
    versions.commit(versions.claim(), path=data_path, row_count=int(row_count))
    versions.prune(keep)


def read_manifest(spark: SparkSession, manifest_path: str) -> DataFrame:
    """The marker as one row; no row before the first publish."""
    latest = Versions(spark, manifest_path).latest()
    fields = [f.name for f in MANIFEST_SCHEMA]
    return spark.createDataFrame([tuple(latest[f] for f in fields)] if latest else [], MANIFEST_SCHEMA)
