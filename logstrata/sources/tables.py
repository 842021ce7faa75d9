"""Stored Gold data, the stored step log and driver-side step rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from logstrata.schemas import AUDIT_SCHEMA, GOLD_COLUMNS, GOLD_SCHEMA
from logstrata.sinks.versions import current_path


def load_gold(
    spark: SparkSession,
    path: str | None = None,
    table: str | None = None,
    fmt: str = "parquet",
) -> DataFrame:
    """Latest version of the published Gold data, by table name or path.

    A path that publishes versions stands for the one that is complete and
    newest now; later publishes do not disturb a reader that has begun.
    Reading the published columnar copy (instead of re-parsing text) gives
    every analysis column pruning and filter pushdown.  Columns come in
    contract order, also from a table partitioned by date (which stores its
    partition column last).
    """
    if table is not None:
        spark.catalog.refreshTable(table)  # another session may have moved it
        return spark.table(table).select(*GOLD_COLUMNS)
    if path is None:
        raise ValueError("load_gold needs a table name or a path")
    return spark.read.schema(GOLD_SCHEMA).format(fmt).load(current_path(spark, path)).select(*GOLD_COLUMNS)


def step_rows_frame(spark: SparkSession, rows: Sequence[tuple]) -> DataFrame:
    """Driver-side step rows -> DataFrame with the explicit audit schema.

    The schema is explicit because inference fails when every RecordCount
    is None.  The row list is bounded by the number of pipeline steps.
    """
    return spark.createDataFrame(list(rows), AUDIT_SCHEMA)
