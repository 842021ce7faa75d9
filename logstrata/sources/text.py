"""Raw access-log text."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession


def read_logs(
    spark: SparkSession,
    paths: str | Iterable[str],
    line_sep: str | None = None,
    recursive: bool = False,
) -> DataFrame:
    """Bronze: one row per line, column ``value`` (string).

    ``paths`` is any Hadoop path, directory, glob or list of them.  Line
    terminators (``\\n``, ``\\r\\n``) are stripped and blank lines are kept.
    Nothing is counted here: the row count is observed on the first write
    instead of costing an extra full scan.  Uncompressed (or splittable)
    text is split into ``spark.sql.files.maxPartitionBytes`` chunks, so the
    parse runs in parallel; a gzip file is one task, so prefer many files.
    """
    reader = spark.read
    if line_sep is not None:
        reader = reader.option("lineSep", line_sep)
    if recursive:
        reader = reader.option("recursiveFileLookup", "true")
    if isinstance(paths, str):
        return reader.text(paths)
    return reader.text(list(paths))
