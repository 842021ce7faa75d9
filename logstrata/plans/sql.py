"""Q1: ad-hoc SQL over stored tables, seen as the view ``logs_temp`` (and others by name).

Every query has a session of its own, with the settings of the caller's, so
queries of several threads do not see each other's views.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from typing import Any

from pyspark.sql import DataFrame, SparkSession

from logstrata.constants import SQL_VIEW_NAME, STATUS_ERROR, STATUS_OK

Source = Callable[[SparkSession], DataFrame]


def own_session(spark: SparkSession) -> SparkSession:
    """A new session on the same application with the SQL settings of ``spark`` and no views."""
    own = spark.newSession()
    for row in spark.sql("SET").collect():  # the settings that were made, a few rows
        if row["key"].startswith("spark.sql.") and own.conf.isModifiable(row["key"]):
            own.conf.set(row["key"], row["value"])
    own.catalog.setCurrentDatabase(spark.catalog.currentDatabase())
    return own


def query_frames(spark: SparkSession, sources: Mapping[str, Source], query: str, args: Mapping[str, Any] | list | None = None) -> DataFrame:
    """Run ``query`` in a session of its own in which each of ``sources`` is a view; ``args`` are bound, not spliced in."""
    own = own_session(spark)
    for name, source in sources.items():
        source(own).createOrReplaceTempView(name)
    return own.sql(query, args=args)


def query_table(
    spark: SparkSession, path: str, query: str, fmt: str = "parquet", args: Mapping[str, Any] | list | None = None, tables: Mapping[str, str] | None = None
) -> DataFrame:
    """Run ``query`` with the table stored at ``path`` as ``logs_temp``; the result is lazy.

    ``args`` are values for ``:name`` or ``?`` markers in the query; ``tables``
    are further stored tables by view name, e.g. the logs of other runs.
    """
    paths = {SQL_VIEW_NAME: path, **(tables or {})}
    return query_frames(spark, {n: lambda s, p=p: s.read.format(fmt).load(p) for n, p in paths.items()}, query, args)


def error_steps_query() -> str:
    """Failed steps in time order."""
    return f"SELECT * FROM {SQL_VIEW_NAME} WHERE Status = '{STATUS_ERROR}' ORDER BY Timestamp ASC"


def successful_steps_query() -> str:
    """Successful steps in time order."""
    return f"SELECT * FROM {SQL_VIEW_NAME} WHERE Status = '{STATUS_OK}' ORDER BY Timestamp ASC"
