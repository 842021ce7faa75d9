"""The full request table with optional user filters."""

from __future__ import annotations

from pyspark.sql import DataFrame

from logstrata.functions.predicates import request_filter
from logstrata.schemas import GOLD_COLUMNS


def request_table(gold: DataFrame, **filters) -> DataFrame:
    """All Gold columns of the requests that pass the given filters.

    Keyword arguments: ``ip``, ``method``, ``uri``, ``protocol``, ``status``,
    ``status_category``, ``endpoint``, ``weekday`` (a value or a collection),
    ``date_from``, ``date_to``, ``bytes_from``, ``bytes_to`` (inclusive),
    ``undated`` (True or False).  The
    filter is a plain conjunction on stored columns, so on a Parquet table it
    is pushed into the scan (and prunes ``Date`` partitions when the table is
    partitioned by date).
    """
    cond = request_filter(**filters)
    table = gold.select(*GOLD_COLUMNS)
    return table if cond is None else table.filter(cond)
