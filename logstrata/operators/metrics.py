"""Analyses and dashboard metrics over the Gold request table.

Every function is lazy and returns a DataFrame; nothing is collected here.
All aggregations are single-key or global, so Spark plans them as a partial
(map-side) hash aggregate, one hash exchange on the key and a final
aggregate.  The map-side step folds a hot key (one client sending a third of
all requests) into one row per task before the shuffle, so no reducer ever
receives that key's raw rows.  Ranked outputs add the key as a tie-break so
results are deterministic; top-k is planned as ``TakeOrderedAndProject``
(each task keeps only k rows).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logstrata import constants as C
from logstrata.functions.enrich import day_of_week, weekday_name
from logstrata.functions.predicates import has_endpoint, is_client_error


# ---------------------------------------------------------------- building blocks
def row_count(df: DataFrame, name: str = "row_count") -> DataFrame:
    """One-row count."""
    return df.agg(F.count(F.lit(1)).alias(name))


def group_count(df: DataFrame, key: str) -> DataFrame:
    """Requests per value of ``key``; NULL and ``''`` are groups like any other."""
    return df.groupBy(key).agg(F.count(F.lit(1)).alias("count"))


def ranked(counts: DataFrame, key: str, k: int | None = None) -> DataFrame:
    """Order by count desc, key asc; keep the first k when given."""
    out = counts.orderBy(F.col("count").desc(), F.col(key).asc_nulls_first())
    return out.limit(k) if k is not None else out


def distinct_values(df: DataFrame, column: str, name: str) -> DataFrame:
    """A8 + count: number of distinct values, NULL counted as one value.

    Matches ``select(column).distinct().count()``.  Written as a global
    aggregate over the de-duplicated column so it stays a DataFrame.
    """
    return df.select(column).distinct().agg(F.count(F.lit(1)).alias(name))


def _mean_per_day():
    """Dated requests / distinct dates as double; NULL when nothing is dated."""
    d = F.col("Date")
    return F.try_divide(F.count(d).cast("double"), F.count_distinct(d))


def _distinct_with_null(column: str):
    """count(DISTINCT c) plus one when a NULL occurs (same as A8 + count; 0 without rows)."""
    c = F.col(column)
    return F.count_distinct(c) + F.coalesce(F.max(F.when(c.isNull(), 1).otherwise(0)), F.lit(0))


def mean_bytes() -> Column:
    """Mean of Bytes from an integer sum, so its digits do not depend on the order of tasks."""
    return F.try_divide(F.sum("Bytes").cast("double"), F.count("Bytes"))


# ---------------------------------------------------------------- the six analyses
def top_ips(gold: DataFrame, k: int = C.TOP_IPS_K) -> DataFrame:
    """A1: the k clients with most requests (``''`` is a valid client)."""
    return ranked(group_count(gold, "IP"), "IP", k)


def top_endpoints(gold: DataFrame, k: int = C.TOP_ENDPOINTS_K) -> DataFrame:
    """A2: the k most requested endpoints, files and unparsed lines left out."""
    return ranked(group_count(gold.filter(has_endpoint()), "Endpoint"), "Endpoint", k)


def distinct_ips(gold: DataFrame) -> DataFrame:
    """A3."""
    return distinct_values(gold, "IP", "distinct_ips")


def distinct_days(gold: DataFrame) -> DataFrame:
    """A4: lines without a date add one (NULL) day, as in the original."""
    return distinct_values(gold, "Date", "distinct_days")


def response_size(gold: DataFrame) -> DataFrame:
    """Sum, max, min and mean of Bytes in one pass (NULLs ignored)."""
    b = F.col("Bytes")
    return gold.agg(
        F.sum(b).cast("bigint").alias("total_bytes"),
        F.max(b).alias("max_bytes"),
        F.min(b).alias("min_bytes"),
        mean_bytes().alias("avg_bytes"),
    )


def client_errors_by_weekday(gold: DataFrame) -> DataFrame:
    """Client errors (4xx) per weekday name, full ranking."""
    errors = gold.filter(is_client_error(gold.columns))
    return ranked(group_count(errors, "Day_of_Week_Name"), "Day_of_Week_Name")


def worst_error_weekday(gold: DataFrame) -> DataFrame:
    """The weekday with most client errors."""
    errors = gold.filter(is_client_error(gold.columns))
    return ranked(group_count(errors, "Day_of_Week_Name"), "Day_of_Week_Name", 1)


# ---------------------------------------------------------------- dashboard metrics
def total_requests(gold: DataFrame) -> DataFrame:
    """D1 ("total IPs"): number of requests that carry a client field."""
    return gold.agg(F.count("IP").alias("total_requests"))


def mean_requests_per_day(gold: DataFrame) -> DataFrame:
    """D3: dated requests / distinct dates, as double; undated lines excluded."""
    return gold.agg(_mean_per_day().alias("mean_requests_per_day"))


def distinct_uris(gold: DataFrame) -> DataFrame:
    """Distinct URIs, ``''`` (unparsed request) counted as one."""
    return distinct_values(gold, "URI", "distinct_uris")


def requests_by_method(gold: DataFrame) -> DataFrame:
    """D7."""
    return ranked(group_count(gold, "Method"), "Method")


def requests_by_status(gold: DataFrame) -> DataFrame:
    """Requests per status category."""
    return ranked(group_count(gold, "Categoria_Status"), "Categoria_Status")


def requests_by_protocol(gold: DataFrame) -> DataFrame:
    """D11."""
    return ranked(group_count(gold, "Protocol"), "Protocol")


def requests_by_date(gold: DataFrame) -> DataFrame:
    """Requests per calendar day, in date order (NULL first)."""
    return group_count(gold, "Date").orderBy(F.col("Date").asc_nulls_first())


def dashboard_summary(gold: DataFrame) -> DataFrame:
    """D1-D6 as one row from a single scan and a single aggregation.

    The three exact distinct counts are rewritten by Catalyst into one
    ``Expand`` + two-level aggregate, de-duplicated map-side per task, so the
    table is read once instead of once per tile.
    """
    return gold.agg(
        F.count("IP").alias("total_requests"),
        _distinct_with_null("IP").cast("bigint").alias("distinct_ips"),
        _mean_per_day().alias("mean_requests_per_day"),
        _distinct_with_null("Date").cast("bigint").alias("distinct_days"),
        _distinct_with_null("URI").cast("bigint").alias("distinct_uris"),
        mean_bytes().alias("avg_bytes"),
    )


# ---------------------------------------------------------------- dashboard from one scan
def dashboard_cube(gold: DataFrame) -> DataFrame:
    """Requests per date, method, protocol and status category: one scan, one exchange.

    All counts and means of the dashboard except the distinct clients and
    URIs follow from these rows; weekday names follow from the date.
    """
    return gold.groupBy("Date", "Method", "Protocol", "Categoria_Status").agg(
        F.count(F.lit(1)).alias("requests"), F.count("IP").alias("with_ip"),
        F.sum("Bytes").alias("bytes"), F.count("Bytes").alias("sized"),
    )


def dashboard_breakdowns(gold: DataFrame) -> DataFrame:
    """Panel, key (as text) and count, all from one reading of the log.

    Every row of the cube goes to each of its panels, so the log itself is
    read and grouped once.
    """
    return breakdowns_of_cube(dashboard_cube(gold))


def breakdowns_of_cube(cube: DataFrame) -> DataFrame:
    """The panels of :func:`dashboard_breakdowns` from a cube that is at hand."""

    def entry(panel: str, key: Column) -> Column:
        return F.struct(F.lit(panel).alias("panel"), key.cast("string").alias("key"))

    entries = [entry("method", F.col("Method")), entry("status", F.col("Categoria_Status")), entry("protocol", F.col("Protocol")), entry("date", F.col("Date"))]
    error = F.when(is_client_error(cube.columns), entry("error_weekday", weekday_name(day_of_week("Date"))))
    rows = cube.select(F.explode(F.array(*entries, error)).alias("entry"), "requests").where("entry IS NOT NULL")
    return rows.groupBy("entry.panel", "entry.key").agg(F.sum("requests").alias("count"))


def dashboard_totals(gold: DataFrame) -> DataFrame:
    """D1, D3, D4 and D6 from the cube, as one row; counts are 0 and means NULL without rows."""
    return totals_of_cube(dashboard_cube(gold))


def totals_of_cube(cube: DataFrame) -> DataFrame:
    """The row of :func:`dashboard_totals` from a cube that is at hand."""
    dated = F.col("Date").isNotNull()
    days = F.count_distinct("Date")
    return cube.agg(
        F.coalesce(F.sum("with_ip"), F.lit(0)).alias("total_requests"),
        _distinct_with_null("Date").cast("bigint").alias("distinct_days"),
        F.try_divide(F.sum(F.when(dated, F.col("requests"))).cast("double"), days).alias("mean_requests_per_day"),
        F.try_divide(F.sum("bytes").cast("double"), F.sum("sized")).alias("avg_bytes"),
    )
