"""Column expressions that derive the Gold columns from Silver ones."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from logstrata import constants as C


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def log_date(timestamp: Column | str = "Timestamp") -> Column:
    """Local calendar date of the raw timestamp; the zone offset is ignored.

    The token before the first colon is parsed with ``try_to_date`` so a
    malformed date becomes NULL instead of failing the job under ANSI.
    """
    token = F.regexp_extract(_c(timestamp), C.DATE_TOKEN_PATTERN, 1)
    return F.try_to_date(token, C.DATE_FORMAT)


def day_of_week(date: Column | str = "Date") -> Column:
    """1 = Sunday ... 7 = Saturday; NULL for a NULL date."""
    return F.dayofweek(_c(date))


def weekday_name(day: Column | str = "Day_of_Week") -> Column:
    day = _c(day)
    expr = None
    for number, name in C.WEEKDAY_NAMES.items():
        expr = F.when(day == number, name) if expr is None else expr.when(day == number, name)
    return expr.otherwise(C.UNKNOWN_WEEKDAY)


def status_code(status: Column | str = "Status") -> Column:
    """Status as int, NULL when it is not a number (``''``)."""
    return _c(status).try_cast("int")


def status_category(status: Column | str = "Status") -> Column:
    code = status_code(status)
    expr = None
    for low, high, label in C.STATUS_CATEGORIES:
        cond = (code >= low) & (code < high)
        expr = F.when(cond, label) if expr is None else expr.when(cond, label)
    return expr.otherwise(C.UNKNOWN_CATEGORY)


def is_file_uri(uri: Column | str = "URI") -> Column:
    """URI ends in an extension such as ``.png``."""
    return _c(uri).rlike(C.FILE_URI_PATTERN)


def endpoint(uri: Column | str = "URI") -> Column:
    """``/`` is the home page, files have no endpoint, else the first segment."""
    uri = _c(uri)
    return (
        F.when(uri == C.HOME_URI, C.HOME_ENDPOINT)
        .when(is_file_uri(uri), "")
        .otherwise(F.regexp_extract(uri, C.FIRST_SEGMENT_PATTERN, 1))
    )
