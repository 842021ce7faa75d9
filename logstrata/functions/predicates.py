"""Row predicates used by the analyses and the request table filter."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from logstrata import constants as C
from logstrata.functions.enrich import status_code


def has_endpoint() -> Column:
    """the request hit a page, not a file and not an unparsed line."""
    return F.col("Endpoint") != ""


def is_client_error(columns: Iterable[str] = ()) -> Column:
    """status in [400, 500).

    On Gold data the stored category says the same thing and, being a plain
    string comparison, reaches the Parquet reader as a pushed ``EqualTo``;
    the numeric range needs a cast that blocks pushdown.  Silver data has no
    category, so it falls back to the range on the status code.
    """
    if "Categoria_Status" in set(columns):
        return F.col("Categoria_Status") == C.CLIENT_ERROR
    code = status_code("Status")
    return (code >= 400) & (code < 500)


def _as_list(value) -> list:
    if isinstance(value, (list, tuple, set, frozenset)):
        return list(value)
    return [value]


def _member(column: str, value) -> Column:
    values = _as_list(value)
    return F.col(column) == values[0] if len(values) == 1 else F.col(column).isin(values)


def request_filter(
    ip=None,
    method=None,
    status_category=None,
    endpoint=None,
    date_from: dt.date | str | None = None,
    date_to: dt.date | str | None = None,
    status=None,
    uri=None,
    protocol=None,
    weekday=None,
    bytes_from: int | None = None,
    bytes_to: int | None = None,
    undated: bool | None = None,
) -> Column | None:
    """conjunction of the optional filters of the request table.

    Each argument is a single value or a collection (``IN``).  Dates are
    inclusive, as are the sizes ``bytes_from`` and ``bytes_to``; ``undated``
    keeps only rows without (True) or with (False) a date.  Returns None when
    no filter was given.  Every term is a
    comparison on a stored column, so all of them push down to Parquet.
    """
    terms: list[Column] = []
    if ip is not None:
        terms.append(_member("IP", ip))
    if method is not None:
        terms.append(_member("Method", method))
    if status_category is not None:
        terms.append(_member("Categoria_Status", status_category))
    if endpoint is not None:
        terms.append(_member("Endpoint", endpoint))
    for column, value in (("Status", status), ("URI", uri), ("Protocol", protocol), ("Day_of_Week_Name", weekday)):
        if value is not None:
            terms.append(_member(column, value))
    if bytes_from is not None:
        terms.append(F.col("Bytes") >= int(bytes_from))
    if bytes_to is not None:
        terms.append(F.col("Bytes") <= int(bytes_to))
    if undated is not None:
        terms.append(F.col("Date").isNull() if undated else F.col("Date").isNotNull())
    if date_from is not None:
        terms.append(F.col("Date") >= F.lit(date_from).cast("date"))
    if date_to is not None:
        terms.append(F.col("Date") <= F.lit(date_to).cast("date"))
    if not terms:
        return None
    cond = terms[0]
    for term in terms[1:]:
        cond = cond & term
    return cond
