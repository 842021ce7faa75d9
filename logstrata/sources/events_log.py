"""Access-log lines derived from an ``events`` table.

The test tables hold no web-server log, so the lines are built from
``events`` by a fixed, integer-only rule (one line per event) that SQL
engines can reproduce exactly.  It is a narrow projection: the number of
lines grows with the events table and the derivation never shuffles.

Layout of a regular line::

    {host}{ident}[{time} +0000] "{method} {uri}{proto}" {status} {bytes}{tail}

with ``e`` = event_id and ``u`` = user_id.  The rule deliberately produces
the awkward cases the parser must survive: empty lines, non-log lines,
unparseable dates, a numeric ident that shadows the status, requests without
a protocol or with a space in the URI, ``-`` and overflowing sizes and
combined-format tails.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# FIXED VALUES of the derivation rule (first match wins in every part).
# ---------------------------------------------------------------------------
EMPTY_LINE_MOD = 389  # e % 389 = 0 -> empty line
GARBAGE_LINE_MOD = 97  # e % 97 = 0 -> the line "garbage"
GARBAGE_LINE = "garbage"
HOST_MODS = (8, 251)  # host = 10.0.{u % 8}.{u % 251}
NUMERIC_IDENT_MOD = 53  # e % 53 = 0 -> ident " - 123 ", else " - - "
BAD_DATE_MOD = 61  # e % 61 = 0 -> time "32/Foo/2024:00:00:00"
BAD_DATE = "32/Foo/2024:00:00:00"
TIME_FORMAT = "dd/MMM/yyyy:HH:mm:ss"
ZONE = " +0000"
METHOD_BY_EVENT_TYPE = {"purchase": "POST", "signup": "PUT", "error": "HEAD"}  # else GET
DEFAULT_METHOD = "GET"
URIS_BY_E_MOD_12 = [
    "/",
    "/home",
    "/products/",  # followed by e % 50
    "/img/logo.png",
    "/search?q=a",
    "/s?v=1.5",
    "/index.php?id=2",
    "//dd",
    "/api/v1/items",
    "/cart/",
    "/static/app.js",
    "/a b",
]
PRODUCT_MOD = 50
PROTO_MOD = 7  # 0 -> " HTTP/1.0", 1 -> none, else " HTTP/1.1"
ERROR_STATUSES_BY_E_MOD_5 = [400, 403, 404, 500, 503]
OTHER_STATUS_BY_E_MOD_9 = {0: 304, 1: 301, 2: 404, 3: 199}  # else 200
DEFAULT_STATUS = 200
DASH_BYTES_MOD = 11  # e % 11 = 0 -> "-"
HUGE_BYTES_MOD = 101  # e % 101 = 0 -> "99999999999"
HUGE_BYTES = "99999999999"
BYTES_FACTOR, BYTES_MOD = 37, 50000  # else (e * 37) % 50000
TAIL_MOD = 29  # e % 29 = 0 -> combined-format tail
TAIL = ' "http://r/x" "Mozilla/5.0 (X11)"'


def _s(c: Column) -> Column:
    return c.cast("string")


def access_log_line(
    event_id: str = "event_id",
    user_id: str = "user_id",
    ts: str = "ts",
    event_type: str = "event_type",
) -> Column:
    """The access-log line of one event, as a string column."""
    e, u, et = F.col(event_id), F.col(user_id), F.col(event_type)

    host = F.concat(F.lit("10.0."), _s(u % HOST_MODS[0]), F.lit("."), _s(u % HOST_MODS[1]))
    ident = F.when(e % NUMERIC_IDENT_MOD == 0, " - 123 ").otherwise(" - - ")
    time = F.when(e % BAD_DATE_MOD == 0, BAD_DATE).otherwise(F.date_format(F.col(ts), TIME_FORMAT))

    method = None
    for kind, verb in METHOD_BY_EVENT_TYPE.items():
        method = F.when(et == kind, verb) if method is None else method.when(et == kind, verb)
    method = method.otherwise(DEFAULT_METHOD)

    k = e % len(URIS_BY_E_MOD_12)
    uri = None
    for i, text in enumerate(URIS_BY_E_MOD_12):
        value = F.concat(F.lit(text), _s(e % PRODUCT_MOD)) if i == 2 else F.lit(text)
        uri = F.when(k == i, value) if uri is None else uri.when(k == i, value)

    p = e % PROTO_MOD
    proto = F.when(p == 0, " HTTP/1.0").when(p == 1, "").otherwise(" HTTP/1.1")

    k5 = e % len(ERROR_STATUSES_BY_E_MOD_5)
    error_status = None
    for i, code in enumerate(ERROR_STATUSES_BY_E_MOD_5):
        error_status = F.when(k5 == i, code) if error_status is None else error_status.when(k5 == i, code)
    k9 = e % 9
    other_status = None
    for i, code in OTHER_STATUS_BY_E_MOD_9.items():
        other_status = F.when(k9 == i, code) if other_status is None else other_status.when(k9 == i, code)
    other_status = other_status.otherwise(DEFAULT_STATUS)
    status = F.when(et == "error", error_status).otherwise(other_status)

    size = (
        F.when(e % DASH_BYTES_MOD == 0, "-")
        .when(e % HUGE_BYTES_MOD == 0, HUGE_BYTES)
        .otherwise(_s((e * BYTES_FACTOR) % BYTES_MOD))
    )
    tail = F.when(e % TAIL_MOD == 0, TAIL).otherwise("")

    regular = F.concat(
        host, ident, F.lit("["), time, F.lit(ZONE + '] "'), method, F.lit(" "), uri, proto,
        F.lit('" '), _s(status), F.lit(" "), size, tail,
    )
    return (
        F.when(e % EMPTY_LINE_MOD == 0, "")
        .when(e % GARBAGE_LINE_MOD == 0, GARBAGE_LINE)
        .otherwise(regular)
    )


def access_log_lines(events: DataFrame) -> DataFrame:
    """Bronze-shaped DataFrame (``value``) with one line per event."""
    return events.select(access_log_line().alias("value"))
