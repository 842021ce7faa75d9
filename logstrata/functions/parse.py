"""Column expressions that take one raw access-log line apart (Silver fields).

All are built-in ``regexp_extract`` calls, so they stay inside whole-stage
codegen; no Python runs per row.  ``regexp_extract`` yields ``''`` when the
pattern does not match, so only ``Bytes`` can be NULL for a non-NULL line.

The Silver projection runs in two steps (:func:`silver_tokens`, then
:func:`silver_from_tokens`): the first step finds the request and the size
token once per line, the second reads the parts from those short tokens.
Keeping the tokens as columns of their own stops Spark from evaluating the
line-wide regexes once per consumer (expressions inside ``CASE`` branches
are not shared by subexpression elimination).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from logstrata import constants as C

REQUEST_TOKEN = "_request"
BYTES_TOKEN = "_bytes"


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def ip(line: Column | str = "value") -> Column:
    """First whitespace-free token of the line (client host)."""
    return F.regexp_extract(_c(line), C.IP_PATTERN, 1)


def _few(line: Column, mark: str) -> Column:
    """Whether the line is short or holds at most ``FEW_MARKS`` of ``mark``; the search ends at the first too many."""
    size = F.octet_length(line)
    return (size <= C.SHORT_LINE) | (F.octet_length(F.substring_index(line, mark, C.FEW_MARKS + 1)) == size)


def raw_timestamp(line: Column | str = "value") -> Column:
    """Text inside the first ``[...]`` pair, unparsed."""
    line = _c(line)
    fixed, linear = F.regexp_extract(line, C.TIMESTAMP_PATTERN, 1), F.regexp_extract(line, C.TIMESTAMP_FIRST_PATTERN, 1)
    return F.when(_few(line, "["), fixed).otherwise(linear)


def status(line: Column | str = "value") -> Column:
    """First three-digit token surrounded by whitespace, kept as a string."""
    return F.regexp_extract(_c(line), C.STATUS_PATTERN, 1)


def request(line: Column | str = "value") -> Column:
    """The first ``"METHOD URI [PROTOCOL]"`` match, quotes included, or ``''``."""
    line = _c(line)
    short, linear = F.regexp_extract(line, C.REQUEST_SHORT_PATTERN, 0), F.regexp_extract(line, C.REQUEST_TOKEN_PATTERN, 1)
    return F.when(_few(line, '"'), short).otherwise(linear)


def request_part(request_token: Column | str, group: int) -> Column:
    """Group 1 (method), 2 (URI) or 3 (protocol) of a :func:`request` token."""
    return F.regexp_extract(_c(request_token), C.REQUEST_PARTS_PATTERN, group)


def bytes_token(line: Column | str = "value") -> Column:
    """Trailing digit run preceded by whitespace, or ``''``."""
    return F.regexp_extract(_c(line), C.BYTES_FROM_END_PATTERN, 1)


def bytes_value(token: Column | str) -> Column:
    """A :func:`bytes_token` as int; ``''`` and values above 2^31-1 are NULL.

    Up to nine digits always fit, so only longer tokens take ``try_cast``
    (ANSI-safe); empty tokens never reach a cast at all.
    """
    t = _c(token)
    n = F.length(t)
    return (
        F.when(n == 0, F.lit(None).cast("int"))
        .when(n <= C.INT_SAFE_DIGITS, t.cast("int"))
        .otherwise(t.try_cast("int"))
    )


def silver_tokens(line: Column | str = "value") -> list[Column]:
    """Step 1: every line-wide regex once."""
    return [
        ip(line).alias("IP"),
        raw_timestamp(line).alias("Timestamp"),
        request(line).alias(REQUEST_TOKEN),
        status(line).alias("Status"),
        bytes_token(line).alias(BYTES_TOKEN),
    ]


def silver_from_tokens() -> list[Column]:
    """Step 2: the seven Silver columns, aliased and in contract order."""
    return [
        F.col("IP"),
        F.col("Timestamp"),
        request_part(REQUEST_TOKEN, 1).alias("Method"),
        request_part(REQUEST_TOKEN, 2).alias("URI"),
        request_part(REQUEST_TOKEN, 3).alias("Protocol"),
        F.col("Status"),
        bytes_value(BYTES_TOKEN).alias("Bytes"),
    ]
