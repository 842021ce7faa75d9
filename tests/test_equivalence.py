"""The staged Silver projection equals the literal fixed patterns.

The literal form below is the specification: each field is one
``regexp_extract`` of the fixed pattern over the whole line and the size is
``try_cast`` to int.  The production form finds the request once and reads
its parts from the match, scans the size from the end of the line and skips
the cast for empty or short tokens.  Both run in Spark (same regex engine),
over text with every character class that matters: all Java line
terminators, vertical tab, quotes, brackets, digits and non-ASCII.
"""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from conftest import lines_frame
from logstrata import constants as C
from logstrata.operators.layers import bronze_to_silver
from logstrata.schemas import SILVER_COLUMNS

CHARS = st.sampled_from(
    list(" \t\n\r\x0b\x0c\u0085  \"[]:/.-?=_")
    + list("0123456789")
    + list("aGETPOSTHTTP")
    + ["é", "\U0001f600"]
)
DIGITS = st.text(st.sampled_from("0123456789"), min_size=1, max_size=14)
PIECES = st.sampled_from(
    ['"GET / HTTP/1.1"', '"GET /a b HTTP/1.0"', '"-"', '"GET /a"', '"x"y z"', "[10/Oct/2000:13:55:36 -0700]", " - - "]
)
TEXT = st.lists(st.one_of(st.text(CHARS, max_size=6), DIGITS, PIECES), max_size=10).map("".join)
LINES = st.lists(TEXT, min_size=1, max_size=60)


def literal_silver(df):
    v = F.col("value")
    return df.select(
        F.regexp_extract(v, C.IP_PATTERN, 1).alias("IP"),
        F.regexp_extract(v, C.TIMESTAMP_PATTERN, 1).alias("Timestamp"),
        F.regexp_extract(v, C.REQUEST_PATTERN, 1).alias("Method"),
        F.regexp_extract(v, C.REQUEST_PATTERN, 2).alias("URI"),
        F.regexp_extract(v, C.REQUEST_PATTERN, 3).alias("Protocol"),
        F.regexp_extract(v, C.STATUS_PATTERN, 1).alias("Status"),
        F.regexp_extract(v, C.BYTES_PATTERN, 1).try_cast("int").alias("Bytes"),
    )


@settings(max_examples=40, deadline=None, suppress_health_check=list(HealthCheck))
@given(LINES)
def test_staged_silver_equals_literal_patterns(spark, lines):
    df = lines_frame(spark, lines)
    fast = [tuple(r) for r in bronze_to_silver(df).select(*SILVER_COLUMNS).collect()]
    spec = [tuple(r) for r in literal_silver(df).collect()]
    assert fast == spec


def test_edge_cases(spark):
    lines = [
        "a 12", "a 12\n", "a 12\r\n", "a 12\u0085", "a 12 x", "a 1 2", "a 12b", " 5", "5",
        "x 2147483647", "x 2147483648", "x 00000000000000012", "x 0", "", "\n",
        'h "GET /x HTTP/1.1" "GET /y HTTP/1.0"', 'h "GET /a b" "POST /c d"', '"A\x0bB C"', '"A\u0085B C"',
    ]
    df = lines_frame(spark, lines)
    assert [tuple(r) for r in bronze_to_silver(df).collect()] == [tuple(r) for r in literal_silver(df).collect()]


HARD = ['"' * 40, "[" * 40, '"a' * 20, '"a ' * 20, "[a" * 20, '"a b' * 15, '""" "" """ "', '[\u2028[x]', "[a\n[b]", "]][[]]", '"GET /' + "a" * 60, '" " "', '"a b"c" d"e', 'x"a b  c"d" e"']


def test_both_sides_of_the_switch(spark):
    """Lines with as many quotes or brackets as the short patterns take, one less and one more, short and long."""
    n = C.FEW_MARKS
    ends = ['"GET /a HTTP/1.1"', '"GET /a"b c"', "[x]", '"a  b"', "[[y] z]", ' "a b" [c]']
    lines = [head * k + gap + end for head in ('"', "[", '"x', '"x ', "[x ", "[\n") for k in (n - 3, n - 2, n - 1, n, n + 1) for gap in ("", " ", "p" * C.SHORT_LINE, " q" * C.SHORT_LINE) for end in ends]
    df = lines_frame(spark, lines)
    assert [tuple(r) for r in bronze_to_silver(df).collect()] == [tuple(r) for r in literal_silver(df).collect()]


def test_long_runs_of_quotes_and_brackets(spark):
    df = lines_frame(spark, HARD + [a + b for a in HARD for b in HARD])
    assert [tuple(r) for r in bronze_to_silver(df).collect()] == [tuple(r) for r in literal_silver(df).collect()]


@settings(max_examples=25, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.text(st.sampled_from(list('""""[[]] \t\r\u0085\u2028ab')), max_size=40), min_size=1, max_size=80))
def test_dense_quotes_and_brackets(spark, lines):
    df = lines_frame(spark, lines)
    assert [tuple(r) for r in bronze_to_silver(df).collect()] == [tuple(r) for r in literal_silver(df).collect()]


def test_unterminated_lines_take_linear_time(spark):
    import time

    n = 16_384
    kinds = ['h - - [x] "GET /' + "a" * n, "h " + "[" * n, "h " + '"' * n, "h " + '"a ' * (n // 3), "h " + '"a b' * (n // 4), "h " + "[a" * (n // 2), "h " + " 1" * (n // 2) + "x"]
    bronze_to_silver(lines_frame(spark, kinds)).collect()
    kinds += [(kind[: C.SHORT_LINE - 8] + " ") for kind in kinds]
    for line in kinds:
        df = bronze_to_silver(lines_frame(spark, [line] * 40).coalesce(1))
        start = time.perf_counter()
        df.collect()
        assert time.perf_counter() - start < 2, line[:20]
