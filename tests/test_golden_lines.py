"""Edge-case lines with hand-checked Silver/Gold values (FIXTURES.md §2)."""

import datetime as dt

import pytest

from conftest import lines_frame
from logstrata.operators.layers import bronze_to_gold, bronze_to_silver
from logstrata.schemas import GOLD_SCHEMA, SILVER_SCHEMA

T = "[10/Oct/2000:13:55:36 -0700]"
D = dt.date(2000, 10, 10)

# line, IP, Method, URI, Protocol, Status, Bytes, category, endpoint, dated
GOLDEN = [
    (f'10.0.0.1 - - {T} "GET / HTTP/1.0" 200 2326', "10.0.0.1", "GET", "/", "HTTP/1.0", "200", 2326, "Sucesso", "home-page", True),
    (f'10.0.0.1 - - {T} "GET /a/b.png HTTP/1.0" 304 -', "10.0.0.1", "GET", "/a/b.png", "HTTP/1.0", "304", None, "Redirecionamento", "", True),
    (f'10.0.0.2 - - {T} "GET /a" 404 12', "10.0.0.2", "GET", "/a", "", "404", 12, "Erro do Cliente", "a", True),
    (f'10.0.0.2 - - {T} "GET /a b HTTP/1.0" 404 12', "10.0.0.2", "", "", "", "404", 12, "Erro do Cliente", "", True),
    (f'10.0.0.3 - 123 {T} "GET /x/y HTTP/1.1" 500 99', "10.0.0.3", "GET", "/x/y", "HTTP/1.1", "123", 99, "Desconhecido", "x", True),
    (f'10.0.0.3 - - {T} "GET /s?q=1 HTTP/1.1" 200 512 "http://r/x" "Mozilla/5.0 (X11)"', "10.0.0.3", "GET", "/s?q=1", "HTTP/1.1", "200", None, "Sucesso", "s?q=1", True),
    (f'10.0.0.3 - - {T} "GET /s?v=1.5 HTTP/1.1" 200 99999999999', "10.0.0.3", "GET", "/s?v=1.5", "HTTP/1.1", "200", None, "Sucesso", "", True),
    ('10.0.0.3 - - [32/Foo/2000:13:55:36 -0700] "GET //dd HTTP/1.1" 199 5', "10.0.0.3", "GET", "//dd", "HTTP/1.1", "199", 5, "Desconhecido", "", False),
    ("garbage", "garbage", "", "", "", "", None, "Desconhecido", "", False),
    ("", "", "", "", "", "", None, "Desconhecido", "", False),
    (" lead 123 x", "", "", "", "", "123", None, "Desconhecido", "", False),
    (f'10.0.0.4 - - {T} "-" 408 -', "10.0.0.4", "", "", "", "408", None, "Erro do Cliente", "", True),
    (f'10.0.0.5 - - {T} "GET /index.php?id=2 HTTP/1.1" 200 ', "10.0.0.5", "GET", "/index.php?id=2", "HTTP/1.1", "200", None, "Sucesso", "index.php?id=2", True),
]


@pytest.fixture(scope="module")
def gold_rows(spark):
    # collect() keeps the order of the input list (narrow projection only).
    return bronze_to_gold(lines_frame(spark, [g[0] for g in GOLDEN])).collect()


def test_silver_schema(spark):
    df = bronze_to_silver(lines_frame(spark, ["x"]))
    assert [(f.name, f.dataType) for f in df.schema] == [(f.name, f.dataType) for f in SILVER_SCHEMA]


def test_gold_schema(spark):
    df = bronze_to_gold(lines_frame(spark, ["x"]))
    assert [(f.name, f.dataType) for f in df.schema] == [(f.name, f.dataType) for f in GOLD_SCHEMA]


@pytest.mark.parametrize("index", range(len(GOLDEN)))
def test_golden_line(spark, gold_rows, index):
    line, ip, method, uri, proto, status, size, category, endpoint, dated = GOLDEN[index]
    row = gold_rows[index]
    assert (row.IP, row.Method, row.URI, row.Protocol, row.Status, row.Bytes) == (ip, method, uri, proto, status, size)
    assert row.Categoria_Status == category
    assert row.Endpoint == endpoint
    if dated:
        assert (row.Date, row.Day_of_Week, row.Day_of_Week_Name) == (D, 3, "Terça")
        assert row.Timestamp == "10/Oct/2000:13:55:36 -0700"
    else:
        assert (row.Date, row.Day_of_Week, row.Day_of_Week_Name) == (None, None, "desconhecido")


def test_row_order_kept(spark, gold_rows):
    # Guards the index-based comparison above.
    assert [r.IP for r in gold_rows] == [g[1] for g in GOLDEN]


def test_every_weekday_name(spark):
    # 2024-01-07 is a Sunday; one line per day of that week.
    lines = [f'h - - [{d:02d}/Jan/2024:00:00:00 +0000] "GET / HTTP/1.1" 200 1' for d in range(7, 14)]
    rows = bronze_to_gold(lines_frame(spark, lines)).select("Day_of_Week", "Day_of_Week_Name").collect()
    assert [tuple(r) for r in rows] == [
        (1, "Domingo"), (2, "Segunda"), (3, "Terça"), (4, "Quarta"),
        (5, "Quinta"), (6, "Sexta"), (7, "Sábado"),
    ]


@pytest.mark.parametrize(
    "status,category",
    [("100", "Desconhecido"), ("199", "Desconhecido"), ("200", "Sucesso"), ("299", "Sucesso"),
     ("300", "Redirecionamento"), ("399", "Redirecionamento"), ("400", "Erro do Cliente"),
     ("499", "Erro do Cliente"), ("500", "Erro do Servidor"), ("599", "Erro do Servidor"),
     ("600", "Desconhecido"), ("042", "Desconhecido")],
)
def test_status_boundaries(spark, status, category):
    line = f'h - - [01/Jan/2024:00:00:00 +0000] "GET / HTTP/1.1" {status} 1'
    row = bronze_to_gold(lines_frame(spark, [line])).first()
    assert (row.Status, row.Categoria_Status) == (status, category)
