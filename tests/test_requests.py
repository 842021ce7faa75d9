"""Every filter of the request table against DuckDB on the same data."""

import duckdb
import pytest

from conftest import SF_SMALL
from logstrata import catalog
from logstrata.operators.requests import request_table
from logstrata.oracle import prelude
from logstrata.schemas import GOLD_COLUMNS

CASES = [
    ({}, "TRUE"),
    ({"ip": "10.0.3.5"}, "\"IP\" = '10.0.3.5'"),
    ({"ip": ["", "garbage"]}, "\"IP\" IN ('', 'garbage')"),
    ({"method": "HEAD"}, "\"Method\" = 'HEAD'"),
    ({"status_category": ["Erro do Cliente", "Erro do Servidor"]}, "\"Categoria_Status\" IN ('Erro do Cliente', 'Erro do Servidor')"),
    ({"endpoint": "home-page"}, "\"Endpoint\" = 'home-page'"),
    ({"date_from": "2024-01-29"}, "\"Date\" >= DATE '2024-01-29'"),
    ({"date_to": "2024-01-02"}, "\"Date\" <= DATE '2024-01-02'"),
    (
        {"method": "GET", "endpoint": ["products", "search?q=a"], "date_from": "2024-01-10", "date_to": "2024-01-12"},
        "\"Method\" = 'GET' AND \"Endpoint\" IN ('products', 'search?q=a') "
        "AND \"Date\" BETWEEN DATE '2024-01-10' AND DATE '2024-01-12'",
    ),
]


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    c.execute(f"CREATE VIEW events AS SELECT * FROM read_parquet('{SF_SMALL}/events.parquet')")
    return c


@pytest.mark.parametrize("filters,where", CASES)
def test_request_filter(spark, con, filters, where):
    got = request_table(catalog.gold(spark, SF_SMALL), **filters)
    assert got.columns == GOLD_COLUMNS
    rows = sorted((tuple(r) for r in got.collect()), key=repr)
    expected = sorted((tuple(r) for r in con.sql(prelude() + f"SELECT * FROM gold WHERE {where}").fetchall()), key=repr)
    assert rows == expected
    if filters:
        assert len(rows) < 1000  # the filter did something


def test_the_remaining_filters(spark):
    from logstrata import catalog
    from logstrata.operators.requests import request_table
    from logstrata.operators import metrics as M
    from conftest import SF_SMALL

    gold = catalog.gold(spark, SF_SMALL).cache()
    rows = gold.collect()
    cases = {
        "status": ("404", lambda r: r.Status == "404"), "uri": (["/", "/home"], lambda r: r.URI in ("/", "/home")),
        "protocol": ("HTTP/1.0", lambda r: r.Protocol == "HTTP/1.0"), "weekday": ("Domingo", lambda r: r.Day_of_Week_Name == "Domingo"),
        "bytes_from": (40_000, lambda r: r.Bytes is not None and r.Bytes >= 40_000), "bytes_to": (100, lambda r: r.Bytes is not None and r.Bytes <= 100),
        "undated": (True, lambda r: r.Date is None),
    }
    for name, (value, keep) in cases.items():
        assert request_table(gold, **{name: value}).count() == sum(map(keep, rows)), name
    assert request_table(gold, undated=False).count() == sum(r.Date is not None for r in rows)

    ranking = [(r["count"], r["Day_of_Week_Name"]) for r in M.client_errors_by_weekday(gold).collect()]
    assert ranking == sorted(ranking, key=lambda x: (-x[0], x[1])) and len(ranking) > 3
    empty = gold.where("false")
    summary = M.dashboard_summary(empty).first()
    assert (summary.distinct_ips, summary.distinct_days, summary.distinct_uris, summary.avg_bytes) == (0, 0, 0, None)
    assert M.dashboard_totals(empty).first()[:2] == (0, 0)
