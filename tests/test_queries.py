"""Every registered query against its DuckDB oracle at sf0.001 (driver gate)."""

import duckdb
import pytest

from conftest import SF_SMALL
import __spark_entry__ as E
from logstrata.catalog import QUERIES
from logstrata.oracle import oracle_sql

TABLES = "events".split()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


def _canon(v):
    return round(v, 9) if isinstance(v, float) else v


def _sorted_rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(_canon(r[i]) for i in order) for r in rows), key=repr)


SPARK_TO_DUCK = {"string": "VARCHAR", "int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "date": "DATE"}


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    df = QUERIES[name](spark, SF_SMALL)
    rel = con.sql(oracle_sql()[name])
    assert sorted(df.columns) == sorted(rel.columns)
    duck_types = dict(zip(rel.columns, map(str, rel.types)))
    for col, typ in df.dtypes:
        assert SPARK_TO_DUCK[typ] == duck_types[col], col
    assert _sorted_rows(df.columns, [tuple(r) for r in df.collect()]) == _sorted_rows(rel.columns, rel.fetchall())


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["IP", "count"]
    assert df.count() == 10
