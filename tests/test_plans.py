"""Physical-plan shape: pushdown, pruning, partial aggregation, top-k, no Python."""

import contextlib
import io

import pytest

from conftest import SF_SMALL
from logstrata import catalog
from logstrata.operators import metrics as M
from logstrata.operators.requests import request_table
from logstrata.plans.ingest import read_published_gold
from logstrata.sinks import publish_parquet


def plan(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode="formatted")
    return buf.getvalue()


@pytest.fixture(scope="module")
def published(spark):
    from logstrata.session import scratch_path

    path = scratch_path(spark, "plans-gold")
    publish_parquet(catalog.gold(spark, SF_SMALL), path, partition_by=["Date"])
    return read_published_gold(spark, path)


def test_top_ips_is_partial_agg_plus_topk(published):
    p = plan(M.top_ips(published))
    assert "TakeOrderedAndProject" in p
    assert p.count("HashAggregate") >= 2  # partial (map side) + final
    assert "ReadSchema: struct<IP:string>" in p


def test_endpoint_filter_pushed_to_parquet(published):
    p = plan(M.top_endpoints(published))
    assert "PushedFilters: [IsNotNull(Endpoint), Not(EqualTo(Endpoint,))]" in p
    assert "ReadSchema: struct<Endpoint:string>" in p


def test_client_error_filter_pushed_to_parquet(published):
    p = plan(M.client_errors_by_weekday(published))
    assert "EqualTo(Categoria_Status,Erro do Cliente)" in p


def test_request_filter_prunes_date_partitions(published):
    p = plan(request_table(published, method="GET", date_from="2024-01-05", date_to="2024-01-06"))
    assert "PartitionFilters: [isnotnull(Date" in p
    assert "EqualTo(Method,GET)" in p


def test_parse_is_one_codegen_stage_without_shuffle(spark):
    p = plan(catalog.q_gold_from_text(spark, SF_SMALL))
    assert "Exchange" not in p
    assert "* Project" in p  # "*" marks operators compiled by whole-stage codegen


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_no_python_in_any_query_plan(spark, name):
    p = plan(catalog.QUERIES[name](spark, SF_SMALL))
    for marker in ("BatchEvalPython", "ArrowEvalPython", "PythonUDF", "FlatMapGroupsInPandas", "MapInPandas"):
        assert marker not in p


FILTERED = {
    "endpoint_filter": "Not(EqualTo(Endpoint,))",
    "top_endpoints": "Not(EqualTo(Endpoint,))",
    "client_error_rows": "EqualTo(Categoria_Status,Erro do Cliente)",
    "client_errors_by_weekday": "EqualTo(Categoria_Status,Erro do Cliente)",
    "worst_error_weekday": "EqualTo(Categoria_Status,Erro do Cliente)",
    "request_table_filtered": "In(Method, [GET,POST])",
}


@pytest.mark.parametrize("name", sorted(FILTERED))
def test_registered_filters_reach_the_published_table(spark, name):
    p = plan(catalog.QUERIES[name](spark, SF_SMALL))
    assert FILTERED[name] in p.replace("In(Method,[GET, POST])", "In(Method, [GET,POST])").replace("In(Method, [GET, POST])", "In(Method, [GET,POST])")
    assert "regexp_extract" not in p


def test_breakdowns_read_the_log_once(published):
    p = plan(M.dashboard_breakdowns(published))
    assert p.count("Scan parquet") == 2  # once in the tree, once in the list of nodes
