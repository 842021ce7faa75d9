"""Dashboard state by day against the same metrics over all of Gold."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from logstrata import catalog
from logstrata.operators import metrics as M
from logstrata.plans.rollup import Rollup, touched_days, update_rollup
from logstrata.session import list_folder
from logstrata.sinks import publish_parquet
from logstrata.sources.tables import load_gold

METRICS = [
    (Rollup.summary, M.dashboard_summary), (Rollup.breakdowns, M.dashboard_breakdowns), (Rollup.top_ips, M.top_ips), (Rollup.top_endpoints, M.top_endpoints),
    (Rollup.distinct_ips, M.distinct_ips), (Rollup.distinct_uris, M.distinct_uris), (Rollup.distinct_days, M.distinct_days), (Rollup.response_size, M.response_size),
]


def same(spark, root, gold):
    state = Rollup.load(spark, root)
    for ours, full in METRICS:
        found, expected = ours(state), full(gold)
        assert found.columns == expected.columns
        assert sorted(map(tuple, found.collect()), key=repr) == sorted(map(tuple, expected.collect()), key=repr), full.__name__


@pytest.fixture(scope="module")
def gold(spark):
    return catalog.gold(spark, SF_SMALL).cache()


def test_a_day_more_reads_that_day_alone(spark, scratch, gold):
    root, day = scratch("rollup"), dt.date(2024, 1, 9)
    publish_parquet(gold.where(F.col("Date") != F.lit(day)), f"{root}/gold", partition_by=["Date"])
    before = load_gold(spark, path=f"{root}/gold")
    update_rollup(spark, before, f"{root}/rollup")
    same(spark, f"{root}/rollup", before)

    publish_parquet(gold.where(F.col("Date") == F.lit(day)), f"{root}/gold", mode="append", partition_by=["Date"])
    after = load_gold(spark, path=f"{root}/gold")
    plan = after.where(F.col("Date").isin([day]))._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [(Date" in plan or "PartitionFilters: [isnotnull(Date" in plan
    # Only the day's folder can be read: the others are moved out of sight of the update.
    only = spark.read.schema(after.schema).option("basePath", f"{root}/gold").parquet(f"{root}/gold/Date={day}")
    update_rollup(spark, only, f"{root}/rollup", [day])
    same(spark, f"{root}/rollup", after)


def test_undated_rows_vanished_days_and_reruns(spark, scratch, gold):
    root = scratch("rollup-days")
    update_rollup(spark, gold, root)
    less = gold.where("Date IS NOT NULL AND Date <> '2024-01-03'")
    assert "2024-01-03" not in update_rollup(spark, less, root, [None, "2024-01-03"])
    same(spark, root, less)
    for _ in range(3):
        update_rollup(spark, gold, root, [None, "2024-01-03"])
    same(spark, root, gold)
    # the first version is still needed for the other days, those between are gone
    assert len([n for n in list_folder(spark, f"{root}/_versions") if n.startswith("data-")]) <= 3


def test_two_updates_that_overlap_both_count(spark, scratch, gold, monkeypatch):
    from logstrata.plans import rollup

    root = scratch("rollup-two")
    update_rollup(spark, gold.where("Date < '2024-01-10'"), root)
    real = rollup._states
    nested = []

    def states(rows):
        if not nested:  # while the first update writes, another begins and ends
            nested.append(1)
            update_rollup(spark, gold, root, ["2024-01-20"])
        return real(rows)

    monkeypatch.setattr(rollup, "_states", states)
    update_rollup(spark, gold, root, ["2024-01-15"])
    same(spark, root, gold.where("Date < '2024-01-10' OR Date IN (DATE '2024-01-15', DATE '2024-01-20')"))


def test_nothing(spark, scratch, gold):
    root = scratch("rollup-none")
    same(spark, root, gold.limit(0))
    assert update_rollup(spark, gold.limit(0), root) == []
    same(spark, root, gold.limit(0))
    assert touched_days(gold.limit(0)) == []
