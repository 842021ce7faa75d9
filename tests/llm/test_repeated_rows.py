"""A third of all rows without id and text, or all equal: no group gathers them, and results stay the same."""

from collections import Counter

import pytest
from llm_cases import DOCS, prose  # noqa: F401
from pyspark.sql import functions as F

from logstrata.llm import common, sharding


def table(spark, equal, others=2000):
    rows = spark.range(others).select(F.col("id").alias("doc_id"), F.concat(F.lit("text "), F.col("id").cast("string")).alias("text"))
    again = spark.range(others // 2).select(F.lit(equal[0]).cast("long").alias("doc_id"), F.lit(equal[1]).cast("string").alias("text"))
    return rows.union(again).repartition(4)


@pytest.mark.parametrize("equal", [(None, None), (7, "the same")])
def test_rows_are_dealt_evenly(spark, scratch, equal):
    path = scratch("equal")
    table(spark, equal, 20_000).write.parquet(path)
    sizes = spark.read.parquet(path).groupBy(common.dealt(30, "doc_id", "text").alias("piece")).count().collect()
    assert max(r["count"] for r in sizes) <= 2 * 30_000 / 30


@pytest.mark.parametrize("equal", [(None, None), (7, "the same")])
def test_buckets_of_the_shuffle_stay_small_and_its_order_the_same(spark, scratch, equal):
    path = scratch("equal")
    table(spark, equal).write.parquet(path)
    docs = spark.read.parquet(path)
    sizes = sharding._scattered(docs, docs.columns, 30, 20, "doc_id", "text", 10).groupBy("__bucket").count().collect()
    assert max(r["count"] for r in sizes) <= 2 * 3000 / 30
    orders = []
    for parts in (1, 5):
        dealt = sharding.external_shuffle(docs.repartition(parts, F.rand(parts)), bucket_bytes=2000, hot_rows=10)
        orders.append([tuple(r) for r in dealt.orderBy("shard", "slot").select("shard", "slot", "doc_id", "text").collect()])
    assert orders[0] == orders[1] and len(orders[0]) == 3000
    assert max(Counter(o[0] for o in orders[0]).values()) - min(Counter(o[0] for o in orders[0]).values()) <= 1


def test_equal_rows_fill_several_files(spark, scratch):
    from logstrata.llm.tokenfile import read_token_files, write_token_files

    path = scratch("equal")
    table(spark, (7, "the same text once more"), 600).write.parquet(path)
    files = write_token_files(spark.read.parquet(path), file_bytes=2500)
    sizes = [r["docs"] for r in files.collect()]
    assert sum(sizes) == 900 and len(sizes) > 3 and max(sizes) < 300
    rows = sorted(read_token_files(files).collect(), key=lambda r: r["start"])
    assert [r["doc_id"] for r in rows] == sorted(r["doc_id"] for r in rows)
    assert all(b["start"] == a["start"] + a["n_tokens"] for a, b in zip(rows, rows[1:]))


def test_equal_pieces_get_places_of_their_own(spark, scratch, monkeypatch):
    from logstrata.llm import packing

    monkeypatch.setattr(packing, "SALT_ROWS", 50)
    path = scratch("pieces")
    spark.range(900).select(F.lit(None).cast("long").alias("doc_id"), F.lit(0).alias("piece"), F.lit(7).cast("long").alias("length")).write.parquet(path)
    placed = packing.pack(spark.read.parquet(path), capacity=70).collect()
    assert len({(r["sequence_id"], r["offset"]) for r in placed}) == 900
    assert len({r["sequence_id"] for r in placed}) == 90
