"""Operator 10: sharding by a two-pass external shuffle.

Pass one scatters records uniformly into buckets that fit in memory, by a
seeded hash.  Pass two shuffles each bucket (Fisher-Yates, seeded by bucket)
and writes it.  Buckets laid end to end are a random order of all records;
shards are equal runs of that order, so their counts are at most one apart.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from logstrata.llm.common import pieces_for, table, text_bytes, written
from logstrata.session import scratch_path

#: Up to so many buckets, their starts (16 bytes each) are broadcast; beyond, they are joined by shuffle.
BROADCAST_BUCKETS = 200_000


#: Records of one id and text up to this number stay together; more are dealt out by so many.
HOT_ROWS = 4096


def _scattered(docs: DataFrame, kept: list[str], buckets: int, seed: int, id_col: str, text_col: str, hot_rows: int) -> DataFrame:
    """``docs`` with __draw (from id and text) and __bucket.

    Records that repeat one id and text more than ``hot_rows`` times are
    numbered, in salted groups, and each run of ``hot_rows`` numbers draws a
    bucket of its own.  Equal records are interchangeable, so the result does
    not depend on which of them gets which number.
    """
    place = F.shiftrightunsigned(F.monotonically_increasing_id(), 12)
    rows = docs.select(*kept, F.xxhash64(F.lit(seed), F.col(id_col), F.col(text_col)).alias("__draw"), place.alias("__salt"))
    hot = written(rows.groupBy("__draw").agg(F.count("*").alias("__n")).where(F.col("__n") > hot_rows).select("__draw"), "hot-draws")
    single = F.pmod("__draw", F.lit(buckets)).cast("int").alias("__bucket")
    if hot.isEmpty():
        return rows.select(*kept, "__draw", single)
    once = rows.join(hot, "__draw", "left_anti").select(*kept, "__draw", single)
    again = rows.join(hot, "__draw", "left_semi")
    before = Window.partitionBy("__draw").orderBy("__salt").rowsBetween(Window.unboundedPreceding, -1)
    starts = again.groupBy("__draw", "__salt").agg(F.count("*").alias("__n"))
    starts = starts.select("__draw", "__salt", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__start"))
    nth = F.row_number().over(Window.partitionBy("__draw", "__salt").orderBy("__salt")) - 1
    again = again.withColumn("__nth", nth).join(starts, ["__draw", "__salt"])
    run = F.floor((F.col("__start") + F.col("__nth")) / hot_rows)
    return once.union(again.select(*kept, "__draw", F.pmod(F.xxhash64("__draw", run), F.lit(buckets)).cast("int").alias("__bucket")))


def external_shuffle(
    docs: DataFrame, shards: int = 8, seed: int = 20, id_col: str = "doc_id", text_col: str = "text",
    bucket_bytes: int = 16 << 20, path: str | None = None, hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Every record of ``docs`` with ``shard`` and ``slot``, written by shard under ``path`` (or the shared folder) and read back.

    The order depends on the seed and on ids and texts alone, not on how the
    input is partitioned or on retries.  Null ids and null or empty texts are
    ordinary records, repeated rows stay repeated; input columns named shard
    or slot (or beginning with ``__``) are left out.  An empty table gives no rows.
    """
    kept = [c for c in docs.columns if c not in ("shard", "slot") and not c.startswith("__")]
    buckets = pieces_for(docs, text_bytes(text_col), bucket_bytes)
    scattered = _scattered(docs, kept, buckets, seed, id_col, text_col, hot_rows)
    counts = scattered.groupBy("__bucket").agg(F.count("*").alias("__n"))
    before = Window.orderBy("__bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("__bucket", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__start"))
    total = F.lit(counts.agg(F.coalesce(F.sum("__n"), F.lit(0))).first()[0])

    def fisher_yates(bucket: pa.Table) -> pa.Table:
        at = np.argsort(bucket.column("__draw").to_numpy(), kind="stable")
        first = bucket.column("__bucket")[0].as_py()
        at = at[np.random.default_rng([seed, first]).permutation(len(at))]
        place = pa.array(np.arange(len(at), dtype=np.int64))
        return bucket.take(pa.array(at)).drop_columns(["__draw"]).append_column("__place", place)

    schema = scattered.drop("__draw").schema.add("__place", "long")
    shuffled = scattered.groupBy("__bucket").applyInArrow(fisher_yates, schema)
    shuffled = shuffled.join(F.broadcast(starts) if buckets <= BROADCAST_BUCKETS else starts, "__bucket")
    shuffled = shuffled.withColumn("__at", F.col("__start") + F.col("__place")).withColumn("__total", total.cast("long"))
    shard = F.expr(f"cast((__at * {shards}) div __total as int)")
    first = F.expr(f"(shard * __total + {shards - 1}) div {shards}")
    placed = shuffled.withColumn("shard", shard).withColumn("slot", F.col("__at") - first).select(*kept, "slot", "shard")
    path = path or scratch_path(docs.sparkSession, "shards")
    placed.write.partitionBy("shard").parquet(path)
    return docs.sparkSession.read.schema(placed.schema).parquet(path)


def op10_external_shuffle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Law ``rows``: the counts of the eight shards are at most one apart."""
    records = external_shuffle(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return records.select(
        "doc_id", text_bytes().alias("size"), F.crc32(F.coalesce(F.encode("text", "UTF-8"), F.lit(b""))).alias("text_crc32"),
        F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"),
    )
