"""Incremental ingest processes each new log file exactly once."""

from pyspark.sql import functions as F

from conftest import SF_SMALL
from logstrata import catalog
from logstrata.plans.ingest import read_published_gold
from logstrata.sources.events_log import access_log_lines
from logstrata.streaming import run_incremental_ingest


def test_incremental_ingest_only_new_files(spark, scratch):
    events = catalog.events(spark, SF_SMALL)
    cut = F.to_timestamp(F.lit("2024-01-16 00:00:00"))
    early, late = events.filter(F.col("ts") < cut), events.filter(F.col("ts") >= cut)
    source = scratch("stream-src")
    out, checkpoint = scratch("stream-out"), scratch("stream-cp")

    # the first half of the month has arrived
    access_log_lines(early).write.text(source)
    run_incremental_ingest(spark, source, out, checkpoint)
    assert read_published_gold(spark, out).count() == early.count()

    # new files land in the same folder: only they are parsed on the next run
    access_log_lines(late).write.mode("append").text(source)
    run_incremental_ingest(spark, source, out, checkpoint)
    gold = read_published_gold(spark, out)
    assert gold.count() == events.count()
    batch = catalog.gold(spark, SF_SMALL)
    assert gold.exceptAll(batch).count() == 0 and batch.exceptAll(gold).count() == 0
