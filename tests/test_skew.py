"""A client that sends a third of all requests: results stay exact and whole."""

from pyspark.sql import functions as F

from conftest import SF_MEDIUM
from logstrata import catalog
from logstrata.operators import metrics as M


def test_hot_client_is_counted_exactly(spark):
    gold = catalog.gold(spark, SF_MEDIUM)
    n = gold.count()
    # rewrite the client of every third request to one hot address
    hot = gold.withColumn("_i", F.monotonically_increasing_id()).withColumn(
        "IP", F.when(F.col("_i") % 3 == 0, F.lit("10.9.9.9")).otherwise(F.col("IP"))
    ).drop("_i").cache()
    hot_rows = hot.filter(F.col("IP") == "10.9.9.9").count()
    assert hot_rows >= n // 3 - 8
    top = M.top_ips(hot).collect()
    assert (top[0].IP, top[0]["count"]) == ("10.9.9.9", hot_rows)
    assert sum(r["count"] for r in M.group_count(hot, "IP").collect()) == n
    others = hot.filter(F.col("IP") != "10.9.9.9").select("IP").distinct().count()
    assert M.distinct_ips(hot).first()[0] == others + 1
    assert M.dashboard_summary(hot).first().distinct_ips == others + 1
    hot.unpersist()
