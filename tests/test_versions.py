"""Complete versions: Gold by path, tables and manifests that are never missing, runs that overlap, data skipping, isolated SQL."""

import os
import subprocess
import sys
import threading
from concurrent.futures import ThreadPoolExecutor

import pytest
from pyspark.sql import functions as F

from conftest import ROOT, SF_SMALL, lines_frame
from logstrata import catalog
from logstrata import constants as C
from logstrata.operators.requests import request_table
from logstrata.plans.audit import open_runs, read_step_log, settle_open_runs
from logstrata.plans.ingest import run_ingest
from logstrata.plans.pipeline import query_step_log, run_pipeline
from logstrata.plans.sql import query_table
from logstrata.session import list_folder
from logstrata.sinks import publish_manifest, publish_parquet, publish_table, read_manifest
from logstrata.sinks.tables import register_table
from logstrata.sinks.versions import Versions, current_path
from logstrata.sources.tables import load_gold


def _log(spark, path, lines, day=1):
    lines_frame(spark, [f'h{i} - - [{day:02d}/Jan/2024:00:00:00 +0000] "GET /p/{i} HTTP/1.1" 200 1' for i in range(lines)]).coalesce(1).write.text(path)
    return path


@pytest.mark.parametrize("by", [None, ["Date"]])
def test_gold_by_path_after_several_runs(spark, scratch, by):
    text, root = catalog.log_text(spark, SF_SMALL), scratch("by-path")
    for _ in range(3):
        result = run_pipeline(spark, text, root, table_name="t_by_path", partition_by=by)
        found = load_gold(spark, path=result.paths.gold)
        assert found.count() == 1000 and found.exceptAll(catalog.gold(spark, SF_SMALL)).isEmpty()
        assert spark.table("t_by_path").count() == 1000


@pytest.mark.parametrize("by", [None, ["Date"]])
def test_readers_during_republishes_see_whole_versions(spark, scratch, by):
    """The n-th publish has n rows on each of two days: all else would be a mixture or a gap."""
    root, name, stop, seen, wrong = scratch("gapless"), f"t_gapless_{len(by or [])}", threading.Event(), [], []
    gold = load_gold(spark, path=_published(spark, scratch, 40))

    def publish(n):
        rows = gold.limit(n).withColumn("Date", F.lit("2024-01-01").cast("date"))
        publish_table(rows.union(rows.withColumn("Date", F.lit("2024-01-02").cast("date"))), name, f"{root}/table", partition_by=by)

    def read():
        while not stop.is_set():
            try:
                counts = [r[1] for r in load_gold(spark, table=name).groupBy("Date").count().collect()]
                by_path = load_gold(spark, path=f"{root}/table").count()
                seen.append((*counts, by_path))
                if len(set(counts)) != 1 or by_path % 2:
                    wrong.append(counts)
            except Exception as exc:  # noqa: BLE001 - any failure is what is tested
                wrong.append(exc)

    publish(1)
    reader = threading.Thread(target=read)
    reader.start()
    for n in range(2, 12):
        publish(n)
    stop.set()
    reader.join()
    assert not wrong and len(seen) > 3
    assert spark.table(name).count() == 22


def _published(spark, scratch, rows):
    root = scratch("published")
    run_ingest(spark, _log(spark, f"{root}/text", rows), f"{root}/gold", f"{root}/manifest", "t_published")
    return f"{root}/gold"


def test_a_manifest_is_always_there_and_only_grows(spark, scratch):
    path, stop, versions, wrong = scratch("manifest"), threading.Event(), [], []
    assert read_manifest(spark, path).count() == 0
    publish_manifest(spark, path, "/data/0", 0)

    def read():
        while not stop.is_set():
            rows = read_manifest(spark, path).collect()
            if len(rows) != 1 or rows[0].path != f"/data/{rows[0].row_count}":
                wrong.append(rows)
            else:
                versions.append(rows[0].version)

    reader = threading.Thread(target=read)
    reader.start()
    for n in range(1, 30):
        publish_manifest(spark, path, f"/data/{n}", n)
    stop.set()
    reader.join()
    assert not wrong and versions == sorted(versions)
    assert read_manifest(spark, path).first().row_count == 29


def test_a_run_that_ends_late_does_not_replace_a_newer_one(spark, scratch):
    root = scratch("late")
    old, new = _log(spark, f"{root}/old", 3), _log(spark, f"{root}/new", 5)
    versions = Versions(spark, f"{root}/gold")
    with versions.writing() as late:  # starts first
        run_ingest(spark, new, f"{root}/gold", f"{root}/manifest", "t_late")
        catalog.layers.bronze_to_gold(spark.read.text(old)).write.parquet(late.path)
        versions.commit(late, row_count=3)
    assert load_gold(spark, path=f"{root}/gold").count() == spark.table("t_late").count() == 5


def test_pruning_leaves_running_versions_alone(spark, scratch):
    root = scratch("prune")
    versions = Versions(spark, root)
    running, killed = versions.claim(), versions.claim()
    for version in (running, killed):
        spark.range(3).write.parquet(version.path)
    for n in range(4):
        with versions.writing() as version:
            spark.range(n).write.parquet(version.path)
            versions.commit(version)
        versions.prune(keep=2)
    assert len(versions.committed()) == 2
    assert spark.read.parquet(running.path).count() == 3
    versions.prune(keep=2, abandoned_seconds=-1)
    assert len([n for n in list_folder(spark, versions.folder) if n.startswith("data-")]) == 2
    with pytest.raises(ValueError):
        with versions.writing() as version:
            spark.range(9).write.parquet(version.path)
            raise ValueError
    assert spark.read.parquet(current_path(spark, root)).count() == 3 and not versions._named("claim")


def test_a_table_of_another_shape_is_replaced(spark, scratch):
    path = _published(spark, scratch, 4)
    spark.sql("DROP TABLE IF EXISTS t_shape")
    spark.sql("CREATE TABLE t_shape (a int) USING parquet")
    register_table(spark, "t_shape", current_path(spark, path))
    assert load_gold(spark, table="t_shape").count() == 4


def test_shuffled_rows_by_date_make_few_files(spark, scratch):
    path = scratch("few-files")
    gold = catalog.gold(spark, SF_SMALL).where("Date IS NOT NULL").repartition(24)
    publish_parquet(gold, path, partition_by=["Date"])
    days = gold.select("Date").distinct().count()
    assert days > 25 and len(spark.read.parquet(path).inputFiles()) == days


def test_a_hot_day_is_split(spark, scratch):
    path, name = scratch("hot-day"), "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    day = F.when(F.col("id") % 3 == 0, F.lit(1)).otherwise(F.col("id") % 20)
    rows = spark.range(0, 60_000, 1, 8).select(day.alias("day"), F.sha2(F.col("id").cast("string"), 256).alias("text"))
    before = spark.conf.get(name)
    spark.conf.set(name, "262144")
    try:
        publish_parquet(rows, path, partition_by=["day"])
    finally:
        spark.conf.set(name, before)
    assert len([f for f in spark.read.parquet(path).inputFiles() if "day=1/" in f]) > 3
    assert spark.read.parquet(path).count() == 60_000


def _rows_scanned(df) -> int:
    """Rows that the Parquet scan handed on."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan()
    node = plan.executedPlan() if hasattr(plan, "executedPlan") and plan.nodeName() == "AdaptiveSparkPlan" else plan
    while node.children().size():
        node = node.children().head()
    return int(node.metrics().apply("numOutputRows").value())


def test_absent_values_read_no_row_group(spark, scratch):
    """Values too many for a dictionary, and wanted ones between the least and the greatest."""
    gold = spark.range(0, 100_000, 1, 2).crossJoin(catalog.gold(spark, SF_SMALL).limit(1))
    gold = gold.withColumn("URI", F.concat(F.lit("/"), F.sha2(F.col("id").cast("string"), 256))).withColumn("IP", F.md5(F.col("id").cast("string"))).drop("id")
    plain, skipped = scratch("plain"), scratch("skip")
    publish_parquet(gold, plain)
    publish_parquet(gold, skipped, sort_by=["Status"], skip_by={"IP": 50_000, "URI": 50_000})
    for absent in ({"ip": "7" * 32}, {"uri": "/8"}, {"ip": ["7" * 32, "8" * 32]}):
        assert _rows_scanned(request_table(load_gold(spark, path=skipped), **absent)) == 0
        assert _rows_scanned(request_table(load_gold(spark, path=plain), **absent)) > 0
    there = gold.first().URI
    assert request_table(load_gold(spark, path=skipped), uri=there).count() == 1


def test_queries_of_several_threads_do_not_mix(spark, scratch):
    paths = []
    for n in range(8):
        paths.append(scratch(f"own-{n}"))
        spark.range(n, n + 1).select("id").write.parquet(paths[-1])

    def ask(n):
        return [query_table(spark, paths[n], "SELECT id, :x AS x FROM logs_temp WHERE id >= :x", args={"x": n}).collect() for _ in range(40)]

    with ThreadPoolExecutor(8) as pool:
        answers = list(pool.map(ask, range(8)))
    assert answers == [[[(n, n)]] * 40 for n in range(8)]
    assert not any(t.isTemporary for t in spark.catalog.listTables())


def test_several_stored_tables_and_the_callers_settings(spark, scratch):
    one, two = scratch("one"), scratch("two")
    spark.range(5).write.parquet(one)
    spark.range(3, 9).write.parquet(two)
    both = query_table(spark, one, "SELECT count(*) FROM logs_temp JOIN other USING (id)", tables={"other": two})
    assert both.first()[0] == 2
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
    try:
        assert query_table(spark, one, "SELECT current_timezone() FROM logs_temp LIMIT 1").first()[0] == "Asia/Tokyo"
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    injected = query_table(spark, one, "SELECT count(*) FROM logs_temp WHERE cast(id AS string) = ?", args=["1' OR '1'='1"])
    assert injected.first()[0] == 0


KILLED = """
import os, sys
sys.path.insert(0, {root!r})
from logstrata.session import get_session
from logstrata.plans import ingest, pipeline
ingest.write_files = lambda *a, **k: os.kill(os.getpid(), 9)
spark = get_session("local[2]", shuffle_partitions=2, conf={{"spark.sql.warehouse.dir": {out!r} + "/warehouse"}})
pipeline.run_pipeline(spark, {text!r}, {out!r}, table_name="t_killed")
"""


def test_a_killed_driver_leaves_its_steps(spark, scratch):
    out = scratch("killed").removeprefix("file:")
    text = _log(spark, f"{out}/text", 5)
    done = subprocess.run([sys.executable, "-c", KILLED.format(root=ROOT, out=out, text=text)], capture_output=True, timeout=120, env={**os.environ})
    assert done.returncode == -9
    rows = query_step_log(spark, f"{out}/step_log", "SELECT PipelineStep, Status FROM logs_temp ORDER BY Timestamp").collect()
    assert [tuple(r) for r in rows] == [(step, C.STATUS_START) for step in (C.STEP_READ, C.STEP_SILVER, C.STEP_GOLD, C.STEP_SAVE)]
    # A good run beside it, in the same log; then the lost one is settled.
    result = run_pipeline(spark, text, out, table_name="t_killed", log_mode="append")
    assert len(open_runs(spark, result.paths.step_log)) == 1
    assert read_step_log(spark, result.paths.step_log).count() == 24 + 4
    assert settle_open_runs(spark, result.paths.step_log, 3600) == []
    assert len(settle_open_runs(spark, result.paths.step_log, 0)) == 1 and open_runs(spark, result.paths.step_log) == []
    assert read_step_log(spark, result.paths.step_log).count() == 28
