"""Sink round trips (K1, K2, K4, K5), the step log (M1-M4, K3) and SQL (Q1)."""

import pytest
from pyspark.errors import AnalysisException

from conftest import SF_SMALL, lines_frame
from logstrata import catalog
from logstrata import constants as C
from logstrata.operators.layers import bronze_to_gold
from logstrata.plans.audit import StepLog
from logstrata.plans.ingest import read_published_gold
from logstrata.plans.pipeline import query_step_log, run_pipeline
from logstrata.plans.sql import query_table, successful_steps_query
from logstrata.schemas import AUDIT_SCHEMA, GOLD_COLUMNS
from logstrata.sinks import export_csv, publish_manifest, publish_parquet, publish_table, read_csv_export, read_manifest
from logstrata.sinks.versions import current_path
from logstrata.sources.tables import load_gold


def _rows(df):
    return sorted((tuple(r) for r in df.select(*GOLD_COLUMNS).collect()), key=repr)


@pytest.fixture(scope="module")
def gold(spark):
    return catalog.gold(spark, SF_SMALL)


def test_parquet_round_trip(spark, gold, scratch):
    path = scratch("k1")
    publish_parquet(gold, path)
    assert _rows(read_published_gold(spark, path)) == _rows(gold)


def test_parquet_single_file_and_partitioned(spark, gold, scratch):
    one = scratch("k1-one")
    publish_parquet(gold, one, single_file=True)
    files = [f for f in spark.read.parquet(one).inputFiles()]
    assert len(files) == 1
    by_date = scratch("k1-date")
    publish_parquet(gold, by_date, partition_by=["Date"])
    back = read_published_gold(spark, by_date)
    assert back.columns == GOLD_COLUMNS
    assert _rows(back) == _rows(gold)


def test_table_publish_is_external_and_rerun_replaces(spark, gold, scratch):
    path = scratch("k2")
    publish_table(gold, "t_k2", path)
    publish_table(gold.limit(5), "t_k2", path)
    assert spark.table("t_k2").count() == 5
    assert spark.read.parquet(current_path(spark, path)).count() == 5
    kind = [r for r in spark.sql("DESCRIBE TABLE EXTENDED t_k2").collect() if r[0] == "Type"][0][1]
    assert kind.upper() == "EXTERNAL"


def test_csv_keeps_empty_string_and_null_apart(spark, scratch):
    lines = ["garbage", "", 'h - - [01/Jan/2024:00:00:00 +0000] "GET / HTTP/1.1" 200 -']
    g = bronze_to_gold(lines_frame(spark, lines))
    path = scratch("k5")
    export_csv(g, path)
    assert _rows(read_csv_export(spark, path)) == _rows(g)


def test_manifest(spark, scratch):
    path = scratch("k4")
    publish_manifest(spark, path, "/data/gold", 42)
    row = read_manifest(spark, path).first()
    assert (row.path, row.row_count) == ("/data/gold", 42)


def test_step_log_records_start_success_and_error():
    log = StepLog()
    with log.step("a") as out:
        out.record_count = 3
    with pytest.raises(ValueError):
        with log.step("b"):
            raise ValueError("boom")
    assert [(e.step, e.status, e.record_count) for e in log.events] == [
        ("a", "Inicio", None), ("a", "Sucesso", 3), ("b", "Inicio", None), ("b", "Erro", None)
    ]
    assert log.events[-1].message == "boom"
    stamps = [e.timestamp for e in log.events]
    assert stamps == sorted(stamps) and len(set(stamps)) == len(stamps)


def test_step_log_frame_all_counts_null(spark):
    log = StepLog()
    log.record("x", "Inicio")
    df = log.to_frame(spark)
    assert df.schema == AUDIT_SCHEMA and df.first().RecordCount is None


def test_failed_run_still_stores_error_row(spark, scratch):
    out = scratch("bad-run")
    with pytest.raises(AnalysisException):
        run_pipeline(spark, out + "/no-such-log", output_dir=out, table_name="t_bad")
    rows = query_table(spark, out + "/step_log", "SELECT PipelineStep, Status FROM logs_temp WHERE Status = 'Erro'").collect()
    assert [tuple(r) for r in rows] == [(C.STEP_READ, C.STATUS_ERROR)]


def test_pipeline_run_and_sql(spark):
    result = catalog.pipeline_run(spark, SF_SMALL)
    ok = query_step_log(spark, result, successful_steps_query()).collect()
    assert [r.PipelineStep for r in ok] == [
        C.STEP_SAVE, C.STEP_GOLD, C.STEP_SILVER, C.STEP_READ, C.STEP_TABLE, C.STEP_TRIGGER,
        C.STEP_TOP_IPS, C.STEP_TOP_ENDPOINTS, C.STEP_DISTINCT_IPS, C.STEP_DISTINCT_DAYS,
        C.STEP_RESPONSE_SIZE, C.STEP_ERROR_WEEKDAY,
    ]
    counts = {r.PipelineStep: r.RecordCount for r in ok}
    assert counts[C.STEP_READ] == counts[C.STEP_SILVER] == counts[C.STEP_GOLD] == counts[C.STEP_TABLE] == 1000
    assert counts[C.STEP_DISTINCT_IPS] == 17 and counts[C.STEP_DISTINCT_DAYS] == 31
    assert result.report.distinct_ips == 17
    # the view is dropped again after the query was analysed
    assert not any(t.name == C.SQL_VIEW_NAME for t in spark.catalog.listTables())


def test_pipeline_with_table_copy_and_date_partitions(spark, scratch):
    text = catalog.log_text(spark, SF_SMALL)
    result = run_pipeline(
        spark, text, output_dir=scratch("copy-run"), table_name="t_copy", copy_table=True, partition_by=["Date"]
    )
    assert result.ingest.table_path == result.paths.table
    assert spark.table("t_copy").count() == 1000
    assert result.report.distinct_days == 31


def test_parallel_analyses_match_sequential(spark):
    from logstrata.plans.analysis import run_analyses

    gold = catalog.gold(spark, SF_SMALL)
    seq_log, par_log = StepLog(), StepLog()
    seq = run_analyses(gold, seq_log)
    par = run_analyses(gold, par_log, parallel=6)
    assert seq == par
    key = lambda e: (e.step, e.status, e.message, e.record_count)
    assert sorted(map(key, seq_log.events), key=repr) == sorted(map(key, par_log.events), key=repr)


def test_pipeline_in_another_table_format(spark, scratch):
    # ORC is built in; Delta takes the same path where it is installed.
    text = catalog.log_text(spark, SF_SMALL)
    out = scratch("orc-run")
    result = run_pipeline(spark, text, output_dir=out, table_name="t_orc", fmt="orc")
    assert spark.table("t_orc").count() == 1000
    assert load_gold(spark, path=result.paths.table, fmt="orc").count() == 1000
    steps = query_table(spark, result.paths.step_log, "SELECT count(*) FROM logs_temp", fmt="orc").first()[0]
    assert steps == 24


def test_missing_table_format_reports_the_real_error(spark, scratch):
    import importlib.util

    if importlib.util.find_spec("delta") is not None:
        pytest.skip("Delta is installed here")
    text = catalog.log_text(spark, SF_SMALL)
    with pytest.raises(Exception) as info:
        run_pipeline(spark, text, output_dir=scratch("delta-run"), table_name="t_delta", fmt="delta")
    assert "DATA_SOURCE_NOT_FOUND" in str(info.value)
    assert any("step log could not be stored" in note for note in getattr(info.value, "__notes__", []))


def test_ingest_single_file_counts_every_row_once(spark, scratch):
    from logstrata.plans.ingest import run_ingest

    text = catalog.log_text(spark, SF_SMALL)
    root = scratch("single")
    log = StepLog()
    result = run_ingest(spark, text, root + "/gold", root + "/manifest", "t_single", log=log, single_file=True)
    assert result.row_count == 1000
    assert len(spark.read.parquet(result.gold_path).inputFiles()) == 1
    counts = {(e.step, e.status): e.record_count for e in log.events}
    assert counts[(C.STEP_READ, C.STATUS_OK)] == counts[(C.STEP_TABLE, C.STATUS_OK)] == 1000


def test_rerun_by_date_replaces_every_date(spark, scratch):
    """Also in a session that overwrites partitions one by one; table, path, manifest and step log agree."""
    from logstrata.plans.ingest import run_ingest

    line = 'h - - [{:02d}/Jan/2024:00:00:00 +0000] "GET / HTTP/1.1" 200 1'
    root = scratch("rerun")
    for name, days in (("one", (1, 2)), ("two", (3,))):
        spark.createDataFrame([(line.format(d),) for d in days], "value string").write.text(f"{root}/{name}")
    name = "spark.sql.sources.partitionOverwriteMode"
    before = spark.conf.get(name)
    spark.conf.set(name, "dynamic")
    try:
        for source in ("one", "two"):
            log = StepLog()
            result = run_ingest(spark, f"{root}/{source}", f"{root}/gold", f"{root}/manifest", "t_rerun", log=log, partition_by=["Date"])
        publish_parquet(read_published_gold(spark, result.gold_path), f"{root}/direct", partition_by=["Date"])
        publish_parquet(bronze_to_gold(lines_frame(spark, [line.format(9)])), f"{root}/direct", partition_by=["Date"])
    finally:
        spark.conf.set(name, before)
    assert read_published_gold(spark, f"{root}/direct").count() == 1
    counts = {(e.step, e.status): e.record_count for e in log.events}
    assert spark.table("t_rerun").count() == read_manifest(spark, f"{root}/manifest").first().row_count == 1
    assert counts[(C.STEP_TABLE, C.STATUS_OK)] == counts[(C.STEP_READ, C.STATUS_OK)] == 1


@pytest.mark.parametrize("lines", [[], ["garbage", ""], ['h - - [01/Jan/2024:00:00:00 +0000] "GET / HTTP/1.1" 200 -', "x"]])
def test_partitioned_tables_have_the_contract_schema(spark, scratch, lines):
    from logstrata.plans.ingest import run_ingest
    from logstrata.schemas import GOLD_SCHEMA
    from logstrata.sources.tables import load_gold

    root = scratch("contract")
    lines_frame(spark, lines).write.text(f"{root}/text")
    result = run_ingest(spark, f"{root}/text", f"{root}/gold", f"{root}/manifest", "t_contract", partition_by=["Date"])
    for loaded in (load_gold(spark, table="t_contract"), load_gold(spark, path=result.gold_path)):
        assert [(f.name, f.dataType) for f in loaded.schema] == [(f.name, f.dataType) for f in GOLD_SCHEMA]
        assert loaded.count() == len(lines)


CSV_TEXTS = [" 10/Oct/2000 ", " ", "\\N", "", None, '"', 'a"b', "\\", "\\\\N", 'x\\"', "a,b", "é\t ", "#c", "null"]


def test_csv_round_trip_of_hard_texts(spark, scratch):
    from logstrata.schemas import GOLD_SCHEMA

    rows = [(t, t, "GET", t, None, "", None, None, None, t, t, t) for t in CSV_TEXTS]
    g = spark.createDataFrame(rows, GOLD_SCHEMA)
    path = scratch("csv-hard")
    export_csv(g, path)
    assert _rows(read_csv_export(spark, path)) == _rows(g)


def test_csv_round_trip_of_any_text(spark, scratch):
    from hypothesis import HealthCheck, given, settings
    from hypothesis import strategies as st

    from logstrata.schemas import GOLD_SCHEMA

    text = st.one_of(st.none(), st.text(st.sampled_from(list(' \t\\",N\'#aé/[]')), max_size=8))

    @settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
    @given(st.lists(st.tuples(text, text, text), min_size=1, max_size=40))
    def check(rows):
        g = spark.createDataFrame([(a, b, c, a, b, c, 1, None, None, a, b, c) for a, b, c in rows], GOLD_SCHEMA)
        path = scratch("csv-any")
        export_csv(g, path)
        assert _rows(read_csv_export(spark, path)) == _rows(g)

    check()


def test_a_run_that_fails_in_the_middle_leaves_the_published_data(spark, scratch, monkeypatch):
    from logstrata.plans import ingest

    root = scratch("safe")
    lines_frame(spark, ["a", "b"]).write.text(f"{root}/text")
    ingest.run_ingest(spark, f"{root}/text", f"{root}/gold", f"{root}/manifest", "t_safe")
    real = ingest.write_files

    def half(df, path, **options):
        real(df.limit(1), path)
        raise OSError("lost")

    monkeypatch.setattr(ingest, "write_files", half)
    log = StepLog()
    with pytest.raises(OSError):
        ingest.run_ingest(spark, f"{root}/text", f"{root}/gold", f"{root}/manifest", "t_safe", log=log)
    spark.catalog.refreshTable("t_safe")
    assert spark.table("t_safe").count() == 2 and read_manifest(spark, f"{root}/manifest").first().row_count == 2
    assert (C.STEP_READ, C.STATUS_OK) not in {(e.step, e.status) for e in log.events}


def test_old_runs_are_removed_and_files_sized(spark, scratch):
    from logstrata.plans.ingest import run_ingest
    from logstrata.session import delete_folder, list_folder

    root = scratch("versions")
    lines_frame(spark, ["line"] * 100).coalesce(1).write.text(f"{root}/text")
    for _ in range(4):
        result = run_ingest(spark, f"{root}/text", f"{root}/gold", f"{root}/manifest", "t_versions", max_records_per_file=30)
    assert len([n for n in list_folder(spark, f"{root}/gold/_versions") if n.startswith("data-")]) == 2
    assert len(spark.read.parquet(result.gold_path).inputFiles()) == 4
    split = run_ingest(spark, f"{root}/text", f"{root}/gold", f"{root}/manifest", "t_versions", split_bytes=100)
    assert split.row_count == 100 and len(spark.read.parquet(split.gold_path).inputFiles()) > 1
    delete_folder(spark, root)
    assert list_folder(spark, root) == []


def test_step_log_append_keeps_history(spark, scratch):
    path = scratch("history")
    for n in range(2):
        log = StepLog()
        log.record("a", C.STATUS_OK, record_count=n)
        log.write(spark, path, mode="append")
    assert query_table(spark, path, "SELECT sum(RecordCount), count(*) FROM logs_temp").first() == (1, 2)
