"""What operators leave in the shared folder, and where token files go."""

from llm_cases import none, odd, odd_rows  # noqa: F401
from pyarrow import fs

from logstrata.session import list_folder, shared_dir


def _left_by(spark, job):
    """Kinds of the tables that stand in the shared folder after ``job`` and did not before."""
    folder = f"{shared_dir(spark)}/logstrata"
    before = set(list_folder(spark, folder))
    out = job()
    return out, sorted(name.rsplit("-", 1)[0] for name in set(list_folder(spark, folder)) - before)


def test_components_leave_their_last_round(spark):
    from logstrata.llm.common import components

    edges = spark.range(200).selectExpr("id AS a", "id + 1 AS b")  # a path: several rounds
    found, left = _left_by(spark, lambda: components(edges, "path"))
    assert left == ["path"]
    assert {(r.node, r.component) for r in found.collect()} == {(n, 0) for n in range(201)}


def test_components_go_with_the_run_they_belong_to(spark):
    from logstrata.llm.common import Scratch, components

    work = Scratch(spark)
    edges = spark.createDataFrame([(1, 2), (3, 2), (None, 4), (5, 5)], "a long, b long")

    def job():
        found = {tuple(r) for r in components(edges, work=work).collect()}
        work.clear()
        return found

    found, left = _left_by(spark, job)
    assert found == {(1, 1), (2, 1), (3, 1)} and left == []


def test_jaccard_groups_leave_the_groups_alone(spark, odd, none):  # noqa: F811
    from logstrata.llm.jaccard import near_duplicate_groups

    for docs in (odd, none):
        found, left = _left_by(spark, lambda: near_duplicate_groups(docs, chunk_bytes=20_000))
        assert left == ["groups"]
        assert found.count() == docs.count()


def test_pipeline_leaves_its_last_table(spark):
    import corpus_pipeline

    found, left = _left_by(spark, lambda: corpus_pipeline.run(spark, "/root/testdata/sf0.001"))
    assert [name for name in left if name in {n.replace(" ", "-") for n, _ in corpus_pipeline.STAGES}] == ["best-fit-packing"]
    assert found.count()


def test_token_files_go_to_stores_under_their_hadoop_names(monkeypatch):
    from logstrata.llm import tokenfile

    assert tokenfile._SCHEMES["s3a"] == "s3"
    monkeypatch.setitem(tokenfile._SCHEMES, "shared", "file")
    for path in ("shared:///data/x", "file:///data/x", "/data/x"):
        store, name = tokenfile.store_of(path)
        assert isinstance(store, fs.LocalFileSystem) and name == "/data/x"
