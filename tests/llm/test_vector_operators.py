import math

import numpy as np
import pytest

VECTORS = "vec_id long, embedding array<float>, label int"


@pytest.fixture(scope="module")
def vectors(spark):
    """Clusters around the threshold, copies, and every kind of vector that takes no part."""
    r = np.random.default_rng(2)
    rows = []
    for cluster in range(12):
        centre = r.normal(size=16)
        for n in range(14):
            rows.append((len(rows), (centre + r.normal(size=16) * r.choice([0.05, 0.2, 0.3])).astype(np.float32).tolist(), cluster % 3))
    copy = rows[5][1]
    rows += [(len(rows) + i, copy, rows[5][2]) for i in range(40)]  # one vector on many rows
    at = len(rows)
    rows += [(at, None, 1), (at + 1, [0.0] * 16, 1), (at + 2, [float("nan")] + [1.0] * 15, 1), (at + 3, [float("inf")] + [1.0] * 15, 1),
             (at + 4, copy, None), (at + 5, [], 1), (None, copy, rows[5][2]), (at + 6, [1.0, 2.0], 1), (at + 7, [3.0e-20 * x for x in copy], rows[5][2])]
    return rows


def usable(v):
    return v is not None and len(v) and all(x is not None and math.isfinite(x) for x in v) and any(v)


def test_near_duplicates_match_brute_force(spark, vectors):
    from pyspark.sql import functions as F

    from logstrata.llm.embeddings import near_duplicates

    known = [(i, np.array(v, np.float32).astype(float), label) for i, v, label in vectors if i is not None and label is not None and usable(v)]
    links = {i: set() for i, _, _ in vectors if i is not None}
    for i, x, a in known:
        for j, y, b in known:
            if i != j and a == b and len(x) == len(y) and x @ y / np.sqrt((x @ x) * (y @ y)) >= 0.93:
                links[i].add(j)
    label = {i: i for i in links}
    for _ in links:
        label = {i: min([label[i]] + [label[j] for j in links[i]]) for i in links}
    df = spark.createDataFrame(vectors, VECTORS).withColumn("node", F.lit("clash")).withColumn("tile", F.lit("clash")).repartition(3)
    got = near_duplicates(df, tile_rows=25).collect()
    assert len(got) == len(vectors)
    for row in got:
        i = row["vec_id"]
        if i is None:
            assert (row["n_links"], row["component_id"], row["kept"]) == (0, None, False)
        else:
            assert (row["n_links"], row["component_id"], row["kept"]) == (len(links[i]), label[i], label[i] == i), i
    assert near_duplicates(df.limit(0)).count() == 0


def test_quantisation_bounds_hold():
    from logstrata.llm.embeddings import quantise

    r = np.random.default_rng(3)
    x = np.concatenate([r.normal(size=(300, 48)), r.normal(size=(20, 48)) * 1e-30, np.eye(48)])
    codes, scale, error = quantise(x)
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    about = (codes.astype(float) * scale[:, None]) @ (codes.astype(float) * scale[:, None]).T
    assert (np.abs(unit @ unit.T - about) <= error[:, None] + (1 + error)[:, None] * error[None, :] + 1e-12).all()


def exact_nearest(rows, k, every=20):
    known = [(i, np.array(v, float)) for i, v, _ in rows if i is not None and usable(v) and len(v) == 16]
    return {i: sorted(((-float(x @ y), j) for j, y in known if j != i))[:k] for i, x in known if i % every == 0}


def test_nearest_is_exact_when_all_leaves_are_opened(spark, vectors):
    from pyspark.sql import functions as F

    from logstrata.llm.forest import nearest

    rows = [(i, None if v is None else [float(np.float32(x)) for x in v], label) for i, v, label in vectors]
    df = spark.createDataFrame(rows, VECTORS).withColumn("leaf", F.lit("clash")).withColumn("score", F.lit("clash")).repartition(3)
    want = exact_nearest(rows, 20)
    got = {}
    for r in nearest(df, df.where("vec_id % 20 = 0"), search_share=1.0).orderBy("query_id", "rank").collect():
        got.setdefault(r["query_id"], []).append((r["score"], r["vec_id"]))
    assert got.keys() == want.keys()
    for query, found in got.items():
        assert len(found) == 20
        assert np.allclose([-s for s, _ in found], [s for s, _ in want[query]], atol=1e-9)
    assert nearest(df.limit(0), df).count() == 0


def test_few_candidates_all_come_back(spark):
    from logstrata.llm.forest import nearest

    df = spark.createDataFrame([(0, [1.0, 0.0], 0), (1, [0.5, 0.5], 0), (2, [0.5, 0.5], 0), (3, [-1.0, 0.0], 0)], VECTORS)
    got = nearest(df, df.where("vec_id = 0"), search_share=1.0).orderBy("rank").collect()
    assert [(r["rank"], r["vec_id"], r["score"]) for r in got] == [(1, 1, 0.5), (2, 2, 0.5), (3, 3, -1.0)]


def test_recall_on_the_table(spark):
    from logstrata.llm.forest import op8_projection_forest

    rows = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet").collect()
    ids, x = np.array([r["vec_id"] for r in rows]), np.array([r["embedding"] for r in rows], float)
    found = {}
    for r in op8_projection_forest(spark, "/root/testdata/sf0.01").collect():
        found.setdefault(r["query_id"], set()).add(r["vec_id"])
    hits = total = 0
    for n in np.flatnonzero(ids % 20 == 0):
        scores = x @ x[n]
        scores[n] = -np.inf
        best = ids[np.lexsort((ids, -scores))[:20]]
        hits, total = hits + len(found[ids[n]] & set(best)), total + 20
    assert hits / total >= 0.9


def test_clustered_vectors_need_a_small_share(spark):
    """100 clusters: the measured share opens under a tenth of the rows, and recall holds."""
    from logstrata.llm.forest import Forest, least_share, nearest

    r = np.random.default_rng(5)
    centres = r.normal(size=(100, 16))
    x = centres[r.integers(0, 100, 6000)] + 0.05 * r.normal(size=(6000, 16))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    forest = Forest(x, 4, 9, 1.0)
    assert least_share(forest, x, 20, 0.96) * 4 < 0.1  # of the rows, in all four trees together
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>").repartition(4)
    found = {}
    for row in nearest(df, df.where("vec_id % 20 = 0")).collect():
        found.setdefault(row["query_id"], set()).add(row["vec_id"])
    hits = 0
    for n in range(0, 6000, 20):
        scores = x @ x[n]
        scores[n] = -np.inf
        hits += len(found[n] & set(np.argsort(-scores)[:20].tolist()))
    assert hits / (300 * 20) >= 0.95


def test_components_of_long_chains_and_stars(spark):
    from logstrata.llm.common import components

    edges = [(i, i + 1) for i in range(0, 40)] + [(100, 100 + i) for i in range(1, 30)] + [(7, 7), (None, 3), (500, 400), (400, 500)]
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {i: 0 for i in range(41)} | {100 + i: 100 for i in range(30)} | {400: 400, 500: 400}
