"""Operator 1: embedding near-dedup by int8 tile products with rigorous error bounds.

Equal vectors of one label are one node.  Nodes are dealt into tiles; each
pair of tiles of a label is compared by one product of int8 codes.  A code
and its scale miss the unit vector by a known distance, so every product has
a bound: pairs clear of the threshold on either side are decided by it, the
rest are computed anew in double precision from the original values.  A tile
pair reports link counts by node and a spanning forest of its links, so its
output is at most two rows a node however many pairs link.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, FloatType

from logstrata.llm.common import components, table, written

THRESHOLD = 0.93
TILE = 2048
#: Above the rounding of the single-precision products of codes and scales.
_SLACK = 1e-5


def usable(vector: str) -> F.Column:
    """Not null, not empty, without null or non-finite components, and not zero."""
    v = F.col(vector)
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return F.coalesce(finite & F.exists(v, lambda x: x != 0), F.lit(False))


class _Tile:
    """Unpacked columns of one tile."""

    def __init__(self, row: dict, kind: str):
        self.ids = np.frombuffer(row["ids"], np.int64)
        self.weights = np.frombuffer(row["weights"], np.int64)
        n = len(self.ids)
        self.codes = np.frombuffer(row["codes"], np.int8).reshape(n, -1)
        self.scale, self.error = np.frombuffer(row["bounds"], np.float32).reshape(2, n)
        self.exact = np.frombuffer(row["exact"], kind).reshape(n, -1)


def quantise(vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Int8 codes, scales and distances: unit vector = scale * code + something no longer than the distance."""
    unit = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    unit /= np.linalg.norm(unit, axis=1, keepdims=True)
    scale = (np.abs(unit).max(axis=1) / 127).astype(np.float32)
    codes = np.rint(unit / scale[:, None].astype(np.float64)).astype(np.int8)
    error = np.linalg.norm(unit - codes * scale[:, None].astype(np.float64), axis=1)
    return codes, scale, np.nextafter(error.astype(np.float32), np.float32(np.inf))


def cosine(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Cosines of rows, in double precision."""
    a, b = a.astype(np.float64), b.astype(np.float64)
    a, b = (x / np.abs(x).max(axis=1, keepdims=True) for x in (a, b))
    return (a * b).sum(axis=1) / (np.sqrt((a * a).sum(axis=1)) * np.sqrt((b * b).sum(axis=1)))


def linked(a: _Tile, b: _Tile, threshold: float) -> np.ndarray:
    """Boolean matrix of the links between two tiles."""
    wide = a.codes.shape[1] * 127 * 127 >= 1 << 24  # sums of products stay exact in single precision below that
    kind = np.float64 if wide else np.float32
    about = (a.codes.astype(kind) @ b.codes.astype(kind).T) * a.scale[:, None] * b.scale[None, :]
    # |xy - x'y'| <= |x - x'| |y| + |x'| |y - y'|, with unit x and y.
    bound = a.error[:, None] + (1 + a.error)[:, None] * b.error[None, :] + np.float32(_SLACK)
    links = about - bound >= threshold
    left, right = np.nonzero((about + bound >= threshold) & ~links)
    for start in range(0, len(left), 1 << 16):
        i, j = left[start:start + (1 << 16)], right[start:start + (1 << 16)]
        links[i, j] = cosine(a.exact[i], b.exact[j]) >= threshold
    return links


def forest(links: np.ndarray, same: bool) -> tuple[np.ndarray, np.ndarray]:
    """(node, smallest node connected to it) for all nodes but the smallest; columns follow the rows unless both are the same nodes."""
    rows, columns = links.shape
    left, right = np.nonzero(links)
    right = right if same else right + rows
    label = np.arange(rows if same else rows + columns)
    while True:
        before = label.copy()
        least = np.minimum(label[left], label[right])
        np.minimum.at(label, left, least)
        np.minimum.at(label, right, least)
        label = label[label]
        if np.array_equal(label, before):
            node = np.flatnonzero(label != np.arange(len(label)))
            return node, label[node]


def near_duplicates(
    vectors: DataFrame, threshold: float = THRESHOLD, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", tile_rows: int = TILE
) -> DataFrame:
    """One row for each row of ``vectors``: vec_id, n_links, component_id, kept.

    Vectors are compared only within an equal, non-null label and equal
    length; vectors that are null, empty, zero or hold null or non-finite
    components, and rows without id, link with nothing (n_links 0, component
    their own id).  Equal vectors link.  Rows that repeat an id with the same
    vector count as further copies of it; rows that share an id with
    different vectors are one node of the component graph.  ``kept`` is false
    for a null id.  Other columns are not read; an empty table gives no rows.
    """
    kind = vectors.schema[vector_col].dataType
    exact = "float32" if isinstance(kind, ArrayType) and isinstance(kind.elementType, FloatType) else "float64"
    rows = vectors.select(
        F.col(id_col).cast("long").alias("vec_id"),
        F.when(F.col(label_col).isNotNull() & F.col(id_col).isNotNull() & usable(vector_col), F.col(label_col).cast("string")).alias("label"),
        F.col(vector_col).cast(ArrayType(FloatType()) if exact == "float32" else "array<double>").alias("vector"),
    )
    nodes = rows.where("label IS NOT NULL").groupBy("label", "vector").agg(F.min("vec_id").alias("node"), F.count("*").alias("weight"))
    nodes = written(nodes.withColumn("size", F.size("vector")), "nodes")
    group = ["label", "size"]
    tiles = nodes.groupBy(*group).agg(F.ceil(F.count("*") / tile_rows).cast("int").alias("tiles"))
    placed = nodes.join(tiles, group).withColumn("tile", F.pmod(F.xxhash64("node"), F.col("tiles")).cast("int"))
    packed_type = "label string, size int, tiles int, tile int, ids binary, weights binary, codes binary, bounds binary, exact binary"

    def pack(tile: pa.Table) -> pa.Table:
        first = {c: tile.column(c)[0].as_py() for c in ("label", "size", "tiles", "tile")}
        values = tile.column("vector").combine_chunks().flatten().to_numpy().astype(exact).reshape(tile.num_rows, -1)
        codes, scale, error = quantise(values.astype(np.float64))
        packed = {
            "ids": tile.column("node").to_numpy().astype(np.int64).tobytes(), "weights": tile.column("weight").to_numpy().astype(np.int64).tobytes(),
            "codes": codes.tobytes(), "bounds": np.concatenate([scale, error]).tobytes(), "exact": values.tobytes(),
        }
        schema = [("label", pa.string()), ("size", pa.int32()), ("tiles", pa.int32()), ("tile", pa.int32())] + [(c, pa.binary()) for c in packed]
        return pa.Table.from_pylist([first | packed], schema=pa.schema(schema))

    packed = placed.groupBy(*group, "tiles", "tile").applyInArrow(pack, packed_type)
    # A tile goes to one group for each tile of its label, so each pair of tiles meets once.
    other = F.explode(F.sequence(F.lit(0), F.col("tiles") - 1))
    paired = packed.withColumn("other", other)
    paired = paired.withColumn("low", F.least("tile", "other")).withColumn("high", F.greatest("tile", "other"))

    found_schema = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("n", pa.int64())])

    def compare(pair: pa.Table) -> pa.Table:
        sides = [_Tile(r, exact) for r in pair.to_pylist()]
        same = len(sides) == 1
        one, two = sides[0], sides[-1]
        links = linked(one, two, threshold)
        if same:
            np.fill_diagonal(links, False)
        counts = [(one.ids, links @ two.weights)] + ([] if same else [(two.ids, links.T @ one.weights)])
        ids = one.ids if same else np.concatenate([one.ids, two.ids])
        node, root = forest(links, same)
        a, b, n = [ids[node]], [ids[root]], [np.zeros(len(node), np.int64)]
        for own, count in counts:
            some = np.flatnonzero(count)
            a.append(own[some])
            b.append(own[some])
            n.append(count[some])
        return pa.table([np.concatenate(x) for x in (a, b, n)], schema=found_schema)

    found = written(paired.groupBy(*group, "low", "high").applyInArrow(compare, "a long, b long, n long"), "links")
    links = found.groupBy("a").agg(F.sum("n").alias("links"))
    member = components(found.where("a <> b"), "near-components")
    nodes = nodes.join(links, nodes["node"] == links["a"], "left").drop("a").join(member, "node", "left")
    known = nodes.select("label", "vector", (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("n_links"), F.coalesce("component", "node").alias("component"))
    out = rows.join(known, ["label", "vector"], "left")
    component = F.coalesce("component", "vec_id")
    return out.select(
        "vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"),
        F.coalesce(F.col("vec_id") == component, F.lit(False)).alias("kept"),
    )


def op1_int8_tiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "embeddings"))


OP1_SQL = f"""
WITH RECURSIVE v AS (
    SELECT vec_id, label, embedding::DOUBLE[] AS e FROM embeddings
    WHERE label IS NOT NULL AND embedding IS NOT NULL AND list_sum(list_transform(embedding::DOUBLE[], lambda x: x * x)) > 0
), n AS (
    SELECT vec_id, label, e, sqrt(list_sum(list_transform(e, lambda x: x * x))) AS norm FROM v
), link AS (
    SELECT a.vec_id AS a, b.vec_id AS b FROM n a JOIN n b ON a.label = b.label AND a.vec_id <> b.vec_id
    WHERE list_inner_product(a.e, b.e) / (a.norm * b.norm) >= {THRESHOLD}
), reach AS (
    SELECT vec_id AS a, vec_id AS b FROM embeddings UNION SELECT r.a, l.b FROM reach r JOIN link l ON r.b = l.a
), smallest AS (
    SELECT a, min(b) AS component_id FROM reach GROUP BY a
)
SELECT vec_id, (SELECT count(*) FROM link WHERE link.a = vec_id)::BIGINT AS n_links, component_id, vec_id = component_id AS kept
FROM embeddings JOIN smallest ON a = vec_id
"""
