"""Operator 8: approximate nearest neighbours by a forest of random-projection trees.

Trees are grown on a bounded sample: each node splits at the median of the
projection on the difference of two random points.  Every vector is then sent
down every tree.  A query searches all trees through one priority queue,
always opening the branch with the least squared distance to its cell, until
its share of the small leaves is found; the vectors of these leaves, and no
others, are ranked exactly in double precision.  Inner products become
distances by one more coordinate that lifts all vectors to the same norm.

The share is measured: queries from the sample are searched in the sample and
compared with brute force there, and the least share that reaches the wanted
recall is taken.  Subtrees of some thousand vectors travel together; a query
visits a subtree once, with the list of leaves it opens there.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from logstrata.llm.common import table, written
from logstrata.llm.embeddings import usable

NEAREST = 20
EVERY = 20
TREES = 4
SAMPLE = 20_000
LEAF_ROWS = 128
FEWEST_LEAVES = 16
#: Recall at ``k`` that the share of opened leaves must reach on the sample, measured with so many of its vectors as queries.
RECALL, TRIALS = 0.975, 100
_BLOCK_ROWS, _BLOCK_QUERIES = 8192, 4096
#: Subtrees that travel as one have so many levels, but a tree has at least 2^4 of them.
_BLOCK_DEPTH, _TOP_LEVELS = 5, 4


class Forest:
    def __init__(self, sample: np.ndarray, trees: int, depth: int, top_norm: float, seed: int = 8):
        self.top = top_norm
        self.trees, self.leaves = [], 0
        self._blocks: list[int] = []  # of each leaf
        self._block_depth = max(0, min(_BLOCK_DEPTH, depth - _TOP_LEVELS))
        points = self.lift(sample)
        random = np.random.default_rng(seed)
        for _ in range(trees):
            self.trees.append(self._grow(points, np.arange(len(points)), depth, random))
        self.block = np.array(self._blocks, np.int32)

    def lift(self, vectors: np.ndarray) -> np.ndarray:
        """With the coordinate that brings each norm to the largest."""
        rest = np.sqrt(np.maximum(0, self.top**2 - (vectors * vectors).sum(axis=1, keepdims=True)))
        return np.hstack([vectors, rest])

    def _grow(self, points: np.ndarray, own: np.ndarray, depth: int, random: np.random.Generator, block: int | None = None):
        """A leaf is its number; an inner node is (normal, offset, below, above).  A block is named after its first leaf."""
        if block is None and depth <= self._block_depth:
            block = self.leaves
        for _ in range(8 if depth and len(own) > 1 else 0):
            a, b = points[random.choice(own, 2, replace=False)]
            length = np.linalg.norm(a - b)
            if length > 0:
                normal = (a - b) / length
                along = points[own] @ normal
                offset = float(np.median(along))
                above = along > offset
                if above.any():
                    return normal, offset, self._grow(points, own[~above], depth - 1, random, block), self._grow(points, own[above], depth - 1, random, block)
        self._blocks.append(self.leaves if block is None else block)
        self.leaves += 1
        return self.leaves - 1

    def place(self, vectors: np.ndarray) -> np.ndarray:
        """Leaf of each vector in each tree (vectors x trees)."""
        points, out = self.lift(vectors), np.empty((len(vectors), len(self.trees)), np.int32)
        for t, tree in enumerate(self.trees):
            todo = [(tree, np.arange(len(points)))]
            while todo:
                node, own = todo.pop()
                if isinstance(node, int):
                    out[own, t] = node
                    continue
                above = points[own] @ node[0] > node[1]
                todo += [(node[2], own[~above]), (node[3], own[above])]
        return out

    def search(self, vector: np.ndarray, leaves: int) -> list[int]:
        """The nearest ``leaves`` leaves of all trees, by one priority queue."""
        norm = np.linalg.norm(vector)
        point = np.append(vector * (self.top / norm), 0.0)
        queue: list[tuple] = [(0.0, t, tree) for t, tree in enumerate(self.trees)]
        order, found = len(queue), []
        while queue and len(found) < leaves:
            far, _, node = heapq.heappop(queue)
            while not isinstance(node, int):
                margin = float(point @ node[0] - node[1])
                near, away = (node[3], node[2]) if margin > 0 else (node[2], node[3])
                heapq.heappush(queue, (far + margin * margin, order, away))
                order += 1
                node = near
            found.append(node)
        return found


def least_share(forest: Forest, sample: np.ndarray, k: int, recall: float, trials: int = TRIALS) -> float:
    """The least share of all leaves with which sample vectors find ``recall`` of their ``k`` best in the sample."""
    if len(sample) <= k + 1:
        return 1.0
    leaves = forest.place(sample)
    needed = []
    for n in np.linspace(0, len(sample) - 1, min(trials, len(sample))).astype(int):
        scores = sample @ sample[n]
        scores[n] = -np.inf
        opened_at = np.empty(forest.leaves, np.int64)
        opened_at[forest.search(sample[n], forest.leaves)] = np.arange(forest.leaves)
        needed.append(opened_at[leaves[np.argpartition(-scores, k)[:k]]].min(axis=1) + 1)
    return float(np.quantile(np.concatenate(needed), recall, method="higher") / forest.leaves)


def _matrix(column: pa.Array | pa.ChunkedArray, size: int) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, size)


def nearest(
    vectors: DataFrame, queries: DataFrame, k: int = NEAREST, id_col: str = "vec_id", vector_col: str = "embedding",
    trees: int = TREES, sample_rows: int = SAMPLE, leaf_rows: int = LEAF_ROWS, search_share: float | None = None, recall: float = RECALL,
) -> DataFrame:
    """The ``k`` rows of ``vectors`` with the largest inner product for each row of ``queries``: query_id, rank, vec_id, score.

    Every usable vector is indexed; ``sample_rows`` bounds what the trees are
    grown on and, if ``search_share`` is not given, what the share of leaves
    that a query opens is measured on, for a ``recall``.  Ties go to smaller ids; a query's own id is no
    candidate.  Vectors that are null, empty, zero or hold null or non-finite
    components, rows without id, and vectors of another length than the most
    common one take no part.  Of equal vectors only the ``k + 1`` smallest ids
    can be answers, so a vector on a third of all rows is indexed so often
    and no more.  Rows that share an id are one candidate with its best
    score.  With no more than ``k`` candidates all come back.
    """
    def clean(df: DataFrame) -> DataFrame:
        rows = df.where(F.col(id_col).isNotNull() & usable(vector_col))
        return rows.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("vector"))

    spark = vectors.sparkSession
    copies = Window.partitionBy("vector").orderBy("id")
    indexed = clean(vectors).withColumn("copy", F.row_number().over(copies)).where(F.col("copy") <= k + 1).drop("copy")
    indexed = written(indexed, "indexed")
    sizes = indexed.groupBy(F.size("vector").alias("size")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "size").limit(1).collect()
    answer = "query_id long, rank int, vec_id long, score double"
    if not sizes:
        return spark.createDataFrame([], answer)
    size, total = sizes[0]
    indexed = indexed.where(F.size("vector") == size)
    asked = clean(queries).where(F.size("vector") == size)
    norm = F.sqrt(F.aggregate("vector", F.lit(0.0), lambda s, x: s + x * x))
    top = indexed.agg(F.max(norm)).first()[0]
    picked = indexed.orderBy(F.xxhash64("id"), "id").limit(sample_rows).select("vector").collect()
    depth = (max(FEWEST_LEAVES, -(-total // leaf_rows)) - 1).bit_length()
    sample = np.array([r[0] for r in picked])
    model = Forest(sample, trees, depth, top)
    share = least_share(model, sample, k, recall) if search_share is None else search_share
    shared, opened = spark.sparkContext.broadcast(model), max(1, -int(-share * model.leaves // 1))

    pairs = pa.schema([("block", pa.int32()), ("leaves", pa.list_(pa.int32())), ("id", pa.int64()), ("vector", pa.list_(pa.float64()))])

    def spread(parts: Iterator[pa.RecordBatch], leaves_of) -> Iterator[pa.RecordBatch]:
        for part in parts:
            if part.num_rows:
                rows, leaves = leaves_of(_matrix(part.column(1), size))
                # One row for each vector and block, with the leaves there.
                order = np.lexsort((leaves, shared.value.block[leaves], rows))
                rows, leaves = rows[order], leaves[order]
                blocks = shared.value.block[leaves]
                first = np.flatnonzero(np.concatenate([[True], (rows[1:] != rows[:-1]) | (blocks[1:] != blocks[:-1])]))
                taken = part.take(pa.array(rows[first]))
                lists = pa.ListArray.from_arrays(pa.array(np.append(first, len(leaves)), pa.int32()), pa.array(leaves, pa.int32()))
                yield pa.RecordBatch.from_arrays([pa.array(blocks[first], pa.int32()), lists, taken.column(0), taken.column(1).cast(pairs.field(3).type)], schema=pairs)

    def place(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def all_trees(x: np.ndarray) -> tuple:
            return np.repeat(np.arange(len(x)), trees), shared.value.place(x).reshape(-1)

        yield from spread(parts, all_trees)

    def visit(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def best(x: np.ndarray) -> tuple:
            found = [shared.value.search(v, opened) for v in x]
            return np.repeat(np.arange(len(x)), [len(f) for f in found]), np.concatenate(found).astype(np.int32)

        yield from spread((part.slice(n, 256) for part in parts for n in range(0, part.num_rows, 256)), best)

    kind = "block int, leaves array<int>, id long, vector array<double>"
    members, visits = indexed.mapInArrow(place, kind), asked.mapInArrow(visit, kind)
    # Blocks of any size are met in parts of bounded rows by lots of bounded queries.
    in_parts = members.groupBy("block").agg(F.ceil(F.count("*") / _BLOCK_ROWS).cast("int").alias("parts"))
    in_lots = visits.groupBy("block").agg(F.ceil(F.count("*") / _BLOCK_QUERIES).cast("int").alias("lots"))
    grid = F.broadcast(written(in_parts.join(in_lots, "block"), "block-grid"))  # one row for each block of the forest
    own = F.xxhash64("id")
    members = members.join(grid, "block").select("block", F.pmod(own, "parts").cast("int").alias("part"), F.explode(F.sequence(F.lit(0), F.col("lots") - 1)).alias("lot"), "leaves", "id", "vector")
    visits = visits.join(grid, "block").select("block", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), F.pmod(own, "lots").cast("int").alias("lot"), "leaves", "id", "vector")
    scored = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.float64())])

    def rank(rows: pa.Table, queries: pa.Table) -> pa.Table:
        if not rows.num_rows or not queries.num_rows:
            return scored.empty_table()
        ids, x, leaf = rows.column("id").to_numpy(), _matrix(rows.column("vector"), size), rows.column("leaves").combine_chunks().flatten().to_numpy()
        order = np.lexsort((ids, leaf))
        ids, x, leaf = ids[order], x[order], leaf[order]
        tables = []
        for start in range(0, queries.num_rows, 512):
            lot = queries.slice(start, 512).combine_chunks()
            opened = lot.column("leaves").combine_chunks()
            of = np.repeat(np.arange(lot.num_rows), np.diff(opened.offsets.to_numpy()))
            tables.append(_best(lot.column("id").to_numpy(), _matrix(lot.column("vector"), size), of, opened.flatten().to_numpy(), ids, x, leaf, k, scored))
        return pa.concat_tables(tables)

    key = ["block", "part", "lot"]
    found = visits.groupBy(*key).cogroup(members.groupBy(*key))
    found = found.applyInArrow(lambda q, m: rank(m, q), "query_id long, vec_id long, score double")
    found = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    place_of = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(place_of)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


def _best(
    asked: np.ndarray, q: np.ndarray, of: np.ndarray, opened: np.ndarray, ids: np.ndarray, x: np.ndarray, leaf: np.ndarray, k: int, schema: pa.Schema
) -> pa.Table:
    """The ``k`` best for each query among the rows (by leaf, then id) of the leaves it opened, scores summed the same way wherever a pair meets."""
    about = np.full((len(q), len(ids)), -np.inf)
    by_leaf = np.argsort(opened, kind="stable")
    present, first = np.unique(leaf, return_index=True)
    last = np.append(first[1:], len(leaf))
    low, high = np.searchsorted(opened[by_leaf], present, "left"), np.searchsorted(opened[by_leaf], present, "right")
    for a, b, i, j in zip(first, last, low, high):
        if j > i:
            own = of[by_leaf[i:j]]
            about[own, a:b] = q[own] @ x[a:b].T
    about[asked[:, None] == ids[None, :]] = -np.inf
    keep = min(k, len(ids))
    floor = np.partition(about, len(ids) - keep, axis=1)[:, len(ids) - keep]
    slack = 1e-12 * np.maximum(1.0, np.abs(about, where=np.isfinite(about), out=np.zeros_like(about)).max(axis=1))
    i, j = np.nonzero((about >= (floor - slack)[:, None]) & (about > -np.inf))
    score = (q[i] * x[j]).sum(axis=1)
    order = np.lexsort((ids[j], -score, i))
    i, j, score = i[order], j[order], score[order]
    nth = np.arange(len(i)) - np.searchsorted(i, i)
    best = nth < k
    return pa.table([asked[i[best]], ids[j[best]], score[best]], schema=schema)


def op8_projection_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return nearest(vectors, vectors.where(F.col("vec_id") % EVERY == 0))
