"""Texts as chunks of word numbers, and packed arrays that chunks and buckets exchange (operators 11 and 12).

A chunk holds the rows of one input split up to some megabytes of text, so no
text is shuffled.  It knows its distinct words by 64 bits of hash, dealt to
buckets by further bits; a bucket hears each distinct word or phrase of a
chunk once, with its count there, so what it holds does not grow with the
copies of a text.  Chunk and bucket counts follow the bytes of the corpus.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from logstrata.llm.common import Scratch
from logstrata.session import delete_folder, scratch_path

#: Up to so many buckets a table of chunks is stored by chunk.
_STORED_BUCKETS = 4096

_PACKER, _UNPACKER = zstandard.ZstdCompressor(level=1), zstandard.ZstdDecompressor()


def pack(values: np.ndarray) -> bytes:
    """An array as compressed planes of its bytes, least significant first."""
    return _PACKER.compress(np.ascontiguousarray(np.ascontiguousarray(values).view(np.uint8).reshape(len(values), values.itemsize).T).tobytes())


def unpack(packed: bytes, kind=np.uint64) -> np.ndarray:
    size = np.dtype(kind).itemsize
    planes = np.frombuffer(_UNPACKER.decompress(packed), np.uint8).reshape(size, -1)
    return np.ascontiguousarray(planes.T).view(kind).ravel()


def pack_sorted(values: np.ndarray) -> bytes:
    """Ascending unsigned 64-bit numbers, as packed differences."""
    return pack(np.diff(values.astype(np.uint64), prepend=np.uint64(0)))


def unpack_sorted(packed: bytes) -> np.ndarray:
    return np.cumsum(unpack(packed), dtype=np.uint64)


def spread(values: np.ndarray, buckets: int) -> np.ndarray:
    """Buckets of numbers, by well-mixed bits."""
    mixed = (values ^ (values >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    return ((mixed ^ (mixed >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9) >> np.uint64(24)) % np.uint64(buckets)


def segments(bucket: np.ndarray) -> tuple[np.ndarray, list[tuple[int, int, int]]]:
    """A stable order by bucket, and (bucket, first, end) of each that is present."""
    order = np.argsort(bucket, kind="stable")
    present, first = np.unique(bucket[order], return_index=True)
    ends = np.append(first[1:], len(order))
    return order, list(zip(present.tolist(), first.tolist(), ends.tolist()))


def word_hashes(words: Iterable[bytes], seed: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """64 bits that tell words apart and, independent of them, bits that deal them to buckets."""
    words = list(words)
    first = np.fromiter((xxhash.xxh3_64_intdigest(w, seed) for w in words), np.uint64, len(words))
    return first, np.fromiter((xxhash.xxh3_64_intdigest(w, seed ^ 0x5BD1E995) for w in words), np.uint64, len(words))


def gathered(arrays: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """Distinct values of several arrays, the sums of their counts, and where the values of each array are among them."""
    values, inverse = np.unique(np.concatenate(arrays), return_inverse=True)
    sums = np.bincount(inverse, weights=np.concatenate(counts), minlength=len(values)).astype(np.int64)
    return values, sums, np.split(inverse, np.cumsum([len(a) for a in arrays])[:-1])


def chunk_number(n: int) -> int:
    """A number for the n-th chunk of this task; written once by Spark's commit of one attempt, so it stays."""
    return (TaskContext.get().partitionId() << 24) + n


def text_pieces(parts: Iterable[pa.RecordBatch], at: int, chunk_bytes: int) -> Iterator[list[pa.RecordBatch]]:
    """Record batches in groups whose texts (UTF-8 column ``at``) come to about ``chunk_bytes``."""
    held, size = [], 0
    for whole in parts:
        for start in range(0, whole.num_rows, 64):
            part = whole.slice(start, 64)
            held.append(part)
            size += part.column(at).nbytes
            if size >= chunk_bytes:
                yield held
                held, size = [], 0
    if held:
        yield held


class ChunkTable:
    """Chunk rows stored by chunk, so that what buckets answer joins them without shuffling them."""

    def __init__(self, chunks: DataFrame, count: int, name: str):
        self._spark, self._path = chunks.sparkSession, scratch_path(chunks.sparkSession, name)
        self._table = f"{name.replace('-', '_')}_{uuid.uuid4().hex[:12]}"
        chunks.write.option("path", self._path).bucketBy(max(1, min(count, _STORED_BUCKETS)), "chunk").saveAsTable(self._table)
        self.rows = self._spark.table(self._table)

    def answered(self, answers: DataFrame, columns: list[str], make: Callable[[pa.Table, pa.Table], pa.Table], schema: str, where=None) -> DataFrame:
        """``make`` for each chunk and its rows of ``answers``."""
        rows = self.rows if where is None else self.rows.where(where)
        return rows.select("chunk", *columns).groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInArrow(make, schema)

    def drop(self) -> None:
        self._spark.sql(f"DROP TABLE IF EXISTS {self._table}")
        delete_folder(self._spark, self._path)


class Workspace(Scratch):
    """Written intermediates and chunk tables of one run, removed when its result stands."""

    def __init__(self, spark: SparkSession):
        super().__init__(spark)
        self._tables: list[ChunkTable] = []

    def chunks(self, df: DataFrame, count: int, name: str) -> ChunkTable:
        self._tables.append(ChunkTable(df, count, name))
        return self._tables[-1]

    def clear(self, keep: int = 0) -> None:
        super().clear(keep)
        while self._tables:
            self._tables.pop().drop()


def sum_row(df: DataFrame, *columns: str) -> tuple[int, ...]:
    """Totals of some columns: one row reaches the driver."""
    return tuple(int(v) for v in df.agg(*[F.coalesce(F.sum(c), F.lit(0)) for c in columns]).first())
