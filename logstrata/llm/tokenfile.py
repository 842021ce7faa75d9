"""Operator 5: token-id files of independent zstandard frames with a trailing seek table.

A file is a run of whole documents in ascending id order.  Ids are unsigned
32-bit little-endian; a frame closes after the document that fills it.  The
last frame is the index: one record for each document (id, frame, first byte
in it, number of ids).  Then comes the seek table, a skippable frame in the
seekable zstandard layout: for each frame its compressed and plain size and
the low 32 bits of XXH64 of the plain bytes, then the number of frames, a
flag byte and a magic number.  A reader fetches the table and the index, then
only the frames of the documents asked for, and checks every frame it opens.
"""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import xxhash
import zstandard
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from logstrata.llm.common import batches, give_back, pieces_for, table, text_bytes, written
from logstrata.llm.tokens import encoder
from logstrata.llm.wordchunks import text_pieces
from logstrata.session import scratch_path

TOKENIZER = "byte_bpe_50k.json"
END_ID = 2

# Fixed values of the seekable zstandard layout.
SKIPPABLE_MAGIC = 0x184D2A5E
SEEKABLE_MAGIC = 0x8F92EAB1
CHECKSUM_FLAG = 0x80

_ENTRY = struct.Struct("<III")
_FOOTER = struct.Struct("<IBI")
#: has_id is 0 for a null id.
_INDEX = np.dtype([("doc_id", "<i8"), ("frame", "<u4"), ("first", "<u4"), ("ids", "<u4"), ("has_id", "u1")])


class TokenFileWriter:
    def __init__(self, out, frame_bytes: int = 1 << 18, level: int = 3):
        self._out, self._frame_bytes = out, frame_bytes
        self._zstd = zstandard.ZstdCompressor(level=level)
        self._frames: list[bytes] = []
        self._held: list[bytes] = []
        self._size = 0
        self._index: list[tuple] = []

    def add(self, doc_id: int | None, ids: bytes) -> None:
        self._index.append((doc_id or 0, len(self._frames), self._size, len(ids) // 4, doc_id is not None))
        self._held.append(ids)
        self._size += len(ids)
        if self._size >= self._frame_bytes:
            self._close_frame()

    def _close_frame(self) -> None:
        plain = b"".join(self._held)
        coded = self._zstd.compress(plain)
        self._out.write(coded)
        self._frames.append(_ENTRY.pack(len(coded), len(plain), xxhash.xxh64_intdigest(plain) & 0xFFFFFFFF))
        self._held, self._size = [], 0

    def finish(self) -> None:
        if self._held:
            self._close_frame()
        self._held = [np.array(self._index, _INDEX).tobytes()]
        self._close_frame()
        table = b"".join(self._frames) + _FOOTER.pack(len(self._frames), CHECKSUM_FLAG, SEEKABLE_MAGIC)
        self._out.write(struct.pack("<II", SKIPPABLE_MAGIC, len(table)) + table)


class TokenFileReader:
    """Random access to the documents of one file (a pyarrow file or any binary file object)."""

    def __init__(self, source):
        self._source = source
        source.seek(0, 2)
        end = source.tell()
        frames, _, magic = _FOOTER.unpack(self._bytes(end - _FOOTER.size, _FOOTER.size))
        if magic != SEEKABLE_MAGIC:
            raise ValueError("no seek table at the end of the file")
        size = frames * _ENTRY.size
        entries = np.frombuffer(self._bytes(end - _FOOTER.size - size, size), "<u4").reshape(-1, 3)
        self._sizes, self._sums = entries[:, :2].astype(np.int64), entries[:, 2]
        self._starts = np.concatenate([[0], np.cumsum(self._sizes[:, 0])])
        self.index = np.frombuffer(self.frame(frames - 1), _INDEX)

    def _bytes(self, start: int, size: int) -> bytes:
        self._source.seek(int(start))
        return self._source.read(int(size))

    def frame(self, n: int) -> bytes:
        plain = zstandard.ZstdDecompressor().decompress(self._bytes(self._starts[n], self._sizes[n, 0]), max_output_size=int(self._sizes[n, 1]))
        if xxhash.xxh64_intdigest(plain) & 0xFFFFFFFF != self._sums[n]:
            raise ValueError(f"frame {n} does not match its checksum")
        return plain

    def documents(self, wanted: Iterable[int] | None = None) -> Iterator[tuple[int | None, bytes]]:
        """(doc_id, ids) in file order, of all documents or of those in ``wanted``; other frames stay closed."""
        index = self.index
        if wanted is not None:
            index = index[np.isin(index["doc_id"], list(wanted)) & (index["has_id"] == 1)]
        opened, plain = -1, b""
        for doc_id, frame, first, ids, has_id in index.tolist():
            if frame != opened and ids:
                opened, plain = frame, self.frame(frame)
            yield (doc_id if has_id else None), plain[first:first + 4 * ids] if ids else b""


#: What pyarrow calls stores that Hadoop has other names for.
_SCHEMES = {"s3a": "s3", "s3n": "s3"}


def store_of(path: str) -> tuple[fs.FileSystem, str]:
    """pyarrow's file system for a path as Spark writes it, and the path there."""
    scheme, mark, rest = path.partition("://")
    return fs.FileSystem.from_uri(_SCHEMES.get(scheme, scheme) + mark + rest)


#: Text encoded at once.
_TEXT_BYTES = 2 << 20


def write_token_files(
    docs: DataFrame, path: str | None = None, id_col: str = "doc_id", text_col: str = "text",
    tokenizer_path: str | None = None, end_id: int = END_ID, file_bytes: int = 32 << 20,
) -> DataFrame:
    """Writes files under ``path`` (shared storage) and returns the list of them: part, file, docs, ids, start.

    ``start`` is the number of ids in all files before.  Files hold about
    ``file_bytes`` of text each, ranges of ascending id (nulls first; rows of
    one id in an order fixed by their texts).  Null and empty texts are
    documents of the end id alone; repeated rows are repeated documents; an
    empty table writes no file.  A file is written under another name and
    then renamed, so lost or repeated tasks leave no partial file.
    """
    spark = docs.sparkSession
    path = (path or scratch_path(spark, "token-ids")).rstrip("/")
    source = tokenizer_path or public_tokenizers.path(TOKENIZER)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    files = pieces_for(rows, text_bytes(), file_bytes)
    # Rows that repeat an id and text may fill several files: their place in the input tells them apart.
    rows = rows.withColumn("place", F.monotonically_increasing_id())
    order = [F.col("doc_id").asc_nulls_first(), F.xxhash64("text"), F.col("place")]
    rows = rows.repartitionByRange(files, *order).sortWithinPartitions(*order).drop("place")
    schema = pa.schema([("part", pa.int32()), ("file", pa.string()), ("docs", pa.int64()), ("ids", pa.int64())])
    end = struct.pack("<I", end_id)

    def write(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        out, counts = None, [0, 0]
        for held in text_pieces(parts, 1, _TEXT_BYTES):
            if out is None:
                store, folder = store_of(path)
                store.create_dir(folder, recursive=True)
                draft, final = f"{folder}/_{uuid.uuid4().hex}", f"{folder}/part-{part:06d}.ids.zst"
                out = store.open_output_stream(draft)
                writer = TokenFileWriter(out)
            ids_of, texts = ([v for piece in held for v in piece.column(c).to_pylist()] for c in (0, 1))
            for doc_id, ids in zip(ids_of, encoder(source, True).encode(texts)):
                writer.add(doc_id, ids + end)
                counts = [counts[0] + 1, counts[1] + len(ids) // 4 + 1]
        if out is not None:
            writer.finish()
            out.close()
            store.move(draft, final)
            yield next(batches([[part, f"{path}/part-{part:06d}.ids.zst", *counts]], schema))
        give_back()

    listed = written(rows.mapInArrow(write, "part int, file string, docs long, ids long"), "token-files")
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    return listed.withColumn("start", F.coalesce(F.sum("ids").over(before), F.lit(0)))


def read_token_files(files: DataFrame) -> DataFrame:
    """Every document of the listed files: doc_id, start, n_tokens, ids_crc32 (of the ids as stored)."""
    schema = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64())])

    def read(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts:
            for file, start in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                yield from batches(_digests(file, start), schema)

    spread = files.select("file", "start").repartition(max(1, files.count()), "file")
    return spread.mapInArrow(read, "doc_id long, start long, n_tokens long, ids_crc32 long")


def _digests(file: str, start: int) -> Iterator[list]:
    store, name = store_of(file)
    with store.open_input_file(name) as source:
        for doc_id, ids in TokenFileReader(source).documents():
            yield [doc_id, start, len(ids) // 4, zlib.crc32(ids)]
            start += len(ids) // 4


def op5_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_token_files(write_token_files(table(spark, sf_dir, "documents")))
