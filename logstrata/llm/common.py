"""Helpers shared by the training-data operators: tables, sizes, written intermediates, cached splitting."""

from __future__ import annotations

import ctypes
import re
import tempfile
import zipfile
from collections.abc import Callable, Iterable, Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from logstrata.session import delete_folder, scratch_path

#: Words of all text operators: runs of anything but space and the ASCII control blanks.
WORD = r"[^\x20\x09-\x0D]+"

_BLANK_BEFORE_SPACE = re.compile(r"\s ")


_SHIPPED: dict[str, tempfile.TemporaryDirectory] = {}


def ship_package(spark: SparkSession) -> None:
    """Give the executors this library, once per application, as Spark's own file server hands out Python files."""
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    package = Path(__file__).resolve().parents[1]
    folder = tempfile.TemporaryDirectory(prefix="package-")  # Spark serves the file from here while the driver lives
    archive = Path(folder.name, f"{package.name}_package.zip")
    with zipfile.ZipFile(archive, "w") as z:
        for source in sorted(package.rglob("*.py")):
            z.write(source, source.relative_to(package.parent))
    sc.addPyFile(str(archive))
    _SHIPPED[sc.applicationId] = folder


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship_package(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


class Scratch:
    """Written intermediates of one run, removed when what was made of them is written itself."""

    def __init__(self, spark: SparkSession):
        self._spark, self._paths = spark, []

    def written(self, df: DataFrame, name: str) -> DataFrame:
        """``df`` written as Parquet under the shared folder and read back: cuts lineage, survives lost executors."""
        self._paths.append(scratch_path(self._spark, name))
        df.write.parquet(self._paths[-1])
        return self._spark.read.schema(df.schema).parquet(self._paths[-1])

    def take(self, other: "Scratch") -> None:
        """What ``other`` holds is removed with what this one holds."""
        self._paths, other._paths = other._paths + self._paths, []

    def clear(self, keep: int = 0) -> None:
        """Remove all tables but the ``keep`` written last."""
        while len(self._paths) > keep:
            delete_folder(self._spark, self._paths.pop(0))


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written and read back, to stay: a result, or what a result is read from."""
    return Scratch(df.sparkSession).written(df, name)


def pieces_for(df: DataFrame, size: Callable | F.Column, target: int) -> int:
    """How many pieces of about ``target`` (bytes or rows) ``df`` makes; at least one.  One aggregate row reaches the driver."""
    total = df.agg(F.coalesce(F.sum(size), F.lit(0)).cast("long")).first()[0]
    return max(1, -(-int(total) // target))


def text_bytes(text: str = "text") -> F.Column:
    """UTF-8 length of a nullable text column, at least one byte a row."""
    return F.coalesce(F.octet_length(F.col(text)), F.lit(0)).cast("long") + F.lit(1)


def dealt(pieces: int, *columns: str) -> F.Column:
    """A piece for each row, by a hash of ``columns`` and of where the row stands in its input split.

    Equal rows (a third of all may be) go to many pieces.  A task that runs
    again deals its rows as before if it reads them in the same order, which
    holds for files; other input should be written first.
    """
    place = F.shiftrightunsigned(F.monotonically_increasing_id(), 6)
    return F.pmod(F.xxhash64(*columns, place), F.lit(pieces)).cast("long")


def batches(rows: Iterable[list], schema: pa.Schema, limit: int = 4096) -> Iterator[pa.RecordBatch]:
    """Rows (lists in schema order) as record batches of at most ``limit`` rows."""
    held: list = []
    for row in rows:
        held.append(row)
        if len(held) >= limit:
            yield _batch(held, schema)
            held = []
    if held:
        yield _batch(held, schema)


def give_back() -> None:
    """Return freed memory of this worker to the system: Arrow's pool and the C heap keep it otherwise, and workers live on."""
    pa.default_memory_pool().release_unused()
    if _LIBC is not None and hasattr(_LIBC, "malloc_trim"):
        _LIBC.malloc_trim(0)


def lean(make: Callable) -> Callable:
    """``make`` for a group of rows, giving memory back when it is done with one."""

    def done(out):
        give_back()
        return out

    # Spark counts the arguments.
    if make.__code__.co_argcount == 1:
        return lambda rows: done(make(rows))
    return lambda rows, others: done(make(rows, others))


def _libc() -> ctypes.CDLL | None:
    try:
        return ctypes.CDLL(None)
    except OSError:  # not every system has one to load
        return None


_LIBC = _libc()


def _batch(rows: list, schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)


class Memo(dict):
    """A dictionary that computes missing values.

    Bounded in entries and in key length, so memory stays bounded: when full,
    it keeps its entries as the older generation and starts anew; what is
    used again comes back from there.
    """

    def __init__(self, compute: Callable, entries: int = 300_000, longest: int = 64):
        super().__init__()
        self._compute, self._entries, self._longest, self._older = compute, entries, longest, {}

    def __missing__(self, key):
        value = self._older.get(key)
        if value is None:
            value = self._compute(key)
        if len(key) <= self._longest:
            if len(self) >= self._entries:
                self._older = dict(self)
                self.clear()
            self[key] = value
        return value


def space_segments(text: str) -> list[str]:
    """``text`` cut before each space that follows a non-blank character.

    A byte-level split pattern whose alternatives take a blank only at their
    start never matches across such a place, so every segment can be encoded
    by itself.  Texts with blanks in a row come back as one segment.
    """
    if "  " in text or _BLANK_BEFORE_SPACE.search(text):
        return _careful_segments(text)
    head, *rest = text.split(" ")
    segments = [" " + word for word in rest]
    if head:
        segments.insert(0, head)
    return segments


def _careful_segments(text: str) -> list[str]:
    out, start = [], 0
    for cut in re.finditer(r"(?<=\S) ", text):
        if cut.start() > start:
            out.append(text[start:cut.start()])
            start = cut.start()
    out.append(text[start:])
    return out


def components(edges: DataFrame, name: str = "components", max_rounds: int = 60, work: Scratch | None = None) -> DataFrame:
    """Connected components of ``edges`` (a long, b long): node long, component long (smallest node).

    Alternating large-star and small-star rounds (Kiveris et al. 2014): every
    round is two aggregates and two joins on the node, written to the shared
    folder; about log(longest path) rounds.  Nodes without edges are absent.
    Null ends and loops are left out.  Only one checksum row a round reaches
    the driver.  A round's tables are removed when the next one is written;
    the last stays, or goes with what ``work`` holds.
    """
    start = edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    rounds = Scratch(edges.sparkSession)
    now, before = rounds.written(start, name), None
    for _ in range(max_rounds):
        mark = tuple(now.agg(F.count("*"), F.coalesce(F.sum(F.xxhash64("a", "b").cast("decimal(20,0)")), F.lit(0))).first())
        if mark == before or mark[0] == 0:
            if work is not None:
                work.take(rounds)
            return now.select(F.col("a").alias("node"), F.col("b").alias("component")).union(
                now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
            )
        before = mark
        both = now.union(now.select("b", "a").toDF("a", "b"))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a"), F.least("a", "m").alias("m"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()
        large = rounds.written(large, name)
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        linked = large.join(least, "a")
        small = linked.where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b")).union(least.select("a", F.col("m").alias("b")))
        now = rounds.written(small.distinct(), name)
        rounds.clear(keep=1)
    raise RuntimeError(f"components did not settle in {max_rounds} rounds")
