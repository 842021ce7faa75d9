"""Operator 2: substring dedup by Rabin-Karp hashes of all fixed-length word windows.

Documents are dealt into chunks.  A chunk's windows are hashed in
numpy, and their hashes go, at most two copies each, to buckets of the hash
space as packed arrays; a bucket finds the hashes that occur more than once
and tells each chunk which of its own those are.  The chunk then merges the
windows so marked into maximal intervals of words and drops these.  A passage
on a third of all documents costs two hashes a chunk, so no bucket grows with
its copies.

Two windows count as equal when 64 bits of hash and their bucket (independent
bits, more of them as the corpus grows) agree.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from itertools import compress, count

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import ArrayType, StructType

from logstrata.llm.common import dealt, lean, pieces_for, table, text_bytes
from logstrata.llm.wordchunks import segments

WINDOW = 35
# Fixed odd bases of the two polynomial hashes modulo 2^64.
_BASES = (0x9E3779B97F4A7C15, 0xD1342543DE82EF95)


def _powers(base: int, n: int) -> np.ndarray:
    factors = np.full(n, base, np.uint64)
    if n:
        factors[0] = 1
    return np.cumprod(factors, dtype=np.uint64)


class _Windows:
    """Hashes of all windows of a chunk's documents, and where they stand."""

    def __init__(self, texts: list[bytes | None], window: int):
        self.texts, self.window = texts, window
        number = defaultdict(count().__next__)
        # Words as numbers, text by text: a chunk has millions of words, too many to hold as objects.
        parts = [np.array([number[x] for x in self.words(i)], np.int32) for i in range(len(texts))]
        lengths = np.array([len(p) for p in parts], np.int64)
        self.ends = np.cumsum(lengths)
        ids = np.concatenate(parts) if parts else np.zeros(0, np.int32)
        del parts
        self.size = len(ids)
        self.at = np.zeros(0, np.int64)
        self.hashes = self.spread = np.zeros(0, np.uint64)
        if self.size < window:
            return
        room = np.repeat(self.ends, lengths) - np.arange(self.size)  # words left in the document
        self.at = np.flatnonzero(room >= window)
        first, second = (self._rolling(ids, number, seed, base) for seed, base in enumerate(_BASES))
        self.hashes = first ^ (second >> np.uint64(32))
        self.spread = second * np.uint64(0xBF58476D1CE4E5B9) >> np.uint64(24)

    def words(self, i: int) -> list[bytes]:
        """Words of a text; bytes.split cuts at the blanks of WORD."""
        return self.texts[i].split() if self.texts[i] else []

    def _rolling(self, ids: np.ndarray, number: dict, seed: int, base: int) -> np.ndarray:
        words = np.fromiter((xxhash.xxh3_64_intdigest(w, seed) for w in number), np.uint64, len(number))
        sums, terms = np.zeros(self.size + 1, np.uint64), words[ids]
        terms *= _powers(base, self.size)
        np.cumsum(terms, out=sums[1:])
        del terms
        # (sum of w_j base^j over the window) / base^i is the same wherever the window stands.
        return (sums[self.at + self.window] - sums[self.at]) * _powers(pow(base, -1, 1 << 64), self.size)[self.at]

    def repeated(self, known: np.ndarray) -> np.ndarray:
        """Mask of the words covered by windows whose hash is in ``known`` (sorted)."""
        edge = np.zeros(self.size + 1, np.int64)
        if len(known):
            starts = self.at[_within(self.hashes, known)]
            np.add.at(edge, starts, 1)
            np.add.at(edge, starts + self.window, -1)
        return np.cumsum(edge)[:-1] > 0


def _texts(chunk: pa.Table, text_col: str) -> list[bytes | None]:
    """Texts as UTF-8, without a second column of them."""
    return chunk.column(text_col).cast(pa.binary()).to_pylist()


def _within(values: np.ndarray, known: np.ndarray) -> np.ndarray:
    """Which of ``values`` are in ``known`` (sorted)."""
    if not len(known):
        return np.zeros(len(values), bool)
    return known[np.minimum(np.searchsorted(known, values), len(known) - 1)] == values


def _at_most_two(values: np.ndarray) -> np.ndarray:
    """Sorted values, each at most twice."""
    values = np.sort(values)
    return values[np.concatenate([np.ones(min(2, len(values)), bool), values[2:] != values[:-2]])]


def remove_repeats(
    docs: DataFrame, window: int = WINDOW, id_col: str = "doc_id", text_col: str = "text",
    chunk_bytes: int = 8 << 20, bucket_bytes: int = 12 << 20,
) -> DataFrame:
    """All columns of ``docs`` and n_words, n_removed (long), removed (intervals of word numbers, end excluded) and kept (words left, joined by one space).

    A word goes if a window over it has a word sequence that starts elsewhere
    too, in any document, the same included; windows are judged on the input.
    Null and empty texts have no words and keep ''.  Repeated rows are copies
    like others.  Input columns with the names added (or beginning with
    ``__``) are left out.  ``chunk_bytes`` and ``bucket_bytes`` of text set how
    many chunks and buckets there are, so both follow the corpus.
    """
    added = ("n_words", "n_removed", "removed", "kept")
    kept = [c for c in docs.columns if c not in added and not c.startswith("__")]
    total = pieces_for(docs, text_bytes(text_col), 1)
    chunks, buckets = -(-total // chunk_bytes), -(-total // bucket_bytes)
    rows = docs.select(*kept, dealt(chunks, id_col, text_col).alias("__chunk"))
    blobs = pa.schema([("__chunk", pa.int64()), ("__bucket", pa.int64()), ("__hashes", pa.binary())])

    @lean
    def scatter(chunk: pa.Table) -> pa.Table:
        found = _Windows(_texts(chunk, text_col), window)
        bucket = (found.spread % np.uint64(buckets)).astype(np.int32)
        del found.spread, found.at
        order, cuts = segments(bucket)
        rows = [(b, found.hashes[order[i:j]]) for b, i, j in cuts]
        own = chunk.column("__chunk")[0].as_py() if chunk.num_rows else 0
        return pa.table([[own] * len(rows), [b for b, _ in rows], [_at_most_two(h).tobytes() for _, h in rows]], schema=blobs)

    @lean
    def gather(bucket: pa.Table) -> pa.Table:
        owners = bucket.column("__chunk").to_pylist()
        arrays = [np.frombuffer(b, np.uint64) for b in bucket.column("__hashes").to_pylist()]
        everything = np.sort(np.concatenate(arrays))
        twice = np.unique(everything[1:][everything[1:] == everything[:-1]])
        rows = [(o, a[_within(a, twice)]) for o, a in zip(owners, arrays)]
        rows = [(o, a) for o, a in rows if len(a)]
        return pa.table([[o for o, _ in rows], [a.tobytes() for _, a in rows]], schema=answers)

    answers = pa.schema([("__chunk", pa.int64()), ("__hashes", pa.binary())])
    # Both passes group the same rows, so Spark shuffles the texts once and reads that twice.
    sent = rows.groupBy("__chunk").applyInArrow(scatter, "__chunk long, __bucket long, __hashes binary")
    marked = sent.groupBy("__bucket").applyInArrow(gather, "__chunk long, __hashes binary")
    out = rows.drop("__chunk").schema.add("n_words", "long").add("n_removed", "long")
    span = StructType().add("first", "integer").add("end", "integer")
    out = out.add("removed", ArrayType(span)).add("kept", "string")
    schema = to_arrow_schema(out)

    @lean
    def cut(chunk: pa.Table, marks: pa.Table) -> pa.Table:
        found = _Windows(_texts(chunk, text_col), window)
        known = [np.frombuffer(b, np.uint64) for b in marks.column("__hashes").to_pylist()]
        gone = found.repeated(np.sort(np.concatenate(known)) if known else np.zeros(0, np.uint64))
        columns = list(zip(*_documents(found, gone))) or [[], [], [], []]
        arrays = [chunk.column(c).cast(schema.field(c).type) for c in kept] + [pa.array(c, schema.field(n).type) for c, n in zip(columns, added)]
        return pa.table(arrays, schema=schema)

    return rows.groupBy("__chunk").cogroup(marked.groupBy("__chunk")).applyInArrow(cut, out)


def _documents(found: _Windows, gone: np.ndarray) -> Iterator[tuple]:
    start = 0
    for i, end in enumerate(found.ends.tolist()):
        words, own = found.words(i), gone[start:end]
        start = end
        removed = int(own.sum())
        if not removed:
            yield len(words), 0, [], b" ".join(words).decode()
            continue
        edges = np.flatnonzero(np.diff(np.concatenate([[0], own.view(np.int8), [0]]))).reshape(-1, 2)
        spans = [{"first": a, "end": b} for a, b in edges.tolist()]
        yield len(words), removed, spans, b" ".join(compress(words, (~own).tolist())).decode()


def op2_window_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    left = remove_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return left.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


OP2_SQL = f"""
WITH word AS (
    SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda w: w <> '') AS words FROM documents
), opening AS (
    SELECT doc_id, first, sha256(array_to_string(words[first:first + {WINDOW - 1}], ' ')) AS digest
    FROM (SELECT doc_id, words, unnest(range(1, len(words) - {WINDOW - 2})) AS first FROM word)
), repeated AS (
    SELECT digest FROM opening GROUP BY digest HAVING count(*) > 1
), gone AS (
    SELECT doc_id, list(DISTINCT covered) AS places
    FROM (SELECT doc_id, unnest(range(first, first + {WINDOW})) AS covered FROM opening SEMI JOIN repeated USING (digest)) GROUP BY doc_id
)
SELECT doc_id, len(words)::BIGINT AS n_words, coalesce(len(places), 0)::BIGINT AS n_removed,
       sha256(array_to_string(list_filter(words, lambda w, i: NOT coalesce(list_contains(places, i), false)), ' ')) AS kept_sha256
FROM word LEFT JOIN gone USING (doc_id)
"""
