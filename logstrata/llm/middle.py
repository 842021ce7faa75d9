"""Operator 13: fill-in-the-middle forms of whole texts, cut at units found by memoised content-defined chunks.

A unit is a run of ASCII letters or one other code point.  A rolling hash of
the bytes cuts each text into chunks whose borders depend on content alone, so
texts that share passages share chunks.  What a chunk adds to the count of
units and code points is summed up once and kept by its content: two chunks
are the same only if all their bytes are.  Two letters that meet at a border
are one unit, so the sums of chunks combine to the units of the text, and a
cut is looked for inside the one chunk that holds it.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from logstrata.llm.common import table

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
PLAIN_PERCENT = 10  # of texts stay as they are
SPM_PERCENT = 20  # of the others put the suffix first

# Fixed odd base of the rolling hash modulo 2^64, and a factor that spreads its bits.
_BASE, _SPREAD = 0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9
_WINDOW = 24  # bytes that decide a border
_BITS = 10  # of the hash that are zero at a border: 1024 bytes from one to the next, on average
_LEAST, _MOST = 256, 8192  # bytes of a chunk
_PIECE = 1 << 18  # bytes hashed at once

_LETTER = np.zeros(256, bool)
_LETTER[65:91] = _LETTER[97:123] = True


def _powers(base: int, n: int) -> np.ndarray:
    factors = np.full(n, base, np.uint64)
    factors[0] = 1
    return np.cumprod(factors, dtype=np.uint64)


_POWERS, _INVERSE = _powers(_BASE, _PIECE + _WINDOW), _powers(pow(_BASE, -1, 1 << 64), _PIECE)


def _marked(data: np.ndarray) -> np.ndarray:
    """Places right after windows whose hash marks a border."""
    out = []
    for start in range(0, len(data) - _WINDOW + 1, _PIECE):
        part = data[start:start + _PIECE + _WINDOW - 1].astype(np.uint64) + np.uint64(1)
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(part * _POWERS[:len(part)], dtype=np.uint64)])
        n = len(part) - _WINDOW + 1
        hashes = (sums[_WINDOW:] - sums[:n]) * _INVERSE[:n] * np.uint64(_SPREAD)
        out.append(np.flatnonzero(hashes >> np.uint64(64 - _BITS) == 0) + start + _WINDOW)
    return np.concatenate(out) if out else np.zeros(0, np.int64)


def chunk_borders(text: bytes) -> list[int]:
    """Ends of the chunks of UTF-8 ``text``, each between code points."""
    size, cuts, last = len(text), [], 0

    def close(at: int) -> None:
        nonlocal last
        while at < size and text[at] & 0xC0 == 0x80:  # inside a code point: at most three bytes on
            at += 1
        cuts.append(at)
        last = at

    if size > _LEAST:
        for mark in _marked(np.frombuffer(text, np.uint8)).tolist():
            while mark - last > _MOST:
                close(last + _MOST)
            if mark - last >= _LEAST and mark < size:
                close(mark)
        while size - last > _MOST:
            close(last + _MOST)
    if last < size:
        cuts.append(size)
    return cuts


def _unit_starts(chunk: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Where units start in a chunk taken by itself, and which bytes start a code point."""
    data = np.frombuffer(chunk, np.uint8)
    letter = _LETTER[data]
    heads = data & 0xC0 != 0x80
    starts = heads.copy()
    starts[1:] &= ~(letter[1:] & letter[:-1])
    return np.flatnonzero(starts), heads


class ChunkSums(dict):
    """Chunk -> (units, code points, begins with a letter, ends with one), bounded in bytes.

    When full, what it holds becomes the older generation, from which what is
    used again comes back.
    """

    def __init__(self, most_bytes: int = 24 << 20):
        super().__init__()
        self._most, self._held, self._older = most_bytes // 2, 0, {}

    def __missing__(self, chunk: bytes) -> tuple[int, int, bool, bool]:
        found = self._older.get(chunk)
        if found is None:
            starts, heads = _unit_starts(chunk)
            found = len(starts), int(heads.sum()), bool(_LETTER[chunk[0]]), bool(_LETTER[chunk[-1]])
        self._held += len(chunk) + 200
        if self._held > self._most:
            self._older, self._held = dict(self), len(chunk) + 200
            self.clear()
        self[chunk] = found
        return found


class CutText:
    """A text as chunks with their sums: number of units, and the byte and code point at which a unit starts."""

    def __init__(self, text: bytes, sums: ChunkSums):
        self.size, begin, ends_in_letter = len(text), 0, False
        self.units = self.points = 0
        self._chunks: list[tuple[int, int, int, int, bytes]] = []  # units and code points before, joined, first byte, chunk
        for end in chunk_borders(text):
            chunk = text[begin:end]
            units, points, first, last = sums[chunk]
            joined = int(ends_in_letter and first)  # the first unit goes on from the chunk before
            self._chunks.append((self.units, self.points, joined, begin, chunk))
            self.units += units - joined
            self.points += points
            begin, ends_in_letter = end, last

    def at(self, unit: int) -> tuple[int, int]:
        """Byte and code point where ``unit`` starts; the end of the text for the number of units."""
        if unit >= self.units:
            return self.size, self.points
        low, high = 0, len(self._chunks)
        while high - low > 1:
            middle = (low + high) // 2
            low, high = (middle, high) if self._chunks[middle][0] <= unit else (low, middle)
        units, points, joined, begin, chunk = self._chunks[low]
        starts, heads = _unit_starts(chunk)
        place = int(starts[unit - units + joined])
        return begin + place, points + int(heads[:place].sum())


def draws(key: str, salt: str = "1") -> list[int]:
    """Four numbers below 2^32 from the id."""
    digest = hashlib.sha256(f"{salt}:{key}".encode()).digest()
    return [int.from_bytes(digest[i:i + 4], "big") for i in (0, 4, 8, 12)]


def transform(key: str, text: str | None, sums: ChunkSums, plain: int, spm: int) -> tuple[int, str, int | None, int | None, str]:
    """Units, form, code points of prefix and middle, and the text in its form."""
    text = text or ""
    coded = text.encode()
    cut = CutText(coded, sums)
    h1, h2, h3, h4 = draws(key)
    if not text or any(mark in text for mark in (PREFIX, SUFFIX, MIDDLE)) or h3 % 100 >= 100 - plain:
        return cut.units, "plain", None, None, text
    first, second = sorted((h1 % (cut.units + 1), h2 % (cut.units + 1)))
    (a, a_points), (b, b_points) = cut.at(first), cut.at(second)
    prefix, middle, suffix = coded[:a].decode(), coded[a:b].decode(), coded[b:].decode()
    if h4 % 100 < spm:
        return cut.units, "spm", a_points, b_points - a_points, SUFFIX + suffix + PREFIX + prefix + MIDDLE + middle
    return cut.units, "psm", a_points, b_points - a_points, PREFIX + prefix + SUFFIX + suffix + MIDDLE + middle


ADDED = ("n", "form", "prefix_chars", "middle_chars", "output")


def fill_in_middle(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", plain_percent: int = PLAIN_PERCENT, spm_percent: int = SPM_PERCENT
) -> DataFrame:
    """All columns of ``docs`` and n (units, long), form (plain, psm, spm), prefix_chars, middle_chars (long) and output (string).

    The cuts follow from the id alone, so reruns and repeated rows agree.  A
    null id counts as the empty string; null text as the empty text, which is
    plain, as are texts that hold a marker and ``plain_percent`` of the others
    (``prefix_chars`` and ``middle_chars`` null).  Input columns with the names
    added are left out.  Rows are neither dropped, merged nor moved; nothing
    is shuffled.
    """
    kept = [c for c in docs.columns if c not in ADDED]
    # The id travels as text, beside the column itself, whatever its type is.
    docs = docs.select(*kept, F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("__key"))
    out = docs.select(*kept).schema.add("n", "long").add("form", "string").add("prefix_chars", "long").add("middle_chars", "long").add("output", "string")
    schema, at = to_arrow_schema(out), kept.index(text_col)

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = ChunkSums()
        for whole in parts:
            for start in range(0, whole.num_rows, 256):
                part = whole.slice(start, 256)
                rows = [transform(k, t, sums, plain_percent, spm_percent) for k, t in zip(part.column(len(kept)).to_pylist(), part.column(at).to_pylist())]
                own = [c.cast(schema.field(i).type) for i, c in enumerate(part.columns[:len(kept)])]
                added = [pa.array(c, schema.field(name).type) for name, c in zip(ADDED, zip(*rows))]
                yield pa.RecordBatch.from_arrays(own + added, schema=schema)

    return docs.mapInArrow(run, out)


def restored(output: str = "output", form: str = "form") -> Column:
    """The text that ``output`` was made from; no marker stands in a text that was cut, so the first of each is the one added."""
    rest = F.substring(F.col(output), len(PREFIX) + 1, 2**31 - 1)

    def parts(mark: str) -> tuple[Column, Column, Column]:
        """First, second and last part, of which ``mark`` and MIDDLE stand between."""
        head = F.substring_index(rest, mark, 1)
        tail = F.substring(rest, F.length(head) + len(mark) + 1, F.lit(2**31 - 1))
        second = F.substring_index(tail, MIDDLE, 1)
        return head, second, F.substring(tail, F.length(second) + len(MIDDLE) + 1, F.lit(2**31 - 1))

    prefix, suffix, middle = parts(SUFFIX)
    psm = F.concat(prefix, middle, suffix)
    suffix, prefix, middle = parts(PREFIX)
    spm = F.concat(prefix, middle, suffix)
    return F.when(F.col(form) == "psm", psm).when(F.col(form) == "spm", spm).otherwise(F.col(output))


def op13_chunk_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = fill_in_middle(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return made.select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars",
        F.sha2(F.col("output").cast("binary"), 256).alias("output_sha256"), F.sha2(restored().cast("binary"), 256).alias("restored_sha256"),
    )


OP13_SQL = f"""
WITH unit AS (
    SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') AS units, sha256('1:' || doc_id) AS h
    FROM documents
), draw AS (
    SELECT doc_id, text, units, len(units) AS n, ('0x' || h[1:8])::UBIGINT AS h1, ('0x' || h[9:16])::UBIGINT AS h2,
           ('0x' || h[17:24])::UBIGINT AS h3, ('0x' || h[25:32])::UBIGINT AS h4
    FROM unit
), cut AS (
    SELECT *, least(h1 % (n + 1), h2 % (n + 1))::BIGINT AS a, greatest(h1 % (n + 1), h2 % (n + 1))::BIGINT AS b,
           CASE WHEN text = '' OR contains(text, '{PREFIX}') OR contains(text, '{SUFFIX}') OR contains(text, '{MIDDLE}') OR h3 % 100 >= {100 - PLAIN_PERCENT} THEN 'plain'
                WHEN h4 % 100 < {SPM_PERCENT} THEN 'spm' ELSE 'psm' END AS form
    FROM draw
), part AS (
    SELECT doc_id, text, n, form, array_to_string(units[1:a], '') AS p, array_to_string(units[a + 1:b], '') AS m, array_to_string(units[b + 1:], '') AS s FROM cut
)
SELECT doc_id, n::BIGINT AS n, form, CASE WHEN form <> 'plain' THEN length(p) END::BIGINT AS prefix_chars, CASE WHEN form <> 'plain' THEN length(m) END::BIGINT AS middle_chars,
       sha256(CASE form WHEN 'psm' THEN '{PREFIX}' || p || '{SUFFIX}' || s || '{MIDDLE}' || m WHEN 'spm' THEN '{SUFFIX}' || s || '{PREFIX}' || p || '{MIDDLE}' || m ELSE text END) AS output_sha256,
       sha256(text) AS restored_sha256
FROM part
"""
