"""Operator 7: language identification by prediction by partial matching.

For each language a tree of byte contexts up to three bytes deep is counted
on a bounded, documented sample of labelled texts and then frozen.  The code
length of a byte is that of its longest known context; where the byte was not
seen there, the escape probability of that context (number of distinct
successors over total plus distinct, method C) is paid and the next shorter
context is asked, down to a uniform code.  A text gets the language under
which its whole byte string is shortest.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import DoubleType, StringType, StructType

from logstrata.llm.common import give_back, table

UNKNOWN = "und"
DEPTH = 3  # context bytes
SYMBOLS = 64  # byte classes; the last holds all bytes that are rare in the sample
_PIECE = 1 << 19  # bytes scored at once

#: ASCII capitals count as small letters.
_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[65:91] += 32


class ContextTrees:
    """Frozen statistics of all languages, as tables of code lengths in bits.

    ``samples``: language -> list of texts as bytes.  Classes of bytes are
    chosen by their mean frequency over languages.
    """

    def __init__(self, samples: dict[str, list[bytes]]):
        self.languages = sorted(samples)
        counts = np.zeros(256)
        for texts in samples.values():
            seen = np.bincount(_FOLD[np.frombuffer(b"".join(texts), np.uint8)], minlength=256)
            counts += seen / max(1, seen.sum())
        common = [b for b in np.argsort(-counts, kind="stable")[: SYMBOLS - 1] if counts[b] > 0]
        self.classes = np.full(256, SYMBOLS - 1, np.int32)
        self.classes[common] = np.arange(len(common))
        self.classes = self.classes[_FOLD]
        self.rare_bits = float(np.log2(max(1, 256 - len(common))))
        self._space = int(self.classes[32])
        self.grams, self._counted = self._count(samples)

    def _count(self, samples: dict[str, list[bytes]]) -> tuple[np.ndarray, list[list[tuple[np.ndarray, np.ndarray]]]]:
        per_language = []
        for language in self.languages:
            symbols = [self._symbols(t) for t in samples[language]]
            per_language.append([
                np.unique(np.concatenate([_keys(s, depth) for s in symbols] or [np.zeros(0, np.int64)]), return_counts=True)
                for depth in range(DEPTH + 1)
            ])
        deepest = [orders[DEPTH][0] for orders in per_language]
        return np.unique(np.concatenate(deepest)) if deepest else np.zeros(0, np.int64), per_language

    def _symbols(self, text: bytes) -> np.ndarray:
        """Classes of the bytes, after ``DEPTH`` blanks as the first context."""
        return np.concatenate([np.full(DEPTH, self._space), self.classes[np.frombuffer(text, np.uint8)]]).astype(np.int64)

    def own_rates(self) -> dict[str, tuple[int, float]]:
        """Of each language the bytes it was learned from and the bits a byte that these cost in its own tree."""
        out = {}
        for language, orders in zip(self.languages, self._counted):
            keys, seen = orders[DEPTH]
            total, distinct = _context_sums(keys, seen, SYMBOLS**DEPTH)
            bits = seen @ (np.log2(np.maximum(1, total + distinct))[keys // SYMBOLS] - np.log2(seen))
            bits += self.rare_bits * seen[keys % SYMBOLS == SYMBOLS - 1].sum()
            out[language] = int(seen.sum()), float(bits / max(1, seen.sum()))
        return out


def _keys(symbols: np.ndarray, depth: int) -> np.ndarray:
    """For each byte after the first ``DEPTH`` symbols: its context of ``depth`` symbols and itself as one number."""
    n = max(0, len(symbols) - DEPTH)
    key = np.zeros(n, np.int64)
    for back in range(depth, -1, -1):
        key = key * SYMBOLS + symbols[DEPTH - back:DEPTH - back + n]
    return key


class CodeLengths:
    """The trees spelled out: bits of every symbol after every context of two symbols, and of the longer ones that were seen."""

    def __init__(self, trees: ContextTrees):
        languages = len(trees.languages)
        self.languages, self._symbols = trees.languages, trees._symbols
        self.rare, self.rare_bits = SYMBOLS - 1, trees.rare_bits
        self.bits = np.empty((SYMBOLS**DEPTH, languages), np.float32)
        self.escape = np.empty((SYMBOLS**DEPTH, languages), np.float32)
        # Rows of the deepest level: of each context the first one, and one bit for each symbol seen after it.
        self._first = np.searchsorted(trees.grams, np.arange(SYMBOLS**DEPTH) * SYMBOLS).astype(np.int32)
        self._seen = np.zeros(SYMBOLS**DEPTH, np.uint64)
        np.bitwise_or.at(self._seen, trees.grams // SYMBOLS, np.uint64(1) << (trees.grams % SYMBOLS).astype(np.uint64))
        self.deep = np.zeros((len(trees.grams) + 1, languages), np.float32)
        for column, orders in enumerate(trees._counted):
            shorter = np.full(1, -np.log2(1 / SYMBOLS))
            for depth in range(DEPTH):
                keys, seen = orders[depth]
                total, distinct = _context_sums(keys, seen, SYMBOLS**depth)
                cost = np.repeat(_escape_bits(total, distinct), SYMBOLS)
                cost += np.tile(shorter, SYMBOLS) if depth else shorter[0]
                cost[keys] = np.log2(np.maximum(1, total + distinct))[keys // SYMBOLS] - np.log2(seen)
                shorter = cost
            self.bits[:, column] = shorter
            keys, seen = orders[DEPTH]
            total, distinct = _context_sums(keys, seen, SYMBOLS**DEPTH)
            escape = _escape_bits(total, distinct)
            self.escape[:, column] = escape
            deep = escape[trees.grams // SYMBOLS] + shorter[trees.grams % SYMBOLS**DEPTH]
            deep[np.searchsorted(trees.grams, keys)] = np.log2(np.maximum(1, total + distinct))[keys // SYMBOLS] - np.log2(seen)
            self.deep[1:, column] = deep

    def _row(self, key: np.ndarray) -> np.ndarray:
        """Row of each gram, from 1; 0 for those that no language has."""
        context, symbol = key // SYMBOLS, (key % SYMBOLS).astype(np.uint64)
        seen = self._seen[context] >> symbol
        before = np.bitwise_count(self._seen[context] ^ (seen << symbol))
        return np.where(seen & np.uint64(1), self._first[context] + before + 1, 0)

    def score(self, texts: list[bytes]) -> np.ndarray:
        """Bits of each whole text under each language (texts x languages)."""
        out = np.zeros((len(texts), len(self.languages)))
        held: list[np.ndarray] = []
        owners: list[int] = []
        size = 0
        for owner, text in enumerate(texts):
            symbols = self._symbols(text)
            for start in range(0, max(0, len(symbols) - DEPTH), _PIECE):
                held.append(symbols[start:start + _PIECE + DEPTH])
                owners.append(owner)
                size += len(held[-1])
                if size >= _PIECE:
                    self._add(out, held, owners)
                    held, owners, size = [], [], 0
        if held:
            self._add(out, held, owners)
        return out

    def _add(self, out: np.ndarray, held: list[np.ndarray], owners: list[int]) -> None:
        key = np.concatenate([_keys(s, DEPTH) for s in held])
        starts = np.cumsum([0] + [len(s) - DEPTH for s in held[:-1]])
        row = self._row(key)
        cost = self.deep[row]
        new = np.flatnonzero(row == 0)
        cost[new] = self.escape[key[new] // SYMBOLS] + self.bits[key[new] % SYMBOLS**DEPTH]
        cost[key % SYMBOLS == self.rare] += self.rare_bits
        np.add.at(out, owners, np.add.reduceat(cost, starts, axis=0, dtype=np.float64))


def _context_sums(keys: np.ndarray, seen: np.ndarray, contexts: int) -> tuple[np.ndarray, np.ndarray]:
    total = np.bincount(keys // SYMBOLS, weights=seen, minlength=contexts)
    return total, np.bincount(keys // SYMBOLS, minlength=contexts).astype(float)


def _escape_bits(total: np.ndarray, distinct: np.ndarray) -> np.ndarray:
    """Bits of leaving each context; none for one that was never seen."""
    return np.where(total > 0, np.log2(np.maximum(1, total + distinct)) - np.log2(np.maximum(1, distinct)), 0.0)


def held_out(id_col: str = "doc_id") -> F.Column:
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 3 == 1, F.lit(False))


def train(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
    texts_per_language: int = 300, bytes_per_text: int = 20_000, most_languages: int = 200,
) -> ContextTrees:
    """Trees from at most ``texts_per_language`` labelled texts a language, ``bytes_per_text`` bytes of each.

    The sample is the rows of smallest id hash within each language, out of
    those that are not held out; rows without id, label or text are not
    learned from, nor are labels other than the ``most_languages`` most
    frequent ones.  So it is bounded for any table (texts x bytes x
    languages).  Rows are counted first, and only those with hashes below what
    some more than enough of them have reach the window that picks them.
    """
    labelled = docs.where(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull() & F.col(id_col).isNotNull() & ~held_out(id_col))
    order = F.xxhash64(F.col(id_col).cast("long"))
    sizes = labelled.groupBy(F.col(lang_col).alias("lang")).count().orderBy(F.desc("count"), "lang").limit(most_languages)
    share = F.least(F.lit(1.0), F.lit(2.0 * texts_per_language + 200) / F.col("count"))
    # Hashes from -2^63 on; repeated ids make the window's input larger, not wrong.
    sizes = sizes.select("lang", (F.lit(-(2.0**63)) + share * 2.0**64).alias("most"))
    labelled = labelled.withColumn("__lang", F.col(lang_col)).join(F.broadcast(sizes.withColumnRenamed("lang", "__lang")), "__lang").where(order.cast("double") <= F.col("most"))
    window = Window.partitionBy("lang").orderBy("place")
    first = F.row_number().over(window)
    ids = labelled.select(F.col(lang_col).alias("lang"), order.alias("place"))
    ids = ids.withColumn("n", first).where(F.col("n") <= texts_per_language).drop("n").distinct()
    rows = labelled.select(F.col(lang_col).alias("lang"), order.alias("place"), F.substring(F.encode(text_col, "UTF-8"), 1, bytes_per_text).alias("sample"))
    rows = rows.join(F.broadcast(ids), ["lang", "place"], "left_semi")  # at most texts_per_language rows a language
    rows = rows.withColumn("n", first).where(F.col("n") <= texts_per_language)
    samples: dict[str, list[bytes]] = {}
    for row in rows.orderBy("lang", "place").collect():
        samples.setdefault(row["lang"], []).append(bytes(row["sample"]))
    return ContextTrees(samples)


#: The model of the last query that a Python worker served, spelled out once for all its tasks.
_LENGTHS: dict[str, CodeLengths] = {}


def identify(docs: DataFrame, trees: ContextTrees, text_col: str = "text", prefix: str = "") -> DataFrame:
    """All columns of ``docs`` and lang_pred, score, bits_per_byte (names after ``prefix``; input columns so named are replaced).

    Every whole text is scored.  ``score`` is the share of the best language
    in the likelihoods of all.  Null texts, texts without a letter, and all
    texts when nothing was learned get ``und`` with score 0 and null bits.
    """
    names = [prefix + n for n in ("lang_pred", "score", "bits_per_byte")]
    kept = [c for c in docs.columns if c not in names]
    docs = docs.select(*kept)
    model, at, mark = docs.sparkSession.sparkContext.broadcast(trees), kept.index(text_col), uuid.uuid4().hex
    out = StructType(list(docs.schema.fields)).add(names[0], StringType()).add(names[1], DoubleType()).add(names[2], DoubleType())
    schema = to_arrow_schema(out)

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if mark not in _LENGTHS:
            _LENGTHS.clear()
            _LENGTHS[mark] = CodeLengths(model.value)
        lengths = _LENGTHS[mark]
        for whole in parts:
            for start in range(0, whole.num_rows, 256):
                part = whole.slice(start, 256)
                found = _predict(lengths, part.column(at).to_pylist())
                arrays = [pa.array(c, schema.field(n).type) for n, c in zip(names, found)]
                yield pa.RecordBatch.from_arrays([c.cast(schema.field(i).type) for i, c in enumerate(part.columns)] + arrays, schema=schema)
        give_back()

    return docs.mapInArrow(run, out)


def _predict(lengths: CodeLengths, texts: list[str | None]) -> tuple[list, list, list]:
    known = [i for i, t in enumerate(texts) if t and any(map(str.isalpha, t))] if lengths.languages else []
    languages, scores, rates = [UNKNOWN] * len(texts), [0.0] * len(texts), [None] * len(texts)
    coded = [texts[i].encode() for i in known]
    for i, text, bits in zip(known, coded, lengths.score(coded)):
        best = int(np.argmin(bits))
        languages[i] = lengths.languages[best]
        scores[i] = float(1 / np.exp2(-np.minimum(bits - bits[best], 1000)).sum())
        rates[i] = float(bits[best] / len(text))
    return languages, scores, rates


#: A text that costs more bits a byte under every language than its plain bytes is in none of them.  Prose costs
#: 2 to 4.5, short prose around a key, a password or a number up to 7.4.
REJECT_BITS = 8.0
#: Beyond the allowance (bits; a key of a hundred bytes) a text may cost twice the rate of the texts its language was
#: learned from, and what prose costs in any case.  A language learned from few bytes is judged by REJECT_BITS alone.
ALLOWANCE, TIMES, PROSE_BITS, LEARNED_BYTES = 800.0, 2.0, 4.5, 100_000


def fits(trees: ContextTrees, text_col: str = "text", prefix: str = "") -> F.Column:
    """Whether a text that :func:`identify` has judged is in the language predicted for it; false for ``und``."""
    most = F.lit(REJECT_BITS)
    for language, (learned, rate) in trees.own_rates().items():
        if learned >= LEARNED_BYTES:
            rate = F.lit(max(PROSE_BITS, TIMES * rate)) + F.lit(ALLOWANCE) / F.greatest(F.octet_length(text_col), F.lit(1))
            most = F.when(F.col(f"{prefix}lang_pred") == language, F.least(F.lit(REJECT_BITS), rate)).otherwise(most)
    return (F.col(f"{prefix}lang_pred") != UNKNOWN) & (F.col(f"{prefix}bits_per_byte") <= most)


def op7_ppm_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = identify(docs.select("doc_id", "text"), train(docs))
    return found.select("doc_id", held_out().alias("held_out"), "lang_pred", "score", "bits_per_byte")
