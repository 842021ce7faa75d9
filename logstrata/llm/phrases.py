"""Operator 12: phrases of two and three words by dynamic itemset counting.

The corpus is cut into shards that are scanned in a cycle.  Words are counted
from the first scan on.  A pair is activated by the scan in which both its
words have reached the threshold, a triple by the scan in which both its pairs
have; each is then counted in the next scans, side by side with whatever
else is active, until it has seen every shard once.  So lengths overlap, and
the scans end when everything active has completed its cycle.  A phrase that
is frequent has only frequent parts, so all of them are found and their counts
are exact.

Every scan is a Spark job over the chunks of one shard
(:mod:`logstrata.llm.wordchunks`): chunks ask the buckets of words and of pairs
which of theirs are active since when, and send counts; the state of a bucket
is a row of a written table, replaced by each scan.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import ArrayType, StructType

from logstrata.llm.common import pieces_for, table, text_bytes, written
from logstrata.llm.wordchunks import Workspace, chunk_number, pack, pack_sorted, segments, spread, text_pieces, unpack, unpack_sorted, word_hashes

LEAST, FIRST, SHARDS = 10, 2000, 3
COVERED_PERCENT = 50  # a phrase goes if a longer one around it has so many of its occurrences
UNKNOWN = "und"

_BREAK = 0xFFFFFFFF  # between pieces
_HALF, _LOW = np.uint64(32), np.uint64(0xFFFFFFFF)
#: Capitals A-Z become small; what ends a piece becomes a byte that no UTF-8 text holds.
_FOLD = bytes(0xFF if chr(b) in ".,;:!?\n\x0b\x0c\r" else b + 32 if 65 <= b <= 90 else b for b in range(256))


def _encoded(docs: DataFrame, text_col: str, lang_col: str, chunk_bytes: int, buckets: int, shards: int) -> DataFrame:
    rows = docs.select(F.col(text_col).cast("binary").alias("text"), F.coalesce(F.col(lang_col).cast("string"), F.lit(UNKNOWN)).alias("lang"))
    word = StructType().add("bucket", "integer").add("hashes", "binary").add("counts", "binary").add("names", "binary")
    out = StructType().add("chunk", "long").add("shard", "integer").add("tokens", "binary").add("words", ArrayType(word))
    out = out.add("langs", ArrayType(StructType().add("lang", "string").add("n", "long")))
    schema = to_arrow_schema(out)

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for n, held in enumerate(text_pieces(parts, 0, chunk_bytes)):
            fresh = count().__next__
            known: dict[str, defaultdict] = {}
            tokens = []
            for part in held:
                for text, lang in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                    if lang not in known:
                        known[lang] = defaultdict(fresh, {b"\xff": _BREAK})
                    numbers = known[lang]
                    words = text.translate(_FOLD).replace(b"\xff", b" \xff ").split() if text else []
                    tokens.append(np.fromiter([numbers[w] for w in words] + [_BREAK], np.uint32, len(words) + 1))
            tokens = np.concatenate(tokens)
            yield _chunk_row(n, tokens, known, buckets, shards, schema)

    return rows.mapInArrow(run, out)


def _chunk_row(n: int, tokens: np.ndarray, known: dict[str, defaultdict], buckets: int, shards: int, schema: pa.Schema) -> pa.RecordBatch:
    size = sum(map(len, known.values())) - len(known)
    hashes, bucket, langs = np.zeros(size, np.uint64), np.zeros(size, np.int64), []
    names: list[bytes] = [b""] * size
    word = tokens != _BREAK
    counts = np.bincount(tokens[word], minlength=size).astype(np.uint32)
    for lang, numbers in known.items():
        del numbers[b"\xff"]
        own = np.fromiter(numbers.values(), np.int64, len(numbers))
        first, deal = word_hashes(numbers, xxhash.xxh32_intdigest(lang) | 1 << 32)
        hashes[own], bucket[own] = first, (deal % np.uint64(buckets)).astype(np.int64)
        tag = lang.encode() + b"\xff"
        for w, at in numbers.items():
            names[at] = tag + w
        langs.append({"lang": lang, "n": int(counts[own].sum())})
    order = np.lexsort((hashes, bucket))
    place = np.empty(size, np.uint32)
    place[order] = np.arange(size, dtype=np.uint32)
    tokens[word] = place[tokens[word]]
    words = [
        {"bucket": b, "hashes": pack_sorted(hashes[own]), "counts": pack(counts[own]), "names": pack(np.frombuffer(b"\xfe".join([names[i] for i in own.tolist()]), np.uint8))}
        for b, own in ((b, order[i:j]) for b, i, j in segments(bucket[order])[1])
    ]
    number = chunk_number(n)
    shard = ((number >> 24) + number) % shards  # as _shard_of
    row = [number, shard, pack(tokens), words, langs]
    return pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(row, schema)], schema=schema)


def _shard_of(chunk: str, shards: int) -> Column:
    return F.pmod(F.shiftright(chunk, 24) + F.col(chunk), F.lit(shards))


class _Counted:
    """A bucket's keys with their counts, and for the frequent ones the scan that activated them and a place that stays."""

    def __init__(self, state: list[dict]):
        row = state[0] if state else None
        self.keys = unpack_sorted(row["keys"]) if row else np.zeros(0, np.uint64)
        self.counts = unpack(row["counts"]).astype(np.int64) if row else np.zeros(0, np.int64)
        self.since = unpack(row["since"], np.uint16) if row else np.zeros(0, np.uint16)  # scan + 1; 0: not frequent
        self.places = unpack(row["places"], np.uint32) if row else np.zeros(0, np.uint32)  # from 1

    def add(self, keys: list[np.ndarray], counts: list[np.ndarray], scan: int, least: int) -> np.ndarray:
        """Sum up the counts; returns which keys become frequent by them."""
        values, inverse = np.unique(np.concatenate([self.keys, *keys]), return_inverse=True)
        sums = np.bincount(inverse, weights=np.concatenate([self.counts, *counts]), minlength=len(values)).astype(np.int64)
        since, places = np.zeros(len(values), np.uint16), np.zeros(len(values), np.uint32)
        since[inverse[:len(self.keys)]], places[inverse[:len(self.keys)]] = self.since, self.places
        new = np.flatnonzero((sums >= least) & (since == 0))
        new = new[np.argsort(-sums[new], kind="stable")]  # small numbers for the most frequent
        since[new], places[new] = scan + 1, places.max(initial=0) + 1 + np.arange(len(new), dtype=np.uint32)
        self.keys, self.counts, self.since, self.places = values, sums, since, places
        return new

    def keep(self, which: np.ndarray) -> None:
        self.keys, self.counts, self.since, self.places = (a[which] for a in (self.keys, self.counts, self.since, self.places))

    def of(self, keys: np.ndarray) -> tuple[bytes, bytes]:
        """Places and activating scans of some keys."""
        at = np.minimum(np.searchsorted(self.keys, keys), max(0, len(self.keys) - 1))
        same = self.keys[at] == keys if len(self.keys) else np.zeros(len(keys), bool)
        places, since = (np.where(same, a[at], 0).astype(a.dtype) if len(self.keys) else np.zeros(len(keys), a.dtype) for a in (self.places, self.since))
        return pack(places), pack(since)

    def row(self) -> tuple:
        return pack_sorted(self.keys), pack(self.counts.astype(np.uint64)), pack(self.since), pack(self.places), int(self.since.max(initial=0))


#: What buckets write: their state, what they answer a chunk, and the names of words that became frequent.
_OUT = "kind string, bucket int, chunk long, keys binary, counts binary, since binary, places binary, last int, names binary"
_OUT_SCHEMA = pa.schema([
    ("kind", pa.string()), ("bucket", pa.int32()), ("chunk", pa.int64()), ("keys", pa.binary()), ("counts", pa.binary()),
    ("since", pa.binary()), ("places", pa.binary()), ("last", pa.int32()), ("names", pa.binary()),
])
_SENT = "bucket int, chunk long, keys binary, counts binary"
_SENT_SCHEMA = pa.schema([("bucket", pa.int32()), ("chunk", pa.int64()), ("keys", pa.binary()), ("counts", pa.binary())])
_ANSWER = ["kind", "bucket", "chunk", "since", "places"]


def _table(rows: list[tuple], schema: pa.Schema) -> pa.Table:
    return pa.table([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)] if rows else [pa.array([], f.type) for f in schema], schema=schema)


class _Chunk:
    """A chunk's tokens, and what the buckets have said of its words and pairs before ``scan``."""

    def __init__(self, chunk: pa.Table, answers: pa.Table, buckets: int, scan: int):
        self.number, self._buckets, self._scan, self._answers = chunk.column("chunk")[0].as_py(), buckets, scan, answers
        self.tokens = unpack(chunk.column("tokens")[0].as_py(), np.uint32)
        owners, places, since = self._said("word")
        numbers = np.where(places > 0, (places.astype(np.int64) - 1) * buckets + owners, -1)
        if numbers.max(initial=0) >= 1 << 32:
            raise OverflowError("more than 2^32 frequent words; count with a larger ``least``")
        numbers, since = np.append(numbers, -1), np.append(since, np.uint16(0))
        at = np.where(self.tokens == _BREAK, len(numbers) - 1, self.tokens)
        self.words, self._since = numbers[at], since[at]

    def _said(self, kind: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Buckets, places and activating scans (from 1), of what was frequent before this scan; 0 for the rest."""
        own = self._answers.filter(pc.equal(self._answers.column("kind"), kind)).sort_by("bucket")
        places = [unpack(p, np.uint32) for p in own.column("places").to_pylist()]
        since = [unpack(s, np.uint16) for s in own.column("since").to_pylist()]
        owner = np.repeat(np.array(own.column("bucket").to_pylist(), np.int64), [len(p) for p in places])
        places, since = (np.concatenate(a) if a else np.zeros(0, np.uint16) for a in (places, since))
        known = (since > 0) & (since <= self._scan)
        return owner, np.where(known, places, 0), np.where(known, since, 0).astype(np.uint16)

    def find_pairs(self, shards: int) -> np.ndarray:
        """Distinct active pairs in the order of their buckets; returns how often each counts in this scan."""
        ok = (self.words[1:] >= 0) & (self.words[:-1] >= 0)
        self.at = np.flatnonzero(ok)  # first words
        since = np.maximum(self._since[self.at], self._since[self.at + 1])
        keys, inverse = np.unique(self.words[self.at].astype(np.uint64) << _HALF | self.words[self.at + 1].astype(np.uint64), return_inverse=True)
        order, self.cuts = segments(spread(keys, self._buckets).astype(np.int64))
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        self.keys, self.pair_at = keys[order], place[inverse]
        return np.bincount(self.pair_at, weights=since > self._scan - shards, minlength=len(order)).astype(np.uint32)

    def triples(self, shards: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """Active triples and their counts in this scan, by bucket of their first pair."""
        _, places, since = self._said("pair")
        pair = np.full(len(self.tokens), -1, np.int32)
        pair[self.at] = np.where(places[self.pair_at] > 0, self.pair_at, -1)
        at = np.flatnonzero((pair[1:] >= 0) & (pair[:-1] >= 0))
        at = at[np.maximum(since[pair[at]], since[pair[at + 1]]) > self._scan - shards]
        codes, counts = np.unique(pair[at].astype(np.uint64) << _HALF | self.words[at + 2].astype(np.uint64), return_counts=True)
        owner = (codes >> _HALF).astype(np.int64)
        codes = places[owner].astype(np.uint64) << _HALF | codes & _LOW
        for (b, i, j), k, m in zip(self.cuts, np.searchsorted(owner, [i for _, i, _ in self.cuts]), np.searchsorted(owner, [j for _, _, j in self.cuts])):
            if m > k:
                order = np.argsort(codes[k:m])  # places follow activation, not keys
                yield b, codes[k:m][order], counts[k:m][order].astype(np.uint32)


class _Scans:
    """The counting of one corpus: chunks, and the written state of words, pairs and triples."""

    def __init__(self, docs: DataFrame, text_col: str, lang_col: str, least: int, shards: int, chunk_bytes: int, bucket_bytes: int):
        self.spark, self.work, self.least, self.shards = docs.sparkSession, Workspace(docs.sparkSession), least, shards
        total = pieces_for(docs, text_bytes(text_col), 1)
        self.buckets = -(-total // bucket_bytes)
        rows = _encoded(docs, text_col, lang_col, chunk_bytes, self.buckets, shards)
        self.chunks = self.work.chunks(rows, 2 * -(-total // chunk_bytes), "phrase-chunks")
        none = self.spark.createDataFrame([], _OUT)
        self.words = self.pairs = self.triples = none  # what the last scan wrote
        self.names, self._answers = none, None
        self.cycle_of = {"words": -1, "pairs": -1}  # the last scan that activated by them

    def run(self) -> "_Scans":
        scan = 0
        while True:
            self._scan(scan)
            if scan >= self.shards - 1 and all(last < 0 or scan >= last + self.shards for last in self.cycle_of.values()):
                return self
            scan += 1

    def _scan(self, scan: int) -> None:
        shard, least, shards, buckets = F.col("shard") == scan % self.shards, self.least, self.shards, self.buckets
        if scan < shards:
            self._count_words(scan, shard)
            word_answers = self.words.where("kind = 'word'").select(*_ANSWER)
        else:  # words are complete: their answers to all chunks are written once
            if self._answers is None:
                self._answers = self._final_words()
            word_answers = self._answers.where(_shard_of("chunk", shards) == scan % shards)
        if scan == 0 or self.cycle_of["words"] < 0:
            return

        def send_pairs(chunk: pa.Table, answers: pa.Table) -> pa.Table:
            if not chunk.num_rows:
                return _table([], _SENT_SCHEMA)
            own = _Chunk(chunk, answers, buckets, scan)
            counts = own.find_pairs(shards)
            return _table([(b, own.number, pack_sorted(own.keys[i:j]), pack(counts[i:j])) for b, i, j in own.cuts], _SENT_SCHEMA)

        complete = scan >= self.cycle_of["words"] + shards if scan >= shards else False

        def count_pairs(sent: pa.Table, state: pa.Table) -> pa.Table:
            bucket = (sent if sent.num_rows else state).column("bucket")[0].as_py()
            held = _Counted(state.to_pylist())
            owners, keys, counts = ([], [], []) if not sent.num_rows else (
                sent.column("chunk").to_pylist(), [unpack_sorted(k) for k in sent.column("keys").to_pylist()], [unpack(c, np.uint32) for c in sent.column("counts").to_pylist()]
            )
            held.add([k[c > 0] for k, c in zip(keys, counts)], [c[c > 0] for c in counts], scan, least)
            if complete:
                held.keep(held.since > 0)
            answers = [("pair", bucket, o, None, None, *reversed(held.of(k)), 0, None) for o, k in zip(owners, keys)]
            return _table([("state", bucket, None, *held.row(), None), *answers], _OUT_SCHEMA)

        sent = self.chunks.answered(word_answers, ["tokens"], send_pairs, _SENT, shard)
        state = self.pairs.where("kind = 'state'").drop("kind", "chunk", "last", "names")
        self.pairs = self.work.written(sent.groupBy("bucket").cogroup(state.groupBy("bucket")).applyInArrow(count_pairs, _OUT), "phrase-pairs")
        self._note("pairs", self.pairs)
        pair_answers = self.pairs.where("kind = 'pair'").select(*_ANSWER)

        def send_triples(chunk: pa.Table, answers: pa.Table) -> pa.Table:
            if not chunk.num_rows:
                return _table([], _SENT_SCHEMA)
            own = _Chunk(chunk, answers, buckets, scan)
            own.find_pairs(shards)
            return _table([(b, own.number, pack_sorted(k), pack(c)) for b, k, c in own.triples(shards)], _SENT_SCHEMA)

        def count_triples(sent: pa.Table, state: pa.Table) -> pa.Table:
            bucket = (sent if sent.num_rows else state).column("bucket")[0].as_py()
            held = _Counted(state.to_pylist())
            keys, counts = ([unpack_sorted(k) for k in sent.column("keys").to_pylist()], [unpack(c, np.uint32) for c in sent.column("counts").to_pylist()]) if sent.num_rows else ([], [])
            held.add(keys, counts, scan, least)
            return _table([("state", bucket, None, *held.row(), None)], _OUT_SCHEMA)

        if self.cycle_of["pairs"] < 0 or (self.cycle_of["pairs"] == scan and self._first_pairs == scan):
            return  # no pair was frequent before this scan
        sent = self.chunks.answered(word_answers.union(pair_answers), ["tokens"], send_triples, _SENT, shard)
        state = self.triples.where("kind = 'state'").drop("kind", "chunk", "last", "names")
        self.triples = self.work.written(sent.groupBy("bucket").cogroup(state.groupBy("bucket")).applyInArrow(count_triples, _OUT), "phrase-triples")

    _first_pairs: int | None = None

    def _note(self, kind: str, state: DataFrame) -> None:
        """Remember the last scan that made a phrase of this kind frequent: one number reaches the driver."""
        last = state.agg(F.max("last")).first()[0]
        self.cycle_of[kind] = (last or 0) - 1
        if kind == "pairs" and last and self._first_pairs is None:
            self._first_pairs = last - 1

    def _count_words(self, scan: int, shard: Column) -> None:
        least = self.least

        def count_words(sent: pa.Table, state: pa.Table) -> pa.Table:
            bucket = (sent if sent.num_rows else state).column("bucket")[0].as_py()
            held = _Counted(state.to_pylist())
            owners, keys, counts, names = ([], [], [], []) if not sent.num_rows else (
                sent.column("chunk").to_pylist(), [unpack_sorted(k) for k in sent.column("hashes").to_pylist()],
                [unpack(c, np.uint32) for c in sent.column("counts").to_pylist()], sent.column("names").to_pylist(),
            )
            new = held.add(keys, counts, scan, least)
            out = [("state", bucket, None, *held.row(), None)]
            out += [("word", bucket, o, None, None, *reversed(held.of(k)), 0, None) for o, k in zip(owners, keys)]
            named = np.sort(held.keys[new])
            for own, packed in zip(keys, names):  # each new word is named by one of its chunks
                at = np.flatnonzero(np.isin(own, named, assume_unique=True))
                if len(at):
                    texts = unpack(packed, np.uint8).tobytes().split(b"\xfe")
                    places = held.places[np.searchsorted(held.keys, own[at])]
                    out.append(("name", bucket, None, None, None, None, pack(places), 0, b"\xfe".join([texts[i] for i in at.tolist()])))
                    named = np.setdiff1d(named, own[at], assume_unique=True)
            return _table(out, _OUT_SCHEMA)

        sent = self.chunks.rows.where(shard).select("chunk", F.inline("words"))
        state = self.words.where("kind = 'state'").drop("kind", "chunk", "last", "names")
        self.words = self.work.written(sent.groupBy("bucket").cogroup(state.groupBy("bucket")).applyInArrow(count_words, _OUT), "phrase-words")
        self.names = self.names.union(self.words.where("kind = 'name'"))
        self._note("words", self.words)

    def _final_words(self) -> DataFrame:
        def answer(sent: pa.Table, state: pa.Table) -> pa.Table:
            held, bucket = _Counted(state.to_pylist()), state.column("bucket")[0].as_py()
            owners, keys = (sent.column(c).to_pylist() for c in ("chunk", "hashes"))
            return _table([("word", bucket, o, None, None, *reversed(held.of(unpack_sorted(k))), 0, None) for o, k in zip(owners, keys)], _OUT_SCHEMA)

        sent = self.chunks.rows.select("chunk", F.inline("words")).drop("counts", "names")
        state = self.words.where("kind = 'state'").drop("kind", "chunk", "last", "names")
        return self.work.written(sent.groupBy("bucket").cogroup(state.groupBy("bucket")).applyInArrow(answer, _OUT), "phrase-answers").select(*_ANSWER)

    # ------------------------------------------------------------ what was counted, as rows
    def frequent(self, state: DataFrame) -> DataFrame:
        """bucket, place, key, f of the frequent keys of a state."""
        schema = pa.schema([("bucket", pa.int32()), ("place", pa.int64()), ("key", pa.uint64()), ("f", pa.int64())])

        def rows(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for part in parts:
                for row in part.to_pylist():
                    held = _Counted([row])
                    held.keep(held.since > 0)
                    n = len(held.keys)
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(n, row["bucket"], np.int32)), pa.array(held.places.astype(np.int64)), pa.array(held.keys.view(np.int64)), pa.array(held.counts)], names=schema.names)

        return state.where("kind = 'state'").mapInArrow(rows, "bucket int, place long, key long, f long")

    def named(self) -> DataFrame:
        """number, lang, word of the frequent words."""
        buckets, schema = self.buckets, pa.schema([("number", pa.int64()), ("lang", pa.string()), ("word", pa.string())])

        def rows(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for part in parts:
                for row in part.to_pylist():
                    numbers = (unpack(row["places"], np.uint32).astype(np.int64) - 1) * buckets + row["bucket"]
                    langs, words = zip(*map(_name, row["names"].split(b"\xfe")))
                    yield pa.RecordBatch.from_arrays([pa.array(numbers), pa.array(langs, pa.string()), pa.array(words, pa.string())], schema=schema)

        return self.names.mapInArrow(rows, "number long, lang string, word string")


def _name(name: bytes) -> tuple[str, str]:
    lang, _, word = name.partition(b"\xff")
    return lang.decode(), word.decode()


def _score(a: str, left: str, right: str) -> Column:
    """floor(1000000 a a / (l r)) in 38 digits."""
    wide = [f"cast({c} as decimal(19, 0))" for c in (a, a, left, right)]
    return F.expr(f"cast((cast(1000000 as decimal(7, 0)) * {wide[0]} * {wide[1]}) div ({wide[2]} * {wide[3]}) as long)")


def collocations(
    docs: DataFrame, text_col: str = "text", lang_col: str = "lang", least: int = LEAST, covered_percent: int = COVERED_PERCENT,
    shards: int = SHARDS, chunk_bytes: int = 16 << 20, bucket_bytes: int = 16 << 20,
) -> DataFrame:
    """All phrases of two and three words that occur at least ``least`` times: lang, phrase, words (2 or 3), a, l, r, n, score (long).

    Words are what lies between blanks in the pieces that ``.,;:!?`` and line
    ends leave of the lower-cased (A-Z) text; all counts are by language (null:
    ``und``).  ``a`` counts the phrase, ``l`` and ``r`` its two sides at the cut
    with the lowest score (the first such), ``n`` all words.  Phrases of two
    words inside a longer one that has ``covered_percent`` of their occurrences
    are left out.  Null and empty texts have no words; repeated rows count
    each; ids and further columns are not looked at.
    """
    scans = _Scans(docs, text_col, lang_col, least, shards, chunk_bytes, bucket_bytes).run()
    high, low = F.shiftrightunsigned("key", 32), F.col("key").bitwiseAND(F.lit(0xFFFFFFFF))
    words = scans.frequent(scans.words).select(((F.col("place") - 1) * scans.buckets + F.col("bucket")).alias("number"), F.col("f"))
    words = words.join(scans.named(), "number")
    pairs = scans.frequent(scans.pairs).select(F.struct("bucket", "place").alias("pair"), high.alias("x"), low.alias("y"), "f")
    words, pairs = scans.work.written(words, "phrase-word-rows"), scans.work.written(pairs, "phrase-pair-rows")
    triples = scans.frequent(scans.triples).select(F.struct("bucket", high.cast("long").alias("place")).alias("pair"), low.alias("z"), F.col("f").alias("a"))
    first, second = pairs.withColumnRenamed("f", "f_xy"), pairs.select(F.col("x").alias("y"), F.col("y").alias("z"), F.col("pair").alias("later"), F.col("f").alias("f_yz"))
    triples = scans.work.written(triples.join(first, "pair").join(second, ["y", "z"]), "phrase-triple-rows")
    around = triples.select("pair", "a").union(triples.select(F.col("later").alias("pair"), "a")).groupBy("pair").agg(F.max("a").alias("longest"))
    pairs = pairs.join(around, "pair", "left").where(f"longest IS NULL OR 100 * longest < {covered_percent} * f")

    def word(number: str) -> DataFrame:
        return words.select(F.col("number").alias(number), F.col("word").alias(f"word_{number}"), F.col("f").alias(f"f_{number}"), F.col("lang").alias(f"lang_{number}"))

    two = pairs.join(word("x"), "x").join(word("y"), "y")
    two = two.select(F.col("lang_x").alias("lang"), F.concat_ws(" ", "word_x", "word_y").alias("phrase"), F.lit(2).alias("words"), F.col("f").alias("a"), F.col("f_x").alias("l"), F.col("f_y").alias("r"))
    two = two.withColumn("score", _score("a", "l", "r"))
    three = triples.join(word("x"), "x").join(word("y"), "y").join(word("z"), "z")
    three = three.withColumn("early", _score("a", "f_x", "f_yz")).withColumn("late", _score("a", "f_xy", "f_z"))
    sooner = F.col("early") <= F.col("late")
    three = three.select(
        F.col("lang_x").alias("lang"), F.concat_ws(" ", "word_x", "word_y", "word_z").alias("phrase"), F.lit(3).alias("words"), "a",
        F.when(sooner, F.col("f_x")).otherwise(F.col("f_xy")).alias("l"), F.when(sooner, F.col("f_yz")).otherwise(F.col("f_z")).alias("r"),
        F.least("early", "late").alias("score"),
    )
    totals = scans.chunks.rows.select(F.inline("langs")).groupBy("lang").agg(F.sum("n").alias("n"))
    found = two.union(three).join(totals, "lang").select("lang", "phrase", "words", "a", "l", "r", "n", "score")
    found = written(found, "phrases")
    scans.work.clear()
    return found


def best(found: DataFrame, first: int = FIRST, parts: int = 64) -> DataFrame:
    """The ``first`` phrases of each language with their rank, by score, a and phrase.

    Ranked within ``parts`` parts of a language first, so one task gets at most
    ``parts`` times ``first`` rows of it.
    """
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    part = F.pmod(F.xxhash64("phrase"), F.lit(parts))
    for keys in (["lang", part], ["lang"]):
        found = found.withColumn("rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)).cast("long")).where(F.col("rank") <= first)
    return found


def op12_dynamic_counting(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = best(collocations(table(spark, sf_dir, "documents")))
    return found.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


OP12_SQL = f"""
WITH piece AS (
    SELECT coalesce(lang, '{UNKNOWN}') AS lang,
           unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\\x0A-\\x0D]')) AS piece
    FROM documents
), cut AS (
    SELECT lang, list_filter(regexp_split_to_array(piece, '[\\x20\\x09]+'), lambda w: w <> '') AS w FROM piece
), one AS (
    SELECT lang, x, count(*) AS f FROM (SELECT lang, unnest(w) AS x FROM cut) GROUP BY ALL
), two AS (
    SELECT lang, w[i] AS x, w[i + 1] AS y, count(*) AS f FROM (SELECT lang, w, unnest(range(1, len(w))) AS i FROM cut) GROUP BY ALL HAVING count(*) >= {LEAST}
), three AS (
    SELECT lang, w[i] AS x, w[i + 1] AS y, w[i + 2] AS z, count(*) AS f FROM (SELECT lang, w, unnest(range(1, len(w) - 1)) AS i FROM cut) GROUP BY ALL HAVING count(*) >= {LEAST}
), around AS (
    SELECT lang, x, y, max(f) AS longest FROM (SELECT lang, x, y, f FROM three UNION ALL SELECT lang, y, z, f FROM three) GROUP BY ALL
), kept AS (
    SELECT t.lang, t.x || ' ' || t.y AS phrase, t.f AS a, p.f AS l, q.f AS r
    FROM two t JOIN one p ON t.lang = p.lang AND t.x = p.x JOIN one q ON t.lang = q.lang AND t.y = q.x
         LEFT JOIN around s ON t.lang = s.lang AND t.x = s.x AND t.y = s.y
    WHERE s.longest IS NULL OR 100 * s.longest < {COVERED_PERCENT} * t.f
), cuts AS (
    SELECT t.lang, t.x || ' ' || t.y || ' ' || t.z AS phrase, t.f AS a, p.f AS l, q.f AS r, 1 AS k
    FROM three t JOIN one p ON t.lang = p.lang AND t.x = p.x JOIN two q ON t.lang = q.lang AND t.y = q.x AND t.z = q.y
    UNION ALL
    SELECT t.lang, t.x || ' ' || t.y || ' ' || t.z, t.f, p.f, q.f, 2
    FROM three t JOIN two p ON t.lang = p.lang AND t.x = p.x AND t.y = p.y JOIN one q ON t.lang = q.lang AND t.z = q.x
), scored AS (
    SELECT *, ((1000000::HUGEINT * a * a) // (l::HUGEINT * r))::BIGINT AS score FROM (SELECT *, 0 AS k FROM kept UNION ALL SELECT * FROM cuts)
), lowest AS (
    SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1
), ranked AS (
    SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM lowest
)
SELECT lang, rank::BIGINT AS rank, phrase, a::BIGINT AS a, l::BIGINT AS l, r::BIGINT AS r, n::BIGINT AS n, score
FROM ranked JOIN (SELECT lang, sum(f) AS n FROM one GROUP BY lang) USING (lang) WHERE rank <= {FIRST}
"""
