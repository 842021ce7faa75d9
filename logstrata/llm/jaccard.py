"""Operator 4: near-duplicate documents by an exact Jaccard join over word shingles.

Two sets of similar size whose Jaccard similarity reaches the threshold
differ in at most H elements, H fixed by their size band.  The universe of
shingles is hashed into segments; by the pigeonhole principle such sets agree
in some segment, or, for segments that count twice, differ there in at most
one element, which the signatures of the segment and of all its one-deletion
subsets reveal.  How many segments of either kind a band has is chosen by
cost: signatures to write against matches by chance.  Every band has a few
segments to spare, so that a document may skip those that hold nothing or
only very frequent shingles.

Before that, shingles that no other document has are found by a count over
hash buckets; a document in which they are more than the threshold allows can
link with nothing and gets no signatures.  Equal sets are one set.  Pairs
that share a signature are verified on the whole sets: first one partner for each
document, then, tile by tile, only what a signature still holds apart.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from logstrata.llm.common import Scratch, components, lean, pieces_for, table, text_bytes, written
from logstrata.llm.wordchunks import chunk_number, segments, text_pieces
from logstrata.llm.embeddings import forest

WORDS = 5
PERCENT = 80
#: Counted copies (two a chunk at most) from which a shingle is very frequent.
FREQUENT = 64
_LOT = 512
_TILE = 256

_BASE = 0x9E3779B97F4A7C15
_MIX = np.uint64(0xBF58476D1CE4E5B9)
_MIX2 = np.uint64(0x94D049BB133111EB)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _MIX
    x = (x ^ (x >> np.uint64(27))) * _MIX2
    return x ^ (x >> np.uint64(31))


_POWERS = np.array([pow(_BASE, i, 1 << 64) for i in range(WORDS)], np.uint64)


def shingle_sets(texts: list[bytes | None], words: int = WORDS) -> list[np.ndarray]:
    """The set of each text as sorted 64-bit hashes of its shingles (all words, if fewer); empty without words."""
    number: dict[bytes, int] = {}
    split = [t.lower().split() if t else [] for t in texts]  # on bytes: only A-Z, and the blanks of WORD
    ids = np.fromiter((number.setdefault(w, len(number)) for w in chain.from_iterable(split)), np.int64)
    hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, number), np.uint64, len(number))
    powers = _POWERS if words == WORDS else np.array([pow(_BASE, i, 1 << 64) for i in range(words)], np.uint64)
    out, at = [], 0
    for own in split:
        n = len(own)
        h = hashes[ids[at:at + n]]
        at += n
        if n >= words:
            value = np.zeros(n - words + 1, np.uint64)
            for i in range(words):
                value += _mix(h[i:n - words + 1 + i] * powers[i] + np.uint64(i))
            out.append(np.unique(_mix(value)))
        else:
            out.append(np.unique(_mix(_mix(h * powers[:n] + np.arange(n, dtype=np.uint64)).sum(keepdims=True, dtype=np.uint64))) if n else h)
    return out


class Bands:
    """Size bands and how their sets are cut into segments.

    Band b holds the sizes from ``first[b]`` up to ``first[b + 1]``; a set of
    it can link only within the bands b - 1, b and b + 1.  ``plans[b]`` serves
    the pairs whose smaller set is in band b: (exact segments, segments with
    one deletion, segments to spare).
    """

    def __init__(self, counts: list[int], percent: int = PERCENT):
        self.percent = percent
        self.first = band_starts(percent)
        self.plans = [self._plan(b, counts[b] + (counts[b + 1] if b + 1 < len(counts) else 0)) for b in range(len(counts))]

    def difference(self, band: int) -> int:
        small = self.first[band + 1] - 1
        large = 100 * small // self.percent
        return (100 - self.percent) * (small + large) // (100 + self.percent)

    def _plan(self, band: int, sets: int) -> tuple[int, int, int]:
        units, size = self.difference(band) + 1, self.first[band]
        best = None
        for twice in range(0, units // 2 + 1) if units <= 64 else (0,):
            exact = units - 2 * twice
            mean = size / (exact + twice)
            chance = math.exp(-2 * mean)  # both sides empty; with one deletion also one element on one side
            cost = exact + twice * (1 + mean) + sets * chance * (exact + twice * (1 + 2 * mean))
            if best is None or cost < best[0]:
                best = cost, exact, twice
        _, exact, twice = best
        empty = exact * math.exp(-size / (exact + twice))
        spare = math.ceil(empty + 3 * math.sqrt(empty)) + exact // 16 if exact >= 8 else 0
        return exact + spare, twice, spare

    def signatures(self, size: int, known: np.ndarray, frequent: np.ndarray) -> np.ndarray:
        """Signatures of a set of ``size`` shingles of which ``known`` may be shared (``frequent``: which of these are)."""
        band = int(np.searchsorted(self.first, size, side="right")) - 1
        parts = [self._of(band, known, frequent)]
        if band and self.percent * size <= 100 * (self.first[band] - 1):
            parts.append(self._of(band - 1, known, frequent))
        return np.concatenate(parts)

    def _of(self, band: int, known: np.ndarray, frequent: np.ndarray) -> np.ndarray:
        exact, twice, spare = self.plans[band]
        segments = exact + twice
        mixed = _mix(known + np.uint64(band + 1))
        where = ((mixed >> np.uint64(32)) % np.uint64(segments)).astype(np.int64)
        sums = np.zeros(segments, np.uint64)
        np.add.at(sums, where, mixed)
        held = np.bincount(where, minlength=segments)
        salt = _mix(np.arange(segments, dtype=np.uint64) + np.uint64((band + 1) << 32))
        whole = _mix((sums + held.astype(np.uint64) * _MIX) ^ salt)
        dull = np.bincount(where[frequent], minlength=segments)[:exact] == held[:exact]
        kept = whole[:exact][~dull] if dull.sum() <= spare else whole[:exact]
        if not twice:
            return kept
        some = where >= exact
        place, value = where[some], mixed[some]
        less = _mix((sums[place] - value + (held[place] - 1).astype(np.uint64) * _MIX) ^ salt[place])
        return np.concatenate([kept, whole[exact:], less])


def band_starts(percent: int) -> list[int]:
    """First size of each band, beyond the size of any set."""
    first = [1]
    while first[-1] < 1 << 40:
        first.append(max(first[-1] + 1, -(-100 * first[-1] // percent)))
    return first


class _Chunk:
    """Sets of a chunk's documents, one for each distinct set, with the buckets and short codes of their shingles."""

    def __init__(self, ids: list[int | None], texts: list[bytes | None], words: int, buckets: int):
        self.ids, self.sets = ids, shingle_sets(texts, words)
        digests = np.array([xxhash.xxh3_64_intdigest(s.tobytes()) for s in self.sets], np.uint64)
        second = np.array([xxhash.xxh3_64_intdigest(s.tobytes(), 1) for s in self.sets], np.uint64)
        self.bucket = (second >> np.uint64(16)) % np.uint64(buckets)
        self.digests = digests
        #: (digest, bucket) -> smallest id in this chunk; of sets with elements and an id only.
        self.own: dict[tuple[int, int], int] = {}
        for i, own in enumerate(ids):
            if own is not None and len(self.sets[i]):
                key = self.key(i)
                self.own[key] = min(own, self.own.get(key, own))

    def key(self, i: int) -> tuple[int, int]:
        return int(self.digests[i]), int(self.bucket[i])

    def leaders(self) -> list[int]:
        """Rows that stand for their set here: the first row of the smallest id."""
        seen: dict[tuple[int, int], int] = {}
        for i, own in enumerate(self.ids):
            if own is not None and len(self.sets[i]) and self.own[self.key(i)] == own:
                seen.setdefault(self.key(i), i)
        return list(seen.values())


def _codes(shingles: np.ndarray, buckets: int) -> np.ndarray:
    """Bucket (high half) and 32 more bits of each shingle; equal codes of different shingles only let more documents through."""
    return ((shingles >> np.uint64(32)) % np.uint64(buckets)) << np.uint64(32) | (shingles & np.uint64(0xFFFFFFFF))


_COPY = np.dtype([("digest", "<u8"), ("doc", "<i8"), ("band", "<i8")])


def near_duplicate_groups(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS, percent: int = PERCENT,
    chunk_bytes: int = 8 << 20, bucket_bytes: int = 12 << 20,
) -> DataFrame:
    """One row for each row of ``docs``: doc_id, n_shingles, component_id.

    Sets are distinct shingles of ``words`` words, A-Z lower-cased; a text
    with fewer words is one shingle, null and blank texts have none and link
    with nothing.  Documents link when 100 * intersection >= ``percent`` *
    union; every link counts towards the components.  Rows that share an id
    are one node; rows without id link with nothing and have a null
    component.  Other columns are not read; an empty table gives no rows.
    Shingles are told apart by 64-bit hashes.
    """
    total = pieces_for(docs, text_bytes(text_col), 1)
    buckets = -(-total // bucket_bytes)
    first = np.array(band_starts(percent))
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("binary").alias("text"))
    sent_schema = pa.schema([("chunk", pa.int64()), ("bucket", pa.int64()), ("codes", pa.binary()), ("copies", pa.binary())])
    reply_schema = pa.schema([
        ("chunk", pa.int64()), ("known", pa.binary()), ("frequent", pa.binary()), ("twins", pa.binary()), ("bands", pa.list_(pa.int64())),
    ])

    def chunks(parts: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, pa.Table]]:
        """Runs of an input split; a task that runs again makes the same ones if it reads its rows in the same order, which holds for files."""
        for n, held in enumerate(text_pieces(parts, 1, chunk_bytes)):
            yield chunk_number(n), pa.Table.from_batches(held).combine_chunks()

    def numbered(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for number, chunk in chunks(parts):
            yield from chunk.append_column("chunk", pa.array(np.full(chunk.num_rows, number))).to_batches()

    def sending(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for number, chunk in chunks(parts):
            yield from send(number, chunk).to_batches()

    @lean
    def send(number: int, chunk: pa.Table) -> pa.Table:
        own = _Chunk(chunk.column("doc_id").to_pylist(), chunk.column("text").to_pylist(), words, buckets)
        leaders = own.leaders()
        codes = np.sort(np.concatenate([_codes(own.sets[i], buckets) for i in leaders])) if leaders else np.zeros(0, np.uint64)
        codes = codes[np.concatenate([np.ones(min(2, len(codes)), bool), codes[2:] != codes[:-2]])]
        copies = np.array(
            [(own.digests[i], own.ids[i], np.searchsorted(first, len(own.sets[i]), side="right") - 1) for i in leaders], _COPY
        )
        order, groups = segments(own.bucket[leaders] if leaders else np.zeros(0, np.int64))
        sets = {int(b): copies[order[i:j]].tobytes() for b, i, j in groups}
        present, starts = np.unique(codes >> np.uint64(32), return_index=True)
        low = (codes & np.uint64(0xFFFFFFFF)).astype("<u4")
        shingles = {int(b): c.tobytes() for b, c in zip(present, np.split(low, starts[1:]))}
        rows = [(b, shingles.get(b, b""), sets.get(b, b"")) for b in sorted(shingles.keys() | sets.keys())]
        return pa.table([[number] * len(rows), *(list(c) for c in zip(*rows))] if rows else [[], [], [], []], schema=sent_schema)

    @lean
    def reply(bucket: pa.Table) -> pa.Table:
        if not bucket.num_rows:
            return reply_schema.empty_table()
        number = np.uint64(bucket.column("bucket")[0].as_py()) << np.uint64(32)
        owners = bucket.column("chunk").to_pylist()
        codes = [np.frombuffer(b, "<u4") for b in bucket.column("codes").to_pylist()]
        values = np.sort(np.concatenate(codes))
        known = np.unique(values[1:][values[1:] == values[:-1]])
        frequent = np.unique(values[FREQUENT - 1:][values[FREQUENT - 1:] == values[:max(0, len(values) - FREQUENT + 1)]])
        copies = [np.frombuffer(b, _COPY) for b in bucket.column("copies").to_pylist()]
        sets = np.sort(np.concatenate(copies), order=["digest", "doc"])
        opening = np.concatenate([np.ones(min(1, len(sets)), bool), sets["digest"][1:] != sets["digest"][:-1]])
        smallest = sets["doc"][opening][np.cumsum(opening) - 1] if len(sets) else sets["doc"]
        bands = np.bincount(sets["band"][opening], minlength=len(first) - 1).tolist()
        rows = []
        for i, (owner, own) in enumerate(zip(owners, codes)):
            mine = own[np.concatenate([np.ones(min(1, len(own)), bool), own[1:] != own[:-1]])]
            at = _places(sets, copies[i])
            lost = smallest[at] != copies[i]["doc"]
            twins = np.stack([copies[i]["doc"][lost], smallest[at][lost]], axis=1).astype("<i8")
            rows.append((
                owner, (mine[_within(mine, known)].astype(np.uint64) | number).tobytes(),
                (mine[_within(mine, frequent)].astype(np.uint64) | number).tobytes(), twins.tobytes(), bands if i == 0 else None,
            ))
        return pa.table([list(c) for c in zip(*rows)], schema=reply_schema)

    # The first pass shuffles no text; the second brings each chunk of texts to what the buckets replied.
    sent = texts.mapInArrow(sending, "chunk long, bucket long, codes binary, copies binary")
    replies = sent.groupBy("bucket").applyInArrow(reply, "chunk long, known binary, frequent binary, twins binary, bands array<long>")
    work = Scratch(docs.sparkSession)
    replies = work.written(replies, "replies")
    counted = replies.where("bands IS NOT NULL").select(F.posexplode("bands").alias("band", "n")).groupBy("band").agg(F.sum("n"))
    counts = [0] * (len(first) - 1)
    for band, n in counted.collect():  # one row for each of the size bands
        counts[band] = n
    bands = Bands(counts, percent)
    row_schema = pa.schema([
        ("doc_id", pa.int64()), ("n", pa.int64()), ("twin", pa.int64()), ("signatures", pa.list_(pa.int64())), ("shingles", pa.binary()),
    ])

    @lean
    def sign(chunk: pa.Table, answers: pa.Table) -> pa.Table:
        if not chunk.num_rows:
            return row_schema.empty_table()
        own = _Chunk(chunk.column("doc_id").to_pylist(), chunk.column("text").to_pylist(), words, buckets)
        known, frequent = (
            np.sort(np.concatenate([np.frombuffer(b, "<u8") for b in answers.column(c).to_pylist()] or [np.zeros(0, np.uint64)]))
            for c in ("known", "frequent")
        )
        twins = np.concatenate([np.frombuffer(b, "<i8").reshape(-1, 2) for b in answers.column("twins").to_pylist()] or [np.zeros((0, 2), np.int64)])
        twin_of = dict(twins.tolist())
        leaders = set(own.leaders())
        rows = []
        for i, (doc, shingles) in enumerate(zip(own.ids, own.sets)):
            twin = signed = held = None
            if doc is not None and len(shingles):
                smallest = own.own[own.key(i)]
                twin = twin_of.get(smallest, smallest)
                if i in leaders and twin == doc:
                    shared = shingles[_within(_codes(shingles, buckets), known)]
                    if 100 * len(shared) >= percent * len(shingles):
                        signed = bands.signatures(len(shingles), shared, _within(_codes(shared, buckets), frequent)).view(np.int64)
                        held = shared.tobytes()
            rows.append((doc, len(shingles), twin if twin != doc else None, signed, held))
        return pa.table([pa.array(list(c), f.type) for c, f in zip(zip(*rows), row_schema)], schema=row_schema)

    texts = texts.mapInArrow(numbered, "doc_id long, text binary, chunk long")
    rows = texts.groupBy("chunk").cogroup(replies.groupBy("chunk")).applyInArrow(
        sign, "doc_id long, n long, twin long, signatures array<long>, shingles binary"
    )
    rows = work.written(rows, "signed")
    member = _linked(rows, percent, work)
    out = rows.select("doc_id", F.col("n").alias("n_shingles")).join(member.withColumnRenamed("node", "doc_id"), "doc_id", "left")
    out = written(out.select("doc_id", "n_shingles", F.coalesce("component", "doc_id").alias("component_id")), "groups")
    work.clear()
    return out


def _places(sets: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """A place in ``sets`` (sorted by digest) for each wanted digest."""
    return np.searchsorted(sets["digest"], wanted["digest"])


def _within(values: np.ndarray, known: np.ndarray) -> np.ndarray:
    """Which of ``values`` are in ``known`` (sorted)."""
    if not len(known):
        return np.zeros(len(values), bool)
    return known[np.minimum(np.searchsorted(known, values), len(known) - 1)] == values


def _linked(rows: DataFrame, percent: int, work: Scratch) -> DataFrame:
    """Components over equal sets and verified pairs: node, component."""
    sets = rows.where("signatures IS NOT NULL").select(F.col("doc_id").alias("doc"), "n", "shingles")
    signed = rows.where("signatures IS NOT NULL").select(F.explode("signatures").alias("signature"), F.col("doc_id").alias("doc"), "n")
    shared = signed.groupBy("signature").agg(F.min("doc").alias("a"), F.max("doc").alias("z")).where("a <> z").drop("z")
    # Signatures that only one document has go no further.
    signed = work.written(signed.join(shared, "signature"), "signatures")
    edges = rows.where("twin IS NOT NULL").select(F.col("doc_id").alias("a"), F.col("twin").alias("b"))

    # First, one partner for each document: the smallest that shares a signature.
    pairs = signed.where("doc <> a").groupBy(F.col("doc").alias("b")).agg(F.min("a").alias("a"))
    edges = work.written(edges.union(_verified(pairs, sets, percent, work)), "links")
    member = components(edges, "components", work=work)

    # Documents of one component need no more; what a signature still holds apart is compared in full.
    held = signed.join(member.withColumnRenamed("node", "doc"), "doc", "left").withColumn("component", F.coalesce("component", "doc"))
    apart = held.groupBy("signature").agg(F.min("component").alias("low"), F.max("component").alias("high")).where("low <> high")
    held = held.join(apart.select("signature"), "signature", "left_semi").groupBy("doc", "a").agg(F.first("n").alias("n"), F.first("component").alias("component"))
    held = work.written(held, "apart")
    family = components(held.select(F.col("doc").alias("a"), F.col("a").alias("b")), "families", work=work).toDF("doc", "family")
    rest = held.groupBy("doc").agg(F.first("n").alias("n"), F.first("component").alias("component")).join(family, "doc")
    edges = work.written(edges.union(_compared(work.written(rest, "rest"), sets, percent, work)), "links")
    return components(edges, "components", work=work)


def _compared(rest: DataFrame, sets: DataFrame, percent: int, work: Scratch) -> DataFrame:
    """Links within each family of ``rest`` (doc, n, component, family), as edges that connect what is connected.

    A family is cut into tiles by size band, component and hash; a tile meets
    the tiles of its own and the next band, unless both hold one and the same
    component.  Each meeting reports a spanning forest, at most one edge a
    document, however many pairs link.
    """
    step = math.log(100 / percent) * (1 + 1e-9)  # sets that link are at most one band apart
    rest = rest.withColumn("band", F.floor(F.log("n") / F.lit(step)).cast("int"))
    place = ["family", "band", "component"]
    many = rest.groupBy(*place).agg(F.count("*").alias("docs")).withColumn("pure", F.col("docs") > _TILE // 2)
    # A large component has tiles of its own; small ones share.
    owner = F.when(F.col("pure"), F.col("component"))
    shared = many.groupBy("family", "band", owner.alias("owner")).agg(F.ceil(F.sum("docs") / _TILE).cast("int").alias("tiles"))
    shared = work.written(shared, "tiles")
    same = F.expr("owner <=> own")
    doc = rest.join(many.select(*place, "pure"), place).withColumn("own", owner).drop("component", "pure")
    doc = doc.join(shared.withColumnsRenamed({"family": "f", "band": "g"}), (F.col("family") == F.col("f")) & (F.col("band") == F.col("g")) & same)
    tile = F.struct("band", "own", F.pmod(F.xxhash64("doc"), F.col("tiles")).cast("int").alias("part"))
    doc = doc.select("doc", "n", "family", "band", "own", tile.alias("tile"))
    other = shared.select(F.col("family").alias("f"), F.col("band").alias("g"), "owner", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)).alias("p"))
    near = F.explode(F.array(*[F.col("g") + d for d in (-1, 0, 1)])).alias("at")
    other = other.select("f", near, F.struct(F.col("g").alias("band"), F.col("owner").alias("own"), F.col("p").alias("part")).alias("other"))
    # One component that fills both tiles is connected already.
    met = doc.join(other, (F.col("family") == F.col("f")) & (F.col("band") == F.col("at")))
    met = met.where(~F.coalesce(F.col("own") == F.col("other.own"), F.lit(False)))
    met = met.select("doc", "family", F.least("tile", "other").alias("low"), F.greatest("tile", "other").alias("high"), (F.col("tile") <= F.col("other")).alias("is_low"))
    met = met.join(sets, "doc")
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def compare(rows: pa.Table) -> pa.Table:
        low = rows.column("is_low").to_numpy(zero_copy_only=False)
        ids, sizes = rows.column("doc").to_numpy(), rows.column("n").to_numpy()
        held = [np.frombuffer(s, np.uint64) for s in rows.column("shingles").to_pylist()]
        same = bool(low.all()) or not low.any()
        one = np.arange(len(ids)) if same else np.flatnonzero(low)
        two = one if same else np.flatnonzero(~low)
        owner = np.repeat(np.arange(len(two)), [len(held[j]) for j in two])
        values = np.concatenate([held[j] for j in two])
        order = np.argsort(values, kind="stable")
        values, owner = values[order], owner[order]
        links = np.zeros((len(one), len(two)), bool)
        for row, i in enumerate(one):
            first, last = (np.searchsorted(values, held[i], side) for side in ("left", "right"))
            width = last - first
            places = np.repeat(first - np.concatenate([[0], np.cumsum(width)[:-1]]), width) + np.arange(width.sum())
            both = np.bincount(owner[places], minlength=len(two))
            links[row] = 100 * both >= percent * (sizes[i] + sizes[two] - both)
        node, root = forest(links, same)
        joined = ids[one] if same else np.concatenate([ids[one], ids[two]])
        return pa.table([joined[node], joined[root]], schema=schema)

    return met.groupBy("family", "low", "high").applyInArrow(compare, "a long, b long")


def _verified(pairs: DataFrame, sets: DataFrame, percent: int, work: Scratch) -> DataFrame:
    """Those of ``pairs`` (a, b) whose sets link.  One side's set travels with each pair, in lots of bounded size by the other side."""
    pairs = work.written(pairs.select("a", "b"), "pairs")
    lots = pairs.groupBy("a").agg(F.ceil(F.count("*") / _LOT).cast("int").alias("lots"))
    lot = F.explode(F.sequence(F.lit(0), F.col("lots") - 1)).alias("lot")
    heads = lots.join(sets.toDF("a", "n", "shingles"), "a").select("a", lot, "n", "shingles")
    others = pairs.join(lots, "a").select(F.col("a").alias("head"), F.pmod(F.xxhash64("b"), F.col("lots")).cast("int").alias("part"), F.col("b").alias("doc"))
    others = others.join(sets, "doc").toDF("b", "head", "part", "m", "other")
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def compare(head: pa.Table, rest: pa.Table) -> pa.Table:
        found = []
        right = [(b, m, np.frombuffer(s, np.uint64)) for b, m, s in zip(*(rest.column(c).to_pylist() for c in ("b", "m", "other")))]
        for a, n, own in zip(head.column("a").to_pylist(), head.column("n").to_pylist(), head.column("shingles").to_pylist()):
            own = np.frombuffer(own, np.uint64)
            for b, m, other in right:
                both = int(_within(other, own).sum())
                if 100 * both >= percent * (n + m - both):
                    found.append((a, b))
        return pa.table([[a for a, _ in found], [b for _, b in found]], schema=schema)

    return heads.groupBy("a", "lot").cogroup(others.groupBy("head", "part")).applyInArrow(compare, "a long, b long")


def op4_segment_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicate_groups(table(spark, sf_dir, "documents").select("doc_id", "text"))


OP4_SQL = f"""
WITH RECURSIVE word AS (
    SELECT doc_id, list_filter(regexp_split_to_array(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\\x20\\x09-\\x0D]+'), lambda w: w <> '') AS words
    FROM documents
), shingle AS MATERIALIZED (
    SELECT DISTINCT doc_id, shingle FROM (
        SELECT doc_id, unnest(CASE WHEN len(words) = 0 THEN [] WHEN len(words) < {WORDS} THEN [array_to_string(words, ' ')]
            ELSE list_transform(range(1, len(words) - {WORDS - 2}), lambda i: array_to_string(words[i:i + {WORDS - 1}], ' ')) END) AS shingle
        FROM word)
), size AS MATERIALIZED (
    SELECT doc_id, count(*) AS n FROM shingle GROUP BY doc_id
), common AS (
    SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n FROM shingle a JOIN shingle b USING (shingle) WHERE a.doc_id <> b.doc_id GROUP BY ALL
), link AS MATERIALIZED (
    SELECT a, b FROM common JOIN size s ON s.doc_id = a JOIN size t ON t.doc_id = b WHERE 100 * common.n >= {PERCENT} * (s.n + t.n - common.n)
), reach AS (
    SELECT doc_id AS a, doc_id AS b FROM documents UNION SELECT r.a, l.b FROM reach r JOIN link l ON r.b = l.a
), smallest AS (
    SELECT a, min(b) AS component_id FROM reach GROUP BY a
)
SELECT d.doc_id, coalesce(size.n, 0)::BIGINT AS n_shingles, component_id
FROM documents d JOIN smallest ON smallest.a = d.doc_id LEFT JOIN size ON size.doc_id = d.doc_id
"""
