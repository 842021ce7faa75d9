"""Operator 9: packing token sequences by bin completion over the histogram of lengths.

Only lengths matter for packing, and there are at most ``capacity`` of them,
so the search runs on counts by length (a table of fixed size for any
corpus): best-fit decreasing gives the first incumbent, then a branch and
bound completes bins around the largest length left, over undominated
fillings, cutting branches whose waste can no longer beat the incumbent, in
passes that widen until nothing is left out or the node budget is spent.  The
plan is a list of fillings with multiplicities; documents meet it by their
rank among those of equal length, which Spark computes in salted groups.
"""

from __future__ import annotations

import struct
import zlib
from bisect import bisect_right, insort
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from logstrata.llm.common import batches, dealt, give_back, pieces_for, table, written
from logstrata.llm.tokens import encoder
from logstrata.llm.wordchunks import text_pieces

TOKENIZER = "word_bpe_49k.json"
END_ID = 1
CAPACITY = 4096
#: Pieces of one length and salt; a group that one task ranks.
SALT_ROWS = 20_000
#: Nodes of the search for each length, at least.
DESCENTS = 16

#: (number of bins, lengths in a bin, largest first)
Filling = tuple[int, tuple[int, ...]]


def lower_bound(counts: dict[int, int], capacity: int) -> int:
    """Bins that any packing needs: by volume, and with lengths over half a bin kept apart from what cannot join them."""
    volume = sum(n * c for n, c in counts.items())
    best = -(-volume // capacity)
    lengths = sorted(counts)
    for small in [0] + [n for n in lengths if 2 * n <= capacity]:
        over = sum(counts[n] for n in lengths if n > capacity - small)
        middle = [(n, counts[n]) for n in lengths if 2 * n > capacity and n <= capacity - small]
        room = sum((capacity - n) * c for n, c in middle)
        rest = sum(n * counts[n] for n in lengths if small <= n and 2 * n <= capacity)
        best = max(best, over + sum(c for _, c in middle) + max(0, -(-(rest - room) // capacity)))
    return best


def best_fit_decreasing(counts: dict[int, int], capacity: int) -> list[Filling]:
    """Largest first into the fullest bin with room, for whole groups of equal bins at once."""
    groups: dict[int, list[list]] = {}  # room left -> [bins, lengths]
    rooms: list[int] = []

    def put(room: int, bins: int, lengths: tuple[int, ...]) -> None:
        if room not in groups:
            groups[room] = []
            insort(rooms, room)
        groups[room].append([bins, lengths])

    for length in sorted(counts, reverse=True):
        left = counts[length]
        while left:
            at = bisect_right(rooms, length - 1)
            if at < len(rooms):
                room = rooms[at]
                bins, lengths = groups[room].pop()
                if not groups[room]:
                    del groups[room]
                    rooms.pop(at)
            else:
                room, bins, lengths = capacity, -(-left // (capacity // length)), ()
            each = room // length
            full = min(bins, left // each)
            if full:
                put(room - each * length, full, lengths + (length,) * each)
                left -= full * each
            rest = bins - full
            if rest and left and left < each:
                put(room - left * length, 1, lengths + (length,) * left)
                left, rest = 0, rest - 1
            if rest and lengths:
                put(room, rest, lengths)
    return [(bins, lengths) for found in groups.values() for bins, lengths in found]


@dataclass
class BinCompletion:
    """Branch and bound on counts by length, by limited discrepancy.

    A pass follows the best filling everywhere, but for a limited number of
    deviations (a filling further down the list, or fewer bins of it than
    there could be).  The limit, 0, then ``branches``, doubles from pass to
    pass, and with it the ``steps`` for listing fillings, until a pass left
    nothing out, which proves the packing best, or the lower bound is met.
    ``nodes``, or ``DESCENTS`` for each length if that is more, bounds the
    search, which only ever improves on the incumbent.
    """

    counts: dict[int, int]
    capacity: int
    nodes: int = 12_000
    branches: int = 3
    steps: int = 400
    best: list[Filling] = field(default_factory=list)
    bins: int = 0
    #: Whether ``best`` is known to be optimal.
    proved: bool = False

    def solve(self) -> list[Filling]:
        self.best = best_fit_decreasing(self.counts, self.capacity)
        self.bins = sum(n for n, _ in self.best)
        self.bound = lower_bound(self.counts, self.capacity)
        self.volume = sum(n * c for n, c in self.counts.items())
        self.left = max(self.nodes, DESCENTS * len(self.counts))
        limit = 0
        while self.bins > self.bound and self.left > 0 and not self.proved:
            self.proved = self._search(limit)
            limit = max(1, self.branches, 2 * limit)
        self.proved = self.proved or self.bins == self.bound
        return self.best

    def _search(self, limit: int) -> bool:
        """Depth first with its own stack; each level holds what is not yet tried for the largest length left.  Whether nothing was left out."""
        counts, lengths = dict(self.counts), sorted(self.counts)
        path: list[Filling] = []
        used = waste = 0
        tries, whole = self.steps * (limit + 1), True
        stack = [self._children(counts, lengths, limit, tries, frozenset(), waste)]
        while stack and self.bins > self.bound:
            children, complete = stack[-1]
            if not children:
                whole = whole and complete
                stack.pop()
                if path:
                    bins, filling = path.pop()
                    self._give(counts, lengths, bins, filling)
                    used, waste = used - bins, waste - bins * (self.capacity - sum(filling))
                continue
            if self.left <= 0:
                return False
            self.left -= 1
            bins, filling, cost, banned = children.pop()
            more = bins * (self.capacity - sum(filling))
            # What is lost cannot be made good: a better packing has at least one bin less.
            if waste + more > self._spare():
                continue
            self._take(counts, lengths, bins, filling)
            path.append((bins, filling))
            used, waste = used + bins, waste + more
            if not lengths:
                self.best, self.bins = list(path), used
                stack.append(([], True))
                continue
            if lengths[-1] != filling[0]:
                banned = frozenset()
            stack.append(self._children(counts, lengths, cost, tries, banned, waste))
        return whole

    def _spare(self) -> int:
        """Waste that a packing with one bin less than the incumbent has."""
        return (self.bins - 1) * self.capacity - self.volume

    @staticmethod
    def _take(counts: dict[int, int], lengths: list[int], bins: int, filling: tuple[int, ...]) -> None:
        for n in filling:
            counts[n] -= bins
        for n in set(filling):
            if not counts[n]:
                lengths.pop(bisect_right(lengths, n) - 1)

    @staticmethod
    def _give(counts: dict[int, int], lengths: list[int], bins: int, filling: tuple[int, ...]) -> None:
        for n in set(filling):
            if not counts[n]:
                insort(lengths, n)
        for n in filling:
            counts[n] += bins

    def _children(
        self, counts: dict[int, int], lengths: list[int], limit: int, tries: int, banned: frozenset, waste: int
    ) -> tuple[list[tuple[int, tuple[int, ...], int, frozenset]], bool]:
        """What may come next, best last: bins, filling, deviations left after it and fillings that were dealt with; and whether that is all.

        A filling in ``banned`` has had its number of bins fixed, or all of
        them tried, since the largest length last changed.
        """
        found, complete = self._fillings(counts, lengths, tries, self._spare() - waste, limit, limit + len(banned))
        if complete and len(found) == 1:  # beats all others in every bin
            filling = found[0]
            return [(min(counts[n] // filling.count(n) for n in set(filling)), filling, limit, banned)] * (filling not in banned), True
        children = []
        for rank, filling in enumerate(f for f in found if f not in banned):
            if rank > limit:
                complete = False
                break
            banned = banned | {filling}
            most = min(counts[n] // filling.count(n) for n in set(filling))
            if rank + most - 1 > limit:
                complete = False
            for place, bins in enumerate(_multiples(most, limit - rank + 1)):
                children.append((bins, filling, limit - rank - place, banned))
        return children[::-1], complete

    def _fillings(self, counts: dict[int, int], lengths: list[int], tries: int, spare: int, limit: int, wanted: int) -> tuple[list[tuple[int, ...]], bool]:
        """Undominated fillings around the largest length, least waste first, and whether these are all.

        One filling dominates another if the other's lengths fit into its own
        as bins: an exact single length beats all, and one that leaves room
        for a further length is beaten by that with it.  Fillings that waste
        more than ``spare`` cannot lead to a better packing.  Not more than
        ``wanted`` + 1 are returned.
        """
        largest = lengths[-1]
        room = self.capacity - largest
        have = {largest: counts[largest] - 1}
        if room == 0 or have.get(room, counts.get(room, 0)) > 0:
            return [(largest, room) if room else (largest,)], True
        found: list[tuple[int, tuple[int, ...]]] = []
        asked, complete = tries, True

        def left_of(n: int) -> int:
            return have.get(n, counts[n])

        def extend(left: int, below: int, chosen: tuple[int, ...]) -> bool:
            """Add lengths before place ``below``; False to stop."""
            nonlocal tries, complete
            at = min(below, bisect_right(lengths, left)) - 1
            while at >= 0:
                n = lengths[at]
                most = min(left_of(n), left // n)
                for k in range(most, 0, -1):
                    if tries <= 0:
                        complete = False
                        return False
                    tries -= 1
                    have[n] = left_of(n) - k
                    go_on = extend(left - k * n, at, chosen + (n,) * k)
                    have[n] += k
                    if not go_on:
                        return False
                at -= 1
            if left <= spare and next((n for n in lengths if n > left or left_of(n)), left + 1) > left:
                found.append((left, chosen))
                if not left and not limit:  # only the first is asked for
                    complete = False
                    return False
            return True

        extend(room, len(lengths), (largest,))
        self.left -= (asked - tries) // self.steps  # a long list counts as several nodes
        kept: list[tuple[int, ...]] = []
        for _, filling in sorted(found, key=lambda x: (x[0], len(x[1]))):
            if len(kept) > wanted:
                return kept, False
            if not any(_dominates(f, filling) for f in kept):
                kept.append(filling)
        return kept, complete


def _multiples(most: int, n: int) -> list[int]:
    """The first ``n`` numbers of bins to try out of 1 to ``most``: all, one less, half, one, then the others."""
    first = dict.fromkeys([most, max(1, most - 1), max(1, most // 2), 1])
    return list(first | dict.fromkeys(range(most, max(0, most - n - 4), -1)))[:n]


def _dominates(one: tuple[int, ...], other: tuple[int, ...]) -> bool:
    """Whether the lengths of ``other`` fit into those of ``one`` as bins; equal lengths may be set against each other.  Not looked for beyond 8 lengths."""
    if len(one) >= len(other) and all(a >= b for a, b in zip(one, other)):
        return True
    bins, items = Counter(one), Counter(other)
    rooms, rest = sorted((bins - items).elements()), sorted((items - bins).elements(), reverse=True)
    if sum(rest) > sum(rooms) or len(rest) > 8 or rest and rest[0] > rooms[-1]:
        return False

    def fits(i: int) -> bool:
        if i == len(rest):
            return True
        for j, r in enumerate(rooms):
            if r >= rest[i] and r not in rooms[:j]:
                rooms[j] -= rest[i]
                if fits(i + 1):
                    return True
                rooms[j] += rest[i]
        return False

    return fits(0)


def plan_runs(plan: list[Filling]) -> dict[str, np.ndarray]:
    """The plan by (length, rank): runs of ranks with their first bin, copies in a bin and first place in it, sorted."""
    rows, given, bin_id = [], {}, 0
    for bins, lengths in plan:
        place = 0
        for n in dict.fromkeys(lengths):
            copies = lengths.count(n)
            first = given.get(n, 0)
            rows.append((n, first, bin_id, copies, place))
            given[n] = first + bins * copies
            place += n * copies
        bin_id += bins
    rows.sort()
    columns = np.array(rows, np.int64).reshape(-1, 5).T
    return dict(zip(("length", "rank", "bin", "copies", "place"), columns))


def pack(pieces: DataFrame, capacity: int = CAPACITY, nodes: int = 12_000) -> DataFrame:
    """``pieces`` (a written table with doc_id, piece and length) and sequence_id and offset.

    Lengths must be 1 to ``capacity``.  Rows of one length are ranked in
    salted groups of about ``SALT_ROWS``; counts by length (at most
    ``capacity`` rows) are all that reaches the driver.  Rows that agree in
    every column still get places of their own.
    """
    salts = pieces_for(pieces, F.lit(1), SALT_ROWS)
    salted = pieces.withColumn("__salt", dealt(salts, "doc_id", "piece", "length").cast("int"))
    groups = salted.groupBy("length", "__salt").agg(F.count("*").alias("__n"))
    counts = {int(r[0]): int(r[1]) for r in groups.groupBy("length").agg(F.sum("__n")).collect()}
    if counts and not 1 <= min(counts) <= max(counts) <= capacity:
        raise ValueError("lengths must be 1 to the capacity")
    runs = plan_runs(BinCompletion(counts, capacity, nodes).solve())
    before = Window.partitionBy("length").orderBy("__salt").rowsBetween(Window.unboundedPreceding, -1)
    starts = groups.select("length", "__salt", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__start"))
    own = Window.partitionBy("length", "__salt").orderBy("doc_id", "piece")
    ranked = salted.withColumn("__own", F.row_number().over(own) - 1).join(starts, ["length", "__salt"])
    ranked = ranked.select(*pieces.columns, (F.col("__start") + F.col("__own")).alias("__rank"))
    shared = pieces.sparkSession.sparkContext.broadcast(runs)  # a few runs for each of at most ``capacity`` lengths
    length_at = ranked.columns.index("length")

    def place(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        run = shared.value
        span = np.int64(1) << 44
        keys = run["length"] * span + run["rank"]
        for part in parts:
            length = part.column(length_at).to_numpy().astype(np.int64)
            rank = part.column(part.num_columns - 1).to_numpy()
            at = np.searchsorted(keys, length * span + rank, side="right") - 1
            bins, nth = np.divmod(rank - run["rank"][at], run["copies"][at])
            columns = [*part.columns[:-1], pa.array(run["bin"][at] + bins), pa.array(run["place"][at] + nth * length)]
            yield pa.RecordBatch.from_arrays(columns, names=[*part.schema.names[:-1], "sequence_id", "offset"])

    return ranked.mapInArrow(place, pieces.schema.add("sequence_id", "long").add("offset", "long"))


#: Text encoded at once.
_TEXT_BYTES = 2 << 20


def cut_documents(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", tokenizer_path: str | None = None, end_id: int = END_ID, capacity: int = CAPACITY
) -> DataFrame:
    """Pieces of at most ``capacity`` ids: doc_id, piece, start, length, ids_crc32, ids.

    A document is its ids and the end id; null or empty text is the end id
    alone.  Only longer documents are cut, into full pieces and a rest.
    Repeated rows and null ids are documents like others; other columns are
    not read.
    """
    source = tokenizer_path or public_tokenizers.path(TOKENIZER)
    schema = pa.schema([("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()), ("ids", pa.binary())])
    end = struct.pack("<I", end_id)

    def cut(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for held in text_pieces(parts, 1, _TEXT_BYTES):
            ids, texts = ([v for piece in held for v in piece.column(c).to_pylist()] for c in (0, 1))
            yield from batches(_pieces(ids, texts, encoder(source, False), end, capacity), schema)
        give_back()

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(cut, "doc_id long, piece int, start long, length long, ids_crc32 long, ids binary")


def _pieces(doc_ids: list, texts: list[str | None], tokens, end: bytes, capacity: int) -> Iterator[list]:
    for doc_id, ids in zip(doc_ids, tokens.encode(texts)):
        ids += end
        for n, at in enumerate(range(0, len(ids), 4 * capacity)):
            piece = ids[at:at + 4 * capacity]
            yield [doc_id, n, at // 4, len(piece) // 4, zlib.crc32(piece), piece]


def op9_bin_completion(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(table(spark, sf_dir, "documents"))


def pack_documents(docs: DataFrame) -> DataFrame:
    """Pieces of all documents with their places: doc_id, piece, start, length, ids_crc32, sequence_id, offset."""
    return pack(written(cut_documents(docs).drop("ids"), "lengths"))
