"""Operator 3: byte-level BPE encoding and decoding by backtracking over longest matches.

The vocabulary is a rank file.  Token bytes are mapped to Latin-1 strings, so
that one pyahocorasick trie over all reachable tokens gives the longest token
at a place.  The encoder takes it
and steps back to the next shorter one whenever two neighbours would not stay
apart under the merge order; that test is memoised per token pair and each
position is given up at most once, so a piece of any length takes linear
time.  The result is exactly that of merging by rank.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator
from functools import lru_cache

import ahocorasick
import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from logstrata.llm.common import Memo, space_segments, table

RANKS = "byte_bpe_multi_50k.tiktoken"
OUT = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in f if line.strip())}


def merge_by_rank(piece: bytes, ranks: dict[bytes, int], below: int | None = None) -> list[bytes]:
    """Plain merging, smallest rank first and leftmost on ties; ``below`` stops before that rank."""
    parts = [piece[i:i + 1] for i in range(len(piece))]
    while len(parts) > 1:
        found = [(r, i) for i in range(len(parts) - 1) if (r := ranks.get(parts[i] + parts[i + 1])) is not None]
        if not found or (below is not None and min(found)[0] >= below):
            break
        i = min(found)[1]
        parts[i:i + 2] = [parts[i] + parts[i + 1]]
    return parts


class PairMemo(dict):
    """Token pair -> compatible or not; bounded, so that memory stays bounded on any corpus."""

    def __init__(self, compute, entries: int = 1_000_000):
        super().__init__()
        self._compute, self._entries = compute, entries

    def __missing__(self, pair: tuple[int, int]) -> bool:
        if len(self) >= self._entries:
            self.clear()
        value = self[pair] = self._compute(*pair)
        return value


class BacktrackingBpe:
    """Encoder of single pieces.  Raises ValueError if merge order and ranks do not agree (a token made of a later one)."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.bytes_of = {rank: token for token, rank in ranks.items()}
        self.halves: dict[int, tuple[int, int]] = {}
        automaton = ahocorasick.Automaton()
        for token, rank in ranks.items():
            if len(token) == 1:
                self.halves[rank] = (rank, rank)
            else:
                parts = merge_by_rank(token, ranks, rank)
                if len(parts) != 2:
                    if len(merge_by_rank(token, ranks)) == 1:
                        raise ValueError(f"token {rank} is reached only through a later token")
                    continue  # no merge makes it: it stands only for a whole piece
                self.halves[rank] = (ranks[parts[0]], ranks[parts[1]])
            automaton.add_word(token.decode("latin-1"), rank)
        automaton.make_automaton()
        self.automaton = automaton
        reachable = self.halves.keys()
        self.rank_of = {self.bytes_of[rank].decode("latin-1"): rank for rank in reachable}
        self.widest = max(map(len, self.rank_of), default=1)
        self.length = {rank: len(self.bytes_of[rank]) for rank in reachable}
        self.shorter: dict[int, int | None] = {}
        for rank in reachable:
            token = self.bytes_of[rank]
            prefixes = (ranks.get(token[:n]) for n in range(len(token) - 1, 0, -1))
            self.shorter[rank] = next((p for p in prefixes if p in reachable), None)
        self.pair_rank = {half: rank for rank, half in self.halves.items() if half[0] != rank}
        #: (left, right) -> whether merging by rank can end with the two side by side.
        self.stays_apart = PairMemo(self._compatible)

    def _compatible(self, left: int, right: int) -> bool:
        # Undo merges from the latest back; a pair across the border that would have merged before that is a conflict.
        limit = float("inf")
        while True:
            joint = self.pair_rank.get((left, right))
            if joint is not None and joint < limit:
                return False
            undo_left, undo_right = self.halves[left][0] != left, self.halves[right][0] != right
            if not undo_left and not undo_right:
                return True
            if undo_left and (not undo_right or left > right):
                limit, left = left, self.halves[left][1]
            else:
                # A merge right of the border comes after one of equal rank across it: merges go leftmost first.
                limit, right = right + 1, self.halves[right][0]

    def encode(self, piece: bytes) -> list[int]:
        whole = self.ranks.get(piece)
        if whole is not None:
            return [whole]
        text, size = piece.decode("latin-1"), len(piece)
        find, rank_of, widest = self.automaton.longest_prefix, self.rank_of, self.widest
        length, shorter, apart = self.length, self.shorter, self.stays_apart
        dead: set[int] = set()
        out: list[int] = []
        at, last, token = 0, None, None
        fresh = True  # the longest token at this place is still to be looked up
        while at < size:
            if fresh:
                n = find(text[at:at + widest])
                token = rank_of.get(text[at:at + n])
                while token is None and n:  # a path of the trie that ends between two tokens
                    n -= 1
                    token = rank_of.get(text[at:at + n])
            while token is not None:
                end = at + length[token]
                if (last is None or apart[last, token]) and end not in dead:
                    out.append(token)
                    at, last, fresh = end, token, True
                    break
                token = shorter[token]
            else:
                if last is None:
                    raise ValueError("a byte is missing from the vocabulary")
                dead.add(at)
                token, fresh = out.pop(), False
                at -= length[token]
                last = out[-1] if out else None
                token = shorter[token]
        return out


class Codec:
    """Whole texts: pieces of the split pattern, encoded one by one; ids as decimal strings."""

    def __init__(self, path: str, pattern: str):
        self.bpe = BacktrackingBpe(read_ranks(path))
        self.split = regex.compile(pattern).findall
        self.decimal = {rank: str(rank) for rank in self.bpe.bytes_of}
        self.piece = Memo(lambda p: ",".join(map(self.decimal.__getitem__, self.bpe.encode(p.encode()))))
        self.segment = Memo(lambda s: ",".join(map(self.piece.__getitem__, self.split(s))))
        self.token = {str(rank): token for rank, token in self.bpe.bytes_of.items()}

    def encode(self, text: str) -> str:
        """Ids of the text, decimal, joined by commas."""
        return ",".join(filter(None, map(self.segment.__getitem__, space_segments(text)))) if text else ""

    def decode(self, ids: str) -> bytes:
        return b"".join(map(self.token.__getitem__, ids.split(","))) if ids else b""


@lru_cache(maxsize=2)
def codec(path: str, pattern: str) -> Codec:
    return Codec(path, pattern)


def encode_documents(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", ranks_path: str | None = None, pattern: str | None = None
) -> DataFrame:
    """Every text as ids and back: id, ids (array<int>), decoded (binary).

    Null and empty texts give no ids and empty bytes; repeated rows, null ids
    and other columns do not matter (one row out for each row in, only the
    two named columns are read).  Narrow: no shuffle.
    """
    path, rule = ranks_path or public_tokenizers.path(RANKS), pattern or public_tokenizers.PATTERN
    schema = pa.schema([("doc_id", pa.int64()), ("ids", pa.list_(pa.int32())), ("decoded", pa.binary())])

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code = codec(path, rule)
        for part in parts:
            for ids, texts in _slices(part):
                coded = [code.encode(t or "") for t in texts]
                rows = [[int(x) for x in c.split(",")] if c else [] for c in coded]
                yield pa.RecordBatch.from_arrays([ids, pa.array(rows, schema.field(1).type), pa.array([code.decode(c) for c in coded], pa.binary())], schema=schema)

    return _two(docs, id_col, text_col).mapInArrow(run, "doc_id long, ids array<int>, decoded binary")


def digest_documents(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", ranks_path: str | None = None, pattern: str | None = None
) -> DataFrame:
    """As ``encode_documents`` but with digests of ids and decoded bytes in place of the arrays."""
    path, rule = ranks_path or public_tokenizers.path(RANKS), pattern or public_tokenizers.PATTERN
    schema = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids_sha256", pa.string()), ("decoded_sha256", pa.string())])

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code = codec(path, rule)
        for part in parts:
            for ids, texts in _slices(part):
                counts, coded_sha, decoded_sha = [], [], []
                for t in texts:
                    coded = code.encode(t or "")
                    counts.append(coded.count(",") + 1 if coded else 0)
                    coded_sha.append(hashlib.sha256(coded.encode()).hexdigest())
                    decoded_sha.append(hashlib.sha256(code.decode(coded)).hexdigest())
                yield pa.RecordBatch.from_arrays([ids, pa.array(counts, pa.int64()), pa.array(coded_sha), pa.array(decoded_sha)], schema=schema)

    return _two(docs, id_col, text_col).mapInArrow(run, OUT)


def _two(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))


def _slices(part: pa.RecordBatch, rows: int = 256) -> Iterator[tuple[pa.Array, list]]:
    for i in range(0, part.num_rows, rows):
        piece = part.slice(i, rows)
        yield piece.column(0), piece.column(1).to_pylist()


def op3_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digest_documents(table(spark, sf_dir, "documents"))
