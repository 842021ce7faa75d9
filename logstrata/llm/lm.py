"""Operator 11: scores of whole texts under an n-gram model kept in Elias-Fano tries.

Words, pairs and triples are counted over all texts to learn from.  Words that
occur twice get numbers, small ones for frequent words; pairs and triples of
numbered words that occur twice are kept.  Probabilities are interpolated with
absolute discounts found from the counts of counts: a kept n-gram holds its
discounted share of its context's count, and all that is left of the context
goes to the shorter one, down to (c + 1) / (N + V + 1) for a word.  Shares and
left-overs are kept in 16 bits of logarithm, rounded down, so the
probabilities of all words after a context never add up to more than 1.

Pairs are dealt to buckets by both words, triples go with the pair they begin
with, so no frequent word gathers in one task.  A bucket is one trie
(:class:`~logstrata.llm.eliasfano.Trie`), asked once for each distinct pair and
triple of a chunk of texts.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import ArrayType, StructType

from logstrata.llm.common import pieces_for, table, text_bytes, written
from logstrata.llm.eliasfano import Trie, quantised, restored
from logstrata.llm.wordchunks import Workspace, chunk_number, gathered, pack, pack_sorted, segments, spread, sum_row, text_pieces, unpack, unpack_sorted, word_hashes

#: Stand before and after each text; no UTF-8 text holds these bytes.
BEGIN, END = b"\xff", b"\xfe"
LEAST = 2  # occurrences of what gets a number or a place in a trie
_HALF = np.uint64(32)


@dataclass
class ScoredTexts:
    """Scores, the tries they were read from (bucket, trie) and the numbers of tokens and distinct tokens learned from."""

    scores: DataFrame
    tries: DataFrame
    tokens: int
    types: int


def _encoded(docs: DataFrame, id_col: str, text_col: str, learn: Column, chunk_bytes: int, buckets: int) -> DataFrame:
    rows = docs.select(F.col(text_col).cast("binary").alias("text"), F.col(id_col).alias("id"), F.coalesce(learn, F.lit(False)).alias("learn"))
    own = StructType().add("bucket", "integer").add("hashes", "binary").add("counts", "binary")
    out = StructType().add("chunk", "long").add("ids", ArrayType(rows.schema["id"].dataType)).add("lengths", "binary").add("learn", "binary")
    out = out.add("tokens", "binary").add("begin", "integer").add("end", "integer").add("words", ArrayType(own))
    schema = to_arrow_schema(out)

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for n, held in enumerate(text_pieces(parts, 0, chunk_bytes)):
            number = {BEGIN: 0, END: 1}
            lengths, tokens, ids, learned = [], [], [], []
            for part in held:
                for text in part.column(0).to_pylist():
                    words = text.lower().split() if text else []  # bytes: A-Z alone are lowered, ASCII blanks alone cut
                    lengths.append(len(words))
                    tokens.append(np.fromiter([number.setdefault(w, len(number)) for w in words], np.int32, len(words)))
                ids += part.column(1).to_pylist()
                learned += part.column(2).to_pylist()
            hashes, deal = word_hashes(number)
            bucket = (deal % np.uint64(buckets)).astype(np.int64)
            order = np.lexsort((hashes, bucket))
            place = np.empty(len(order), np.int64)
            place[order] = np.arange(len(order))
            flat = place[np.concatenate(tokens)] if lengths else np.zeros(0, np.int64)
            counts = np.bincount(flat, weights=np.repeat(learned, lengths), minlength=len(order)).astype(np.uint64)
            counts[place[:2]] = sum(learned)
            _, cuts = segments(bucket[order])
            words = [{"bucket": b, "hashes": pack_sorted(hashes[order[i:j]]), "counts": pack(counts[i:j].astype(np.uint32))} for b, i, j in cuts]
            row = [chunk_number(n), ids, pack(np.array(lengths, np.uint32)), np.array(learned, np.uint8).tobytes(), pack(flat.astype(np.uint32)), int(place[0]), int(place[1]), words]
            yield pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(row, schema)], schema=schema)

    return rows.mapInArrow(run, out)


class _Chunk:
    """A chunk's tokens with begin and end of every text, and what the buckets have said of its words and pairs."""

    def __init__(self, chunk: pa.Table, answers: pa.Table, buckets: int):
        row = {name: chunk.column(name)[0].as_py() for name in ("chunk", "lengths", "tokens", "begin", "end")}
        self.number, self._buckets = row["chunk"], buckets
        self.lengths = unpack(row["lengths"], np.uint32).astype(np.int64)
        self._answers = {}
        for kind in set(answers.column("kind").to_pylist()):
            own = answers.filter(pc.equal(answers.column("kind"), kind)).sort_by("bucket")
            self._answers[kind] = {c: own.column(c).to_pylist() for c in ("bucket", "a", "b", "c")}
        begins = np.cumsum(self.lengths + 2) - self.lengths - 2
        self.is_begin = np.zeros(int((self.lengths + 2).sum()), bool)
        self.is_begin[begins] = True
        self.begins = begins
        ends = begins + self.lengths + 1
        word = ~self.is_begin
        word[ends] = False
        self.tokens = np.empty(len(word), np.int32)
        self.tokens[begins], self.tokens[ends], self.tokens[word] = row["begin"], row["end"], unpack(row["tokens"], np.uint32)
        ranks = [(b, unpack(r, np.uint32).astype(np.int64)) for b, r in zip(self._answers["word"]["bucket"], self._answers["word"]["b"])]
        numbers = np.concatenate([np.where(r > 0, (r - 1) * buckets + b, -1) for b, r in ranks])
        if numbers.max(initial=0) >= 1 << 32:
            raise OverflowError("more than 2^32 words occur twice; learn with a larger ``least``")
        self._number = numbers[self.tokens]

    def said(self, kind: str, column: str, dtype) -> np.ndarray:
        """What all buckets answered, laid end to end in their order."""
        parts = [unpack(p, dtype) for p in self._answers.get(kind, {}).get(column, [])]
        return np.concatenate(parts) if parts else np.zeros(0, dtype)

    def find_pairs(self) -> None:
        """Distinct pairs of numbered words, ordered by bucket, and where in the texts they end."""
        number = self._number
        ok = (number[1:] >= 0) & (number[:-1] >= 0) & ~self.is_begin[1:]
        self.at = np.flatnonzero(ok) + 1
        keys, inverse = np.unique(number[self.at - 1].astype(np.uint64) << _HALF | number[self.at].astype(np.uint64), return_inverse=True)
        order, self.cuts = segments(spread(keys, self._buckets).astype(np.int64))
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        self.keys, self.pair_at = keys[order], place[inverse]

    def find_triples(self) -> None:
        """Distinct triples both of whose pairs are kept, in the order of their first pair, and where they end."""
        ranks = self.said("pair", "a", np.uint32).astype(np.int64) - 1
        kept = np.full(len(self.tokens), -1, np.int32)
        kept[self.at] = np.where(ranks[self.pair_at] >= 0, self.pair_at, -1)
        self.triple_ends = np.flatnonzero((kept[1:] >= 0) & (kept[:-1] >= 0)) + 1
        codes, self.triple_at = np.unique(kept[self.triple_ends - 1].astype(np.uint64) << _HALF | self._number[self.triple_ends].astype(np.uint64), return_inverse=True)
        owner = (codes >> _HALF).astype(np.int64)
        self.triples = ranks[owner].astype(np.uint64) << _HALF | codes & np.uint64(0xFFFFFFFF)
        self.kept, self.triple_cuts = ranks >= 0, np.searchsorted(owner, [i for _, i, _ in self.cuts] + [len(ranks)])


def score_texts(
    docs: DataFrame, learn: Column, id_col: str = "doc_id", text_col: str = "text", chunk_bytes: int = 16 << 20, bucket_bytes: int = 16 << 20
) -> ScoredTexts:
    """Per row of ``docs``: id (as ``id_col``), learned (boolean), n_tokens, n_known (long), base_score, score (double, log10).

    Rows where ``learn`` is true are counted, all are scored.  Tokens are the
    words of the lower-cased (A-Z) text and one end.  ``n_known`` are tokens
    learned from; ``base_score`` is that of single tokens with add-one counts.
    Null and empty texts are one end.  Repeated rows count and are scored
    separately, null ids are ids like others; further columns are not looked
    at.  Nothing to learn from: each token has probability 1.
    """
    spark, work = docs.sparkSession, Workspace(docs.sparkSession)
    total = pieces_for(docs, text_bytes(text_col), 1)
    buckets = -(-total // bucket_bytes)
    chunks = work.chunks(_encoded(docs, id_col, text_col, learn, chunk_bytes, buckets), 2 * -(-total // chunk_bytes), "lm-chunks")
    answer = "kind string, bucket int, chunk long, a binary, b binary, c binary"
    answer_schema = pa.schema([("kind", pa.string()), ("bucket", pa.int32()), ("chunk", pa.int64()), ("a", pa.binary()), ("b", pa.binary()), ("c", pa.binary())])

    def answers(rows: list[tuple]) -> pa.Table:
        return pa.table([pa.array(c, f.type) for c, f in zip(zip(*rows), answer_schema)] if rows else [pa.array([], f.type) for f in answer_schema], schema=answer_schema)

    # Words: counts and numbers.
    word_schema = pa.schema(list(answer_schema) + [("tokens", pa.int64()), ("types", pa.int64())])
    begin_hash = word_hashes([BEGIN])[0][0]

    def count_words(rows: pa.Table) -> pa.Table:
        bucket = rows.column("bucket")[0].as_py()
        hashes, counts, own = gathered(
            [unpack_sorted(h) for h in rows.column("hashes").to_pylist()], [unpack(c, np.uint32) for c in rows.column("counts").to_pylist()]
        )
        ranks = _ranks(counts)
        token = hashes != begin_hash
        out = [("word", bucket, c, pack(counts[at].astype(np.uint64)), pack(ranks[at]), None, 0, 0) for c, at in zip(rows.column("chunk").to_pylist(), own)]
        out.append(("model", bucket, None, pack_sorted(hashes), pack(counts.astype(np.uint64)), pack(ranks), int(counts[token].sum()), int((counts[token] > 0).sum())))
        return pa.table([pa.array(c, f.type) for c, f in zip(zip(*out), word_schema)], schema=word_schema)

    said = chunks.rows.select("chunk", F.inline("words"))
    words = work.written(said.groupBy("bucket").applyInArrow(count_words, answer + ", tokens long, types long"), "lm-words")
    n_tokens, n_types = sum_row(words, "tokens", "types")
    word_answers = words.where("kind = 'word'").drop("tokens", "types")

    # Pairs of numbered words: which are kept, and their places.
    columns = ["lengths", "learn", "tokens", "begin", "end"]
    sent = "bucket int, chunk long, a binary, b binary, c binary"
    sent_schema = pa.schema(list(answer_schema)[1:])

    def send_pairs(chunk: pa.Table, answers: pa.Table) -> pa.Table:
        own = _Chunk(chunk, answers, buckets)
        own.find_pairs()
        learned = np.repeat(np.frombuffer(chunk.column("learn")[0].as_py(), np.uint8), own.lengths + 2)
        counts = np.bincount(own.pair_at, weights=learned[own.at], minlength=len(own.keys)).astype(np.uint32)
        rows = [(b, own.number, pack_sorted(own.keys[i:j]), pack(counts[i:j]), None) for b, i, j in own.cuts]
        return pa.table([pa.array(c, f.type) for c, f in zip(zip(*rows), sent_schema)] if rows else [pa.array([], f.type) for f in sent_schema], schema=sent_schema)

    level_schema = pa.schema(list(answer_schema) + [(f"of{c}", pa.int64()) for c in (1, 2, 3, 4)])

    def count_pairs(rows: pa.Table) -> pa.Table:
        bucket = rows.column("bucket")[0].as_py()
        keys, counts, own = gathered([unpack_sorted(k) for k in rows.column("a").to_pylist()], [unpack(c, np.uint32) for c in rows.column("b").to_pylist()])
        kept = counts >= LEAST
        place = np.where(kept, np.cumsum(kept), 0).astype(np.uint32)  # from 1; 0 for none
        out = [("pair", bucket, c, pack(place[at]), None, None, 0, 0, 0, 0) for c, at in zip(rows.column("chunk").to_pylist(), own)]
        out.append(("model", bucket, None, pack_sorted(keys[kept]), pack(counts[kept].astype(np.uint64)), None, *_of_counts(counts)))
        return pa.table([pa.array(c, f.type) for c, f in zip(zip(*out), level_schema)], schema=level_schema)

    of_counts = "".join(f", of{c} long" for c in (1, 2, 3, 4))
    pairs = chunks.answered(word_answers, columns, send_pairs, sent).groupBy("bucket").applyInArrow(count_pairs, answer + of_counts)
    pairs = work.written(pairs, "lm-pairs")
    pair_answers = pairs.where("kind = 'pair'").select(*word_answers.columns)
    discount2 = _discounts(*sum_row(pairs, "of1", "of2", "of3", "of4"))

    # Triples of kept pairs; with them the kept pairs that a chunk wants the shares of.
    def send_triples(chunk: pa.Table, answers: pa.Table) -> pa.Table:
        own = _Chunk(chunk, answers, buckets)
        own.find_pairs()
        own.find_triples()
        learned = np.repeat(np.frombuffer(chunk.column("learn")[0].as_py(), np.uint8), own.lengths + 2)
        counts = np.bincount(own.triple_at, weights=learned[own.triple_ends], minlength=len(own.triples)).astype(np.uint32)
        rows = []
        for (b, i, j), k, m in zip(own.cuts, own.triple_cuts, own.triple_cuts[1:]):
            wanted = own.keys[i:j][own.kept[i:j]]
            if len(wanted):
                rows.append((b, own.number, pack_sorted(wanted), pack_sorted(own.triples[k:m]), pack(counts[k:m])))
        return pa.table([pa.array(c, f.type) for c, f in zip(zip(*rows), sent_schema)] if rows else [pa.array([], f.type) for f in sent_schema], schema=sent_schema)

    wanted = work.written(chunks.answered(word_answers.union(pair_answers), columns, send_triples, sent), "lm-wanted")

    def count_triples(rows: pa.Table) -> pa.Table:
        keys, counts, _ = gathered([unpack_sorted(k) for k in rows.column("b").to_pylist()], [unpack(c, np.uint32) for c in rows.column("c").to_pylist()])
        kept = counts >= LEAST
        out = [("triple", rows.column("bucket")[0].as_py(), None, pack_sorted(keys[kept]), pack(counts[kept].astype(np.uint64)), None, *_of_counts(counts))]
        return pa.table([pa.array(c, f.type) for c, f in zip(zip(*out), level_schema)], schema=level_schema)

    triples = work.written(wanted.select("bucket", "b", "c").groupBy("bucket").applyInArrow(count_triples, answer + of_counts), "lm-triples")
    discount3 = _discounts(*sum_row(triples, "of1", "of2", "of3", "of4"))

    # One trie a bucket, and what its pairs take from the counts of their first words, for the words' buckets.
    # A trie's shares need the counts of first words, so these come first.
    def taken(rows: pa.Table) -> pa.Table:
        keys, counts = unpack_sorted(rows.column("a")[0].as_py()), unpack(rows.column("b")[0].as_py())
        first, starts = np.unique(keys >> _HALF, return_index=True)
        sums = np.add.reduceat(_discounted(counts, discount2), starts) if len(starts) else np.zeros(0)
        order, cuts = segments((first % np.uint64(buckets)).astype(np.int64))
        source = rows.column("bucket")[0].as_py()
        return answers([("taken", b, source, pack_sorted(first[order[i:j]] // np.uint64(buckets)), pack(sums[order[i:j]]), None) for b, i, j in cuts])

    pair_level = pairs.where("kind = 'model'").select("kind", "bucket", "chunk", "a", "b", "c")
    asked = pair_level.groupBy("bucket").applyInArrow(taken, answer)

    def leave(rows: pa.Table, asking: pa.Table) -> pa.Table:
        """For each chunk what its words leave as contexts; for each trie the counts of its first words."""
        bucket, out = rows.column("bucket")[0].as_py(), []
        rows = rows.to_pylist()
        model = next(r for r in rows if r["kind"] == "model")
        counts, ranks = unpack(model["b"]), unpack(model["c"], np.uint32)
        by_rank = np.zeros(int(ranks.max(initial=0)) + 1)
        by_rank[ranks] = counts
        gone = np.zeros(len(by_rank))
        for source, at, sums in zip(*(asking.column(c).to_pylist() for c in ("chunk", "a", "b"))):
            at = unpack_sorted(at).astype(np.int64) + 1
            gone[at] += unpack(sums, np.float64)
            out.append(("first", source, None, pack_sorted(((at - 1) * buckets + bucket).astype(np.uint64)), pack(by_rank[at]), None))
        by_rank[0], gone[0] = 1, 0
        steps = quantised((by_rank - gone) / by_rank)
        out += [("left", bucket, r["chunk"], pack(steps[unpack(r["b"], np.uint32)]), None, None) for r in rows if r["kind"] == "word"]
        return answers(out)

    left = work.written(words.drop("tokens", "types").groupBy("bucket").cogroup(asked.groupBy("bucket")).applyInArrow(leave, answer), "lm-left")
    levels = pair_level.union(triples.select(*pair_level.columns)).union(left.where("kind = 'first'"))

    def plant(rows: pa.Table) -> pa.Table:
        found = {"model": [], "triple": [], "first": []}
        for r in rows.to_pylist():
            found[r["kind"]].append(r)
        keys, counts = unpack_sorted(found["model"][0]["a"]), unpack(found["model"][0]["b"])
        triple = found["triple"][0] if found["triple"] else None
        codes, seen = (unpack_sorted(triple["a"]), unpack(triple["b"])) if triple else (np.zeros(0, np.uint64), np.zeros(0, np.uint64))
        firsts = np.concatenate([unpack_sorted(r["a"]) for r in found["first"]] or [np.zeros(0, np.uint64)])
        of_first = np.concatenate([unpack(r["b"], np.float64) for r in found["first"]] or [np.zeros(0)])
        order = np.argsort(firsts)
        context = of_first[order][np.searchsorted(firsts[order], keys >> _HALF)] if len(keys) else np.zeros(0)
        owner = (codes >> _HALF).astype(np.int64)
        left = 1 - np.bincount(owner, weights=_discounted(seen, discount3), minlength=len(keys)) / counts
        share3 = _discounted(seen, discount3) / counts[owner]
        trie = Trie.build(keys, quantised(_discounted(counts, discount2) / context), quantised(left), codes, quantised(share3))
        return pa.table([[rows.column("bucket")[0].as_py()], [trie]], schema=pa.schema([("bucket", pa.int32()), ("trie", pa.binary())]))

    tries = written(levels.groupBy("bucket").applyInArrow(plant, "bucket int, trie binary"), "lm-tries")

    def ask(trie: pa.Table, rows: pa.Table) -> pa.Table:
        if not rows.num_rows:
            return answers([])
        own, out = Trie(trie.column("trie").combine_chunks()[0].as_buffer()), []
        for r in rows.to_pylist():
            keys, codes = unpack_sorted(r["a"]), unpack_sorted(r["b"])
            share2, left3 = own.pair_steps(own.pair(keys >> _HALF, keys & np.uint64(0xFFFFFFFF)))
            share3 = own.triple_steps(own.triple((codes >> _HALF).astype(np.int64), codes & np.uint64(0xFFFFFFFF)))
            out.append(("share", r["bucket"], r["chunk"], pack(share2), pack(left3), pack(share3)))
        return answers(out)

    shares = tries.groupBy("bucket").cogroup(wanted.groupBy("bucket")).applyInArrow(ask, answer)

    # Probabilities of all tokens, summed by text.
    result = StructType().add(id_col, docs.schema[id_col].dataType).add("learned", "boolean").add("n_tokens", "long").add("n_known", "long")
    result = result.add("base_score", "double").add("score", "double")
    result_schema = to_arrow_schema(result)
    rest = np.log10(n_tokens + n_types + 1)

    def score(chunk: pa.Table, answers: pa.Table) -> pa.Table:
        own = _Chunk(chunk, answers, buckets)
        own.find_pairs()
        own.find_triples()
        counts = own.said("word", "a", np.uint64)
        base = np.log10(counts + 1.0) - rest
        known = np.add.reduceat((counts > 0)[own.tokens] & ~own.is_begin, own.begins, dtype=np.int64)
        p = base[own.tokens]
        p[own.is_begin] = 0
        base_sums = np.add.reduceat(p, own.begins)
        # In place, as a chunk holds millions of tokens: word, then pair, then triple.
        np.power(10.0, p, out=p)
        p[1:] *= restored(own.said("left", "a", np.uint16))[own.tokens[:-1]]
        share, left = np.zeros(len(own.keys)), np.ones(len(own.keys))
        share[own.kept], left[own.kept] = restored(own.said("share", "a", np.uint16)), restored(own.said("share", "b", np.uint16))
        p[own.at] += share[own.pair_at]
        later = own.at + 1 < len(p)
        p[own.at[later] + 1] *= left[own.pair_at[later]]
        p[own.triple_ends] += restored(own.said("share", "c", np.uint16))[own.triple_at]
        p[own.is_begin] = 1
        sums = np.add.reduceat(np.log10(p, out=p), own.begins)
        learned = np.frombuffer(chunk.column("learn")[0].as_py(), np.uint8).astype(bool)
        made = [chunk.column("ids").combine_chunks().flatten(), learned, own.lengths + 1, known, base_sums, sums]
        return pa.table([pa.array(c, f.type) if not isinstance(c, pa.Array) else c.cast(f.type) for c, f in zip(made, result_schema)], schema=result_schema)

    everything = word_answers.union(pair_answers).union(left.where("kind = 'left'")).union(shares)
    scores = written(chunks.answered(everything, columns + ["ids"], score, result), "lm-scores")
    work.clear()
    return ScoredTexts(scores, tries, n_tokens, n_types)


def _ranks(counts: np.ndarray) -> np.ndarray:
    """Places (from 1) of what occurs often enough, most frequent first; 0 for the rest."""
    order = np.argsort(-counts, kind="stable")[: int((counts >= LEAST).sum())]
    ranks = np.zeros(len(counts), np.uint32)
    ranks[order] = np.arange(1, len(order) + 1)
    return ranks


def _of_counts(counts: np.ndarray) -> tuple[int, ...]:
    return tuple(int((counts == c).sum()) for c in (1, 2, 3, 4))


def _discounts(n1: int, n2: int, n3: int, n4: int) -> tuple[float, float]:
    """What to take from a count of 2 and of more, by how often counts of 1 to 4 occur (Chen and Goodman 1998)."""
    if not (n1 and n2):
        return 0.75, 0.75
    y = n1 / (n1 + 2 * n2)
    two, more = 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / max(1, n3)
    return min(max(two, 0.1), 1.9), min(max(more, 0.1), 2.9)


def _discounted(counts: np.ndarray, discounts: tuple[float, float]) -> np.ndarray:
    return counts - np.where(counts == LEAST, *discounts)


def learned_from(id_col: str = "doc_id") -> Column:
    """All but every seventh document, by the checksum of the id as text (null: empty)."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % 7 != 2


def op11_elias_fano_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = score_texts(table(spark, sf_dir, "documents"), learned_from())
    return found.scores.select("doc_id", (~F.col("learned")).alias("held_out"), "n_tokens", "n_known", F.lit(found.tokens).cast("long").alias("train_tokens"), "base_score", "score")
