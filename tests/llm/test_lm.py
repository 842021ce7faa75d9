"""Operator 11: Elias-Fano sequences and tries against sorted arrays, scores against a model kept in dictionaries."""

import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest
from llm_cases import DOCS, none, odd, odd_rows, prose  # noqa: F401
from pyspark.sql import functions as F

from logstrata.llm import lm
from logstrata.llm.eliasfano import EliasFano, Trie, quantised, restored


@pytest.mark.parametrize("n, below", [(0, 10), (1, 1), (1, 1 << 40), (5, 3), (1000, 100), (1000, 1 << 50), (70_000, 1 << 33)])
def test_sequences(n, below):
    r = np.random.default_rng(n)
    values = np.sort(r.integers(0, below, n).astype(np.uint64))
    kept = EliasFano.of(values)
    assert (kept.at(np.arange(n)) == values).all()
    wanted = np.concatenate([r.integers(0, below + 5, 400).astype(np.uint64), values[:400]])
    begin = r.integers(0, n + 1, len(wanted))
    end = np.maximum(begin, r.integers(0, n + 1, len(wanted)))
    places, found = kept.successor(wanted, begin, end)
    for value, b, e, place, hit in zip(wanted, begin, end, places, found):
        assert place == b + np.searchsorted(values[b:e], value) and hit == (place < e and values[place] == value)


@pytest.mark.parametrize("n", [0, 1, 4000])
def test_trie(n, tmp_path):
    r = np.random.default_rng(n)
    pairs = np.unique(r.integers(0, 200, n).astype(np.uint64) << np.uint64(32) | r.integers(0, 300, n).astype(np.uint64))
    triples = np.unique(r.integers(0, max(1, len(pairs) // 2), 3 * n).astype(np.uint64) << np.uint64(32) | r.integers(0, 50, 3 * n).astype(np.uint64))
    share2, left3, share3 = (r.integers(0, 1000, size) for size in (len(pairs), len(pairs), len(triples)))
    (tmp_path / "trie").write_bytes(Trie.build(pairs, share2, left3, triples, share3))
    trie = Trie.open(str(tmp_path / "trie"))  # mapped from a file
    x, y, z = (r.integers(0, top, 3000).astype(np.uint64) for top in (210, 310, 60))
    places = trie.pair(x, y)
    known = {int(k): i for i, k in enumerate(pairs)}
    assert places.tolist() == [known.get(int(k), -1) for k in x << np.uint64(32) | y]
    deeper = {int(k): i for i, k in enumerate(triples)}
    found = trie.triple(places, z)
    assert found.tolist() == [deeper.get((int(a) << 32) | int(b), -1) if a >= 0 else -1 for a, b in zip(places, z)]
    assert trie.pair_steps(places)[0].tolist() == [share2[p] if p >= 0 else 0xFFFF for p in places]
    assert trie.triple_steps(found).tolist() == [share3[p] if p >= 0 else 0xFFFF for p in found]


def test_quantised_values_never_grow():
    values = np.array([1.0, 0.5, 1e-9, 0.123456, 0.0])
    again = restored(quantised(values))
    assert (again <= values).all() and (again >= values * 0.99).all() and again[0] == 1


class Dictionary:
    """The same model in dictionaries, over token lists."""

    def __init__(self, texts):
        self.counts = [Counter(), Counter(), Counter()]
        for t in texts:
            for n in (1, 2, 3):
                self.counts[n - 1].update(tuple(t[i:i + n]) for i in range(len(t) - n + 1))
        one, two, three = self.counts
        numbered = {w for (w,), c in one.items() if c >= 2}
        two = {p: c for p, c in two.items() if set(p) <= numbered}
        d2 = self.discounts(two)
        self.two = {p: c - d2[c > 2] for p, c in two.items() if c >= 2}
        three = {t: c for t, c in three.items() if t[:2] in self.two and t[1:] in self.two}
        d3 = self.discounts(three)
        self.three = {t: c - d3[c > 2] for t, c in three.items() if c >= 2}
        self.left2, self.left3 = Counter(), Counter()
        for p, c in self.two.items():
            self.left2[p[0]] += c
        for t, c in self.three.items():
            self.left3[t[:2]] += c
        self.n = sum(c for (w,), c in one.items() if w != lm.BEGIN)
        self.v = len(one) - ((lm.BEGIN,) in one)

    @staticmethod
    def discounts(counts):
        return lm._discounts(*(sum(c == k for c in counts.values()) for k in (1, 2, 3, 4)))

    def p(self, before, x, z):
        one, two, _ = self.counts
        q = lambda v: float(restored(quantised(np.array([v])))[0])
        p = (one[z,] + 1) / (self.n + self.v + 1)
        c = one[x,] if one[x,] >= 2 else 0
        p = (q(self.two[x, z] / c) if (x, z) in self.two else 0) + (q((c - self.left2[x]) / c) if c else 1) * p
        if before is None:
            return p
        c = two[before, x] if (before, x) in self.two else 0
        return (q(self.three[before, x, z] / c) if (before, x, z) in self.three else 0) + (q((c - self.left3[before, x]) / c) if c else 1) * p

    def score(self, t):
        return sum(math.log10(self.p(t[i - 2] if i > 1 else None, t[i - 1], t[i])) for i in range(1, len(t)))


def tokens(text):
    return [lm.BEGIN] + (text or "").encode().lower().split() + [lm.END]


def case_rows():
    r = random.Random(7)
    words = [prose(i, 1) for i in range(60)]
    out = [(i, " ".join(r.choices(words, k=r.randint(0, 60), weights=[1 / (k + 1) for k in range(60)]))) for i in range(150)]
    return out + [(200, None), (201, ""), (202, " \n"), (203, "É É é É"), (203, "É É é É"), (None, "one two"), (204, out[3][1].upper())]


@pytest.mark.parametrize("chunk_bytes, bucket_bytes, parts", [(16 << 20, 16 << 20, 1), (700, 900, 3)])
def test_scores_equal_the_model_in_dictionaries(spark, chunk_bytes, bucket_bytes, parts):
    rows = case_rows()
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("score", F.lit("clash")).repartition(parts)
    found = lm.score_texts(df, lm.learned_from(), chunk_bytes=chunk_bytes, bucket_bytes=bucket_bytes)
    learned = [t for i, t in rows if zlib.crc32(("" if i is None else str(i)).encode()) % 7 != 2]
    assert 0 < len(learned) < len(rows)
    model = Dictionary(map(tokens, learned))
    assert (found.tokens, found.types) == (model.n, model.v)
    one = model.counts[0]
    expected = []
    for i, text in rows:
        t = tokens(text)
        base = sum(math.log10((one[w,] + 1) / (model.n + model.v + 1)) for w in t[1:])
        expected.append((-1 if i is None else i, len(t) - 1, sum(one[w,] > 0 for w in t[1:]), round(base, 6), round(model.score(t), 6)))
    got = [(-1 if r.doc_id is None else r.doc_id, r.n_tokens, r.n_known, round(r.base_score, 6), round(r.score, 6)) for r in found.scores.collect()]
    assert sorted(got) == sorted(expected)


def test_probabilities_after_a_context_add_up_to_one_at_most():
    model = Dictionary([tokens(t) for _, t in case_rows()])
    words = [w for w, in model.counts[0] if w != lm.BEGIN]
    for before, x in [(None, lm.BEGIN), *list(model.two)[:40], (b"never", b"seen")]:
        total = sum(model.p(before, x, z) for z in words) + model.p(before, x, b"never")
        assert 0.98 < total <= 1 + 1e-9


def test_odd_rows_and_empty_table(spark, odd, odd_rows, none):
    found = lm.score_texts(odd, lm.learned_from(), chunk_bytes=5000, bucket_bytes=9000).scores.collect()
    assert sorted(str(r.doc_id) for r in found) == sorted(str(row[0]) for row in odd_rows)
    assert all(r.score <= 0 and r.n_tokens >= 1 for r in found)
    empty = lm.score_texts(none, lm.learned_from())
    assert empty.scores.count() == 0 and (empty.tokens, empty.types) == (0, 0)
    nothing = lm.score_texts(odd, F.lit(False))
    assert {r.score for r in nothing.scores.collect()} == {0.0}


def test_registered_query(spark):
    rows = lm.op11_elias_fano_lm(spark, "/root/testdata/sf0.001").collect()
    held = [r for r in rows if r.held_out]
    assert held and all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 7 == 2) for r in rows)
    assert sum(r.score for r in held) > sum(r.base_score for r in held)
    assert all(r.train_tokens == sum(x.n_tokens for x in rows if not x.held_out) for r in rows)
