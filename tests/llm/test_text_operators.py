import re
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from llm_cases import DOCS, none, odd, odd_rows, prose  # noqa: F401
from pyspark.sql import functions as F

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def words_of(text):
    return WORD.findall(text or "")


def test_window_repeats_match_brute_force(odd, odd_rows):
    from logstrata.llm.substring import remove_repeats

    window = 35
    split = [words_of(r[1]) for r in odd_rows]
    seen = Counter(tuple(w[i:i + window]) for w in split for i in range(len(w) - window + 1))
    want = Counter()
    for row, w in zip(odd_rows, split):
        gone = set()
        for i in range(len(w) - window + 1):
            if seen[tuple(w[i:i + window])] > 1:
                gone.update(range(i, i + window))
        want[row[0], len(w), len(gone), " ".join(x for i, x in enumerate(w) if i not in gone)] += 1
    left = remove_repeats(odd, chunk_bytes=20_000, bucket_bytes=20_000)
    assert "source" in left.columns and left.columns.count("kept") == 1
    rows = left.select("doc_id", "n_words", "n_removed", "kept", "removed").collect()
    assert Counter(tuple(r)[:4] for r in rows) == want
    assert all(sum(s["end"] - s["first"] for s in r["removed"]) == r["n_removed"] for r in rows)


def test_window_repeats_of_nothing(none):
    from logstrata.llm.substring import remove_repeats

    assert remove_repeats(none).count() == 0


def test_bpe_equals_the_tiktoken_library(odd, odd_rows):
    import tiktoken
    from logstrata.llm.bpe import RANKS, encode_documents, read_ranks

    ranks = read_ranks(public_tokenizers.path(RANKS))
    coder = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    want = sorted((r[0] or -1, coder.encode_ordinary(r[1] or ""), (r[1] or "").encode()) for r in odd_rows)
    got = sorted((r[0] or -1, list(r[1]), bytes(r[2])) for r in encode_documents(odd).collect())
    assert got == want


def test_bpe_of_random_bytes_equals_plain_merging():
    import random

    from logstrata.llm.bpe import BacktrackingBpe, merge_by_rank

    alphabet = [bytes([c]) for c in b"abc"]
    tokens = alphabet + [b"ab", b"bc", b"abc", b"ca", b"aa", b"aaa", b"cab", b"bcaa", b"abcab"]
    bpe = BacktrackingBpe({t: i for i, t in enumerate(tokens)})
    r = random.Random(5)
    for _ in range(3000):
        piece = bytes(r.choice(b"abc") for _ in range(r.randint(1, 24)))
        assert [bpe.bytes_of[i] for i in bpe.encode(piece)] == merge_by_rank(piece, bpe.ranks) or piece in bpe.ranks


def test_bpe_refuses_ranks_out_of_merge_order():
    from logstrata.llm.bpe import BacktrackingBpe

    with pytest.raises(ValueError):
        BacktrackingBpe({b"a": 0, b"b": 1, b"c": 2, b"abc": 3, b"ab": 4})


def brute_groups(rows, percent=80):
    sets = {}
    for row in rows:
        w = re.findall(rb"[^\x20\x09-\x0D]+", (row[1] or "").encode().lower())
        s = {tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())
        if row[0] is not None:
            sets.setdefault(row[0], []).append(s)
    parent = {i: i for i in sets}

    def find(x):
        return x if parent[x] == x else find(parent[x])

    for a in sets:
        for b in sets:
            if a < b and any(s and t and 100 * len(s & t) >= percent * len(s | t) for s in sets[a] for t in sets[b]):
                one, two = sorted((find(a), find(b)))
                parent[two] = one
    return {i: find(i) for i in sets}


def test_jaccard_groups_match_brute_force(odd, odd_rows):
    from logstrata.llm.jaccard import near_duplicate_groups

    want = brute_groups(odd_rows)
    got = near_duplicate_groups(odd, chunk_bytes=30_000, bucket_bytes=30_000).collect()
    assert len(got) == len(odd_rows)
    assert all(r["component_id"] is None if r["doc_id"] is None else r["component_id"] == want[r["doc_id"]] for r in got)
    sizes = {r["doc_id"]: r["n_shingles"] for r in got}
    assert (sizes[5], sizes[6], sizes[7], sizes[8], sizes[17]) == (0, 0, 0, 1, 1)


def test_jaccard_at_the_threshold(spark):
    """Sets of many sizes with similarity just at, above and below 80 %, in chains and in one group of near copies."""
    from logstrata.llm.jaccard import near_duplicate_groups

    rows, doc = [], 0
    for size in list(range(5, 45)) + [100, 333, 1000]:
        base = prose(size, size).split()
        for changed in {0, 1, size // 40, size // 25, size // 18, size // 10}:
            rows.append((doc, " ".join(base[:size - changed] + ["x%d" % i for i in range(changed)]), None, None, 0))
            doc += 1
            rows.append((doc, " ".join(base[:max(1, size - 2 * changed)]), None, None, 0))
            doc += 1
    want = brute_groups(rows)
    got = near_duplicate_groups(spark.createDataFrame(rows, DOCS), chunk_bytes=20_000, bucket_bytes=20_000)
    assert {r["doc_id"]: r["component_id"] for r in got.collect()} == want
    assert len(set(want.values())) < len(want)


def test_jaccard_of_nothing(none):
    from logstrata.llm.jaccard import near_duplicate_groups

    assert near_duplicate_groups(none).count() == 0


def test_signatures_meet_for_every_pair_that_links():
    from logstrata.llm.jaccard import Bands

    r = np.random.default_rng(4)
    for sets in (1, 100_000):
        bands = Bands([sets] * 60)
        for size in (1, 2, 4, 5, 9, 10, 17, 40, 150, 700):
            for _ in range(40):
                x = np.unique(r.integers(0, 1 << 63, size).astype(np.uint64))
                most = len(x) // 9
                cut = int(r.integers(0, most + 1))
                y = np.unique(np.concatenate([x[cut:], r.integers(0, 1 << 63, int(r.integers(0, max(1, most - cut + 1)))).astype(np.uint64)]))
                both = len(np.intersect1d(x, y))
                if 100 * both < 80 * (len(x) + len(y) - both):
                    continue
                rule = r.random() < 0.5  # frequent is a property of the shingle, not of the document
                frequent = [(s % np.uint64(2) == 0) & rule for s in (x, y)]
                one, two = (bands.signatures(len(s), s, f) for s, f in zip((x, y), frequent))
                assert len(np.intersect1d(one, two))


def test_line_dedup(spark, none):
    from logstrata.llm.linededup import dedup_lines

    common, rare = "Accept all cookies", "Read our newsletter"
    rows = [(i, f"{prose(i, 20)}\n  {common}\r\n\n{prose(100 + i, 20)}" + (f"\n{rare}" if i < 8 else ""), None, f"site{i % 12}", 0) for i in range(24)]
    rows += [(100 + i, f"{common}\nok", None, "site0", 0) for i in range(3)]  # a short page, for the greater part the common line
    rows += [(200, None, None, "site1", 0), (201, "", None, "site2", 0), (202, common, None, None, 0), (None, f"{prose(7, 30)}\n{common}", None, "site3", 0), (3, rows[3][1], None, "site3", 0)]
    df = spark.createDataFrame(rows, DOCS).withColumn("n_lines", F.lit("clash")).repartition(4)
    got = {}
    for r in dedup_lines(df).collect():
        got.setdefault(r["doc_id"], []).append(r)
    for i in range(8, 24):
        assert got[i][0]["text"] == f"{prose(i, 20)}\n\n{prose(100 + i, 20)}" and (got[i][0]["n_lines"], got[i][0]["n_removed"]) == (4, 1)
    assert got[0][0]["n_removed"] == 2 and rare not in got[0][0]["text"]  # on exactly eight sites
    assert got[100][0]["text"] == "ok" and got[202][0]["text"] == common
    assert (got[200][0]["text"], got[200][0]["n_lines"]) == (None, 0) and (got[201][0]["text"], got[201][0]["n_lines"]) == ("", 1)
    assert got[None][0]["n_removed"] == 1 and len(got[3]) == 2
    assert dedup_lines(none).count() == 0


def test_lines_of_whole_copies_are_not_boilerplate(spark):
    from logstrata.llm.linededup import dedup_lines

    body, banner = [prose(500 + i, 30) for i in range(4)], "Subscribe to our newsletter"
    rows = [(i, "\n".join([*body, prose(600 + i, 5)]), None, f"site{i}", 0) for i in range(12)]  # near copies on twelve sites
    rows += [(100 + i, f"{prose(700 + i, 30)}\n{banner}", None, f"site{i}", 0) for i in range(8)]
    rows += [(200, f"{body[0]}\n{banner}", None, "site0", 0), (201, banner, None, "site1", 0), (202, f"\n{banner}\n{banner}", None, "site2", 0)]
    got = {r["doc_id"]: r["text"] for r in dedup_lines(spark.createDataFrame(rows, DOCS).repartition(3)).collect()}
    assert all(got[i] == rows[i][1] for i in range(12))
    assert all(got[100 + i] == prose(700 + i, 30) for i in range(8))
    assert got[200] == body[0] and got[201] == banner and got[202] == rows[-1][1]  # nothing else in the last two


def test_line_dedup_is_native(spark, odd):
    from logstrata.llm.linededup import dedup_lines

    plan = dedup_lines(odd)._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


def test_language_on_held_out_texts(spark):
    from logstrata.llm.langid import held_out, identify, train

    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    found = identify(docs, train(docs, texts_per_language=100))
    right = found.where(held_out()).agg(F.avg((F.col("lang_pred") == F.col("lang")).cast("double"))).first()[0]
    assert right > 0.98


def test_language_of_odd_texts(odd, none):
    from logstrata.llm.langid import ContextTrees, identify, train

    trees = ContextTrees({"xx": [b"ba ke lo mi nu ra se ti"], "yy": [b"the cat and the dog"], "zz": []})
    rows = identify(odd, trees).collect()
    by_id = {r["doc_id"]: r for r in rows}
    assert len(rows) == 20 and all(0 <= r["score"] <= 1 for r in rows)
    assert all(by_id[i]["lang_pred"] == "und" for i in (5, 6, 7, 16)) and by_id[1]["lang_pred"] == "xx"
    assert train(none).languages == [] and identify(none, train(none)).count() == 0
    assert {r["lang_pred"] for r in identify(odd, train(none)).collect()} == {"und"}


def test_code_lengths_are_those_of_the_trees():
    """Against a plain byte-by-byte walk from the longest context down."""
    from math import log2

    from logstrata.llm.langid import DEPTH, SYMBOLS, CodeLengths, ContextTrees

    samples = {"a": [b"abracadabra", b"abba"], "b": [b"banana bandana", b"cabbage"]}
    trees = ContextTrees(samples)
    text = b"abra banana qbb"
    got = CodeLengths(trees).score([text])[0]
    for column, language in enumerate(trees.languages):
        counts = Counter()
        for sample in samples[language]:
            s = tuple(trees._symbols(sample))
            for i in range(DEPTH, len(s)):
                for depth in range(DEPTH + 1):
                    counts[s[i - depth:i], s[i]] += 1
        bits, s = 0.0, tuple(trees._symbols(text))
        for i in range(DEPTH, len(s)):
            for depth in range(DEPTH, -1, -1):
                context = s[i - depth:i]
                after = {x: n for (c, x), n in counts.items() if c == context}
                if not after:
                    continue
                total = sum(after.values()) + len(after)
                if s[i] in after:
                    bits -= log2(after[s[i]] / total)
                    break
                bits -= log2(len(after) / total)
            else:
                bits += log2(SYMBOLS)
            bits += trees.rare_bits if s[i] == SYMBOLS - 1 else 0
        assert abs(bits - got[column]) < 1e-3 * bits
