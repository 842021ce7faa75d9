"""Operator 12 against counting every phrase, and its scans against the rule that activates phrases."""

import random
import re
from collections import Counter

import duckdb
import pytest
from llm_cases import none, odd, odd_rows  # noqa: F401
from pyspark.sql import functions as F

from logstrata.llm import phrases


def brute(rows, least, covered=50):
    """lang, phrase -> words, a, l, r, n, score."""
    f, n = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\n-\r]", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")):
            words = [w for w in re.split(r"[ \t]+", piece) if w]
            n[lang] += len(words)
            for size in (1, 2, 3):
                f.update((lang, *words[i:i + size]) for i in range(len(words) - size + 1))
    out = {}
    longest = Counter()
    for p, a in f.items():
        if len(p) == 4 and a >= least:
            for inner in (p[:3], (p[0], *p[2:])):
                longest[inner] = max(longest[inner], a)
    for p, a in f.items():
        if len(p) < 3 or a < least or 100 * longest[p] >= covered * a:
            continue
        cuts = [(1_000_000 * a * a // (f[p[:k + 1]] * f[(p[0], *p[k + 1:])]), k) for k in range(1, len(p) - 1)]
        score, k = min(cuts)
        out[p[0], " ".join(p[1:])] = (len(p) - 1, a, f[p[:k + 1]], f[(p[0], *p[k + 1:])], n[p[0]], score)
    return out


def case_rows(seed=3, docs=120):
    r = random.Random(seed)
    words = ["the", "New", "york", "é", "x.y", "a,b", "of", "city", "日本", "end!", "b\x00c"] + [f"w{i}" for i in range(60)]
    rows = []
    for _ in range(docs):
        text = r.choice([" ", "  ", "\t"]).join(r.choices(words, k=r.randint(0, 60), weights=[30 / (i + 1) for i in range(len(words))]))
        rows.append((r.choice(["en", "fr", None, ""]), text + r.choice(["", "\n", " New York city New York city of the end"])))
    return rows + [(None, None), ("en", ""), ("de", " \n\t "), ("en", "go " * 50)]


def found(df, **options):
    rows = phrases.collocations(df, **options).collect()
    assert len(rows) == len({(r.lang, r.phrase) for r in rows})
    return {(r.lang, r.phrase): (r.words, r.a, r.l, r.r, r.n, r.score) for r in rows}


@pytest.mark.parametrize("shards, chunk_bytes, bucket_bytes, parts, least", [(3, 16 << 20, 16 << 20, 1, 10), (3, 400, 2500, 4, 10), (1, 300, 9000, 2, 4), (2, 600, 4000, 3, 2), (5, 200, 9000, 2, 7)])
def test_all_phrases(spark, shards, chunk_bytes, bucket_bytes, parts, least):
    rows = case_rows()
    df = spark.createDataFrame(rows, "lang string, text string").withColumn("score", F.lit("clash")).withColumn("chunk", F.lit("clash")).repartition(parts)
    expected = brute(rows, least)
    assert len(expected) > 20
    assert found(df, shards=shards, chunk_bytes=chunk_bytes, bucket_bytes=bucket_bytes, least=least) == expected


def test_scans_interleave_lengths(spark):
    """Pairs are counted before words have completed their cycle, and nothing goes on after its own."""
    df = spark.createDataFrame(case_rows(docs=400), "lang string, text string").repartition(6)
    scans = phrases._Scans(df, "text", "lang", 10, 3, 300, 4000).run()
    first = scans.frequent(scans.pairs)
    assert scans.cycle_of["words"] <= 2 and scans.cycle_of["pairs"] <= 5
    assert scans._first_pairs < 3 and first.count() > 0
    scans.work.clear()


def test_counts_past_64_bits_are_exact(spark):
    a, left, right = 3_000_000_019, 4_000_000_007, 5_000_000_029
    row = spark.createDataFrame([(a, left, right)], "a long, l long, r long").select(phrases._score("a", "l", "r")).first()
    assert row[0] == 1_000_000 * a * a // (left * right)


def test_odd_rows_and_empty_table(odd, odd_rows, none):
    expected = brute([(row[2], row[1]) for row in odd_rows], 2)
    assert expected and found(odd, least=2, chunk_bytes=3000, bucket_bytes=9000) == expected
    assert found(none) == {}


def test_ranks_do_not_depend_on_parts(spark):
    rows = [("x", f"p{i}", i % 7, i % 3) for i in range(500)] + [("y", "q", 1, 1)]
    df = spark.createDataFrame(rows, "lang string, phrase string, score long, a long")
    expected = sorted(rows[:500], key=lambda r: (-r[2], -r[3], r[1]))[:60]
    for parts in (1, 5, 64):
        found = phrases.best(df, 60, parts).collect()
        assert sorted((r.rank, r.phrase) for r in found if r.lang == "x") == [(i + 1, r[1]) for i, r in enumerate(expected)]
        assert [(r.rank, r.phrase) for r in found if r.lang == "y"] == [(1, "q")]


def test_registered_query_equals_sql(spark):
    folder = "/root/testdata/sf0.001"
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{folder}/documents.parquet'")
    rows = sorted(map(tuple, phrases.op12_dynamic_counting(spark, folder).collect()))
    assert rows and rows == sorted(con.sql(phrases.OP12_SQL).fetchall())
