"""Operator 13 against a version that cuts every text with a regular expression."""

import hashlib
import random
import re

import duckdb
import pytest

from logstrata.llm import middle
from llm_cases import none, odd, odd_rows  # noqa: F401


def brute(key: str, text: str | None):
    text = text or ""
    units = re.findall(r"[A-Za-z]+|[^A-Za-z]", text)
    h = hashlib.sha256(f"1:{key}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[i:i + 8], 16) for i in (0, 8, 16, 24))
    a, b = sorted((h1 % (len(units) + 1), h2 % (len(units) + 1)))
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if not text or re.search("<[PSM]>", text) or h3 % 100 >= 90:
        return len(units), "plain", None, None, text
    if h4 % 100 < 20:
        return len(units), "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return len(units), "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


@pytest.mark.parametrize("letters", ["ab", " abcé日🙂\n<P>S", "abcdefghijk  ,", "日本語🙂é", "\x00\x85 a"])
def test_any_text_and_a_small_cache(letters):
    r, sums = random.Random(letters), middle.ChunkSums(1 << 16)
    for key, size in enumerate([0, 1, 2, 40, 300, 3000, 9000, 40_000] * 6):
        text = "".join(r.choices(letters, k=size))
        assert middle.transform(str(key), text, sums, 10, 20) == brute(str(key), text)


def test_borders_follow_content():
    r = random.Random(2)
    shared = "".join(r.choices("abcdefgh ,", k=30_000)).encode()
    one, two = (b"x" * k + shared for k in (10, 5_000))

    def chunks(text):
        ends = middle.chunk_borders(text)
        return [text[a:b] for a, b in zip([0] + ends, ends)]

    assert b"".join(chunks(two)) == two
    assert len(set(chunks(one)) & set(chunks(two))) >= 0.8 * len(chunks(one))
    assert all(len(c) <= 8192 + 3 for c in chunks(b"a" * 100_000) + chunks(one))


def test_memory_of_the_cache_is_bounded():
    sums = middle.ChunkSums(1 << 16)
    for n in range(2000):
        sums[b"%d" % n * 50]
    assert sum(map(len, sums)) + sum(map(len, sums._older)) < 1 << 16


def test_odd_rows(odd, odd_rows):
    rows = middle.fill_in_middle(odd).withColumn("again", middle.restored()).collect()
    found = sorted((str(r.doc_id), r.text or "", r.n, r.form, r.prefix_chars, r.middle_chars, r.output) for r in rows)
    assert found == sorted((str(i), t or "", *brute("" if i is None else str(i), t)) for i, t, *_ in odd_rows)
    assert all(r.again == (r.text or "") and r.score == "clash" for r in rows)


def test_empty_table(none):
    made = middle.fill_in_middle(none)
    assert made.count() == 0 and made.columns[-5:] == list(middle.ADDED)


def test_registered_query_equals_sql(spark):
    folder = "/root/testdata/sf0.001"
    found = sorted(map(tuple, middle.op13_chunk_middle(spark, folder).collect()))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{folder}/documents.parquet'")
    assert found == sorted(con.sql(middle.OP13_SQL).fetchall())
    texts = dict(con.sql("SELECT doc_id, coalesce(text, '') FROM documents").fetchall())
    assert all(row[-1] == hashlib.sha256(texts[row[0]].encode()).hexdigest() for row in found)
