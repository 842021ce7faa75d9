import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
from llm_cases import DOCS, odd_rows, prose  # noqa: F401
from pyspark.sql import functions as F
from test_text_operators import brute_groups, words_of
from tokenizers import Tokenizer

import corpus_pipeline


def stage(spark, number, rows, extra=True):
    """The rows of one stage over ``rows``, with further columns that clash with names used inside."""
    df = spark.createDataFrame(rows, DOCS)
    if extra:
        for name in ("n_removed", "kept", "component", "lang_pred", "label"):
            df = df.withColumn(name, F.lit("clash"))
    out = corpus_pipeline.STAGES[number][1](spark, df.repartition(3), "")
    if number < 4:
        assert out.columns == df.columns
    return out


def test_names_and_order():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language ID", "line dedup", "n-gram Jaccard join", "substring dedup", "best-fit packing"]


def test_every_stage_takes_odd_rows_and_empty_tables(spark, odd_rows):
    for number in range(5):
        assert stage(spark, number, []).count() == 0
        assert stage(spark, number, odd_rows).count() > 0


def test_language_id_rejects_what_is_no_language_and_keeps_the_rest(spark, odd_rows):
    kept = [r["doc_id"] for r in stage(spark, 0, odd_rows).collect()]
    assert not {5, 6, 7, 16} & set(kept) and {1, 2, 3, 8, 10, 12} <= set(kept) and kept.count(12) == 2
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    assert corpus_pipeline.language_id(spark, docs, "").count() == docs.where(F.col("text").rlike(r"\p{L}")).count()


def test_language_id_rejects_an_unlearned_language_and_keeps_short_prose_with_a_key(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text", "lang")
    unlearned = docs.where("lang = 'en' AND octet_length(text) >= 1500").select((F.col("doc_id") + 10**9).alias("doc_id"), "text", F.lit(None).cast("string").alias("lang"))
    others = docs.where("lang <> 'en'")
    key = "".join(chr(33 + (7 * i * i + i) % 90) for i in range(60))
    planted = [(2 * 10**9, "kq#7 zx!" + "Zq9#x@Kv7$w" * 200, None)]
    short = others.where("octet_length(text) BETWEEN 60 AND 400").select((F.col("doc_id") + 3 * 10**9).alias("doc_id"), F.concat("text", F.lit(" " + key)).alias("text"), "lang")
    rows = others.union(unlearned).union(short).union(spark.createDataFrame(planted, docs.schema))
    kept = {r[0] for r in corpus_pipeline.language_id(spark, rows, "").select("doc_id").collect()}
    assert unlearned.count() > 50 and short.count() > 5 and not any(10**9 <= i < 3 * 10**9 for i in kept)
    assert {r[0] for r in short.collect()} <= kept
    assert {r[0] for r in others.where(F.col("text").rlike(r"\p{L}")).collect()} <= kept


def test_one_document_of_each_group_stays(spark, odd_rows):
    want = brute_groups(odd_rows)
    kept = Counter(r["doc_id"] for r in stage(spark, 2, odd_rows).collect())
    assert {i for i in kept if i is not None} == set(want.values())
    assert kept[12] == 1 and kept[None] == 2


def brute_run(docs):
    """All five stages over (doc_id, text, lang, source) in plain Python; the language stage keeps every text with letters."""
    docs = [d for d in docs if d[1] and any(map(str.isalpha, d[1]))]
    sites = defaultdict(set)
    for _, text, _, source in docs:
        for line in text.split("\n"):
            if (bare := line.strip(" \t\r")) and source is not None:
                sites[bare].add(source)
    cleaned = []
    for doc_id, text, lang, source in docs:
        lines = text.split("\n")
        common = [x for x in lines if len(sites.get(x.strip(" \t\r"), ())) >= 8]
        if common and 2 * sum(len(x.strip(" \t\r")) for x in common) <= sum(len(x.strip(" \t\r")) for x in lines):
            text = "\n".join(x for x in lines if len(sites.get(x.strip(" \t\r"), ())) < 8)
        cleaned.append((doc_id, text))
    groups = brute_groups(cleaned)
    cleaned = [d for d in cleaned if groups[d[0]] == d[0]]
    split = {i: words_of(t) for i, t in cleaned}
    seen = Counter(tuple(w[n:n + 35]) for w in split.values() for n in range(len(w) - 34))
    pieces = Counter()
    coder = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    for doc_id, text in cleaned:
        w = split[doc_id]
        gone = {j for n in range(len(w) - 34) if seen[tuple(w[n:n + 35])] > 1 for j in range(n, n + 35)}
        if gone:
            text = " ".join(x for j, x in enumerate(w) if j not in gone)
        ids = coder.encode(text, add_special_tokens=False).ids + [1]
        for n, at in enumerate(range(0, len(ids), 4096)):
            own = ids[at:at + 4096]
            pieces[doc_id, n, at, len(own), zlib.crc32(np.array(own, "<u4").tobytes())] += 1
    return pieces


def test_run_matches_brute_force(spark, scratch):
    """Over a table of its own that holds cases for every stage."""
    rows = []
    for i in range(60):
        text = prose(i, 80 + 7 * (i % 9))
        if i % 3 == 0:
            text += "\nsubscribe to our newsletter now\n" + prose(900 + i, 20)
        if i % 10 == 4:
            text += " " + prose(5000, 55)  # a passage of several documents
        rows.append((i, text, "xx", f"site{i % 12}", len(text)))
    for i in range(8):
        rows.append((100 + i, rows[i][1], "xx", "site0", 0))
        near = rows[20 + i][1].split(" ")
        near[40] = "changed"
        rows.append((200 + i, " ".join(near), "xx", "site1", 0))
    rows += [(300, None, "xx", "site2", 0), (301, "12 34", None, "site2", 0), (302, "", None, "site2", 0), (303, prose(77, 6000), None, "site3", 0)]
    path = scratch("pipeline-table")
    spark.createDataFrame(rows, DOCS).repartition(3).write.parquet(f"{path}/documents.parquet")
    got = corpus_pipeline.run(spark, path).collect()
    assert Counter(tuple(r)[:5] for r in got) == brute_run([r[:4] for r in rows])
    bins = defaultdict(int)
    for r in got:
        bins[r["sequence_id"]] += r["length"]
    assert max(bins.values()) <= 4096 and len(bins) == -(-sum(bins.values()) // 4096)


def test_short_pages_lose_boilerplate_and_copies_stay(spark):
    licence, body = "This work is licensed under the GNU General Public License", [prose(500 + i, 30) for i in range(4)]
    rows = [(i, f"{prose(i, 40)}\n{licence}", "xx", f"site{i % 12}", 0) for i in range(24)]
    rows += [(100, f"ba ke lo.\n{licence}", "xx", "site3", 0), (100, f"ba ke lo.\n{licence}", "xx", "site3", 0), (101, f" {licence}\n", "xx", "site4", 0)]
    rows += [(200 + i, "\n".join([*body, prose(600 + i, 8), licence]), "xx", f"site{i}", 0) for i in range(10)]
    rows += [(300 + i, "\n".join(body), "xx", f"site{i}", 0) for i in range(2)]
    rare = "Accept all cookies or read our policy"  # on eight sites, one of them with a short page only
    rows = [(i, f"{t}\n{rare}" if i < 7 else t, *rest) for i, t, *rest in rows] + [(400, f"ti vo\n{rare}", "xx", "site7", 0)]
    got = defaultdict(list)
    for r in stage(spark, 1, rows).collect():
        got[r["doc_id"]].append((r["text"], r["n_chars"]))
    assert got[5] == [(prose(5, 40), len(prose(5, 40)))]
    assert got[100] == [("ba ke lo.", 9)] * 2 and got[400] == [("ti vo", 5)] and got[101][0][0] == f" {licence}\n"  # nothing else in it
    for i in range(10):  # near copies on ten sites: one of them must outlive the next stage with its text
        assert got[200 + i][0][0] == "\n".join([*body, prose(600 + i, 8)])
    assert got[300][0][0] == got[301][0][0] == "\n".join(body)


def test_registered_queries():
    import __spark_entry__

    names = set(__spark_entry__.queries())
    assert "pipeline" in names and all(any(n.startswith(f"op{i}_") for n in names) for i in range(1, 11))


def test_queries_match_their_sql(spark):
    import duckdb
    from logstrata.llm import ORACLE_SQL, QUERIES

    con = duckdb.connect()
    for name in ("documents", "embeddings"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '/root/testdata/sf0.001/{name}.parquet'")
    for name, sql in ORACLE_SQL.items():
        want = con.sql(sql)
        rows = QUERIES[name](spark, "/root/testdata/sf0.001").select(*want.columns).collect()
        assert Counter(map(tuple, rows)) == Counter(want.fetchall()), name
