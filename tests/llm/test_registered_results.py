"""The registered queries without SQL, by name, against libraries and plain Python."""

import hashlib
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from logstrata.llm import QUERIES

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def docs(spark):
    return {r["doc_id"]: r for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}


def ranks(path):
    import base64

    return {base64.b64decode(a): int(b) for a, b in (line.split() for line in open(path, "rb") if line.strip())}


def test_op3(spark, docs):
    coder = tiktoken.Encoding("multi", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken")), special_tokens={})
    rows = {r["doc_id"]: r for r in QUERIES["op3_bpe"](spark, SMALL).collect()}
    assert rows.keys() == docs.keys()
    for i, r in rows.items():
        text = docs[i]["text"] or ""
        ids = coder.encode_ordinary(text)
        assert r["n_tokens"] == len(ids)
        assert r["ids_sha256"] == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(text.encode()).hexdigest()


def test_op5(spark, docs):
    coder, start = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json")), 0
    rows = {r["doc_id"]: r for r in QUERIES["op5_token_files"](spark, SMALL).collect()}
    for i in sorted(docs):
        ids = coder.encode(docs[i]["text"] or "", add_special_tokens=False).ids + [2]
        assert tuple(rows.pop(i))[:4] == (i, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)
    assert not rows


def test_op7(spark, docs):
    rows = QUERIES["op7_ppm_language"](spark, SMALL).collect()
    languages = {r["lang"] for r in docs.values()}
    assert {r["doc_id"] for r in rows} == docs.keys()
    for r in rows:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1) and 0 <= r["score"] <= 1
        text = docs[r["doc_id"]]["text"]
        assert (r["lang_pred"] == "und") == (not text or not any(map(str.isalpha, text))) and r["lang_pred"] in languages | {"und"}
    judged = [r["lang_pred"] == docs[r["doc_id"]]["lang"] for r in rows if r["held_out"] and r["lang_pred"] != "und"]
    assert sum(judged) / len(judged) > 0.95


def test_op9(spark, docs):
    coder = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    want = {}
    for i, d in docs.items():
        ids = coder.encode(d["text"] or "", add_special_tokens=False).ids + [1]
        for n, at in enumerate(range(0, len(ids), 4096)):
            want[i, n] = (at, len(ids[at:at + 4096]), zlib.crc32(np.array(ids[at:at + 4096], "<u4").tobytes()))
    rows = QUERIES["op9_bin_completion"](spark, SMALL).collect()
    assert {(r["doc_id"], r["piece"]): (r["start"], r["length"], r["ids_crc32"]) for r in rows} == want and len(rows) == len(want)
    bins = defaultdict(list)
    for r in rows:
        bins[r["sequence_id"]].append((r["offset"], r["length"]))
    for own in bins.values():
        own.sort()
        assert own[0][0] == 0 and all(a + n == b for (a, n), (b, _) in zip(own, own[1:])) and sum(n for _, n in own) <= 4096
    assert len(bins) == -(-sum(n for _, n, _ in want.values()) // 4096)


def test_op10(spark, docs):
    rows = QUERIES["op10_external_shuffle"](spark, SMALL).collect()
    want = {i: (len((d["text"] or "").encode()) + 1, zlib.crc32((d["text"] or "").encode()), "rows", None) for i, d in docs.items()}
    assert {r["doc_id"]: (r["size"], r["text_crc32"], r["law"], r["grown_shard"]) for r in rows} == want and len(rows) == len(docs)
    slots = defaultdict(list)
    for r in rows:
        slots[r["shard"]].append(r["slot"])
    assert slots.keys() == set(range(8)) and all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert max(map(len, slots.values())) - min(map(len, slots.values())) <= 1


def test_op8_scores_are_exact(spark):
    vectors = {r["vec_id"]: np.array(r["embedding"], float) for r in spark.read.parquet(f"{SMALL}/embeddings.parquet").where(F.col("embedding").isNotNull()).collect()}
    rows = QUERIES["op8_projection_forest"](spark, SMALL).collect()
    assert rows and all(r["score"] == pytest.approx(float(vectors[r["query_id"]] @ vectors[r["vec_id"]]), abs=1e-12) and r["query_id"] % 20 == 0 != r["vec_id"] - r["query_id"] for r in rows)


#: Twelve alphabets' worth of letters: two invented languages in each of six scripts.
SCRIPTS = ["абвгдежзиклмнопрстуф", "αβγδεζηθικλμνξοπρστυ", "あいうえおかきくけこさしすせそたちつてと", "的一是不了人我在有他这中大来上国个到说们", "אבגדהוזחטיכלמנסעפצקר", "अआइईउऊएऐओऔकखगघचछजझटठ"]


def test_languages_of_several_scripts(spark):
    import random

    from logstrata.llm.langid import held_out, identify, train

    rows, r = [], random.Random(11)
    for s, letters in enumerate(SCRIPTS):
        for half in (0, 1):
            # Two languages of one script differ in how often each letter comes and what follows it.
            weights = [1 / (1 + (k * (3 + 4 * half)) % 20) for k in range(20)]
            words = ["".join(r.choices(letters, weights, k=r.randint(2, 7))) for _ in range(200)]
            rows += [(" ".join(r.choices(words, [1 / (1 + k) for k in range(200)], k=size)), f"s{s}{half}") for size in (5, 20, 100) for _ in range(20)]
    docs = spark.createDataFrame([(i, *row) for i, row in enumerate(rows)], "doc_id long, text string, lang string").repartition(3)
    found = identify(docs, train(docs)).where(held_out()).collect()
    assert len(found) > 150 and sum(x["lang_pred"] == x["lang"] for x in found) / len(found) >= 0.97


def test_only_the_most_frequent_labels_are_learned(spark):
    from logstrata.llm.langid import identify, train

    rows = [(i, "ba ke lo mi " * 5, "aa") for i in range(60)] + [(100 + i, "zuz tit vov " * 5, "bb") for i in range(50)] + [(1000 + i, "x y z", f"junk{i}") for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(3)
    trees = train(docs, most_languages=2)
    assert trees.languages == ["aa", "bb"]
    assert {r["lang_pred"] for r in identify(docs.where("doc_id < 60"), trees).collect()} == {"aa"}
