import io
import random
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from llm_cases import none, odd, odd_rows  # noqa: F401
from pyspark.sql import functions as F
from tokenizers import Tokenizer


def library_ids(name, text):
    return Tokenizer.from_file(public_tokenizers.path(name)).encode(text or "", add_special_tokens=False).ids


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def test_token_files_match_the_library(odd, odd_rows, scratch):
    from logstrata.llm.tokenfile import read_token_files, write_token_files

    files = write_token_files(odd, scratch("ids"), file_bytes=40_000)
    got = read_token_files(files).orderBy("start").collect()
    want = Counter()
    for row in odd_rows:
        ids = library_ids("byte_bpe_50k.json", row[1]) + [2]
        want[row[0], len(ids), crc(ids)] += 1
    assert files.count() > 1
    assert Counter((r["doc_id"], r["n_tokens"], r["ids_crc32"]) for r in got) == want
    assert [r["start"] for r in got] == list(np.cumsum([0] + [r["n_tokens"] for r in got])[:-1])
    ids = [r["doc_id"] for r in got]
    assert ids == sorted(ids, key=lambda x: (x is not None, x))


def test_token_files_of_nothing(none):
    from logstrata.llm.tokenfile import read_token_files, write_token_files

    assert read_token_files(write_token_files(none)).count() == 0


class Opened(io.BytesIO):
    """Counts the bytes read."""

    taken = 0

    def read(self, n=-1):
        data = super().read(n)
        self.taken += len(data)
        return data


def test_reader_opens_only_the_frames_asked_for_and_checks_them():
    from logstrata.llm.tokenfile import TokenFileReader, TokenFileWriter

    r = random.Random(1)
    docs = [(i, np.array([r.randrange(50_000) for _ in range(r.choice([0, 1, 50, 900]))], "<u4").tobytes()) for i in range(400)] + [(None, b"\1\0\0\0")]
    out = io.BytesIO()
    writer = TokenFileWriter(out, frame_bytes=4096)
    for doc_id, ids in docs:
        writer.add(doc_id, ids)
    writer.finish()
    data = out.getvalue()
    assert list(TokenFileReader(io.BytesIO(data)).documents()) == docs
    source = Opened(data)
    reader = TokenFileReader(source)
    opened = source.taken
    assert list(reader.documents([7, 300])) == [docs[7], docs[300]]
    assert source.taken - opened < 20_000 < len(data) / 4
    broken = bytearray(data)
    broken[-12 * 3 - 9 + 8] ^= 1  # the checksum of a late frame
    with pytest.raises(ValueError):
        list(TokenFileReader(io.BytesIO(bytes(broken))).documents())


def test_pieces_match_the_library_and_fit(odd, odd_rows):
    from logstrata.llm.packing import pack_documents

    rows = pack_documents(odd).collect()
    want = Counter()
    for row in odd_rows:
        ids = library_ids("word_bpe_49k.json", row[1]) + [1]
        for n, at in enumerate(range(0, len(ids), 4096)):
            want[row[0], n, at, len(ids[at:at + 4096]), crc(ids[at:at + 4096])] += 1
    assert Counter(tuple(r)[:5] for r in rows) == want
    bins = {}
    for r in rows:
        bins.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for held in bins.values():
        at = 0
        for offset, length in sorted(held):
            assert offset == at
            at += length
        assert at <= 4096
    assert len(bins) == -(-sum(r["length"] for r in rows) // 4096)


def test_packing_of_nothing(none):
    from logstrata.llm.packing import pack_documents

    assert pack_documents(none).count() == 0


def fewest_bins(lengths, capacity):
    """Smallest number of bins, by trying all."""
    lengths = sorted(lengths, reverse=True)

    def fits(i, rooms):
        if i == len(lengths):
            return True
        for room in set(rooms):
            if room >= lengths[i]:
                rest = list(rooms)
                rest.remove(room)
                if fits(i + 1, rest + [room - lengths[i]]):
                    return True
        return False

    n = -(-sum(lengths) // capacity)
    while not fits(0, [capacity] * n):
        n += 1
    return n


def test_bin_completion_is_optimal_on_small_cases_and_never_worse_than_best_fit():
    from logstrata.llm.packing import BinCompletion, best_fit_decreasing, lower_bound

    r = random.Random(9)
    for trial in range(150):
        capacity = r.choice([10, 30, 100])
        lengths = [r.randint(1, capacity) for _ in range(r.randint(1, 11))]
        counts = dict(Counter(lengths))
        plan = BinCompletion(counts, capacity, branches=50).solve()
        assert Counter(n for bins, filling in plan for n in filling * bins) == Counter(lengths)
        assert all(sum(f) <= capacity for _, f in plan)
        used, best_fit = (sum(n for n, _ in p) for p in (plan, best_fit_decreasing(counts, capacity)))
        assert lower_bound(counts, capacity) <= fewest_bins(lengths, capacity) <= used <= best_fit
        if trial % 3 == 0:
            assert used <= fewest_bins(lengths, capacity) + 1
    many = dict(Counter(r.randint(1000, 3000) for _ in range(5000)))
    assert BinCompletion(many, 4096).solve() and sum(n for n, _ in BinCompletion(many, 4096).solve()) < sum(n for n, _ in best_fit_decreasing(many, 4096))


def test_bin_completion_finds_the_fewest_bins_with_its_defaults():
    """Among them a case in which the first perfect filling, and any filling alone of its waste, lead astray."""
    from logstrata.llm.packing import BinCompletion

    cases = [[2049, 1638] + [1229] * 6 + [818, 409]]
    r = random.Random(7)
    for _ in range(150):
        near = [round(4096 * x) + r.randint(-2, 2) for x in (0.5, 0.4, 0.3, 0.2, 0.1, 0.25, 0.35, 0.45, 0.15)]
        cases.append([r.choice(near) for _ in range(r.randint(6, 12))])
    for lengths in cases:
        search = BinCompletion(dict(Counter(lengths)), 4096)
        plan = search.solve()
        assert Counter(n for bins, filling in plan for n in filling * bins) == Counter(lengths)
        assert search.proved and sum(n for n, _ in plan) == fewest_bins(lengths, 4096)
    ones = {1: 9000, 1365: 3, 1366: 3, 1367: 3}  # thousands of pieces in a bin
    assert sum(n for n, _ in BinCompletion(ones, 4096).solve()) == -(-(9000 + 3 * 4098) // 4096)


def test_ranks_of_a_length_in_salted_groups(spark):
    """A length that a third of all rows have, in many groups: places stay distinct."""
    from logstrata.llm import packing

    rows = spark.range(3000).select(F.col("id").alias("doc_id"), F.lit(0).alias("piece"), F.when(F.col("id") % 3 == 0, 700).otherwise(1 + F.col("id") % 900).cast("long").alias("length"))
    kept, packing.SALT_ROWS = packing.SALT_ROWS, 100
    try:
        got = packing.pack(rows).toPandas()
    finally:
        packing.SALT_ROWS = kept
    assert len(got) == 3000 and not got.duplicated(["sequence_id", "offset"]).any()
    got = got.sort_values(["sequence_id", "offset"])
    assert ((got.groupby("sequence_id").length.cumsum() - got.length) == got.offset).all()
    assert (got.groupby("sequence_id").length.sum() <= 4096).all()


def test_shards_are_even_and_hold_every_record(odd, odd_rows, none):
    from logstrata.llm.sharding import external_shuffle

    out = external_shuffle(odd, shards=3, bucket_bytes=10_000)
    rows = out.collect()
    assert "score" in out.columns and out.columns.count("shard") == 1
    assert Counter((r["doc_id"], r["text"]) for r in rows) == Counter((r[0], r[1]) for r in odd_rows)
    sizes = Counter(r["shard"] for r in rows)
    assert max(sizes.values()) - min(sizes.values()) <= 1
    for shard, n in sizes.items():
        assert sorted(r["slot"] for r in rows if r["shard"] == shard) == list(range(n))
    assert external_shuffle(none).count() == 0


def test_shuffle_depends_on_the_seed_alone(spark):
    from logstrata.llm.sharding import external_shuffle

    df = spark.range(500).select(F.col("id").alias("doc_id"), F.concat(F.lit("text "), F.col("id")).alias("text"))
    orders = [
        [r["doc_id"] for r in external_shuffle(d, seed=s, bucket_bytes=1000).orderBy("shard", "slot").collect()]
        for d, s in ((df, 1), (df.repartition(7), 1), (df, 2))
    ]
    assert orders[0] == orders[1] != orders[2] and orders[0] != sorted(orders[0])
