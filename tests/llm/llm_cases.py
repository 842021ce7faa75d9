import random

import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
SYLLABLES = ["ba", "ke", "lo", "mi", "nu", "ra", "se", "ti", "vo", "zu"]


def prose(seed: int, words: int) -> str:
    r = random.Random(seed)
    return " ".join("".join(r.choice(SYLLABLES) for _ in range(r.randint(1, 4))) for _ in range(words))


@pytest.fixture(scope="session")
def odd_rows():
    """Null and empty texts, null ids, copies, near copies, shared passages, blanks in a row, one very long text."""
    base, passage = prose(1, 120), prose(2, 60)
    near = base.split()
    near[60] = "other"
    rows = [(1, base), (2, base), (3, " ".join(near)), (4, base.upper()), (5, None), (6, ""), (7, " \t\n "), (8, "one two three"),
            (9, "One  two\tthree"), (None, base), (None, None), (10, prose(3, 50) + "\n" + passage), (11, passage + "\n" + prose(4, 50)),
            (12, prose(5, 30)), (12, prose(5, 30)), (13, "é" * 300 + " ñandú  日本語 🙂\x85x"), (14, "a" * 30_000 + " " + prose(6, 4000)),
            (15, "<|endoftext|> is plain <|startoftext|>"), (16, "12345 !!! ---"), (17, "word " * 200)]
    return [(i, t, "xx", f"s{(i or 0) % 3}", len(t or "")) for i, t in rows]


@pytest.fixture(scope="session")
def odd(spark, odd_rows):
    """The odd rows with further columns that clash with names the operators add or use."""
    from pyspark.sql import functions as F

    df = spark.createDataFrame(odd_rows, DOCS)
    for name in ("n_words", "kept", "n_lines", "shard", "slot", "score", "component", "a", "b", "doc", "id", "label", "piece", "start"):
        df = df.withColumn(name, F.lit("clash"))
    return df.repartition(3)


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], DOCS)
