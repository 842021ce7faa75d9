"""A corpus pipeline of five stages, each written as Parquet and read again by the next.

Null columns, empty texts, repeated rows, empty tables and further columns
are defined by the operators' docstrings; every stage but the last returns the
columns it was given.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from logstrata.llm.common import Scratch, ship_package, table, written
from logstrata.llm.jaccard import near_duplicate_groups
from logstrata.llm.langid import fits, identify, train
from logstrata.llm.linededup import dedup_lines
from logstrata.llm.packing import pack_documents
from logstrata.llm.substring import remove_repeats

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

def _with_text(docs: DataFrame, text: F.Column, columns: list[str]) -> DataFrame:
    """``columns`` with the text replaced and n_chars, if there, counted anew."""
    docs = docs.withColumn("text", text)
    return docs.select(*[F.length("text").cast("long").alias(c) if c == "n_chars" else c for c in columns])


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without text or letters go, and those that no learned language fits; a missing lang is filled in."""
    ship_package(spark)
    trees = train(docs)
    if not trees.languages:  # nothing to judge by: only texts without a letter go
        return docs.where(F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False)))
    found = identify(docs, trees, prefix="__")
    found = found.where(fits(trees, prefix="__"))
    return found.select(*[F.coalesce("lang", "__lang_pred").alias(c) if c == "lang" else c for c in docs.columns])


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that stand on many sites leave the texts, short pages too; whole copies are left to the next stage."""
    return _with_text(dedup_lines(docs), F.col("text"), docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates the document with the smallest id stays.

    Rows that repeat an id and its text are one document.  Documents without
    id stay: they link with nothing.
    """
    ship_package(spark)
    groups = near_duplicate_groups(docs)
    gone = written(groups.where(F.col("doc_id") != F.col("component_id")).select("doc_id").distinct(), "gone")
    again = written(groups.where("doc_id IS NOT NULL").groupBy("doc_id").count().where("count > 1").select("doc_id"), "again")
    # Spark broadcasts these tables of ids only while their files are small.
    left = docs.join(gone, "doc_id", "left_anti")
    once = left.join(again, "doc_id", "left_anti")
    if not again.isEmpty():
        once = once.union(left.join(again, "doc_id", "left_semi").dropDuplicates(["doc_id", "text"]))
    return once.select(*docs.columns)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Words of repeated windows leave the texts; a text with nothing repeated stays as it is."""
    ship_package(spark)
    left = remove_repeats(docs)
    return _with_text(left, F.when(F.col("n_removed") > 0, F.col("kept")).otherwise(F.col("text")), docs.columns)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents with their place in sequences of 4096 ids."""
    ship_package(spark)
    return pack_documents(docs)


STAGES: list[tuple[str, Stage]] = [
    ("language ID", language_id),
    ("line dedup", line_dedup),
    ("n-gram Jaccard join", near_duplicates),
    ("substring dedup", substring_dedup),
    ("best-fit packing", packing),
]

#: Language ID and packing have no SQL form; tests hold run() against a brute-force version.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``: what the last one returns.  A stage's table is removed when the next one is written."""
    docs, tables = table(spark, sf_dir, "documents"), Scratch(spark)
    for name, stage in STAGES:
        docs = tables.written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
        tables.clear(keep=1)
    return docs
