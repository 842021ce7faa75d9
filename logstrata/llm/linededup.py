"""Operator 6: line dedup by the spread of each line over distinct sites, in DataFrame functions only.

One HyperLogLog sketch of sites is kept per line hash and merged by
aggregation.  Lines whose estimate is clear of the threshold are decided by
it; the others get an exact count of distinct sites.  Of the lines that spread
over enough sites those are boilerplate that stand, on as many sites or on
most of theirs, in documents of which such lines are the lesser part: a line
that spreads with whole copies of its document alone is a copy, and copies are
not this operator's work.  Boilerplate leaves every document, short pages too.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from logstrata.llm.common import table, written

#: A line on so many distinct sites is boilerplate.
MIN_SITES = 8
LG_K = 12
_SIGMAS = 5
_RSE = 1.04 / (1 << LG_K // 2)


def _lines(text: str) -> F.Column:
    return F.split(F.col(text), "\n", -1)


def _bare(line: F.Column) -> F.Column:
    return F.btrim(line, F.lit(" \t\r"))


def _key(line: F.Column) -> F.Column:
    """96 bits of hash of a trimmed line."""
    return F.struct(F.xxhash64(line).alias("h"), F.hash(line).alias("g"))


def spread_lines(docs: DataFrame, text_col: str = "text", site_col: str = "source", min_sites: int = MIN_SITES) -> DataFrame:
    """Keys (struct h, g) of the lines that stand on at least ``min_sites`` distinct sites.

    Lines are compared without outer blanks, tabs and carriage returns; blank
    lines and null sites do not count.  A line on a third of all documents is
    one partial sketch per task before the shuffle.
    """
    line = docs.where(F.col(site_col).isNotNull()).select(F.col(site_col).cast("string").alias("site"), F.explode(_lines(text_col)).alias("line"))
    line = line.select("site", _bare(F.col("line")).alias("line")).where("line <> ''").select(_key(F.col("line")).alias("key"), "site")
    spread = line.groupBy("key").agg(F.hll_sketch_agg("site", F.lit(LG_K)).alias("sketch"))
    margin = max(1, round(_SIGMAS * _RSE * min_sites + 0.5))
    spread = spread.select("key", F.hll_sketch_estimate("sketch").alias("sites")).where(F.col("sites") >= min_sites - margin)
    spread = written(spread, "line-spread")  # the few lines that may be spread widely
    clear = spread.where(F.col("sites") > min_sites + margin).select("key")
    near = spread.where(F.col("sites") <= min_sites + margin).select("key")
    exact = line.join(near, "key", "left_semi").groupBy("key").agg(F.count_distinct("site").alias("sites"))
    # Written, so that a join with it shuffles both sides and a line on very many documents can be split.
    return written(clear.union(exact.where(F.col("sites") >= min_sites).select("key")), "spread-lines")


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", site_col: str = "source", min_sites: int = MIN_SITES) -> DataFrame:
    """All columns of ``docs``, the text without boilerplate lines, and n_lines and n_removed (long).

    Input columns named n_lines or n_removed (or beginning with ``__``) are
    replaced.  A text that would have nothing left but blanks stays as it is.
    Null text stays null with no lines; empty text is one blank line.  Rows
    are neither dropped nor merged.
    """
    kept = [c for c in docs.columns if c not in ("n_lines", "n_removed") and not c.startswith("__")]
    # A collision of row keys only unites two rows' sets of lines that are boilerplate anyway.
    row = F.xxhash64(F.col(id_col), F.col(text_col)).alias("__row")
    common = _boilerplate(docs.select(row, text_col, site_col), text_col, site_col, spread_lines(docs, text_col, site_col, min_sites), min_sites)
    rows = docs.select(*kept, row).join(common, "__row", "left").withColumn("__lines", _lines(text_col))

    def is_common(x: F.Column) -> F.Column:
        return F.coalesce(F.array_contains("__common", _key(_bare(x))), F.lit(False)) & (_bare(x) != "")

    rows = rows.withColumn("__found", F.when(F.col("__common").isNotNull(), F.filter("__lines", is_common)))
    rows = rows.withColumn("__cut", F.coalesce(_chars(F.col("__found")) < _chars(F.col("__lines")), F.lit(False)))
    text = F.when(F.col("__cut"), F.array_join(F.filter("__lines", lambda x: ~is_common(x)), "\n")).otherwise(F.col(text_col))
    n_removed = F.when(F.col("__cut"), F.size("__found")).otherwise(0).cast("long")
    n_lines = F.when(F.col(text_col).isNull(), 0).otherwise(F.size("__lines")).cast("long")
    return rows.select(*[text.alias(c) if c == text_col else F.col(c) for c in kept], n_lines.alias("n_lines"), n_removed.alias("n_removed"))


def _chars(lines: F.Column) -> F.Column:
    return F.aggregate(lines, F.lit(0).cast("long"), lambda n, x: n + F.length(_bare(x)))


def _boilerplate(rows: DataFrame, text_col: str, site_col: str, spread: DataFrame, min_sites: int) -> DataFrame:
    """For each __row the keys (__common) of its boilerplate lines, if any."""
    line = rows.select("__row", F.explode(_lines(text_col)).alias("line")).select("__row", _bare(F.col("line")).alias("line"))
    line = line.where("line <> ''").select("__row", _key(F.col("line")).alias("key"), F.length("line").alias("n"))
    part = line.join(spread, "key").groupBy("__row").agg(F.collect_set("key").alias("__common"), F.sum("n").alias("n"))
    # Rows that repeat an id and text are summed on both sides.
    whole = rows.groupBy("__row").agg(F.sum(_chars(_lines(text_col))).alias("whole"))
    part = part.join(whole, "__row").select("__row", "__common", (F.col("n") * 2 <= F.col("whole")).alias("lesser"))
    part = written(part, "line-shares")
    stands = part.select("__row", F.explode("__common").alias("key"), F.col("lesser").cast("int").alias("lesser"))
    stands = stands.join(rows.select("__row", F.col(site_col).cast("string").alias("site")), "__row").where("site IS NOT NULL")
    sites = stands.groupBy("key", "site").agg(F.max("lesser").alias("lesser")).groupBy("key").agg(F.sum("lesser").alias("lesser"), F.count("*").alias("all"))
    sure = written(sites.where((F.col("lesser") >= min_sites) | (F.col("lesser") * 2 > F.col("all"))).select("key"), "boilerplate")
    return part.select("__row", F.explode("__common").alias("key")).join(sure, "key").groupBy("__row").agg(F.collect_set("key").alias("__common"))


def op6_line_spread(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = dedup_lines(table(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_lines", "n_removed", F.sha2(F.col("text"), 256).alias("kept_sha256"))


OP6_SQL = f"""
WITH line AS (
    SELECT doc_id, source, trim(raw, ' ' || chr(9) || chr(13)) AS line, raw, place
    FROM (SELECT doc_id, source, unnest(string_split(text, chr(10))) AS raw,
                 generate_subscripts(string_split(text, chr(10)), 1) AS place FROM documents WHERE text IS NOT NULL)
), spread AS (
    SELECT line FROM line WHERE line <> '' GROUP BY line HAVING count(DISTINCT source) >= {MIN_SITES}
), share AS (
    SELECT doc_id, 2 * sum(CASE WHEN s.line IS NOT NULL THEN length(l.line) ELSE 0 END) <= sum(length(l.line)) AS lesser
    FROM line l LEFT JOIN spread s ON l.line = s.line GROUP BY doc_id
), common AS (
    SELECT line FROM line JOIN spread USING (line) JOIN share USING (doc_id) GROUP BY line
    HAVING count(DISTINCT source) FILTER (lesser) >= {MIN_SITES} OR 2 * count(DISTINCT source) FILTER (lesser) > count(DISTINCT source)
), marked AS (
    SELECT l.*, c.line IS NOT NULL AS is_common FROM line l LEFT JOIN common c ON l.line = c.line
), per AS (
    SELECT doc_id, count(*) AS n_lines, count(*) FILTER (is_common) AS n_common,
           count(*) FILTER (is_common) > 0 AND sum(CASE WHEN is_common THEN length(line) ELSE 0 END) < sum(length(line)) AS cut,
           string_agg(raw, chr(10) ORDER BY place) AS whole,
           coalesce(string_agg(raw, chr(10) ORDER BY place) FILTER (NOT is_common), '') AS kept
    FROM marked GROUP BY doc_id
)
SELECT d.doc_id, coalesce(n_lines, 0)::BIGINT AS n_lines, (CASE WHEN cut THEN n_common ELSE 0 END)::BIGINT AS n_removed,
       sha256(CASE WHEN cut THEN kept ELSE whole END) AS kept_sha256
FROM documents d LEFT JOIN per USING (doc_id)
"""
