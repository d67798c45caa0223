"""Removal of lines that spread over many sites.

Lines are compared by the hash of their trimmed text (two 64-bit hashes). A HyperLogLog
sketch of the sites is built per hash; sketches merge in the shuffle's partial aggregation,
so a line on a third of all pages is one row per task. Lines whose estimate is near the
threshold get an exact distinct count. A boilerplate line stays where it comes first (smallest
id, then place) and goes elsewhere.

Blank lines and lines of fewer than `min_words` words are never removed. NULL sites do not
count as sites; NULL texts stay NULL; a text all of whose lines go becomes empty. Rows with
the same id and text are treated alike; all other columns are kept.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rivulet.llm.tables import documents, settle

MIN_SITES = 12
MIN_WORDS = 3
#: relative standard error of a sketch with 2^10 registers is about 3.3 %
SKETCH_BITS = 10
MARGIN = 0.1
#: names that cannot clash with a table's own columns
ID, HASH, GONE, LINES = "__id", "__hash", "__gone", "__lines"


def _words(line: Column) -> Column:
    return F.size(F.split(line, r"\s+"))


def line_rows(rows: DataFrame, text: str, site: str, id: str, min_words: int) -> DataFrame:
    """(id, hash, place, site, h1, h2) for each line that may be removed; id and hash tell texts apart."""
    lines = rows.select(
        F.col(id).alias("id"), F.xxhash64(text).alias("hash"), F.col(site).alias("site"), F.posexplode(F.split(text, "\n", -1)).alias("place", "line")
    ).withColumn("line", F.trim("line"))
    kept = lines.where((F.col("line") != "") & (_words(F.col("line")) >= min_words))
    return kept.select("id", "hash", "place", "site", F.xxhash64("line").alias("h1"), F.xxhash64(F.lit(1), "line").alias("h2"))


def spread_lines(lines: DataFrame, min_sites: int, margin: float = MARGIN) -> DataFrame:
    """(h1, h2, first): lines on at least `min_sites` sites and where each comes first."""
    first = F.min(F.struct(F.col("id").isNull().alias("none"), "id", "hash", "place")).alias("first")
    sketch = F.hll_sketch_estimate(F.hll_sketch_agg("site", F.lit(SKETCH_BITS))).alias("sites")
    seen = lines.groupBy("h1", "h2").agg(sketch, first, F.count("site").alias("n"))
    likely = settle(seen.where((F.col("n") >= min_sites) & (F.col("sites") >= min_sites * (1 - margin))).drop("n"), "spread")
    sure = likely.where(F.col("sites") > min_sites * (1 + margin)).select("h1", "h2", "first")
    near = likely.where(F.col("sites") <= min_sites * (1 + margin)).select("h1", "h2", "first")
    counted = (
        lines.join(near.select("h1", "h2"), ["h1", "h2"], "left_semi")
        .where("site IS NOT NULL")
        .select("h1", "h2", "site")
        .distinct()
        .groupBy("h1", "h2")
        .count()
        .where(F.col("count") >= min_sites)
    )
    return settle(sure.unionByName(near.join(counted.select("h1", "h2"), ["h1", "h2"], "left_semi")), "boilerplate")


def line_dedup(
    df: DataFrame,
    text: str = "text",
    site: str = "source",
    id: str = "doc_id",
    min_sites: int = MIN_SITES,
    min_words: int = MIN_WORDS,
    removed: str = "n_removed_lines",
) -> DataFrame:
    """The same rows with boilerplate lines taken out of the text, and their number in `removed`."""
    lines = line_rows(df, text, site, id, min_words)
    boilerplate = spread_lines(lines, min_sites)
    here = F.col("id").eqNullSafe(F.col("first.id")) & (F.col("hash") == F.col("first.hash")) & (F.col("place") == F.col("first.place"))
    gone = (
        lines.join(boilerplate, ["h1", "h2"])
        .where(~here)
        .groupBy(F.col("id").alias(ID), F.col("hash").alias(HASH))
        .agg(F.collect_set("place").alias(GONE))
    )
    joined = df.join(gone, F.col(ID).eqNullSafe(df[id]) & (F.col(HASH) == F.xxhash64(df[text])), "left")
    joined = joined.withColumn(LINES, F.when(F.col(GONE).isNotNull(), F.split(text, "\n", -1)))
    places = F.sequence(F.lit(0), F.size(LINES) - 1)
    kept = F.transform(F.array_except(places, GONE), lambda i: F.get(LINES, i))
    cut = F.when(F.col(GONE).isNull(), F.col(text)).otherwise(F.array_join(kept, "\n"))
    count = F.when(F.col(GONE).isNull(), 0).otherwise(F.size(GONE)).cast("long")
    return joined.withColumns({text: cut, removed: count}).drop(ID, HASH, GONE, LINES)


def line_dedup_report(spark, sf_dir: str) -> DataFrame:
    """doc_id, the lines removed, and the text that is left."""
    return line_dedup(documents(spark, sf_dir)).select("doc_id", "n_removed_lines", "text")


ORACLE = f"""
WITH lines AS (
    SELECT doc_id, source, unnest(string_split(text, chr(10))) AS line,
           unnest(range(1, 1 + len(string_split(text, chr(10))))) AS place FROM documents),
keyed AS (SELECT *, trim(line, ' ') AS k FROM lines),
bad AS (SELECT k, min((doc_id, place)) AS first FROM keyed
        WHERE k <> '' AND len(regexp_split_to_array(k, '\\s+')) >= {MIN_WORDS}
        GROUP BY k HAVING count(DISTINCT source) >= {MIN_SITES}),
marked AS (SELECT keyed.*, bad.k IS NOT NULL AND (doc_id, place) <> first AS gone FROM keyed LEFT JOIN bad USING (k)),
cut AS (SELECT doc_id, count(*) FILTER (gone) AS n, string_agg(line, chr(10) ORDER BY place) FILTER (NOT gone) AS t FROM marked GROUP BY doc_id)
SELECT d.doc_id, coalesce(n, 0) AS n_removed_lines, CASE WHEN d.text IS NOT NULL THEN coalesce(t, '') END AS text
FROM documents d LEFT JOIN cut USING (doc_id)"""
