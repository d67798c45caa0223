"""Documents through a chain of operators, each stage written as Parquet and read again.

Each stage takes (spark, docs, sf_dir) and works on all rows its predecessor kept:

1. language: rows whose text has no language (`und`) or a score below LEAST_SCORE go.
2. lines: boilerplate lines that spread over many sources leave the texts; rows stay, but for
   those that had nothing else.
3. near_copies: of documents linked by a five-word-shingle similarity of 0.8, directly or over
   others, the one with the smallest id stays.
4. leaks: documents that hold a benchmark passage go.
5. pieces: adds the piece ids of each text and whether decoding them gives it back.

All but the last return the columns of documents. Rows with a NULL id have no near copies.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rivulet.llm import jaccard, language, leaks, linededup, pieces
from rivulet.llm.tables import settle

LEAST_SCORE = 0.25
SHINGLE_WORDS = 5
SIMILARITY = "0.8"


def keep_known_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = language.fit(docs)
    return language.keep(docs, model, LEAST_SCORE)


def drop_spread_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    cut = linededup.line_dedup(docs, removed="__removed")
    emptied = (F.col("__removed") > 0) & (F.trim("text") == "")
    return cut.where(~F.coalesce(emptied, F.lit(False))).withColumn("n_chars", F.char_length("text").cast("long")).select(docs.columns)


def keep_one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    groups = jaccard.similar_components(docs.select("doc_id", "text"), n=SHINGLE_WORDS, threshold=SIMILARITY)
    gone = groups.where("component != id").select(F.col("id").alias("doc_id")).distinct()
    return docs.join(gone, "doc_id", "left_anti").select(docs.columns)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return leaks.without_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def add_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pieces.add_pieces(docs)


STAGES = [
    ("language", keep_known_languages),
    ("lines", drop_spread_lines),
    ("near_copies", keep_one_of_each_group),
    ("leaks", drop_leaks),
    ("pieces", add_pieces),
]

#: fitted and edit-bounded stages have no SQL form; tests hold each stage against brute force
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of sf_dir."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = settle(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
