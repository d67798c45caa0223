"""Reading, writing and linking that several operators share."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rivulet.session import fresh_dir


def settle(df: DataFrame, name: str) -> DataFrame:
    """Writes to a new table in the shared folder and reads it back: cuts lineage, survives lost executors."""
    path = fresh_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def byte_total(df: DataFrame, text: str) -> int:
    """Bytes in all texts."""
    return df.agg(F.coalesce(F.sum(F.octet_length(text)), F.lit(0)).alias("n")).first()["n"]


def parts(total: float, each: float, least: int = 1) -> int:
    """How many parts of size `each` the total makes."""
    return max(least, math.ceil(total / each))


def spread(key: str | Column, n: int) -> Column:
    """Bucket 0 to n - 1 from a key's hash."""
    return F.pmod(F.xxhash64(key), F.lit(n)).cast("int")


def component_labels(edges: DataFrame, a: str, b: str) -> DataFrame:
    """(node, label): the smallest node reachable over the edges, for each node that has one.

    Each round takes the smallest label among the neighbours, then the label of the label;
    it ends when no label changed. Labels live in written tables, so both sides of every
    join are plain shuffles that adaptive execution splits where one node has many edges.
    """
    ways = F.array(F.struct(F.col(a).alias("x"), F.col(b).alias("y")), F.struct(F.col(b).alias("x"), F.col(a).alias("y")))
    both = settle(edges.where(F.col(a) != F.col(b)).select(F.inline(ways)).distinct(), "links")
    labels = settle(both.groupBy(F.col("x").alias("node")).agg(F.least(F.min("y"), F.col("node")).alias("label")), "labels")
    last = None
    while True:
        now = labels.agg(F.sum(F.col("label").cast("decimal(38,0)")).alias("s")).first()["s"]
        if now == last or now is None:
            return labels
        last = now
        told = both.join(labels, F.col("x") == F.col("node")).select(F.col("y").alias("node"), "label")
        near = settle(told.unionByName(labels).groupBy("node").agg(F.min("label").alias("label")), "labels")
        above = near.select(F.col("node").alias("at"), F.col("label").alias("up"))
        labels = settle(near.join(above, F.col("label") == F.col("at")).select("node", F.col("up").alias("label")), "labels")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")
