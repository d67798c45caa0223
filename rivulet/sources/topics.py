"""Topics (S06-S08, T16): the broker's options, and log tables with the same columns.

A log table has ``topic, partition, offset, timestamp, key, value``. Everything past
the read works on either.
"""

from __future__ import annotations

import json
from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

LOG_SCHEMA = T.StructType(
    [
        T.StructField("topic", T.StringType()),
        T.StructField("partition", T.IntegerType()),
        T.StructField("offset", T.LongType()),
        T.StructField("timestamp", T.TimestampType()),
        T.StructField("key", T.StringType()),
        T.StructField("value", T.StringType()),
    ]
)

Start = str | Mapping[str, Mapping[int, int]]


def parse_offsets(text: str, topic: str) -> dict[str, dict[int, int]]:
    """``partition:0,offset:42;partition:1,offset:300`` as ``{topic: {0: 42, 1: 300}}``."""
    start: dict[int, int] = {}
    for item in filter(None, text.split(";")):
        fields = dict(pair.split(":") for pair in item.split(","))
        start[int(fields["partition"])] = int(fields["offset"])
    return {topic: start}


def kafka_options(
    servers: str, topics: Iterable[str] = (), pattern: str | None = None, start: Start = "latest"
) -> dict[str, str]:
    """Options of Spark's Kafka source for a topic list or a name pattern."""
    topics = list(topics)
    if bool(topics) == bool(pattern):
        raise ValueError("give either topics or a pattern")
    chosen = {"subscribePattern": pattern} if pattern else {"subscribe": ",".join(topics)}
    if isinstance(start, str):
        position = start
    else:
        position = json.dumps({t: {str(p): o for p, o in parts.items()} for t, parts in start.items()})
    return {"kafka.bootstrap.servers": servers, **chosen, "startingOffsets": position}


def subscribe(spark: SparkSession, options: Mapping[str, str]) -> DataFrame:
    """Topic stream with text key and value. Needs Spark's Kafka package on the cluster."""
    raw = spark.readStream.format("kafka").options(**options).load()
    return raw.select(
        "topic", "partition", "offset", "timestamp", F.col("key").cast("string"), F.col("value").cast("string")
    )


def log_table(spark: SparkSession, path: str, stream: bool = False) -> DataFrame:
    """A parquet log table as a table or a stream."""
    return (spark.readStream if stream else spark.read).schema(LOG_SCHEMA).parquet(path)


def of_topics(log: DataFrame, topics: Iterable[str] = (), pattern: str | None = None) -> DataFrame:
    """Rows of the subscribed topics; a pattern must match the whole name."""
    if pattern is not None:
        return log.where(F.col("topic").rlike(f"^(?:{pattern})$"))
    return log.where(F.col("topic").isin(list(topics)))


def from_position(log: DataFrame, start: Mapping[str, Mapping[int, int]]) -> DataFrame:
    """Rows from given offsets on; partitions without one are read from the earliest."""
    keep: Column = F.lit(True)
    for topic, parts in start.items():
        for partition, offset in parts.items():
            here = (F.col("topic") == topic) & (F.col("partition") == partition)
            keep = keep & (~here | (F.col("offset") >= offset))
    return log.where(keep)


def next_positions(log: DataFrame) -> DataFrame:
    """Where to go on reading: one past the highest offset of each partition."""
    return log.groupBy("topic", "partition").agg((F.max("offset") + 1).alias("next_offset"))
