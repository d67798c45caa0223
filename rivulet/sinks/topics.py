"""Rows for topics."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

# Fixed settings of the once-only producer.
PRODUCER = {"kafka.acks": "all", "kafka.retries": "3"}


def json_records(df: DataFrame, topic: str | None = None) -> DataFrame:
    """Each row as one JSON text ``value``, with a topic column if given."""
    value = F.to_json(F.struct("*")).alias("value")
    return df.select(F.lit(topic).alias("topic"), value) if topic else df.select(value)


def routed_records(lines: DataFrame, line: str = "value") -> DataFrame:
    """Per-record topic: first comma field the topic, second the key, whole line the value."""
    fields = F.split(line, ",")
    return lines.select(
        F.get(fields, F.lit(0)).alias("topic"), F.get(fields, F.lit(1)).alias("key"), F.col(line).alias("value")
    )


def kafka_writer(records: DataFrame, servers: str, checkpoint: str, topic: str | None = None) -> DataStreamWriter:
    """Topic stream sink; records without a ``topic`` column go to the one given."""
    options: Mapping[str, str] = {"kafka.bootstrap.servers": servers, **PRODUCER}
    writer = records.writeStream.format("kafka").options(**options).option("checkpointLocation", checkpoint)
    return writer.option("topic", topic) if topic else writer


def console_writer(df: DataFrame, mode: str = "append", prefix: Column | str | None = None) -> DataStreamWriter:
    """Print a stream; end points put a text in front of each value."""
    rows = df if prefix is None else prefixed(df, prefix)
    return rows.writeStream.format("console").outputMode(mode).option("truncate", "false")


def prefixed(df: DataFrame, prefix: Column | str, value: str = "value") -> DataFrame:
    text = F.lit(prefix) if isinstance(prefix, str) else prefix
    return df.withColumn(value, F.concat(text, F.col(value)))
