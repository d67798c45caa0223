"""Running a stream over the files there are, and its common sinks."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rivulet.session import fresh_dir
from rivulet.sinks.ledger import BatchLedger

BatchSink = Callable[[DataFrame, int], None]

# Fixed cadences of the standing jobs.
MICRO_BATCH = {"processingTime": "5 seconds"}
FAST = {"processingTime": "300 milliseconds"}


def skipping_empty(sink: BatchSink) -> BatchSink:
    """Sink that leaves out batches without rows."""

    def write(df: DataFrame, batch_id: int) -> None:
        if not df.isEmpty():
            sink(df, batch_id)

    return write


def drain(df: DataFrame, sink: BatchSink, mode: str, checkpoint: str) -> None:
    """Process everything available now, batch by batch, and stop.

    Offsets and state stay in the checkpoint, so a later run goes on from there.
    """
    query = (
        df.writeStream.foreachBatch(sink)
        .outputMode(mode)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def start(df: DataFrame, sink: BatchSink, mode: str, checkpoint: str, trigger: dict[str, str] | None = None):
    """Start a standing job at a fixed cadence."""
    return (
        df.writeStream.foreachBatch(sink)
        .outputMode(mode)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or MICRO_BATCH))
        .start()
    )


def drained(df: DataFrame, mode: str, name: str) -> DataFrame:
    """All batches of a stream's output with their ``batch_id``, through an effective-once sink."""
    spark = df.sparkSession
    root = fresh_dir(spark, name)
    plain = T.StructType([T.StructField(f.name, f.dataType) for f in df.schema])
    ledger = BatchLedger(spark, f"{root}/out", plain)
    drain(df, ledger.write, mode, f"{root}/checkpoint")
    return ledger.read()


def latest_updates(emitted: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Final row per key of an update-mode output: the one from the last batch."""
    others = [c for c in emitted.columns if c not in keys and c != "batch_id"]
    last = emitted.groupBy(*keys).agg(F.max_by(F.struct(*others), "batch_id").alias("_last"))
    return last.select(*keys, "_last.*")


def counts_per_batch(key: str, ledger: BatchLedger) -> BatchSink:
    """Counts of one batch only, nothing carried over."""

    def write(df: DataFrame, batch_id: int) -> None:
        ledger.write(df.groupBy(key).agg(F.count("*").alias("n")), batch_id)

    return skipping_empty(write)


def running_counts(df: DataFrame, key: str | Column) -> DataFrame:
    """Counts carried across batches; sort the snapshot in complete mode."""
    return df.groupBy(key).agg(F.count("*").alias("n"))


def table_stream(spark: SparkSession, sf_dir: str, name: str, files_per_batch: int | None = None, bytes_per_batch: int = 256 << 30) -> DataFrame:
    """A table's files as a stream, oldest first; a micro-batch holds about ``bytes_per_batch``, or so many files."""
    schema = spark.read.parquet(f"{sf_dir}/{name}.parquet").schema
    # A pattern, as a stream's plain path must be a directory and a table may be one file.
    path = f"{sf_dir}/{name}.parque[t]"
    limit = ("maxBytesPerTrigger", bytes_per_batch) if files_per_batch is None else ("maxFilesPerTrigger", files_per_batch)
    return spark.readStream.schema(schema).option(*limit).parquet(path)
