"""File sinks.

Before a partitioned write the rows are rebalanced on the partition columns. That
groups small partitions into few files while adaptive execution splits a partition
that holds much of the data over several tasks.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from rivulet.sinks import paths

MAX_FILE_ROWS = 5_000_000
SUCCESS = "_SUCCESS"
#: directory of the rows without a partition value
NO_VALUE = "__HIVE_DEFAULT_PARTITION__"

# Fixed codecs of the file formats.
CODECS = {"orc": "zlib", "parquet": "snappy"}


def partitioned(
    df: DataFrame, path: str, by: Sequence[str], fmt: str = "parquet", mode: str = "append",
    max_rows: int = MAX_FILE_ROWS,
) -> None:
    """Files below ``by[0]=../by[1]=..``; ORC with ZLIB, parquet with Snappy."""
    rows = df.hint("rebalance", *by) if by else df
    writer = rows.write.mode(mode).format(fmt).option("maxRecordsPerFile", max_rows)
    if fmt in CODECS:
        writer = writer.option("compression", CODECS[fmt])
    (writer.partitionBy(*by) if by else writer).save(path)


def replace_partitions(df: DataFrame, path: str, by: Sequence[str], fmt: str = "parquet") -> None:
    """Replace only the partitions that ``df`` has rows for."""
    rows = df.hint("rebalance", *by)
    (
        rows.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("maxRecordsPerFile", MAX_FILE_ROWS)
        .partitionBy(*by)
        .format(fmt)
        .save(path)
    )


def with_clock_day(df: DataFrame, clock: Column | None = None, into: str = "c_date") -> DataFrame:
    """Day of the writer's clock, not of the record."""
    return df.withColumn(into, F.date_format(F.current_timestamp() if clock is None else clock, "yyyy-MM-dd"))


def with_day_and_hour(df: DataFrame, time: Column, day: str = "yyyy-MM-dd") -> DataFrame:
    return df.withColumns({"dt": F.date_format(time, day), "h": F.date_format(time, "HH")})


def day_bucket_stream(df: DataFrame, path: str, checkpoint: str, clock: Column | None = None) -> DataStreamWriter:
    """Streaming ORC sink below ``c_date=yyyy-MM-dd``."""
    return (
        with_clock_day(df, clock)
        .writeStream.format("orc")
        .option("path", path)
        .option("compression", CODECS["orc"])
        .option("maxRecordsPerFile", MAX_FILE_ROWS)
        .option("checkpointLocation", checkpoint)
        .partitionBy("c_date")
        .outputMode("append")
    )


def parquet_stream(df: DataFrame, path: str, checkpoint: str) -> DataStreamWriter:
    """Streaming parquet sink; a batch's files count once the batch is in the sink's log."""
    return (
        df.writeStream.format("parquet")
        .option("path", path)
        .option("compression", CODECS["parquet"])
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
    )


def committing_partitions(
    path: str, by: Sequence[str], fmt: str = "orc", finished: Callable[[DataFrame], DataFrame] | None = None
) -> Callable[[DataFrame, int], None]:
    """Sink that puts a ``_SUCCESS`` marker in each partition a batch finished.

    Files go below ``by../batch_id=<n>``, so a replayed batch replaces its own files
    and no others. ``finished`` takes the batch and tells the partitions that are complete
    with it; by default those it touched. Markers are set last, by tasks; setting one again changes nothing.
    """

    def write(df: DataFrame, batch_id: int) -> None:
        replace_partitions(df.withColumn("batch_id", F.lit(batch_id)), path, [*by, "batch_id"], fmt)
        # The batch itself tells its partitions: nothing stored is listed or read.
        done = (finished(df) if finished else df).select(*by).distinct()
        names = [F.concat(F.lit(f"{c}="), F.coalesce(F.col(c).cast("string"), F.lit(NO_VALUE))) for c in by]
        paths.touch_each(done.select(F.concat_ws("/", *names, F.lit(SUCCESS)).alias("file")), path)

    return write


def committed_partitions(spark: SparkSession, path: str, by: Sequence[str]) -> list[tuple[str, ...]]:
    """Partition values that carry the marker, from the directory names alone."""

    def below(prefix: str, depth: int) -> list[tuple[str, ...]]:
        if depth == len(by):
            return [()] if paths.exists(spark, f"{prefix}/{SUCCESS}") else []
        found = []
        for name in paths.children(spark, prefix):
            column, _, value = name.partition("=")
            if column == by[depth]:
                found += [(value, *rest) for rest in below(f"{prefix}/{name}", depth + 1)]
        return found

    return below(path, 0)


def csv_rows(df: DataFrame, path: str, separator: str = " ", mode: str = "errorifexists") -> None:
    """One record per line, fields separated by a space; a text holding one is quoted."""
    df.write.mode(mode).option("sep", separator).csv(path)


def text_rows(df: DataFrame, path: str, value: str, by: Sequence[str]) -> None:
    """Text lines below directories named after record fields."""
    df.select(*by, value).hint("rebalance", *by).write.partitionBy(*by).text(path)


def single_file(df: DataFrame) -> DataFrame:
    """One output partition after parallel work; only for a result known to be small."""
    return df.repartition(1)
