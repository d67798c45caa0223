"""Catalog tables, wide-column cells, generated records and JDBC scans."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rivulet.operators.predicates import partition_equals


def partition_scan(spark: SparkSession, name: str, partition: Mapping[str, Any]) -> DataFrame:
    """Catalog table limited to a partition; only its files are listed and read."""
    return spark.table(name).where(partition_equals(partition))


def create_table(
    spark: SparkSession,
    name: str,
    columns: str,
    using: str,
    options: Mapping[str, str] | None = None,
    partitioned_by: Sequence[str] = (),
    location: str | None = None,
) -> None:
    """``CREATE TABLE .. USING .. OPTIONS ..`` for any connector Spark has."""
    text = f"CREATE TABLE {name} ({columns}) USING {using}"
    if options:
        text += " OPTIONS (" + ", ".join(f"'{k}' = '{v}'" for k, v in options.items()) + ")"
    if partitioned_by:
        text += f" PARTITIONED BY ({', '.join(partitioned_by)})"
    if location:
        text += f" LOCATION '{location}'"
    spark.sql(text)


def wide_rows(cells: DataFrame, family: str, qualifiers: Sequence[str]) -> DataFrame:
    """Newest value of each declared qualifier per row key, as ``rowkey, <family> struct``.

    Cells are ``(rowkey, family, qualifier, ts, value)``. Each qualifier is a
    conditional aggregate, so nothing is collected and one shuffle does it all.
    """
    newest = [
        F.max_by("value", F.when(F.col("qualifier") == q, F.col("ts"))).alias(q) for q in qualifiers
    ]
    flat = cells.where(F.col("family") == family).groupBy("rowkey").agg(*newest)
    return flat.select("rowkey", F.struct(*qualifiers).alias(family))


def one_cell(cells: DataFrame, family: str, qualifier: str) -> DataFrame:
    """Newest value of one cell per row key, as cells again (for a copy to another table)."""
    picked = cells.where((F.col("family") == family) & (F.col("qualifier") == qualifier))
    newest = picked.groupBy("rowkey", "family", "qualifier").agg(
        F.max_by(F.struct("ts", "value"), "ts").alias("_newest")
    )
    return newest.select("rowkey", "family", "qualifier", "_newest.*")


def point_get(keys: DataFrame, table: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """A batch of keys looked up at once; a missing key gives NULLs."""
    return keys.join(table.select(key, *columns), key, "left")


def generated_messages(spark: SparkSession, count: int, value: str = "a") -> DataFrame:
    """Test messages ``(offset, value)``."""
    return spark.range(count).select(F.col("id").alias("offset"), F.lit(value).alias("value"))


def generated_stream(spark: SparkSession, rows_per_second: int = 1) -> DataFrame:
    """Test messages at a steady rate: ``(timestamp, value)``."""
    return spark.readStream.format("rate").option("rowsPerSecond", rows_per_second).load()


def jdbc_options(
    url: str,
    table: str,
    driver: str | None = None,
    split: tuple[str, int, int, int] | None = None,
    fetch_rows: int = 10_000,
    properties: Mapping[str, str] | None = None,
) -> dict[str, str]:
    """Options of a JDBC scan. ``split`` is (column, lower, upper, tasks): one range per task.

    Bounds only place the cuts; rows outside them are still read.
    """
    options = {"url": url, "dbtable": table, "fetchsize": str(fetch_rows), **(properties or {})}
    if driver:
        options["driver"] = driver
    if split:
        column, lower, upper, tasks = split
        options |= {
            "partitionColumn": column,
            "lowerBound": str(lower),
            "upperBound": str(upper),
            "numPartitions": str(tasks),
        }
    return options


def jdbc_table(spark: SparkSession, options: Mapping[str, str], schema: str | None = None) -> DataFrame:
    """JDBC scan, with column types replaced by a declared schema if given."""
    reader = spark.read.format("jdbc").options(**options)
    return (reader.option("customSchema", schema) if schema else reader).load()
