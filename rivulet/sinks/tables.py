"""Catalog table sinks and small results."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Row


def insert_into(df: DataFrame, table: str, columns: Sequence[str]) -> None:
    """``INSERT INTO``: columns by position, in the table's order."""
    df.select(*columns).write.insertInto(table)


def overwrite_partition(df: DataFrame, table: str, partition: Mapping[str, str], columns: Sequence[str]) -> None:
    """``INSERT OVERWRITE .. PARTITION (..)``: replaces that partition and no other."""
    spark = df.sparkSession
    values = ", ".join(f"{k} = '{v}'" for k, v in partition.items())
    spark.sql(
        f"INSERT OVERWRITE TABLE {table} PARTITION ({values}) SELECT {', '.join(columns)} FROM {{rows}}", rows=df
    )


def as_view(df: DataFrame, name: str) -> DataFrame:
    df.createOrReplaceTempView(name)
    return df


def fetch(df: DataFrame, limit: int) -> list[Row]:
    """A bounded number of rows for the client."""
    return df.limit(limit).collect()
