"""Loading the driver's parquet tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rivulet.session import use_utc


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return use_utc(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def zoned(df: DataFrame, *names: str) -> DataFrame:
    """Zone-less columns as TIMESTAMP, which watermarks need."""
    return df.withColumns({n: F.col(n).cast("timestamp") for n in names})


def zoneless(df: DataFrame, *names: str) -> DataFrame:
    """TIMESTAMP columns back to the tables' zone-less type."""
    return df.withColumns({n: F.col(n).cast("timestamp_ntz") for n in names})
