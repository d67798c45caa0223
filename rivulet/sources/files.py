"""Text, comma-separated and JSON-lines files, as tables or streams."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rivulet.functions.text import positional

# Fixed format of the login log: name and type by position.
LOGIN_FIELDS = [("userId", "bigint"), ("ip", "string"), ("eventType", "string"), ("eventTime", "bigint")]


def text_lines(spark: SparkSession, path: str, stream: bool = False) -> DataFrame:
    """One row ``value`` per line."""
    return (spark.readStream if stream else spark.read).text(path)


def socket_lines(spark: SparkSession, host: str, port: int) -> DataFrame:
    """Lines from a socket someone else serves. Operators take any ``value`` stream."""
    return spark.readStream.format("socket").option("host", host).option("port", port).load()


def comma_rows(spark: SparkSession, path: str, schema: str, stream: bool = False) -> DataFrame:
    """Comma-separated lines by position, fields trimmed."""
    reader = spark.readStream if stream else spark.read
    return (
        reader.schema(schema)
        .option("ignoreLeadingWhiteSpace", "true")
        .option("ignoreTrailingWhiteSpace", "true")
        .csv(path)
    )


def login_events(lines: DataFrame) -> DataFrame:
    """Login events from comma-separated lines of any origin."""
    return lines.select(*positional(F.col("value"), LOGIN_FIELDS))


def json_lines(spark: SparkSession, path: str, schema: str | None = None, stream: bool = False) -> DataFrame:
    """JSON lines; a table may infer its schema, a stream needs one. Absent fields are NULL."""
    if schema is None:
        if stream:
            raise ValueError("a JSON stream needs a schema")
        return spark.read.json(path)
    return (spark.readStream if stream else spark.read).schema(schema).json(path)
