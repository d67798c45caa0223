"""User-defined functions (U01-U06): the extension forms of built-in expressions.

Most queries use the built-ins, which stay in the JVM. These forms show how user code is
registered by SQL name. Table functions have an Arrow form for ``TABLE`` arguments and a
plain one for ``LATERAL``.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator, Sequence

import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.functions import arrow_udtf, pandas_udf, udtf


@pandas_udf(T.StringType())
def upper_text(text: pd.Series) -> pd.Series:
    return text.str.upper()


@pandas_udf(T.LongType())
def floored_max(values: pd.Series) -> int:
    """Grouped aggregate: maximum that starts at 0. The built-in form is ``max_with_floor``."""
    top = values.max()
    return 0 if pd.isna(top) else max(int(top), 0)


def merged(
    df: DataFrame, keys: Sequence[str], value: str, function: Callable[[Column], Column], into: str, parts: int = 1024
) -> DataFrame:
    """Aggregate a user function in two steps: over parts of a group, then over their results.

    A grouped pandas function needs its rows in one task. Cutting a group by the hash
    of its rows bounds that task; the function must be able to merge its own results.
    """
    part = F.pmod(F.xxhash64(*df.columns), F.lit(parts))
    partial = df.groupBy(*keys, part.alias("_part")).agg(function(F.col(value)).alias("_partial"))
    return partial.groupBy(*keys).agg(function(F.col("_partial")).alias(into))


def _object(text: str | None) -> dict | None:
    try:
        value = json.loads(text)
    except (TypeError, ValueError):
        return None
    return value if isinstance(value, dict) else None


@udtf(returnType="name string, age int, grade string")
class PersonColumns:
    """JSON text to one row of three columns; bad text gives no row. For LATERAL, which takes no Arrow form."""

    def eval(self, message: str):
        person = _object(message)
        if person is not None:
            yield person.get("name"), person.get("age"), person.get("grade")


@udtf(returnType="attr string")
class CommaRows:
    """Comma-separated text to one row per part, for LATERAL."""

    def eval(self, text: str):
        if text is not None:
            for part in text.split(","):
                yield (part,)


@udtf(returnType="topic string, payload string, offset bigint")
class EnvelopeColumns:
    """JSON envelope to its topic, payload and offset, for LATERAL."""

    def eval(self, message: str):
        record = _object(message)
        if record is not None:
            yield record.get("topic"), record.get("value"), record.get("offset")


def _parsed(batch: pa.RecordBatch, **fields: pa.DataType) -> pa.Table:
    """Fields of the JSON objects in column ``message`` beside their ``id``; other text gives no row."""
    found = [(i, o) for i, t in zip(batch.column("id").to_pylist(), batch.column("message").to_pylist()) if (o := _object(t)) is not None]
    columns = {name: pa.array([o.get(name) for _, o in found], kind) for name, kind in fields.items()}
    return pa.table({"id": pa.array([i for i, _ in found], pa.int64()), **columns})


@arrow_udtf(returnType="id bigint, name string, age int, grade string")
class PersonTable:
    """PersonColumns over a table (id, message), in Arrow batches."""

    def eval(self, batch: pa.RecordBatch) -> Iterator[pa.Table]:
        yield _parsed(batch, name=pa.string(), age=pa.int32(), grade=pa.string())


@arrow_udtf(returnType="id bigint, attr string")
class CommaTable:
    """CommaRows over a table (id, message), in Arrow batches."""

    def eval(self, batch: pa.RecordBatch) -> Iterator[pa.Table]:
        parts = pc.split_pattern(batch.column("message"), ",")
        yield pa.table({"id": batch.column("id").take(pc.list_parent_indices(parts)), "attr": pc.list_flatten(parts)})


@arrow_udtf(returnType="id bigint, topic string, payload string, offset bigint")
class EnvelopeTable:
    """EnvelopeColumns over a table (id, message), in Arrow batches."""

    def eval(self, batch: pa.RecordBatch) -> Iterator[pa.Table]:
        found = _parsed(batch, topic=pa.string(), value=pa.string(), offset=pa.int64())
        yield found.rename_columns(["id", "topic", "payload", "offset"])


def register(spark: SparkSession) -> None:
    """Make the functions callable from SQL."""
    spark.udf.register("upper_text", upper_text)
    spark.udf.register("floored_max", floored_max)
    spark.udtf.register("person_columns", PersonColumns)
    spark.udtf.register("comma_rows", CommaRows)
    spark.udtf.register("envelope_columns", EnvelopeColumns)
    spark.udtf.register("person_table", PersonTable)
    spark.udtf.register("comma_table", CommaTable)
    spark.udtf.register("envelope_table", EnvelopeTable)
