"""JSON text to typed rows, strict or tolerant, and back."""

from __future__ import annotations

import json
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rivulet.functions.times import rfc3339_time, rfc3339_timestamp

# JSON Schema type names and string formats with their column types.
JSON_TYPES = {
    "string": "string",
    "number": "decimal(38,18)",
    "integer": "decimal(38,0)",
    "boolean": "boolean",
    "null": "void",
}
STRING_FORMATS = {"date": "date", "time": "string", "date-time": "timestamp"}

# Types read from JSON text leniently: bad text becomes this value in lenient mode.
LENIENT_DEFAULTS = {"int": "0", "bigint": "0", "double": "0", "boolean": "false"}


def schema_from_json_schema(text: str) -> T.StructType:
    """Row type described by a JSON Schema object."""

    def column_type(node: Mapping) -> T.DataType:
        kind = node.get("type")
        if isinstance(kind, list):
            named = [k for k in kind if k != "null"]
            if len(named) != 1:
                raise ValueError(f"union type is not supported: {kind}")
            kind = named[0]
        if kind == "object":
            return T.StructType([T.StructField(n, column_type(c)) for n, c in node["properties"].items()])
        if kind == "array":
            return T.ArrayType(column_type(node["items"]))
        if kind == "string" and node.get("contentEncoding") == "base64":
            return T.BinaryType()
        if kind == "string" and "format" in node:
            return T.DataType.fromDDL(STRING_FORMATS[node["format"]])
        return T.DataType.fromDDL(JSON_TYPES[kind])

    root = column_type(json.loads(text))
    if not isinstance(root, T.StructType):
        raise ValueError("the root of a row schema is an object")
    return root


def strict_rows(df: DataFrame, value: str, schema: T.StructType, fail_on_missing: bool = True) -> DataFrame:
    """Columns of a JSON text column; bad JSON fails the job, and so does a missing field if asked.

    A field that is present with JSON null stays NULL.
    """
    parsed = F.from_json(value, schema, {"mode": "FAILFAST"})
    if not fail_on_missing:
        return df.withColumn("_row", parsed).select(*_others(df, value), "_row.*")
    present = F.json_object_keys(value)
    missing = F.array_except(F.array(*[F.lit(n) for n in schema.names]), present)
    checked = F.when(
        F.size(missing) > 0,
        F.raise_error(F.concat(F.lit("missing field: "), F.array_join(missing, ","))).cast(schema),
    ).otherwise(parsed)
    return df.withColumn("_row", checked).select(*_others(df, value), "_row.*")


def tolerant_rows(
    df: DataFrame, value: str, schema: T.StructType, lenient: bool = False, fail_on_missing: bool = False
) -> DataFrame:
    """Columns of a JSON text column plus ``is_dead``; bad messages never fail the job.

    A message is dead if it is no JSON object, or holds a value that cannot be
    converted. Integer, double and boolean texts are forgiving in ``lenient`` mode
    (0 or false), NULL otherwise. Filter on ``is_dead`` for good rows and dead
    letters; the message column is kept for the latter.
    """
    raw = T.StructType([T.StructField(f.name, _raw_type(f.dataType)) for f in schema])
    with_corrupt = T.StructType([*raw.fields, T.StructField("_corrupt", T.StringType())])
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"}
    read = df.withColumn("_raw", F.from_json(value, with_corrupt, options))
    bad = F.col("_raw").isNull() | F.col("_raw._corrupt").isNotNull()
    if fail_on_missing:
        present = F.json_object_keys(value)
        wanted = F.array(*[F.lit(n) for n in schema.names])
        bad = bad | (F.size(F.array_except(wanted, present)) > 0)
    converted = []
    for f in schema:
        text = F.col("_raw")[f.name]
        column, failed = _convert(text, f.dataType, lenient)
        converted.append(column.alias(f.name))
        if failed is not None:
            bad = bad | (text.isNotNull() & failed)
    is_dead = F.coalesce(bad, F.lit(True)) & F.col(value).isNotNull()
    rows = read.select(*df.columns, F.struct(*converted).alias("_row"), is_dead.alias("is_dead"))
    return rows.select(
        *df.columns, *[F.when(~F.col("is_dead"), F.col("_row")[n]).alias(n) for n in schema.names], "is_dead"
    )


def good_and_dead(rows: DataFrame, value: str) -> tuple[DataFrame, DataFrame]:
    """Split tolerant rows into good rows and the dead messages."""
    good = rows.where(~F.col("is_dead")).drop("is_dead", value)
    return good, rows.where("is_dead").select(value)


def _others(df: DataFrame, value: str) -> list[str]:
    return [c for c in df.columns if c != value]


def _raw_type(kind: T.DataType) -> T.DataType:
    """Scalars are read as text and converted by rule; nested types as they are."""
    nested = (T.StructType, T.ArrayType, T.MapType)
    return kind if isinstance(kind, nested) else T.StringType()


def _convert(text: Column, kind: T.DataType, lenient: bool) -> tuple[Column, Column | None]:
    """Typed column and the test for a value that kills the message."""
    name = kind.simpleString()
    if isinstance(kind, (T.StructType, T.ArrayType, T.MapType, T.StringType)):
        return text, None
    if isinstance(kind, T.NullType):
        return F.lit(None), None
    if isinstance(kind, T.BinaryType):
        column = F.try_to_binary(text, F.lit("base64"))
    elif isinstance(kind, T.TimestampType):
        column = rfc3339_timestamp(text)
    elif isinstance(kind, T.TimestampNTZType):
        column = rfc3339_timestamp(text).cast(kind)
    elif name in LENIENT_DEFAULTS:
        column = text.try_cast(kind)
        if name in ("int", "bigint"):
            column = F.coalesce(column, text.try_cast("double").try_cast(kind))
        if lenient:
            fallback = F.when(text.isNotNull(), F.lit(LENIENT_DEFAULTS[name]).cast(kind))
            column = F.coalesce(column, fallback)
        return column, None
    else:
        column = F.trim(text).try_cast(kind)
    return column, column.isNull()


def time_of_day(text: Column) -> Column:
    """Strict UTC time of a JSON text field."""
    return rfc3339_time(text)


def joined_fields(value: Column, paths: Sequence[str], separator: str = ",") -> Column:
    """Fields of a JSON text joined in order; a missing one reads ``null``."""
    fields = [F.coalesce(F.get_json_object(value, p), F.lit("null")) for p in paths]
    return F.concat_ws(separator, *fields)


def object_pairs(value: Column, x: str = "x", y: str = "y") -> Column:
    """JSON array of objects as an array of (x, y) structs; explode it for rows."""
    element = T.StructType([T.StructField(x, T.StringType()), T.StructField(y, T.StringType())])
    return F.from_json(value, T.ArrayType(element))


def append_if(objects: Column, matches: Callable[[Column], Column], extra: Column) -> Column:
    """Append ``extra`` to an array if some element matches."""
    return F.when(F.exists(objects, matches), F.array_append(objects, extra)).otherwise(objects)


def envelope(with_timestamp: bool = True) -> Column:
    """Topic record as JSON text; a null key or value is left out."""
    names = ["topic", "partition", "offset", *(["timestamp"] if with_timestamp else []), "key", "value"]
    return F.to_json(F.struct(*names))
