"""User-defined aggregates with a buffer of their own (U02): initialise, update, merge, evaluate.

An aggregate works on arrays: a batch's values with the number of each value's group. Every task turns its
rows into one buffer per group before the shuffle, so a hot group sends one row per task and flush. Buffers
are merged in key order, batch by batch, and evaluated; no group is ever whole in memory.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructField, StructType

Buffers = dict[str, np.ndarray]
#: groups that a task holds before it sends them on
FLUSH = 1 << 16


@dataclass(frozen=True)
class Aggregate:
    """``update`` makes buffers from (values, their groups, number of groups), also for groups without values;
    ``merge`` adds up (buffers, their groups, number of groups); ``evaluate`` turns buffers into results."""

    buffer: str
    result: str
    update: Callable[[np.ndarray, np.ndarray, int], Buffers]
    merge: Callable[[Buffers, np.ndarray, int], Buffers]
    evaluate: Callable[[Buffers], pa.Array]


def summed(values: np.ndarray, groups: np.ndarray, n: int) -> np.ndarray:
    """Exact sums per group of whole numbers."""
    out = np.zeros(n, np.int64)
    np.add.at(out, groups, values)
    return out


MEAN = Aggregate(
    buffer="total bigint, n bigint",
    result="double",
    update=lambda values, groups, n: {"total": summed(values, groups, n), "n": np.bincount(groups, minlength=n)},
    merge=lambda buffers, groups, n: {c: summed(b, groups, n) for c, b in buffers.items()},
    evaluate=lambda b: pa.array(b["total"] / np.maximum(b["n"], 1), mask=b["n"] == 0),
)


def _groups(table: pa.Table, keys: Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
    """Number of each row's group, and a row of each group; NULL keys are equal."""
    codes = np.zeros(table.num_rows, np.int64)
    first = np.zeros(min(1, table.num_rows), np.int64)
    for key in keys:
        column = pc.dictionary_encode(table[key].combine_chunks(), null_encoding="encode")
        codes = codes * max(1, len(column.dictionary)) + column.indices.to_numpy(zero_copy_only=False)
        _, first, codes = np.unique(codes, return_index=True, return_inverse=True)
    return codes, first


def aggregate(df: DataFrame, keys: Sequence[str], value: str, function: Aggregate, into: str) -> DataFrame:
    """``(keys, into)``; NULL values are left out, and a group of them alone has an empty buffer."""
    keys = list(keys)
    key_fields = [StructField(f"_key{i}", df.schema[k].dataType) for i, k in enumerate(keys)]
    buffers = StructType.fromDDL(function.buffer).fields
    partial = StructType([*key_fields, *buffers])
    final = StructType([*key_fields, StructField(into, StructType.fromDDL(f"r {function.result}")["r"].dataType)])
    names, fields = [f.name for f in key_fields], [f.name for f in buffers]
    partial_arrow, final_arrow = to_arrow_schema(partial), to_arrow_schema(final)

    def table_of(keyed: pa.Table, first: np.ndarray, columns: Buffers) -> pa.Table:
        chosen = keyed.select(names).take(pa.array(first))
        for c in fields:
            chosen = chosen.append_column(c, pa.array(columns[c]))
        return chosen.cast(partial_arrow)

    def merged(table: pa.Table) -> pa.Table:
        codes, first = _groups(table, names)
        return table_of(table, first, function.merge({c: table[c].to_numpy() for c in fields}, codes, len(first)))

    def update(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            table = pa.Table.from_batches([batch])
            codes, first = _groups(table, names)
            valid = table["_value"].is_valid().to_numpy()
            values = table["_value"].drop_null().to_numpy()
            own = table_of(table, first, function.update(values, codes[valid], len(first)))
            held = own if held is None else merged(pa.concat_tables([held, own]).combine_chunks())
            if held.num_rows >= FLUSH:
                yield from held.to_batches()
                held = None
        if held is not None:
            yield from held.to_batches()

    def finish(table: pa.Table) -> list[pa.RecordBatch]:
        result = function.evaluate({c: table[c].to_numpy() for c in fields})
        return table.select(names).append_column(into, result).cast(final_arrow).to_batches()

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None  # the group the last batch ended in
        for batch in batches:
            table = pa.Table.from_batches([batch]).cast(partial_arrow)
            if held is not None:
                table = pa.concat_tables([held, table]).combine_chunks()
            if table.num_rows:
                codes, _ = _groups(table, names)
                done = merged(table)
                last = codes[-1]
                yield from finish(done.filter(pa.array(np.arange(done.num_rows) != last)))
                held = done.slice(int(last), 1)
        if held is not None:
            yield from finish(held)

    rows = df.select(*[F.col(k).alias(n) for k, n in zip(keys, names)], F.col(value).alias("_value"))
    sent = rows.mapInArrow(update, partial).repartition(*names).sortWithinPartitions(*names)
    return sent.mapInArrow(merge, final).select(*[F.col(n).alias(k) for k, n in zip(keys, names)], into)
