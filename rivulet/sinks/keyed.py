"""Tables with one current row per key.

A batch only writes its own newest row per key. Reading merges the batches, newest
first. Every ``fold_every`` batches the batch that comes next folds them into a base, and
readers list what came after the last base alone. A batch's directory is replaced if the
batch is replayed; a base is written once and never again.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rivulet.sinks import paths

VERSION = "_batch"
FOLD_EVERY = 20


def newest(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Row of each key with the greatest order; reduced before the shuffle."""
    others = [c for c in df.columns if c not in keys]
    best = df.groupBy(*keys).agg(F.max_by(F.struct(*others), F.struct(*order)).alias("_best"))
    return best.select(*keys, "_best.*").select(*df.columns)


class KeyedTable:
    """Upsert target. ``order`` ranks rows of one key inside a batch."""

    def __init__(
        self,
        spark: SparkSession,
        path: str,
        schema: T.StructType,
        keys: Sequence[str],
        order: Sequence[str],
        fold_every: int = FOLD_EVERY,
    ):
        self.spark = spark
        self.path = path
        self.schema = schema
        self.keys = list(keys)
        self.order = list(order)
        self.fold_every = fold_every

    def _delta(self, batch_id: int) -> str:
        return f"{self.path}/delta/group={batch_id // self.fold_every}/{VERSION}={batch_id}"

    def _base(self, batch_id: int) -> str:
        return f"{self.path}/base/{VERSION}={batch_id}"

    def upsert(self, df: DataFrame, batch_id: int) -> None:
        """``foreachBatch`` body; a later batch wins over an earlier one."""
        if batch_id and batch_id % self.fold_every == 0:
            self.compact(batch_id)
        rows = newest(df.select(*self.schema.names), self.keys, self.order)
        rows.write.mode("overwrite").parquet(self._delta(batch_id))

    def _done(self, pattern: str, before: int | None) -> list[int]:
        found = (int(f.split("/")[-2].partition("=")[2]) for f in paths.matching(self.spark, f"{pattern}/_SUCCESS"))
        return sorted(i for i in found if before is None or i < before)

    def _parts(self, before: int | None) -> tuple[int | None, list[int]]:
        """The last base, if any, and the batches after it."""
        bases = self._done(f"{self.path}/base/{VERSION}=*", before)
        upto = bases[-1] if bases else -1
        groups = [int(n.partition("=")[2]) for n in paths.children(self.spark, f"{self.path}/delta")]
        recent = [g for g in groups if (g + 1) * self.fold_every > upto]
        deltas = [i for g in recent for i in self._done(f"{self.path}/delta/group={g}/{VERSION}=*", before) if i > upto]
        return (upto if bases else None), sorted(deltas)

    def _versions(self, before: int | None) -> DataFrame | None:
        base, deltas = self._parts(before)
        stored = T.StructType([*self.schema.fields, T.StructField(VERSION, T.LongType())])
        read = self.spark.read.schema(stored)
        union = None
        if base is not None:
            union = read.option("basePath", f"{self.path}/base").parquet(self._base(base))
        if deltas:
            newer = read.option("basePath", f"{self.path}/delta").parquet(*map(self._delta, deltas)).select(*stored.names)
            union = newer if union is None else union.union(newer)
        return union

    def batch(self, batch_id: int) -> DataFrame:
        """The rows one batch has written."""
        return self.spark.read.schema(self.schema).parquet(self._delta(batch_id))

    def current(self, before: int | None = None, only: DataFrame | None = None) -> DataFrame:
        """The table as of the last committed batch, or as of the one before ``before``.

        ``only`` holds the keys wanted, or some columns of them, NULLs included; others are left out before the merge.
        """
        versions = self._wanted(self._versions(before), only)
        if versions is None:
            return self.spark.createDataFrame([], self.schema)
        return newest(versions, self.keys, [VERSION, *self.order]).select(*self.schema.names)

    def _wanted(self, versions: DataFrame | None, only: DataFrame | None) -> DataFrame | None:
        if versions is None or only is None:
            return versions
        wanted = only.toDF(*[f"_only_{c}" for c in only.columns])
        same = [F.col(c).eqNullSafe(F.col(f"_only_{c}")) for c in only.columns]
        return versions.join(wanted, reduce(and_, same), "left_semi")

    def compact(self, before: int | None = None) -> None:
        """Fold all batches so far into a new base; a base that is there already stays."""
        _, deltas = self._parts(before)
        if deltas and not paths.exists(self.spark, f"{self._base(deltas[-1])}/_SUCCESS"):
            self.current(before).write.mode("overwrite").parquet(self._base(deltas[-1]))


class MergedTable(KeyedTable):
    """Upsert target whose batches may also set single columns or take keys away.

    A batch's rows say what they do: set all columns, set some, or remove the key. Reading takes each
    column from the newest row that set it; a removal sets all to NULL and hides the key until a
    later row sets something. Rows of one key in one batch are ranked by ``order``.
    """

    SET, GONE = "_set", "_gone"

    def __init__(
        self,
        spark: SparkSession,
        path: str,
        schema: T.StructType,
        keys: Sequence[str],
        order: Sequence[str] = (),
        fold_every: int = FOLD_EVERY,
    ):
        marks = [T.StructField(self.SET, T.ArrayType(T.StringType())), T.StructField(self.GONE, T.BooleanType())]
        super().__init__(spark, path, T.StructType([*schema.fields, *marks]), keys, order, fold_every)
        self.values = [c for c in schema.names if c not in self.keys]
        self.visible = schema.names

    def full(self, df: DataFrame) -> DataFrame:
        """Rows that set all columns."""
        return self.partial(df.select(*self.visible))

    def partial(self, df: DataFrame) -> DataFrame:
        """Rows that set the columns they have and leave the others as they are."""
        has = [c for c in self.values if c in df.columns]
        return self._marked(df, has, False)

    def removed(self, df: DataFrame) -> DataFrame:
        """Rows that take their keys away."""
        return self._marked(df.select(*self.keys), self.values, True)

    def _marked(self, df: DataFrame, has: Sequence[str], gone: bool) -> DataFrame:
        kinds = {f.name: f.dataType for f in self.schema.fields}
        columns = [(F.col(c) if c in df.columns else F.lit(None)).cast(kinds[c]).alias(c) for c in self.visible]
        return df.select(*columns, F.array(*map(F.lit, has)).cast("array<string>").alias(self.SET), F.lit(gone).alias(self.GONE))

    def _merged(self, rows: DataFrame, place: Sequence[str]) -> DataFrame:
        """One row per key: each column from the last row that set it."""
        at = F.struct(*place)
        newest_of = [
            F.max_by(F.struct(c), F.when(F.array_contains(self.SET, c), at)).alias(f"_{i}") for i, c in enumerate(self.values)
        ]
        every = F.array_distinct(F.flatten(F.collect_set(self.SET))).alias(self.SET)
        best = rows.groupBy(*self.keys).agg(*newest_of, every, F.max_by(self.GONE, at).alias(self.GONE))
        columns = [F.col(f"_{i}")[c].alias(c) for i, c in enumerate(self.values)]
        return best.select(*self.keys, *columns, self.SET, self.GONE).select(*self.schema.names)

    def upsert(self, df: DataFrame, batch_id: int) -> None:
        """``foreachBatch`` body for rows made by ``full``, ``partial`` and ``removed``."""
        if batch_id and batch_id % self.fold_every == 0:
            self.compact(batch_id)
        rows = self._merged(df.select(*self.schema.names), [self.GONE, *self.order])
        rows.write.mode("overwrite").parquet(self._delta(batch_id))

    def rows(self, before: int | None = None) -> DataFrame:
        """The keys that are there, with their columns."""
        return self.current(before).where(~F.col(self.GONE)).select(*self.visible)

    def current(self, before: int | None = None, only: DataFrame | None = None) -> DataFrame:
        versions = self._wanted(self._versions(before), only)
        return self.spark.createDataFrame([], self.schema) if versions is None else self._merged(versions, [VERSION])


def without_fields(documents: DataFrame, *fields: str) -> DataFrame:
    """Documents after a scripted removal of fields."""
    return documents.drop(*fields)


def without_nested(document: Column, *fields: str) -> Column:
    """Struct form of the removal."""
    return document.dropFields(*fields)


def put_cells(df: DataFrame, rowkey: str, family: str, qualifiers: Sequence[str], ts: Column) -> DataFrame:
    """Cells ``(rowkey, family, qualifier, ts, value)`` of a wide-column put; NULLs write no cell."""
    pairs = F.array(
        *[F.struct(F.lit(q).alias("qualifier"), F.col(q).cast("string").alias("value")) for q in qualifiers]
    )
    cells = df.select(
        F.col(rowkey).cast("string").alias("rowkey"), F.lit(family).alias("family"), ts.alias("ts"), F.inline(pairs)
    )
    return cells.where(F.col("value").isNotNull()).select("rowkey", "family", "qualifier", "ts", "value")
