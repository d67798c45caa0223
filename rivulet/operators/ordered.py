"""Per-key ordered computation whose work does not depend on how rows spread over keys.

A window ``PARTITION BY key ORDER BY seq`` puts all rows of a key in one task. If one key
holds a third of a 100 TB table that task never ends. Here the whole table is range
partitioned by (key, order), so each slice is a stretch of that order with about the same
number of rows: small keys share a slice, a large one runs over many. The window runs per
(key, slice). What a slice needs from the ones before it (a running sum, a count, the last
row) is computed on one row per key and slice; only the one key that comes from the slice
before can need it, so what is joined back has at most one row per slice.

Cuts use the whole order, then a hash of the row, then its place: ties, NULL keys, NULL
order values and equal rows are cut like all others. The slices are written once and read by
both sides of the join, so both see the same cuts, also after executors were lost.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from rivulet.session import settle

SLICE = "_slice"
TIE, PLACE = "_row_hash", "_row_place"
#: items in one part of a list
PART_ROWS = 100_000


def with_slices(df: DataFrame, keys: Sequence[str], order: Sequence[str], slices: int | None = None) -> DataFrame:
    """Add the slice number and what orders equal rows; by default one slice per shuffle partition."""
    slices = slices or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = df.withColumns({TIE: F.xxhash64(*df.columns), PLACE: F.monotonically_increasing_id()})
    ranged = placed.repartitionByRange(slices, *keys, *order, TIE, PLACE)
    return settle(ranged.withColumn(SLICE, F.spark_partition_id().cast("long")), "slices")


def slice_window(keys: Sequence[str], order: Sequence[str]) -> WindowSpec:
    return Window.partitionBy(*keys, SLICE).orderBy(*order, TIE, PLACE)


def join_carried(
    rows: DataFrame,
    sliced: DataFrame,
    keys: Sequence[str],
    summary: Column,
    carried: Callable[[WindowSpec, Column], Column],
    into: str,
) -> DataFrame:
    """Join to each row, as ``into``, what the earlier slices of its key add up to.

    ``summary`` aggregates one slice; ``carried`` turns a key's summaries into the value that
    enters a slice. At most one key per slice has such a value: the broadcast is no longer
    than the number of slices.
    """
    along = Window.partitionBy(*keys).orderBy(SLICE)
    names = {k: f"_key{i}" for i, k in enumerate(keys)}
    entering = (
        sliced.groupBy(*keys, SLICE)
        .agg(summary.alias("_summary"))
        .withColumn(into, carried(along, F.col("_summary")))
        .where(F.col(into).isNotNull())
        .select(*[F.col(k).alias(n) for k, n in names.items()], F.col(SLICE).alias("_at"), into)
    )
    same = F.col(SLICE) == F.col("_at")
    for k, n in names.items():
        same = same & F.col(k).eqNullSafe(F.col(n))
    return rows.join(F.broadcast(entering), same, "left").drop("_at", *names.values())


def _before(w: WindowSpec) -> WindowSpec:
    return w.rowsBetween(Window.unboundedPreceding, -1)


def previous_row(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], columns: Sequence[str], into: str = "prev", slices: int | None = None
) -> DataFrame:
    """Struct of ``columns`` of the row before, per key in the given order."""
    sliced = with_slices(df, keys, order, slices)
    picked = F.struct(*columns)
    rows = sliced.withColumn("_lag", F.lag(picked).over(slice_window(keys, order)))
    tail = F.max_by(picked, F.struct(*order, TIE, PLACE))
    joined = join_carried(rows, sliced, keys, tail, lambda w, s: F.lag(s).over(w), "_entering")
    return joined.withColumn(into, F.coalesce("_lag", "_entering")).select(*df.columns, into)


def running_sum(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], value: Column, into: str = "running", slices: int | None = None
) -> DataFrame:
    """Sum of ``value`` up to and including each row; one result per input row."""
    sliced = with_slices(df.withColumn("_v", value), keys, order, slices)
    upto = slice_window(keys, order).rowsBetween(Window.unboundedPreceding, 0)
    rows = sliced.withColumn("_sum", F.sum("_v").over(upto))
    joined = join_carried(rows, sliced, keys, F.sum("_v"), lambda w, s: F.sum(s).over(_before(w)), "_entering")
    zero = F.lit(0)
    return joined.withColumn(into, F.coalesce("_sum", zero) + F.coalesce("_entering", zero)).select(*df.columns, into)


def last_known(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], value: str, into: str = "known", slices: int | None = None
) -> DataFrame:
    """Latest non-null ``value`` at or before each row."""
    sliced = with_slices(df, keys, order, slices)
    upto = slice_window(keys, order).rowsBetween(Window.unboundedPreceding, 0)
    rows = sliced.withColumn("_last", F.last(value, ignorenulls=True).over(upto))
    tail = F.max_by(value, F.when(F.col(value).isNotNull(), F.struct(*order, TIE, PLACE)))
    joined = join_carried(rows, sliced, keys, tail, lambda w, s: F.last(s, ignorenulls=True).over(_before(w)), "_entering")
    return joined.withColumn(into, F.coalesce("_last", "_entering")).select(*df.columns, into)


def row_numbers(df: DataFrame, keys: Sequence[str], order: Sequence[str], into: str = "n", slices: int | None = None) -> DataFrame:
    """Place of each row in its key's order, from 1."""
    return running_sum(df, keys, order, F.lit(1).cast("long"), into, slices)


def ordered_lists(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    item: Column,
    into: str = "items",
    part_rows: int = PART_ROWS,
    slices: int | None = None,
) -> DataFrame:
    """Items of each key in order, as ``(keys, part, items)``.

    Every key has the parts 0, 1, 2, ... of ``part_rows`` items each, the last one shorter:
    the item in place n (from 1) is in part (n - 1) div part_rows, whatever the key's size.
    """
    numbered = row_numbers(df.withColumn("_item", item), keys, order, "_n", slices)
    entries = F.sort_array(F.collect_list(F.struct("_n", "_item")))
    part = F.floor((F.col("_n") - 1) / F.lit(part_rows)).alias("part")
    return numbered.groupBy(*keys, part).agg(entries.alias("_entries")).select(*keys, "part", F.col("_entries._item").alias(into))
