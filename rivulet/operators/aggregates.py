"""Aggregates (A), sorts and limits (O). All partially aggregate before the shuffle."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rivulet.functions.text import java_tokens
from rivulet.operators import ordered


def money_sum(column: str | Column) -> Column:
    """Sum of two-decimal amounts, exact and independent of shuffle order."""
    column = F.col(column) if isinstance(column, str) else column
    return F.sum(column.cast("decimal(18,2)")).cast("double")


def word_counts(lines: DataFrame, line: str = "value") -> DataFrame:
    """Occurrences of each space-separated token."""
    words = lines.select(F.explode(java_tokens(F.col(line))).alias("word"))
    return words.groupBy("word").agg(F.count("*").alias("n"))


def tagged_union(sources: Mapping[str, DataFrame], tag: str = "flag") -> DataFrame:
    """Union by position with a constant column naming each row's source."""
    union = None
    for name, df in sources.items():
        part = df.withColumn(tag, F.lit(name))
        union = part if union is None else union.union(part)
    return union


def conditional_sums(
    tagged: DataFrame, keys: Sequence[str], value: str, outputs: Mapping[str, str], tag: str = "flag"
) -> DataFrame:
    """Per key, one sum per tag; rows of other tags count 0, so no sum is NULL."""
    return tagged.groupBy(*keys).agg(
        *[
            F.sum(F.when(F.col(tag) == name, F.col(value)).otherwise(0)).alias(out)
            for out, name in outputs.items()
        ]
    )


def conditional_max(
    df: DataFrame, keys: Sequence[str], columns: Sequence[str], tags: Sequence, tag: str = "flag"
) -> DataFrame:
    """``max(if(tag = t, column, NULL))`` for each column and tag, as ``column_tag``."""
    return df.groupBy(*keys).agg(
        *[
            F.max(F.when(F.col(tag) == t, F.col(c))).alias(f"{c}_{t}")
            for t in tags
            for c in columns
        ]
    )


def full_merge(
    first: DataFrame, second: DataFrame, keys: Sequence[str], columns: Sequence[str]
) -> DataFrame:
    """Full outer merge on the keys without a join; ``first`` wins where both have a value."""
    tagged = tagged_union({"0": first.select(*keys, *columns), "1": second.select(*keys, *columns)})
    wide = conditional_max(tagged, keys, columns, ["0", "1"])
    return wide.select(*keys, *[F.coalesce(f"{c}_0", f"{c}_1").alias(c) for c in columns])


def max_with_floor(column: str | Column, floor: int = 0) -> Column:
    """Maximum that starts at ``floor``; empty and all-lower groups give the floor."""
    start = F.lit(floor)
    return F.greatest(F.coalesce(F.max(column), start), start)


def distinct_list(
    df: DataFrame,
    keys: Sequence[str],
    value: str,
    seq: str,
    separator: str = ",",
    into: str = "items",
    part_rows: int = ordered.PART_ROWS,
) -> DataFrame:
    """Distinct values of each key joined in first-seen order, as ``(keys, part, items)``."""
    first_seen = df.where(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.min(seq).alias("_seq"))
    lists = ordered.ordered_lists(first_seen, keys, ["_seq", value], F.col(value), into, part_rows)
    return lists.withColumn(into, F.array_join(into, separator))


def joined_list(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    value: str,
    separator: str = ",",
    into: str = "items",
    part_rows: int = ordered.PART_ROWS,
) -> DataFrame:
    """All non-null values of each key joined in order, as ``(keys, part, items)``."""
    present = df.where(F.col(value).isNotNull())
    lists = ordered.ordered_lists(present, keys, order, F.col(value), into, part_rows)
    return lists.withColumn(into, F.array_join(into, separator))


def changelog_of_counts(df: DataFrame, keys: Sequence[str], order: Sequence[str], slices: int | None = None) -> DataFrame:
    """Running count per key as a changelog.

    Each input row withdraws the key's previous count, if any, and adds the new
    one: ``(keys, order, is_add, n)``.
    """
    counted = ordered.row_numbers(df, keys, order, "_n", slices)
    change = F.when(F.col("_n") > 1, F.array(_change(False, -1), _change(True, 0))).otherwise(
        F.array(_change(True, 0))
    )
    return counted.select(*keys, *order, F.inline(change))


def _change(is_add: bool, offset: int) -> Column:
    return F.struct(F.lit(is_add).alias("is_add"), (F.col("_n") + offset).alias("n"))


def top_counts(df: DataFrame, key: str, into: str = "n") -> DataFrame:
    """Count per key, largest first; equal counts by key."""
    return df.groupBy(key).agg(F.count("*").alias(into)).orderBy(F.desc(into), F.asc(key))


def group_sums_as_map(df: DataFrame, key: str, item: str, value: str, into: str = "sums") -> DataFrame:
    """One row per key holding a map item -> sum over all its items; NULL items are left out."""
    sums = df.where(F.col(item).isNotNull()).groupBy(key, item).agg(money_sum(value).alias("_sum"))
    return sums.groupBy(key).agg(F.map_from_entries(F.collect_list(F.struct(item, "_sum"))).alias(into))
