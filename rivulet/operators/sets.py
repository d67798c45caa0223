"""Set operations (E). Spark's own operators, named after the rule they keep."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame


def union_rows(a: DataFrame, b: DataFrame) -> DataFrame:
    """Union by position, duplicates kept."""
    return a.union(b)


def union_distinct(a: DataFrame, b: DataFrame) -> DataFrame:
    """Each distinct row of either side once."""
    return a.union(b).distinct()


def union_distinct_stream(a: DataFrame, b: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Distinct union of two streams: a row is added once, however far apart its copies come.

    The state holds every distinct row, as the rule asks; a rule with a horizon would bound it.
    """
    return a.union(b).dropDuplicates(list(columns))


def except_distinct(a: DataFrame, b: DataFrame) -> DataFrame:
    """Distinct rows of ``a`` that are not in ``b``."""
    return a.subtract(b)


def except_multiset(a: DataFrame, b: DataFrame) -> DataFrame:
    """Rows of ``a`` with each row of ``b`` taken away once."""
    return a.exceptAll(b)


def key_difference(a: DataFrame, b: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys of ``a`` that ``b`` lacks."""
    return a.select(*keys).subtract(b.select(*keys))
