"""Predicates as Column expressions (P08-P14), so that they reach the scan."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from functools import reduce
from typing import Any

from pyspark.sql import Column
from pyspark.sql import functions as F


def term(field: str, value: Any) -> Column:
    """Field equals value."""
    return F.col(field) == F.lit(value)


def in_range(field: str, gte=None, gt=None, lte=None, lt=None) -> Column:
    """Field within the given bounds."""
    tests = []
    if gte is not None:
        tests.append(F.col(field) >= F.lit(gte))
    if gt is not None:
        tests.append(F.col(field) > F.lit(gt))
    if lte is not None:
        tests.append(F.col(field) <= F.lit(lte))
    if lt is not None:
        tests.append(F.col(field) < F.lit(lt))
    return all_of(tests)


def all_of(tests: Iterable[Column]) -> Column:
    return reduce(lambda a, b: a & b, tests, F.lit(True))


def any_of(tests: Iterable[Column]) -> Column:
    return reduce(lambda a, b: a | b, tests, F.lit(False))


def bool_query(must: Iterable[Column] = (), should: Iterable[Column] = ()) -> Column:
    """Compound query: every ``must`` holds; without any, at least one ``should`` does.

    Beside a ``must`` the ``should`` tests only affect ranking, so they do not filter.
    """
    must, should = list(must), list(should)
    if must:
        return all_of(must)
    return any_of(should) if should else F.lit(True)


def in_values(field: str, values: Iterable[Any]) -> Column:
    """Field is one of the values; no values match nothing."""
    values = list(values)
    return F.col(field).isin(values) if values else F.lit(False)


def partition_equals(values: Mapping[str, Any]) -> Column:
    """Conjunction of equalities, e.g. on partition columns."""
    return all_of(term(k, v) for k, v in values.items())
