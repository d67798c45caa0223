"""Patterns over named events in order (T09, U09), for rows spread over range slices.

A pattern is a chain of steps. A step follows the one before it either at once (`next`) or at the first
later row that fits (`followed_by`). Every row that fits the first step opens a match of its own, and
each has at most one: the steps decide which row comes next, so matches may overlap.

The steps are compiled, last one first, to columns over the rows: what would follow a row if it were
taken for that step. Reading the rows backwards, that is an automaton with one state per step, the
match that a row of the step would open; all a slice needs from the one after it are these states.
They come from one row per key and slice, so a key that holds most of the rows runs over many tasks.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from rivulet.operators import ordered
from rivulet.session import settle


@dataclass(frozen=True)
class Step:
    name: str
    condition: Column
    strict: bool = False


@dataclass(frozen=True)
class Pattern:
    """Steps in order; ``bound`` seconds from the first event to the last, exclusive."""

    steps: tuple[Step, ...]
    bound: int | None = None

    @classmethod
    def begin(cls, name: str, condition: Column) -> Pattern:
        return cls((Step(name, condition),))

    def next(self, name: str, condition: Column) -> Pattern:
        """The very next row must fit."""
        return self._with(Step(name, condition, True))

    def followed_by(self, name: str, condition: Column) -> Pattern:
        """The first later row that fits; others between are passed over."""
        return self._with(Step(name, condition))

    def within(self, seconds: int) -> Pattern:
        return replace(self, bound=seconds)

    def _with(self, step: Step) -> Pattern:
        if step.name in {s.name for s in self.steps}:
            raise ValueError(f"two steps are named {step.name}")
        return replace(self, steps=(*self.steps, step))


def match(
    events: DataFrame,
    pattern: Pattern,
    key: str,
    time: str,
    order: Sequence[str],
    columns: Sequence[str],
    slices: int | None = None,
) -> DataFrame:
    """One row per match: the key and, named after each step, a struct of its event's ``columns``.

    ``order`` puts a key's rows in line; rows that tie in it are ordered by their content. A condition that is
    NULL does not fit.
    """
    fits = {f"_fits_{i}": F.coalesce(s.condition, F.lit(False)) for i, s in enumerate(pattern.steps)}
    wanted = dict.fromkeys([key, time, *order, *columns])
    rows = ordered.with_slices(events.withColumns(fits).select(*wanted, *fits), [key], order, slices)
    event = F.struct(time, *[c for c in columns if c != time])
    last = len(pattern.steps) - 1
    # `_open` is the match a row would open as step i: its events from step i on
    rows = rows.withColumn("_open", F.when(F.col(f"_fits_{last}"), F.array(event)))
    for i in range(last, 0, -1):
        rows = _following(rows, [key], order, F.col(f"_fits_{i}"), pattern.steps[i].strict)
        opened = F.concat(F.array(event), F.col("_next"))
        rows = rows.withColumn("_open", F.when(F.col(f"_fits_{i - 1}"), opened)).drop("_next")
        if i > 1:  # the next step reads the rows twice
            rows = settle(rows, "steps")
    found = rows.where(F.col("_open").isNotNull())
    if pattern.bound is not None:
        ends = [F.unix_micros(F.col("_open")[i][time].cast("timestamp")) for i in (0, last)]
        found = found.where(ends[1] - ends[0] < pattern.bound * 1_000_000)
    named = [F.struct(*[F.col("_open")[i][c].alias(c) for c in columns]).alias(s.name) for i, s in enumerate(pattern.steps)]
    return found.select(key, *named)


def _following(rows: DataFrame, keys: list[str], order: Sequence[str], fits: Column, strict: bool) -> DataFrame:
    """Adds ``_next``: `_open` of the next row, if it fits, or of the first later row that fits."""
    window = ordered.slice_window(keys, order)
    place = F.struct(*order, ordered.TIE, ordered.PLACE)
    state = F.struct(F.col("_open").alias("open"))  # not NULL, though what it holds may be
    if strict:
        state = F.struct(F.when(fits, F.col("_open")).alias("open"))
        ahead = rows.withColumn("_ahead", F.lead(state).over(window))
        first = F.min_by(state, place)
    else:
        state = F.when(fits, state)
        ahead = rows.withColumn("_ahead", F.first(state, ignorenulls=True).over(window.rowsBetween(1, Window.unboundedFollowing)))
        first = F.min_by(state, F.when(fits, place))
    joined = ordered.join_carried(ahead, rows, keys, first, _later, "_entering")
    return joined.withColumn("_next", F.coalesce("_ahead", "_entering")["open"]).drop("_ahead", "_entering")


def _later(along: WindowSpec, summary: Column) -> Column:
    """The first state of the slices after this one."""
    return F.first(summary, ignorenulls=True).over(along.rowsBetween(1, Window.unboundedFollowing))
