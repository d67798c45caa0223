"""A keyed process function with state and timers (U08): bursts of fails on a stream.

Input columns are ``user_id, event_time, seq, kind``. The state's keys are GROUPS of users by hash, as each key
costs some milliseconds of calls between Spark and Python in a micro-batch; a user's rows are in one group. Rows
wait in a list state until the watermark has passed their second. A group has one timer for the earliest second
that waits, not one per row: it takes all that are over and is set anew for the earliest of the others. Rows are
appended as they come, packed, one entry per Arrow batch; the list is rewritten only when a timer fires. The open
bursts are a value state, and the end of the earliest one a timer of its own. Rows without a time are left out.

It needs a state store that holds lists and timers: RocksDB, whose changelog checkpoints write
what a batch changed (``rocks_state`` sets both for the streams started inside it). A group's share of a micro-batch
is handed to one task in Arrow batches.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

SECOND = 1_000_000
BURST = "user_id bigint, first_fail bigint, last_fail bigint, fails bigint"

STATE_SETTINGS = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


@contextmanager
def rocks_state(spark: SparkSession) -> Iterator[None]:
    """Streams started inside keep their state in RocksDB; the session's settings come back after."""
    before = {name: spark.conf.get(name, None) for name in STATE_SETTINGS}
    for name, value in STATE_SETTINGS.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            if value is None:
                spark.conf.unset(name)
            else:
                spark.conf.set(name, value)


#: groups of users; fixed for the life of a checkpoint
GROUPS = 4096
#: rows in one entry of the list state
PACKED = 10_000
USER = [("none", "?"), ("user", "<i8")]
WAITING = np.dtype([*USER, ("t", "<i8"), ("seq", "<i8"), ("fail", "?")])
OPEN = np.dtype([*USER, ("first", "<i8"), ("last", "<i8"), ("fails", "<i8")])


def packed(rows: np.ndarray) -> list[tuple[bytes]]:
    """Waiting rows as entries of the list state."""
    return [(rows[i : i + PACKED].tobytes(),) for i in range(0, len(rows), PACKED)]


def per_second(times: np.ndarray, seqs: np.ndarray, fails: np.ndarray) -> Iterator[tuple[int, bool, int]]:
    """(second, whether a non-fail is in it, fails after the last one) in the order of time, then sequence."""
    order = np.lexsort((seqs, times))
    seconds, failed = times[order] // SECOND, fails[order]
    starts = np.flatnonzero(np.concatenate([[True], seconds[1:] != seconds[:-1]]))
    ends = np.append(starts[1:], len(seconds))
    upto = np.concatenate([[0], np.cumsum(failed)])
    stop = np.maximum.accumulate(np.where(failed, -1, np.arange(len(failed))))[ends - 1]
    stopped = stop >= starts
    counts = upto[ends] - upto[np.where(stopped, stop + 1, starts)]
    yield from zip(seconds[starts].tolist(), stopped.tolist(), counts.tolist())


def by_user(rows: np.ndarray) -> Iterator[tuple[tuple[bool, int], np.ndarray]]:
    """(whether it is NULL, user) and rows of each user."""
    rows = rows[np.lexsort((rows["user"], rows["none"]))]
    new = (rows["user"][1:] != rows["user"][:-1]) | (rows["none"][1:] != rows["none"][:-1])
    for own in np.split(rows, np.flatnonzero(new) + 1) if len(rows) else ():
        yield (bool(own["none"][0]), int(own["user"][0])), own


class Bursts(StatefulProcessor):
    """Gathers each user's fails from a first one for ``span`` seconds; a non-fail before that drops them."""

    def __init__(self, span: int, min_fails: int):
        self.span, self.min_fails = span, min_fails

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.waiting = handle.getListState("waiting", "rows binary")
        self.open = handle.getValueState("open", "bursts binary")

    def call_at(self, rows: np.ndarray) -> None:
        """Sets the timer for the earliest second of waiting rows."""
        self.handle.registerTimer((int(rows["t"].min()) // SECOND + 1) * 1000)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        for batch in rows:
            new = np.empty(len(batch), WAITING)
            for c in WAITING.names:
                new[c] = batch[c].to_numpy()
            if len(new):
                self.waiting.appendList(packed(new))
                self.call_at(new)
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        limit = timerValues.getCurrentWatermarkInMs() // 1000  # seconds before this one are over
        held = np.frombuffer(b"".join(r[0] for r in self.waiting.get()) if self.waiting.exists() else b"", WAITING)
        over = held["t"] // SECOND < limit
        due, rest = held[over], held[~over]
        if len(due):
            if len(rest):
                self.waiting.put(packed(rest))
            else:
                self.waiting.clear()
        if len(rest):
            self.call_at(rest)
        before = self.open.get()[0] if self.open.exists() else b""
        bursts = {(none, user): tuple(burst) for none, user, *burst in np.frombuffer(before, OPEN).tolist()}
        closed = []
        for user, own in by_user(due):
            burst = bursts.pop(user, None)
            for second, stopped, fails in per_second(own["t"], own["seq"], own["fail"]):
                if burst is not None and second > burst[0] + self.span:
                    closed.append((user, *burst))
                    burst = None
                if stopped:
                    burst = None
                if fails:
                    burst = (second, second, fails) if burst is None else (burst[0], second, burst[2] + fails)
            if burst is not None:
                bursts[user] = burst
        for user in [u for u, burst in bursts.items() if burst[0] + self.span + 1 <= limit]:
            closed.append((user, *bursts.pop(user)))
        after = np.array([(*user, *burst) for user, burst in sorted(bursts.items())], OPEN)
        if len(after):
            if after.tobytes() != before:
                self.open.update((after.tobytes(),))
            self.handle.registerTimer((int(after["first"].min()) + self.span + 1) * 1000)
        elif before:
            self.open.clear()
        found = [(None if none else user, first * SECOND, last * SECOND, n) for (none, user), first, last, n in closed if n >= self.min_fails]
        if found:
            users, *others = zip(*found)
            yield pd.DataFrame({"user_id": pd.array(users, "Int64"), **dict(zip(("first_fail", "last_fail", "fails"), others))})


def ordered_bursts(
    events: DataFrame, span_seconds: int, min_fails: int, delay: str, fail: str = "fail", groups: int = GROUPS
) -> DataFrame:
    """T08b on a stream: bursts of fails, reported when the watermark has passed their span."""
    rows = events.withWatermark("event_time", delay).where("event_time IS NOT NULL").select(
        F.pmod(F.xxhash64("user_id"), F.lit(groups)).cast("int").alias("group"),
        F.col("user_id").isNull().alias("none"),
        F.coalesce("user_id", F.lit(0)).cast("long").alias("user"),
        "event_time",
        F.unix_micros("event_time").alias("t"),
        F.coalesce("seq", F.lit(2**63 - 1)).alias("seq"),
        F.coalesce(F.col("kind") == fail, F.lit(False)).alias("fail"),
    )
    found = rows.groupBy("group").transformWithStateInPandas(
        statefulProcessor=Bursts(span_seconds, min_fails), outputStructType=BURST, outputMode="Append", timeMode="EventTime"
    )
    return found.withColumns({c: F.timestamp_micros(c) for c in ("first_fail", "last_fail")})
