"""Detection of consecutive failures per key (T08, T08b, T09), batch form."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rivulet.operators import ordered


def consecutive_fails(
    events: DataFrame,
    key: str,
    kind: str,
    time: str,
    order: list[str],
    within: Column,
    fail: str = "fail",
    message: str = "login fail!",
    slices: int | None = None,
) -> DataFrame:
    """Alert for each fail whose previous event of the key is a fail too.

    ``order`` decides what "previous" means: a sequence column for arrival order,
    the event time (then the sequence) for event-time order. The bound is
    exclusive: ``time < previous time + within``. An earlier time than the
    previous row's also passes, as only the upper side is bounded.
    """
    paired = ordered.previous_row(
        events.select(key, kind, time, *[o for o in order if o != time]),
        [key], order, [kind, time], "_prev", slices,
    )
    return paired.where(
        (F.col(kind) == fail)
        & (F.col(f"_prev.{kind}") == fail)
        & (F.col(time) < F.col(f"_prev.{time}") + within)
    ).select(
        key,
        F.col(f"_prev.{time}").alias("first_fail"),
        F.col(time).alias("last_fail"),
        F.lit(message).alias("warning"),
    )


def fail_bursts(
    events: DataFrame,
    key: str,
    kind: str,
    time: str,
    order: list[str],
    span_seconds: int,
    min_fails: int,
    fail: str = "fail",
    slices: int | None = None,
) -> DataFrame:
    """Fails gathered from a first one for ``span_seconds``, reported from ``min_fails`` on.

    A non-fail before the span is over drops what has been gathered. The next burst
    starts at the first fail after that or after the span. Times count in whole
    seconds; an event exactly ``span_seconds`` after the first is still inside.

    Rows are cut into pieces at non-fails and at gaps above the span, after which a burst
    always begins anew; both are window built-ins over sliced keys. A piece is reduced to
    one row per second before it is walked, so a task walks the seconds of a piece, not its
    rows. Seconds of a piece are at most ``span_seconds`` apart.
    """
    failed = F.col(kind) == fail
    previous = ordered.previous_row(
        events.select(key, kind, time, *[o for o in order if o != time]), [key], order, [time], "_prev", slices
    )
    seconds = F.unix_seconds(F.col(time).cast("timestamp"))
    gap = seconds - F.unix_seconds(F.col(f"_prev.{time}").cast("timestamp")) > span_seconds
    starts = F.when(~failed | F.coalesce(gap, F.lit(False)), 1).otherwise(0).cast("long")
    cut = previous.withColumn("_cut", starts).drop("_prev")
    numbered = ordered.running_sum(cut, [key], order, F.col("_cut"), "_run", slices)
    # A non-fail ends the piece before it, unless a gap has done so; its place tells.
    per_second = (
        numbered.withColumn("_run", F.when(failed, F.col("_run")).otherwise(F.col("_run") - 1))
        .withColumn("_t", F.unix_seconds(F.col(time).cast("timestamp")))
        .groupBy(key, "_run", "_t")
        .agg(F.count_if(failed).alias("_n"), F.count_if(~failed).alias("_stop"))
    )
    whole = Window.partitionBy(key, "_run")
    walked = (
        per_second.withColumn("_fails", F.sum("_n").over(whole))
        .where(F.col("_fails") >= min_fails)
        .repartition(key, "_run")
        .sortWithinPartitions(key, "_run", "_t")
        .select(key, "_run", "_t", "_n", "_stop")
    )
    schema = T.StructType(
        [
            T.StructField(key, events.schema[key].dataType),
            T.StructField("first_fail", T.LongType()),
            T.StructField("last_fail", T.LongType()),
            T.StructField("fails", T.LongType()),
        ]
    )

    def walk(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        group, burst = None, None
        for batch in batches:
            found = []
            for user, run, t, n, stop in zip(*(batch[c].tolist() for c in batch.columns)):
                if group != (user, run):
                    found.append(burst)
                    group, burst = (user, run), None
                if burst is not None and t > burst[1] + span_seconds:
                    found.append(burst)
                    burst = None
                if n:
                    burst = (user, t, t, n) if burst is None else (user, burst[1], t, burst[3] + n)
                if stop:
                    burst = None
            yield reported(found)
        yield reported([burst])

    def reported(bursts: list[tuple | None]) -> pd.DataFrame:
        enough = [b for b in bursts if b is not None and b[3] >= min_fails]
        return pd.DataFrame(enough, columns=schema.names)

    time_type = events.schema[time].dataType
    return walked.mapInPandas(walk, schema).withColumns(
        {c: F.timestamp_seconds(c).cast(time_type) for c in ("first_fail", "last_fail")}
    )
