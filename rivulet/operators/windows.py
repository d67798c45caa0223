"""Event-time windows (T01-T06). The same function serves tables and streams."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def windowed(
    df: DataFrame,
    time: str,
    size: str,
    aggregates: dict[str, Column],
    keys: Sequence[str] = (),
    slide: str | None = None,
    watermark: str | None = None,
) -> DataFrame:
    """Aggregates per window and key with the window's start and end.

    Windows are aligned to the epoch. ``watermark`` bounds lateness on a stream.
    """
    if watermark:
        df = df.withWatermark(time, watermark)
    window = F.window(time, size, slide) if slide else F.window(time, size)
    return (
        df.groupBy(window.alias("_w"), *keys)
        .agg(*[c.alias(n) for n, c in aggregates.items()])
        .select(
            F.col("_w.start").alias("window_start"),
            F.col("_w.end").alias("window_end"),
            *keys,
            *aggregates,
        )
    )


def on_clock(df: DataFrame, clock: Column | None = None, into: str = "clock") -> DataFrame:
    """Stamp rows with processing time; pass ``clock`` to replay a known one."""
    return df.withColumn(into, F.current_timestamp() if clock is None else clock)


def whole_window_sum(
    df: DataFrame, time: str, size: str, value: Column, label: str, seq: str
) -> DataFrame:
    """One row per window over all keys: the sum, labelled with the first row's key."""
    return windowed(df, time, size, {label: F.min_by(label, seq), "total": F.sum(value)})
