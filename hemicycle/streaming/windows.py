"""Aggregates over event-time windows of a stream, with a watermark for late rows.

The same plan serves a batch and a stream. In a stream the state holds one partial aggregate per key and open window;
a window is written once, when the watermark (the latest time seen, less the delay) has passed its end, and rows
that come later than that are dropped. A batch has no watermark, so `closed` gives the windows that a stream over the
same rows has written by its end, as long as no row came late.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Windows:
    """Windows of a fixed size, each `slide` after the last (tumbling without one), or sessions that end after a `gap`."""

    size: str | None = None
    slide: str | None = None
    gap: str | None = None

    def column(self, at: str) -> Column:
        if self.gap:
            return F.session_window(at, self.gap)
        return F.window(at, self.size, self.slide) if self.slide else F.window(at, self.size)


def windowed(events: DataFrame, at: str, windows: Windows, by: Sequence[str], aggregates: Sequence[Column], delay: str) -> DataFrame:
    """(window_start, window_end, keys, aggregates) of a batch or a stream. Rows without a time are left out.

    Times without a zone are taken in the session's. Windows of a fixed size are counted from the start of 1970 in UTC.
    """
    timed = events.filter(F.col(at).isNotNull()).withColumn(at, F.col(at).cast("timestamp")).withWatermark(at, delay)
    found = timed.groupBy(windows.column(at).alias("window"), *by).agg(*aggregates)
    return found.select(F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"), *found.columns[1:])


def closed(rows: DataFrame, events: DataFrame, at: str, delay: str) -> DataFrame:
    """Of windowed rows of a batch, those whose end the watermark has passed at the end of the events."""
    latest = events.agg((F.max(F.col(at).cast("timestamp")) - F.expr(f"INTERVAL {delay}")).alias("mark")).first()["mark"]
    if latest is None:
        return rows.filter(F.lit(False))
    # a plain condition on the end would be moved before the merging of sessions, where it cuts their last rows off
    return rows.filter(F.when(F.monotonically_increasing_id() >= 0, F.col("window_end") <= F.lit(latest)))


def run(rows: DataFrame, path: str, checkpoint: str) -> None:
    """Writes the closed windows of a stream of what is there now; a later run with the same checkpoint goes on from there.

    State and progress lie in the checkpoint folder, which all executors must reach, as must `path`; the sink commits each
    batch once, so a batch that is run again after a failure leaves no second copy.
    """
    query = rows.writeStream.format("parquet").outputMode("append").option("checkpointLocation", checkpoint).trigger(availableNow=True).start(path)
    query.awaitTermination()
