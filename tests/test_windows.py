"""Event-time windows: a replayed stream equals the batch, goes on after a stop, and drops late rows."""

from __future__ import annotations

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from hemicycle.streaming.windows import Windows, closed, run, windowed

KINDS = {"tumbling": Windows("1 hour"), "sliding": Windows("1 hour", "20 minutes"), "sessions": Windows(gap="25 minutes")}
START = datetime(2024, 1, 1)
SCHEMA = "at timestamp, who string, n int"


def rows(first: int, last: int, step: int = 7):
    return [(START + timedelta(minutes=m), "ab"[m % 3 == 0], m) for m in range(first, last, step) if not 120 <= m % 300 < 180] + [(None, "a", 1)]


def cells():
    return [F.count("*").alias("rows"), F.sum("n").alias("total")]


def as_set(df) -> set:
    found = [tuple(r) for r in df.collect()]
    assert len(found) == len(set(found))
    return set(found)


@pytest.mark.parametrize("kind", KINDS)
def test_a_stream_that_is_stopped_equals_the_batch(spark, tmp_path, kind):
    source, out, state = (str(tmp_path / x) for x in ("in", "out", "state"))
    stream = lambda: windowed(spark.readStream.schema(SCHEMA).parquet(source), "at", KINDS[kind], ["who"], cells(), "10 minutes")
    for first, last in ((0, 400), (400, 800), (800, 1500)):
        spark.createDataFrame(rows(first, last), SCHEMA).coalesce(1).write.mode("append").parquet(source)
        run(stream(), out, state)  # a new run each time, from the state that the last one left
        batch = spark.read.parquet(source)
        expected = closed(windowed(batch, "at", KINDS[kind], ["who"], cells(), "10 minutes"), batch, "at", "10 minutes")
        assert as_set(spark.read.parquet(out)) == as_set(expected) != set()
    before = as_set(spark.read.parquet(out))
    run(stream(), out, state)  # nothing new, nothing twice
    assert as_set(spark.read.parquet(out)) == before


def test_late_rows_are_dropped_and_others_counted(spark, tmp_path):
    source, out, state = (str(tmp_path / x) for x in ("in", "out", "state"))
    stream = lambda: windowed(spark.readStream.schema(SCHEMA).parquet(source), "at", KINDS["tumbling"], ["who"], cells(), "2 hours")
    add = lambda *minutes: spark.createDataFrame([(START + timedelta(minutes=m), "a", m) for m in minutes], SCHEMA).coalesce(1).write.mode("append").parquet(source)
    add(5, 10, 300)
    run(stream(), out, state)
    add(20, 200, 600)  # the first is behind the watermark of 3 o'clock, the second is in time
    run(stream(), out, state)
    found = {(r.window_start.hour, r["rows"], r.total) for r in spark.read.parquet(out).collect()}
    assert found == {(0, 2, 15), (3, 1, 200), (5, 1, 300)}


def test_closed_windows_of_nothing(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert closed(windowed(none, "at", KINDS["sliding"], ["who"], cells(), "1 minute"), none, "at", "1 minute").count() == 0
