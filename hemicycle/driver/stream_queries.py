"""Event-time windows of the given events, replayed as a stream."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hemicycle.driver.registry import add
from hemicycle.driver.roles import read_source
from hemicycle.session import work_dir
from hemicycle.streaming.windows import Windows, run, windowed

DELAY = "1 hour"


def _replayed(windows: Windows, by: str):
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        folder = work_dir(spark)
        source = read_source(spark, sf_dir, "events")
        # one file a batch is a stream's usual order; the given table is a single file, and so a single batch
        stream = spark.readStream.schema(source.schema).option("pathGlobFilter", "events.parquet").parquet(sf_dir)
        cells = [F.count("*").alias("n"), F.max("value").alias("largest")]
        run(windowed(stream, "ts", windows, [by], cells, DELAY), f"{folder}/rows", f"{folder}/state")
        rows = spark.read.parquet(f"{folder}/rows")
        return rows.select(*(F.col(c).cast("string") for c in ("window_start", "window_end")), by, "n", "largest")

    return query


_CLOSED = "window_end <= (SELECT max(ts) - INTERVAL 1 HOUR FROM events)"
_TEXT = "CAST(window_start AS VARCHAR) AS window_start, CAST(window_end AS VARCHAR) AS window_end"
add(
    "event_windows_tumbling",
    _replayed(Windows("6 hours"), "event_type"),
    f"""WITH w AS (SELECT time_bucket(INTERVAL 6 HOURS, ts, TIMESTAMP '1970-01-01') AS window_start, event_type, count(*) AS n, max(value) AS largest FROM events GROUP BY ALL),
    x AS (SELECT *, window_start + INTERVAL 6 HOURS AS window_end FROM w)
    SELECT {_TEXT}, event_type, n, largest FROM x WHERE {_CLOSED}""",
)
add(
    "event_windows_sliding",
    _replayed(Windows("6 hours", "2 hours"), "event_type"),
    f"""WITH s AS (SELECT time_bucket(INTERVAL 2 HOURS, ts, TIMESTAMP '1970-01-01') - INTERVAL 2 HOURS * k AS window_start, event_type, value
      FROM events, unnest([0, 1, 2]) AS u(k)),
    x AS (SELECT window_start, window_start + INTERVAL 6 HOURS AS window_end, event_type, count(*) AS n, max(value) AS largest FROM s GROUP BY ALL)
    SELECT {_TEXT}, event_type, n, largest FROM x WHERE {_CLOSED}""",
)
add(
    "event_windows_sessions",
    _replayed(Windows(gap="3 hours"), "user_id"),
    f"""WITH g AS (SELECT *, CASE WHEN ts < lag(ts) OVER (PARTITION BY user_id ORDER BY ts) + INTERVAL 3 HOURS THEN 0 ELSE 1 END AS opens FROM events),
    s AS (SELECT *, sum(opens) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS session FROM g),
    x AS (SELECT user_id, session, min(ts) AS window_start, max(ts) + INTERVAL 3 HOURS AS window_end, count(*) AS n, max(value) AS largest FROM s GROUP BY ALL)
    SELECT {_TEXT}, user_id, n, largest FROM x WHERE {_CLOSED}""",
)
