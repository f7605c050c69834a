"""Extras over the event table."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..streaming import windows
from . import query, table


@query("""SELECT time_bucket(INTERVAL '10 minutes', ts::TIMESTAMP) AS window_start, event_type, count(*) AS n, round(sum(value), 4) AS total, min(value) AS low, max(value) AS high FROM events GROUP BY 1, 2""")
def event_windows(spark, sf):
    w = windows.windowed(table(spark, sf, "events"), "10 minutes")
    return w.select(F.col("window_start").cast("timestamp_ntz").alias("window_start"), "event_type", "n", F.round("total", 4).alias("total"), "low", "high")


@query("""WITH g AS (SELECT *, CASE WHEN ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts) < INTERVAL '2 minutes' THEN 0 ELSE 1 END AS o FROM events), s AS (SELECT *, sum(o) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS k FROM g)
SELECT user_id, min(ts)::TIMESTAMP AS session_start, count(*) AS n, round(sum(value), 4) AS total FROM s GROUP BY user_id, k""")
def event_sessions(spark, sf):
    s = windows.sessions(table(spark, sf, "events"), "2 minutes")
    return s.select("user_id", F.col("session_start").cast("timestamp_ntz").alias("session_start"), "n", F.round("total", 4).alias("total"))
