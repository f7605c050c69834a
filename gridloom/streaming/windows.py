"""Windowed aggregation of events with watermarks: the same function serves streams and tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

EVENTS = "event_id long, ts timestamp, user_id long, event_type string, value double, props string"


def read_events(spark: SparkSession, path: str, per_trigger: int = 10) -> DataFrame:
    """A stream of the event files that appear under a folder."""
    return spark.readStream.schema(EVENTS).option("maxFilesPerTrigger", per_trigger).parquet(path)


def _measures() -> list:
    return [F.count("*").alias("n"), F.sum("value").alias("total"), F.min("value").alias("low"), F.max("value").alias("high")]


def windowed(events: DataFrame, size: str, step: str | None = None, late: str = "10 minutes", keys: tuple[str, ...] = ("event_type",)) -> DataFrame:
    """Tumbling (or, with a step, sliding) windows by key; events later than the watermark are left out of a stream."""
    events = events.withWatermark("ts", late) if events.isStreaming else events
    w = F.window("ts", size, step) if step else F.window("ts", size)
    out = events.groupBy(w, *keys).agg(*_measures())
    return out.select(F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"), *keys, "n", "total", "low", "high")


def sessions(events: DataFrame, gap: str, late: str = "10 minutes", key: str = "user_id") -> DataFrame:
    """Runs of a key's events with no pause of ``gap``."""
    events = events.withWatermark("ts", late) if events.isStreaming else events
    out = events.groupBy(F.session_window("ts", gap).alias("s"), key).agg(*_measures())
    return out.select(key, F.col("s.start").alias("session_start"), F.col("s.end").alias("session_end"), "n", "total", "low", "high")


def deduplicated(events: DataFrame, late: str = "10 minutes") -> DataFrame:
    """Each event id once, with bounded state on a stream."""
    return events.withWatermark("ts", late).dropDuplicatesWithinWatermark(["event_id"]) if events.isStreaming else events.dropDuplicates(["event_id"])
