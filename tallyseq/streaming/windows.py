"""Event-time operators that give the same rows on a table and on a stream."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def windowed_counts(events: DataFrame, ts: str, keys: list[str], value: str, width: str, slide: str | None = None, late: str = "10 minutes") -> DataFrame:
    """(window_start, keys, n, total) per window; on a stream rows later than the watermark are dropped."""
    rows = events.withWatermark(ts, late) if events.isStreaming else events
    w = F.window(ts, width, slide) if slide else F.window(ts, width)
    return rows.groupBy(w.alias("w"), *keys).agg(F.count("*").alias("n"), F.sum(value).alias("total")).select(F.col("w.start").alias("window_start"), *keys, "n", "total")


def sessions(events: DataFrame, ts: str, key: str, gap: str, late: str = "10 minutes") -> DataFrame:
    """(key, session_start, session_end, n) of events with gaps below `gap`."""
    rows = events.withWatermark(ts, late) if events.isStreaming else events
    return rows.groupBy(F.session_window(ts, gap).alias("w"), key).agg(F.count("*").alias("n")).select(key, F.col("w.start").alias("session_start"), F.col("w.end").alias("session_end"), "n")
