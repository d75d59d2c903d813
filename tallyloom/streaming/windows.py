"""Sessions and sliding windows: one plan for a table and for a stream.

On a stream a watermark bounds the state: a session is given out once it can't grow any more, and a
sliding window each time it changes, until it is too old to change.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _bounded(events: DataFrame, time: str, delay: str) -> DataFrame:
    return events.withWatermark(time, delay) if events.isStreaming else events


def sessions(events: DataFrame, user: str, time: str, gap: str = "30 minutes", delay: str = "1 hour") -> DataFrame:
    """Activity of each user between pauses longer than ``gap``.

    Sessions of equal neighbours are merged before the shuffle too, so a user with a third of all
    events sends one row per session and task. Events without user or time are in no session.
    """
    known = events.filter(F.col(user).isNotNull() & F.col(time).isNotNull())
    return (
        _bounded(known, time, delay)
        .groupBy(user, F.session_window(time, gap).alias("_session"))
        .agg(F.count(F.lit(1)).alias("events"), F.min(time).alias("first_at"), F.max(time).alias("last_at"))
        .select(user, "first_at", "last_at", F.col("_session.end").alias("ends_at"), "events")
    )


def sliding_counts(
    events: DataFrame, by: str, time: str, width: str = "1 hour", slide: str = "15 minutes", delay: str = "1 hour"
) -> DataFrame:
    """Events and their values per kind in overlapping windows."""
    known = events.filter(F.col(time).isNotNull())
    return (
        _bounded(known, time, delay)
        .groupBy(by, F.window(time, width, slide).alias("_window"))
        .agg(F.count(F.lit(1)).alias("events"), F.sum(F.col("value").cast("decimal(18,2)")).alias("value"))
        .select(by, F.col("_window.start").alias("begins_at"), F.col("_window.end").alias("ends_at"), "events", "value")
    )
