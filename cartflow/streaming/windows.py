"""Windowed counts and event-id de-duplication on streams."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def hopping_counts(events: DataFrame, size: str = "5 minutes", slide: str = "1 minute",
                   watermark: str = "10 minutes") -> DataFrame:
    """Events per type in sliding windows (the 300 s / 60 s buffer)."""
    w = F.window("ts", size, slide)
    return (events.withWatermark("ts", watermark).groupBy(w.alias("w"), "event_type")
            .agg(F.count(F.lit(1)).alias("events"))
            .select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"),
                    "event_type", "events"))


def sliding_by_key(events: DataFrame, size: str = "5 minutes", slide: str = "1 minute", watermark: str = "10 minutes",
                   salts: int = 16) -> DataFrame:
    """Events of each key (T4) in sliding windows, each event counted once.

    Panes of one slide are counted first, and every window sums its panes, so
    only a pane, not each event, goes to several windows.  Events without a
    session and user share the key 'unknown', whose panes are counted in
    ``salts`` parts.  Panes and windows behind the watermark leave the state
    (append mode).
    """
    from cartflow.sources.events import event_key
    key = event_key(F.col("session_id"), F.col("user_id"))
    ev = events.select("ts", key.alias("key"), "event_id").withWatermark("ts", watermark)
    salt = F.when(F.col("key") == "unknown", F.pmod(F.xxhash64("event_id", "ts"), F.lit(salts))).otherwise(0)
    panes = ev.groupBy(F.window("ts", slide).alias("pane"), "key", salt.alias("salt")) \
        .agg(F.count(F.lit(1)).alias("n"))
    w = F.window(F.window_time("pane"), size, slide)
    return (panes.groupBy(w.alias("w"), "key").agg(F.sum("n").alias("events"))
            .select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "key", "events"))


def hourly_tumbling(events: DataFrame, watermark: str = "10 minutes") -> DataFrame:
    """Events per type and hour (tumbling window)."""
    return (events.withWatermark("ts", watermark).groupBy(F.window("ts", "1 hour").alias("w"), "event_type")
            .agg(F.count(F.lit(1)).alias("events"))
            .select(F.col("w.start").alias("hour"), "event_type", "events"))


def dedup_events(events: DataFrame, watermark: str = "10 minutes") -> DataFrame:
    """Drop re-delivered events (same event id) within the watermark."""
    return events.withWatermark("ts", watermark).dropDuplicatesWithinWatermark(["event_id"])
