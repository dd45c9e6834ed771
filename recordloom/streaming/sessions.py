"""Idle-gap sessions and repeated events on a stream."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

# Fixed value: a session ends after two hours without activity.
IDLE_GAP = "2 hours"


#: Sessions of a table are first formed within stretches of so many seconds.
STRETCH = 6 * 3600


def stream_sessions(log: DataFrame, user: str, ts: str, late: str = "10 minutes", gap: str = IDLE_GAP) -> DataFrame:
    """Sessions ``(user, session_start, session_end, events)``; works on a stream and on a
    table.

    On a stream a session is emitted once the watermark has passed its end, and state of
    closed sessions is dropped; a task holds one user's open sessions and the events of one micro-batch.  On a table, events
    are first merged within stretches of time, so a busy user is many groups; what is then merged per
    user are stretches, whose number follows the time covered and not the events.
    """
    timed = log.withColumn(ts, F.col(ts).cast("timestamp"))
    if timed.isStreaming:
        timed = timed.withWatermark(ts, late)
        return timed.groupBy(F.session_window(ts, gap).alias("w"), F.col(user)).agg(F.count(F.lit(1)).alias("events")).select(
            user, F.col("w.start").alias("session_start"), F.col("w.end").alias("session_end"), "events"
        )
    parts = timed.filter(F.col(ts).isNotNull()).groupBy(
        F.session_window(ts, gap).alias("w"), F.floor(F.unix_timestamp(ts) / STRETCH).alias("s"), F.col(user)).agg(F.count(F.lit(1)).alias("n"))
    by_user = Window.partitionBy(user).orderBy("w.start")
    starts = F.coalesce(F.lag("w.end").over(by_user) <= F.col("w.start"), F.lit(True))
    numbered = parts.withColumn("_new", starts.cast("int")).withColumn("_session", F.sum("_new").over(by_user))
    return numbered.groupBy(user, "_session").agg(
        F.min("w.start").alias("session_start"), F.max("w.end").alias("session_end"), F.sum("n").alias("events")).drop("_session")


def once_per_key(stream: DataFrame, keys: Sequence[str], ts: str, late: str = "1 hour") -> DataFrame:
    """Let each key pass once; keys are forgotten ``late`` after their event time, so the
    state stays bounded."""
    timed = stream.withColumn(ts, F.col(ts).cast("timestamp")).withWatermark(ts, late)
    return timed.dropDuplicatesWithinWatermark(list(keys))
