"""Assign session ids from an inactivity gap."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cartflow.operators.scan import time_bucket


def sessionize(ev: DataFrame, gap_seconds: int = 12 * 3600, user_col: str = "user_id",
               ts_col: str = "ts", tie_col: str = "event_id", bucket_seconds: int = 86400,
               prefix: str = "sess_") -> DataFrame:
    """Give every event a ``session_id``.

    A new session starts at a user's first event and whenever the gap to the
    user's previous event (ordered by ts, then event id) is ``>= gap_seconds``.
    ``session_id = <prefix><user>_<n>`` with n counting sessions from 1.

    One pass, skew-safe: windows run inside ``(user, day)``.  Inside a day
    the gap test uses ``lag``; whether a day's first event opens a session
    depends only on the previous active day's last event, and the number of
    sessions opened before a day is a running sum over days.  Both come from a
    one-row-per-(user, day) table, so a user with a third of all events is
    still spread over one task per active day.
    """
    gap_us = gap_seconds * 1_000_000
    b = "_sz_b"
    df = ev.withColumn(b, time_bucket(ts_col, bucket_seconds))
    w = Window.partitionBy(user_col, b).orderBy(ts_col, tie_col)
    wrun = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    us = F.unix_micros(F.col(ts_col))

    prev = F.lag(us).over(w)
    local = df.select("*", prev.alias("_sz_prev"),
                      F.lead(F.lit(1)).over(w).isNull().alias("_sz_end"),
                      F.first(us).over(wrun).alias("_sz_first"))
    # Sessions opened inside the day by events other than its first one.
    opened = F.when(F.col("_sz_prev").isNotNull() & (us - F.col("_sz_prev") >= gap_us), 1).otherwise(0)
    local = local.select("*", F.sum(opened).over(wrun).alias("_sz_local"))

    days = local.filter(F.col("_sz_end")).select(
        user_col, b, F.col("_sz_first").alias("_d_first"), us.alias("_d_last"), F.col("_sz_local").alias("_d_local"))
    wd = Window.partitionBy(user_col).orderBy(b)
    prev_last = F.lag("_d_last").over(wd)
    days = days.select("*", F.when(prev_last.isNull() | (F.col("_d_first") - prev_last >= gap_us), 1)
                       .otherwise(0).alias("_d_opens"))
    days = days.select(user_col, b, "_d_opens",
                       F.coalesce(F.sum(F.col("_d_local") + F.col("_d_opens"))
                                  .over(wd.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_d_before"))

    out = local.join(days, [user_col, b], "inner")
    n = F.col("_d_before") + F.col("_d_opens") + F.col("_sz_local")
    out = out.withColumn("session_id", F.concat(F.lit(prefix), F.col(user_col).cast("string"), F.lit("_"),
                                                n.cast("string")))
    return out.drop(*[c for c in out.columns if c.startswith(("_sz_", "_d_"))])
