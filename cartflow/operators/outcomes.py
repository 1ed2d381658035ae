"""Time-ordered joins: outcome labelling (J4), recovery (J6), idle abandonment.

Each "first event of kind B after event A in the same session" is a reverse
segmented scan over the union of A and B rows, not a range self-join: no
pairs are materialised and a hot session is split by time bucket.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartflow import constants as K
from cartflow.functions.exprs import round_half_up, seconds_between
from cartflow.operators.scan import segmented_scan, time_bucket

BUCKET_SECONDS = 3600


def match_event(anchors: DataFrame, targets: DataFrame, target_cols: list[str], prefix: str,
                key: str = "session_id", direction: str = "next",
                bucket_seconds: int = BUCKET_SECONDS) -> DataFrame:
    """For every anchor row, the nearest target row in time within ``key``.

    ``direction="next"``: first target strictly after the anchor;
    ``direction="prev"``: last target at or before it.  Both inputs need
    ``key, ts, event_id``; the target's ``ts, event_id`` and ``target_cols``
    are added with ``prefix`` (NULL when there is none).
    """
    tgt_struct = F.struct(F.col("ts"), F.col("event_id"),
                          *[F.col(c) for c in target_cols])
    a = anchors.select(key, "ts", F.col("event_id"), F.lit(1).alias("_kind"),
                       F.struct(*[F.col(c) for c in anchors.columns]).alias("_payload"))
    t = targets.select(key, "ts", F.col("event_id"), F.lit(0).alias("_kind"),
                       tgt_struct.alias("_tgt"))
    a = a.withColumn("_tgt", F.lit(None).cast(t.schema["_tgt"].dataType))
    t = t.withColumn("_payload", F.lit(None).cast(a.schema["_payload"].dataType))
    u = a.unionByName(t).withColumn("_nb", time_bucket("ts", bucket_seconds))
    # Ordered by (ts, event_id, kind) with targets (kind 0) first at a tie:
    # scanning forward a tied target counts as "at or before"; scanning
    # backward the anchor is visited first, so only strictly later targets count.
    s = segmented_scan(u, [key], ["ts", "event_id", "_kind"], "_nb",
                       lasts={"_m": F.col("_tgt")}, descending=(direction == "next"))
    s = s.filter(F.col("_kind") == 1)
    return s.select("_payload.*", *[F.col(f"_m.{c}").alias(f"{prefix}{c}") for c in ["ts", "event_id", *target_cols]])


def next_match(anchors: DataFrame, targets: DataFrame, key: str = "session_id") -> DataFrame:
    """First target (with a ``value`` column) strictly after each anchor: next_ts, next_event_id, next_value."""
    return match_event(anchors, targets, ["value"], "next_", key, "next")


def label_outcomes(preds: DataFrame, ev: DataFrame) -> DataFrame:
    """Set actual_outcome and was_prediction_correct on predictions.

    A purchase strictly after the prediction marks it 'converted' (correct if
    it predicted no abandonment); an abandonment marks every still-open
    prediction 'abandoned' (correct if it predicted abandonment), and the flag
    is sticky: a prediction made after the session's first abandonment is
    'abandoned' at once.  The earlier outcome wins; predictions with neither
    stay open (NULL).
    """
    anchors = preds.withColumn("ts", F.col("prediction_timestamp")) \
                   .withColumn("event_id", F.col("prediction_id"))
    buys = ev.filter(F.col("event_type") == "purchase").select(
        "session_id", "ts", "event_id", F.coalesce(F.col("cart_value"), F.lit(0.0)).alias("value"))
    nm = next_match(anchors, buys)
    first_ab = ev.filter(F.col("event_type") == "cart_abandoned").groupBy("session_id").agg(
        F.min(F.struct("ts", "event_id")).alias("_fa"))
    j = nm.join(first_ab, "session_id", "left")
    me = F.struct(F.col("ts"), F.col("event_id"))
    nxt = F.struct(F.col("next_ts").alias("ts"), F.col("next_event_id").alias("event_id"))
    fa = F.col("_fa")
    abandoned = fa.isNotNull() & ((fa <= me) | F.col("next_ts").isNull() | (fa < nxt))
    outcome = F.when(abandoned, F.lit("abandoned")).when(F.col("next_ts").isNotNull(), F.lit("converted"))
    j = j.withColumn("actual_outcome", outcome)
    j = j.withColumn("was_prediction_correct",
                     F.when(F.col("actual_outcome").isNull(), F.lit(None).cast("boolean"))
                     .otherwise((F.col("actual_outcome") == "abandoned") == F.col("predicted_abandoned")))
    return j.drop("ts", "event_id", "next_ts", "next_event_id", "next_value", "_fa")


def attribute_recovery(ev: DataFrame, min_delay_seconds: int = K.RECOVERY_DELAY_MIN_SECONDS) -> DataFrame:
    """For every cart abandonment, whether the session's next purchase recovered it.

    Recovered when the first purchase after the abandonment comes at least
    ``min_delay_seconds`` later; then recovery time, seconds and value are set.
    """
    ab = ev.filter(F.col("event_type") == "cart_abandoned").select(
        "session_id", "user_id", "ts", "event_id", "cart_value", "abandonment_reason", "time_in_cart_seconds")
    buys = ev.filter(F.col("event_type") == "purchase").select(
        "session_id", "ts", "event_id", F.coalesce(F.col("cart_value"), F.lit(0.0)).alias("value"))
    nm = next_match(ab, buys)
    gap = seconds_between("ts", "next_ts")
    rec = F.col("next_ts").isNotNull() & (gap >= min_delay_seconds)
    return nm.select(
        "session_id", "user_id", F.col("event_id").alias("abandonment_event_id"),
        F.col("ts").alias("abandonment_time"),
        round_half_up(F.coalesce(F.col("cart_value"), F.lit(0.0)), 2).alias("cart_value"),
        "abandonment_reason", "time_in_cart_seconds",
        F.coalesce(rec, F.lit(False)).alias("recovered"),
        F.when(rec, F.col("next_ts")).alias("recovery_time"),
        F.when(rec, gap).alias("recovery_seconds"),
        F.when(rec, round_half_up("next_value", 2)).alias("recovery_value"))


def detect_abandonment(snap: DataFrame, as_of: str, idle_seconds: int = K.CART_ABANDONMENT_IDLE_SECONDS,
                       bucket_seconds: int = BUCKET_SECONDS) -> DataFrame:
    """T6 (batch twin): carts left idle.

    After an event the session has a non-empty cart, no purchase yet, and no
    further event for ``idle_seconds`` (the next event, or ``as_of`` if none,
    is at least that far away): a cart abandonment is detected at
    ``ts + idle_seconds``.  Each idle gap is one detection.
    """
    s = snap.withColumn("_nb", time_bucket("ts", bucket_seconds))
    s = segmented_scan(s, ["session_id"], ["ts", "event_id"], "_nb",
                       prevs={"_next_ts": F.col("ts")}, descending=True)
    horizon = F.coalesce(F.col("_next_ts"), F.to_timestamp(F.lit(as_of)))
    idle = seconds_between("ts", horizon)
    hit = (F.col("cart_value") > 0) & ~F.col("is_converted") & (idle >= idle_seconds)
    d = s.filter(hit)
    detected = F.col("ts") + F.make_interval(secs=F.lit(idle_seconds))
    return d.select(
        "session_id", "user_id", F.col("event_id").alias("last_event_id"),
        F.col("ts").alias("last_activity"), detected.alias("detected_at"),
        "cart_value",
        F.greatest(F.col("cart_additions") - F.col("cart_removals"), F.lit(0)).alias("items_count"),
        F.col("_next_ts").alias("next_activity"))
