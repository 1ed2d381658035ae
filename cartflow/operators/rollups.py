"""Roll-ups behind the declared-but-unfilled tables.

Columns follow the table definitions; the formulas are ours:
trending = views last hour + 3 x carts last hour + 5 x purchases last hour;
momentum = last-hour revenue / mean revenue per active hour;
purchase_frequency = purchases / max(1, active days);
churn_risk_score = mean predicted probability x 100;
revenue counts purchases at price x quantity.
Every roll-up is a grouped aggregate on its key; modes use a deterministic
tie-break (highest count, then smallest name).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartflow import constants as K
from cartflow.functions.exprs import pct, round_half_up, since
from cartflow.operators.outcomes import attribute_recovery, match_event


def c(name: str) -> Column:
    return F.col(name)


def _cw(cond: Column) -> Column:
    return F.count(F.when(cond, F.lit(1)))


def _amount() -> Column:
    return F.coalesce(c("price"), F.lit(0.0)).cast("decimal(12,2)") * \
        F.coalesce(c("quantity"), F.lit(1)).cast("decimal(10,0)")


def _window(ts: Column, as_of: str, hours: int) -> Column:
    return (ts >= F.to_timestamp(F.lit(as_of)) - F.make_interval(hours=F.lit(hours))) & \
        (ts <= F.to_timestamp(F.lit(as_of)))


def _mode(df: DataFrame, key: str, value: str, name: str) -> DataFrame:
    counts = df.filter(c(value).isNotNull()).groupBy(key, value).agg(F.count(F.lit(1)).alias("_n"))
    return counts.groupBy(key).agg(F.min_by(value, F.struct((-c("_n")).alias("n"), c(value).alias("v"))).alias(name))


def user_profiles(sess: DataFrame, ev: DataFrame, preds: DataFrame, as_of: str) -> DataFrame:
    """Lifetime, RFM, preference and risk metrics per user."""
    s = sess.groupBy("user_id").agg(
        F.count(F.lit(1)).alias("total_sessions"),
        F.sum("page_views").alias("total_page_views"),
        F.sum("products_viewed").alias("total_products_viewed"),
        round_half_up(F.try_divide(F.sum("session_duration_seconds").cast("double"),
                                   F.count(F.lit(1)).cast("double")), 2).alias("avg_session_duration"),
        F.sum("session_duration_seconds").alias("total_time_on_site"),
        F.sum("cart_additions").alias("total_cart_additions"),
        _cw(c("is_cart_abandoned")).alias("total_cart_abandonments"),
        _cw(c("cart_additions") > 0).alias("_cart_sessions"),
        F.count_distinct(F.to_date("start_time")).alias("_active_days"),
        F.min("start_time").alias("first_seen"),
        F.max("last_activity").alias("last_seen"))
    buys = ev.filter(c("event_type") == "purchase").groupBy("user_id").agg(
        F.count(F.lit(1)).alias("total_purchases"),
        F.sum(F.coalesce(c("cart_value"), F.lit(0.0)).cast("decimal(18,2)")).alias("_revenue"),
        F.max("ts").alias("_last_purchase"))
    risk = preds.groupBy("user_id").agg(
        F.sum(c("abandonment_probability").cast("decimal(18,4)")).alias("_psum"),
        F.count("abandonment_probability").alias("_pn"))
    fav = _mode(ev.filter(c("event_type").isin("product_view", "add_to_cart", "purchase")),
                "user_id", "category", "favorite_category")
    dev = _mode(sess, "user_id", "device_type", "device_preference")
    j = s.join(buys, "user_id", "left").join(risk, "user_id", "left") \
         .join(fav, "user_id", "left").join(dev, "user_id", "left")
    as_of_d = F.to_date(F.to_timestamp(F.lit(as_of)))
    purchases = F.coalesce(c("total_purchases"), F.lit(0))
    revenue = F.coalesce(c("_revenue"), F.lit(0).cast("decimal(18,2)"))
    return j.select(
        "user_id", "total_sessions", "total_page_views", "total_products_viewed",
        purchases.alias("total_purchases"),
        round_half_up(revenue, 2).alias("total_revenue"),
        F.coalesce(round_half_up(F.try_divide(revenue.cast("double"), purchases.cast("double")), 2),
                   F.lit(0.0)).alias("avg_order_value"),
        "avg_session_duration", "total_time_on_site", "total_cart_additions", "total_cart_abandonments",
        F.coalesce(pct("total_cart_abandonments", "_cart_sessions"), F.lit(0.0)).alias("cart_abandonment_rate"),
        F.datediff(as_of_d, F.to_date("last_seen")).alias("days_since_last_visit"),
        F.datediff(as_of_d, F.to_date("_last_purchase")).alias("days_since_last_purchase"),
        round_half_up(purchases.cast("double") / F.greatest(F.lit(1), c("_active_days")).cast("double"), 2)
        .alias("purchase_frequency"),
        "favorite_category", "device_preference",
        F.coalesce(round_half_up(F.try_divide(c("_psum").cast("double") * 100.0, c("_pn").cast("double")), 2),
                   F.lit(0.0)).alias("churn_risk_score"),
        "first_seen", "last_seen")


def product_metrics(ev: DataFrame, as_of: str) -> DataFrame:
    """R2: per product views, carts, purchases (total and recent), revenue, rates, trending."""
    et = c("event_type")
    p = ev.filter(c("product_id").isNotNull())
    view, add, buy = et == "product_view", et == "add_to_cart", et == "purchase"
    hour, day = _window(c("ts"), as_of, 1), _window(c("ts"), as_of, 24)
    g = p.groupBy("product_id").agg(
        F.min("category").alias("category"),
        round_half_up(F.max_by("price", F.struct("ts", "event_id")), 2).alias("price"),
        _cw(view).alias("total_views"), _cw(view & hour).alias("views_last_hour"),
        _cw(view & day).alias("views_last_day"),
        _cw(add).alias("total_cart_additions"), _cw(add & hour).alias("cart_additions_last_hour"),
        _cw(buy).alias("total_purchases"), _cw(buy & hour).alias("purchases_last_hour"),
        round_half_up(F.sum(F.when(buy, _amount())), 2).alias("total_revenue"),
        F.max(F.when(view, c("ts"))).alias("last_viewed"),
        F.max(F.when(buy, c("ts"))).alias("last_purchased"))
    g = g.withColumn("total_revenue", F.coalesce(c("total_revenue"), F.lit(0.0)))
    return g.select(
        "*",
        F.coalesce(pct("total_cart_additions", "total_views"), F.lit(0.0)).alias("view_to_cart_rate"),
        F.coalesce(pct("total_purchases", "total_cart_additions"), F.lit(0.0)).alias("cart_to_purchase_rate"),
        F.coalesce(pct("total_purchases", "total_views"), F.lit(0.0)).alias("overall_conversion_rate"),
        (c("views_last_hour") + 3 * c("cart_additions_last_hour") + 5 * c("purchases_last_hour"))
        .cast("double").alias("trending_score"))


def category_metrics(ev: DataFrame, as_of: str) -> DataFrame:
    """Per category totals, last hour, conversion, order value and momentum."""
    et = c("event_type")
    view, buy = et == "product_view", et == "purchase"
    hour = _window(c("ts"), as_of, 1)
    g = ev.filter(c("category").isNotNull()).groupBy("category").agg(
        _cw(view).alias("total_views"), _cw(buy).alias("total_purchases"),
        F.sum(F.when(buy, _amount())).alias("_rev"),
        _cw(view & hour).alias("views_last_hour"), _cw(buy & hour).alias("purchases_last_hour"),
        F.sum(F.when(buy & hour, _amount())).alias("_rev_h"),
        F.count_distinct(F.when(buy, F.date_trunc("hour", "ts"))).alias("_active_hours"))
    rev = F.coalesce(c("_rev"), F.lit(0).cast("decimal(18,2)"))
    rev_h = F.coalesce(c("_rev_h"), F.lit(0).cast("decimal(18,2)"))
    return g.select(
        "category", "total_views", "total_purchases", round_half_up(rev, 2).alias("total_revenue"),
        "views_last_hour", "purchases_last_hour", round_half_up(rev_h, 2).alias("revenue_last_hour"),
        F.coalesce(pct("total_purchases", "total_views"), F.lit(0.0)).alias("conversion_rate"),
        F.coalesce(round_half_up(F.try_divide(rev.cast("double"), c("total_purchases").cast("double")), 2),
                   F.lit(0.0)).alias("avg_order_value"),
        F.coalesce(round_half_up(F.try_divide(rev_h.cast("double") * c("_active_hours").cast("double"),
                                              rev.cast("double")), 2), F.lit(0.0)).alias("momentum_score"))


def cart_abandonments(ev: DataFrame, sess: DataFrame, preds: DataFrame) -> DataFrame:
    """One row per abandonment with cart, context, latest prediction and recovery."""
    rec = attribute_recovery(ev)
    anchors = rec.withColumn("ts", c("abandonment_time")).withColumn("event_id", c("abandonment_event_id"))
    p = preds.select("session_id", c("prediction_timestamp").alias("ts"), c("prediction_id").alias("event_id"),
                     "abandonment_probability", "intervention_triggered", "intervention_type")
    m = match_event(anchors, p, ["abandonment_probability", "intervention_triggered", "intervention_type"],
                    "pred_", direction="prev")
    s = sess.select("session_id", "session_duration_seconds", "page_views", "device_type", "checkout_initiated",
                    "persona", "cart_additions", "cart_removals")
    j = m.join(s, "session_id", "left")
    return j.select(
        "abandonment_event_id", "session_id", "user_id", "cart_value",
        F.greatest(c("cart_additions") - c("cart_removals"), F.lit(0)).alias("item_count"),
        "abandonment_time", c("session_duration_seconds").alias("session_duration"),
        c("page_views").alias("pages_viewed"), "abandonment_reason", "time_in_cart_seconds", "device_type",
        "checkout_initiated", "persona",
        round_half_up(c("pred_abandonment_probability") * 100, 2).alias("churn_probability"),
        F.coalesce(c("pred_intervention_triggered"), F.lit(False)).alias("intervention_triggered"),
        c("pred_intervention_type").alias("intervention_type"),
        "recovered", "recovery_time", "recovery_value")


def recent_events(ev: DataFrame, as_of: str, days: int = K.RECENT_EVENTS_RETENTION_DAYS) -> DataFrame:
    """The recent-events log, keeping the last ``days`` days before ``as_of``."""
    value = F.coalesce(c("cart_value"), c("price").cast("decimal(12,2)") * F.coalesce(c("quantity"), F.lit(1)))
    return ev.filter(since("ts", days * 24, as_of)).select(
        "event_id", c("ts").alias("timestamp"), "event_type", "user_id", "session_id", "product_id", "category",
        round_half_up(value, 2).alias("event_value"), "device_type")
