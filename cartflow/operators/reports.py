"""Reports over session records, predictions and events.

All are declarative DataFrame plans: filters reach the scan, grouped
aggregates run partial/final, and global shares use a one-row aggregate that
is broadcast (its size is one row by construction).  Money is summed as
DECIMAL and averages are ``sum / count`` in double so results do not depend
on partitioning; every fractional output is rounded explicitly.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cartflow import constants as K
from cartflow.functions.exprs import is_high_risk, latency_verdict_avg, latency_verdict_p95, pct, risk_rank, \
    roi_label, round_half_up, since


def c(name: str) -> Column:
    return F.col(name)


def count_when(cond: Column) -> Column:
    return F.count(F.when(cond, F.lit(1)))


def money_sum(x: Column) -> Column:
    """Exact sum of a 2-decimal amount, as double."""
    return F.sum(x.cast("decimal(18,2)")).cast("double")


def money_avg(x: Column, digits: int = 4) -> Column:
    return round_half_up(F.try_divide(F.sum(x.cast("decimal(18,2)")).cast("double"),
                                      F.count(x).cast("double")), digits)


def num_avg(x: Column, digits: int = 4) -> Column:
    """Average of an integer column (exact sum), rounded."""
    return round_half_up(F.try_divide(F.sum(x.cast("long")).cast("double"), F.count(x).cast("double")), digits)


def prob_avg(x: Column, digits: int = 4) -> Column:
    """Average of 4-decimal probabilities (exact sum), rounded."""
    return round_half_up(F.try_divide(F.sum(x.cast("decimal(18,4)")).cast("double"),
                                      F.count(x).cast("double")), digits)


# --- P: projections and filters ----------------------------------------------

def abandonment_detail(sess: DataFrame) -> DataFrame:
    """The cart-abandonment analysis view, newest first."""
    return (sess.filter(c("is_cart_abandoned"))
            .select(F.to_date("start_time").alias("abandonment_date"),
                    F.hour("start_time").alias("abandonment_hour"),
                    (F.dayofweek("start_time") - 1).alias("day_of_week"),
                    "session_id", "user_id", "persona", "device_type", "cart_value",
                    c("cart_additions").alias("items_in_cart"), "abandonment_reason",
                    "time_in_cart_seconds", "checkout_initiated", "page_views",
                    "session_duration_seconds", "products_viewed", "start_time", "last_activity")
            .orderBy(c("start_time").desc_nulls_first(), "session_id"))


def high_value_abandoned(sess: DataFrame, min_value: float = 100.0, n: int = 10) -> DataFrame:
    """Top-n abandoned carts above ``min_value`` (a top-k report)."""
    return (abandonment_detail(sess).filter(c("cart_value") > min_value)
            .select("session_id", "user_id", "cart_value", "abandonment_reason", "device_type",
                    "time_in_cart_seconds")
            .orderBy(c("cart_value").desc(), c("session_id").asc()).limit(n))


def predictions_since(preds: DataFrame, hours: int, as_of: str) -> DataFrame:
    """Predictions in the last ``hours`` before ``as_of``."""
    return preds.filter(since("prediction_timestamp", hours, as_of))


def urgent_predictions(preds: DataFrame, sess: DataFrame, hours: int, as_of: str) -> DataFrame:
    """IN-list, boolean and IS NOT NULL predicates combined."""
    j = predictions_since(preds, hours, as_of).join(sess.select("session_id", "persona", "is_converted"),
                                                    "session_id", "left")
    return j.filter(c("risk_level").isin(*K.HIGH_RISK_LEVELS) & c("intervention_triggered")
                    & c("persona").isNotNull() & ~c("is_converted")) \
        .select("prediction_id", "session_id", "risk_level", "abandonment_probability", "persona")


def display_high_risk(preds: DataFrame, sess: DataFrame, hours: int, as_of: str, n: int = 20) -> DataFrame:
    """The dashboard's high-risk table (first n rows, newest first), formatted."""
    j = predictions_in_range(preds, sess, hours, as_of).filter(c("risk_level").isin(*K.HIGH_RISK_LEVELS))
    j = j.orderBy(c("prediction_timestamp").desc(), c("prediction_id").desc()).limit(n)
    return j.select(
        c("session_id").alias("Session"),
        F.date_format("prediction_timestamp", "HH:mm:ss").alias("Time"),
        c("risk_level").alias("Risk"),
        F.concat(round_half_up(c("abandonment_probability") * 100, 1).cast("string"), F.lit("%")).alias("Probability"),
        F.concat(F.lit("$"), round_half_up("cart_value", 2).cast("string")).alias("Cart $"),
        c("device_type").alias("Device"),
        c("persona").alias("User Type"),
        c("intervention_type").alias("Recommended Action"))


# --- J: joins ----------------------------------------------------------------

SESSION_SIDE = ["cart_value", "page_views", "cart_additions", "device_type", "persona", "is_converted"]


def predictions_in_range(preds: DataFrame, sess: DataFrame, hours: int, as_of: str) -> DataFrame:
    """Predictions with their session's context (left join N:1), newest first."""
    p = predictions_since(preds, hours, as_of).select(
        "prediction_id", "session_id", "prediction_timestamp", "abandonment_probability",
        "predicted_abandoned", "risk_level", "intervention_triggered", "intervention_type",
        "prediction_latency_ms")
    return p.join(sess.select("session_id", *SESSION_SIDE), "session_id", "left") \
        .orderBy(c("prediction_timestamp").desc())


def live_predictions(preds: DataFrame, sess: DataFrame, hours: int, as_of: str, limit: int = 100) -> DataFrame:
    """The most recent ``limit`` predictions with session context (top-k)."""
    j = predictions_in_range(preds, sess, hours, as_of).drop("prediction_id")
    return j.orderBy(c("prediction_timestamp").desc(), c("session_id").asc()).limit(limit)


# --- G: aggregations ---------------------------------------------------------

def conversion_funnel_daily(sess: DataFrame) -> DataFrame:
    """G1: the daily conversion funnel by persona and device."""
    carts = count_when(c("cart_additions") > 0)
    g = sess.groupBy(F.to_date("start_time").alias("funnel_date"), "persona", "device_type").agg(
        F.count(F.lit(1)).alias("total_sessions"),
        count_when(c("page_views") > 0).alias("browsing_sessions"),
        count_when(c("products_viewed") > 0).alias("product_viewed_sessions"),
        carts.alias("cart_active_sessions"),
        count_when(c("checkout_initiated")).alias("checkout_sessions"),
        count_when(c("is_converted")).alias("purchased_sessions"),
        count_when(c("is_cart_abandoned")).alias("abandoned_sessions"),
        money_sum(c("cart_value")).alias("total_cart_value"),
        money_sum(c("purchase_value")).alias("total_purchase_value"),
        money_avg(c("cart_value")).alias("avg_cart_value"),
        money_avg(c("purchase_value")).alias("avg_purchase_value"))
    g = g.withColumn("conversion_rate", pct("purchased_sessions", "cart_active_sessions")) \
         .withColumn("abandonment_rate", pct("abandoned_sessions", "cart_active_sessions"))
    return g.orderBy(c("funnel_date").desc(), c("persona").asc_nulls_last(), "device_type")


def abandonment_reasons(sess: DataFrame) -> DataFrame:
    """Abandonment reasons with value, time and device/persona pivots."""
    g = sess.filter(c("is_cart_abandoned")).groupBy("abandonment_reason").agg(
        F.count(F.lit(1)).alias("total_abandonments"),
        money_avg(c("cart_value")).alias("avg_cart_value"),
        money_sum(c("cart_value")).alias("total_lost_value"),
        num_avg(c("time_in_cart_seconds")).alias("avg_time_in_cart"),
        num_avg(c("page_views")).alias("avg_page_views"),
        *[count_when(c("device_type") == d).alias(f"{d}_count") for d in ("mobile", "desktop", "tablet")],
        *[count_when(c("persona") == p).alias(f"{p}_count") for p in K.PERSONAS])
    return g.orderBy(c("total_abandonments").desc(), c("abandonment_reason").asc_nulls_last())


def top_reasons(sess: DataFrame, n: int = 5) -> DataFrame:
    """The n most frequent abandonment reasons (top-k)."""
    return abandonment_reasons(sess).limit(n)


def risk_distribution(preds: DataFrame, hours: int, as_of: str) -> DataFrame:
    """Predictions per risk level, CRITICAL first."""
    g = predictions_since(preds, hours, as_of).groupBy("risk_level").agg(
        F.count(F.lit(1)).alias("count"), prob_avg(c("abandonment_probability")).alias("avg_probability"))
    return g.orderBy(risk_rank("risk_level").asc_nulls_last())


def hourly_predictions(preds: DataFrame, hours: int, as_of: str) -> DataFrame:
    """Predictions per hour bucket."""
    g = predictions_since(preds, hours, as_of).groupBy(
        F.date_trunc("hour", "prediction_timestamp").alias("hour")).agg(
        F.count(F.lit(1)).alias("total_predictions"),
        count_when(is_high_risk("risk_level")).alias("high_risk_count"),
        prob_avg(c("abandonment_probability")).alias("avg_probability"),
        count_when(c("intervention_triggered")).alias("interventions_triggered"))
    return g.orderBy("hour")


def session_kpis(sess: DataFrame, hours: int, as_of: str) -> DataFrame:
    """Session totals over the window (abandoned = cart > 0 and not converted)."""
    return sess.filter(since("updated_at", hours, as_of)).agg(
        F.count(F.lit(1)).alias("total_sessions"),
        count_when(c("is_converted")).alias("converted_sessions"),
        count_when((c("cart_value") > 0) & ~c("is_converted")).alias("abandoned_sessions"),
        money_avg(c("cart_value"), 2).alias("avg_cart_value"),
        num_avg(c("session_duration_seconds"), 0).alias("avg_duration"),
        num_avg(c("page_views")).alias("avg_page_views"))


def _sessions_with_predictions(preds: DataFrame, sess: DataFrame, hours: int, as_of: str) -> DataFrame:
    """Sessions LEFT JOIN predictions ... IS NOT NULL, i.e. an inner join that fans out."""
    s = sess.filter(since("updated_at", hours, as_of))
    return s.join(preds, "session_id", "left").filter(c("prediction_timestamp").isNotNull())


def persona_performance(preds: DataFrame, sess: DataFrame, hours: int, as_of: str) -> DataFrame:
    """Per persona (rows are predictions, Q4)."""
    j = _sessions_with_predictions(preds, sess, hours, as_of).filter(c("persona").isNotNull())
    g = j.groupBy("persona").agg(
        F.count(F.lit(1)).alias("sessions"),
        count_when(c("is_converted")).alias("conversions"),
        prob_avg(c("abandonment_probability")).alias("avg_abandon_prob"),
        count_when(is_high_risk("risk_level")).alias("high_risk_count"),
        money_avg(c("cart_value"), 2).alias("avg_cart_value"))
    return g.orderBy(c("sessions").desc(), "persona")


def abandonment_by_device(preds: DataFrame, sess: DataFrame, hours: int, as_of: str) -> DataFrame:
    """High-risk share per device."""
    j = _sessions_with_predictions(preds, sess, hours, as_of)
    g = j.groupBy("device_type").agg(
        F.count(F.lit(1)).alias("total_sessions"),
        count_when(is_high_risk("risk_level")).alias("high_risk_sessions"),
        money_avg(c("cart_value")).alias("avg_cart_value"))
    g = g.withColumn("high_risk_rate", pct("high_risk_sessions", "total_sessions"))
    return g.orderBy(c("high_risk_rate").desc_nulls_first(), "device_type")


def conversion_funnel(sess: DataFrame, hours: int, as_of: str) -> DataFrame:
    """One-row funnel over the window."""
    g = sess.filter(since("updated_at", hours, as_of)).agg(
        F.count(F.lit(1)).alias("total_sessions"),
        count_when(c("page_views") > 0).alias("with_pageviews"),
        count_when(c("products_viewed") > 0).alias("viewed_products"),
        count_when(c("cart_additions") > 0).alias("added_to_cart"),
        count_when(c("checkout_initiated")).alias("initiated_checkout"),
        count_when(c("is_converted")).alias("purchased"))
    return g.withColumn("cart_to_purchase_rate", pct("purchased", "added_to_cart"))


def intervention_effectiveness(preds: DataFrame, sess: DataFrame, hours: int, as_of: str,
                               min_count: int = 3) -> DataFrame:
    """Conversions after triggered interventions, groups with >= min_count rows."""
    p = predictions_since(preds, hours, as_of).filter(c("intervention_triggered"))
    j = p.join(sess.select("session_id", "is_converted"), "session_id", "left")
    g = j.groupBy("risk_level", "intervention_type").agg(
        F.count(F.lit(1)).alias("total_interventions"),
        count_when(c("is_converted")).alias("successful_conversions"))
    g = g.filter(c("total_interventions") >= min_count)
    g = g.withColumn("conversion_rate", pct("successful_conversions", "total_interventions"))
    return g.orderBy(c("conversion_rate").desc_nulls_first(), "risk_level")


def latency_stats(preds: DataFrame, hours: int, as_of: str, exact: bool = True) -> DataFrame:
    """Latency count, avg, min, max and continuous p95.

    The exact percentile keeps one counter per distinct latency value; scorer
    latencies are whole milliseconds under a 3 s timeout, so that state is
    bounded.  ``exact=False`` uses ``percentile_approx`` for unbounded inputs.
    """
    lat = c("prediction_latency_ms")
    p95 = F.percentile(lat, 0.95) if exact else F.percentile_approx(lat, 0.95, 10000).cast("double")
    g = predictions_since(preds, hours, as_of).agg(
        F.count(F.lit(1)).alias("total_predictions"),
        num_avg(lat).alias("avg_latency_ms"),
        F.min(lat).alias("min_latency_ms"),
        F.max(lat).alias("max_latency_ms"),
        round_half_up(p95, 4).alias("p95_latency_ms"))
    return g.withColumn("avg_verdict", latency_verdict_avg("avg_latency_ms")) \
            .withColumn("p95_verdict", latency_verdict_p95("p95_latency_ms"))


def business_impact(preds: DataFrame, sess: DataFrame, hours: int, as_of: str) -> DataFrame:
    """Value at risk and carts recovered after interventions."""
    p = predictions_since(preds, hours, as_of)
    j = p.join(sess.select("session_id", "cart_value", "is_converted", "purchase_value"), "session_id", "left")
    hr = is_high_risk("risk_level")
    rec = c("intervention_triggered") & c("is_converted")
    return j.agg(
        count_when(hr).alias("high_risk_predictions"),
        count_when(c("intervention_triggered")).alias("interventions_triggered"),
        money_sum(F.when(hr, c("cart_value")).otherwise(F.lit(0.0))).alias("total_at_risk_value"),
        money_avg(F.when(hr, c("cart_value"))).alias("avg_at_risk_cart_value"),
        count_when(rec).alias("recovered_carts"),
        money_sum(F.when(rec, c("purchase_value")).otherwise(F.lit(0.0))).alias("recovered_revenue"))


def model_accuracy(labelled: DataFrame, hours: int, as_of: str) -> DataFrame:
    """Accuracy, TP/FP/FN, precision and recall of labelled predictions (0 when empty)."""
    lab = predictions_since(labelled, hours, as_of).filter(c("was_prediction_correct").isNotNull())
    ok, pa = c("was_prediction_correct"), c("predicted_abandoned")
    g = lab.agg(
        F.count(F.lit(1)).alias("total_predictions"),
        count_when(ok).alias("correct_predictions"),
        count_when(pa & ok).alias("true_positives"),
        count_when(pa & ~ok).alias("false_positives"),
        count_when(~pa & ~ok).alias("false_negatives"))
    g = g.withColumn("accuracy_rate", pct("correct_predictions", "total_predictions"))
    tp, fp, fn = c("true_positives"), c("false_positives"), c("false_negatives")
    return g.withColumn("precision", F.coalesce(pct(tp, tp + fp), F.lit(0.0))) \
            .withColumn("recall", F.coalesce(pct(tp, tp + fn), F.lit(0.0)))


def abandonment_rate_by_persona(sess: DataFrame) -> DataFrame:
    """G13."""
    g = sess.filter(c("persona").isNotNull()).groupBy("persona").agg(
        F.count(F.lit(1)).alias("total_sessions"), count_when(c("is_cart_abandoned")).alias("abandoned"))
    g = g.withColumn("abandonment_rate", pct("abandoned", "total_sessions"))
    return g.orderBy(c("abandonment_rate").desc_nulls_first(), "persona")


def outcome_summary(sess: DataFrame) -> DataFrame:
    """Purchased / abandoned (cart, not converted) / browsing-only counts and shares."""
    ab = (c("cart_value") > 0) & ~c("is_converted")
    g = sess.agg(
        F.count(F.lit(1)).alias("total_sessions"),
        count_when(c("is_converted")).alias("purchased"),
        count_when(ab).alias("abandoned"),
        count_when(c("cart_value") > 0).alias("with_cart"),
        count_when((c("cart_value") <= 0) & ~c("is_converted")).alias("browsing"))
    for x in ("purchased", "abandoned", "browsing"):
        g = g.withColumn(f"{x}_pct", pct(x, "total_sessions"))
    return g


def persona_outcomes(sess: DataFrame) -> DataFrame:
    """Per persona totals, conversions, abandonments and conversion rate."""
    g = sess.filter(c("persona").isNotNull()).groupBy("persona").agg(
        F.count(F.lit(1)).alias("total"),
        count_when(c("is_converted")).alias("converted"),
        count_when((c("cart_value") > 0) & ~c("is_converted")).alias("abandoned"))
    return g.withColumn("conversion_rate", pct("converted", "total")).orderBy("persona")


def event_mix(ev: DataFrame) -> DataFrame:
    """Count and share per event type; the total is summed over the few grouped rows."""
    per = ev.groupBy("event_type").agg(F.count(F.lit(1)).alias("events"))
    per = per.withColumn("_total", F.sum("events").over(Window.partitionBy(F.lit(1))))
    return per.select("event_type", "events", pct("events", "_total").alias("share_pct")) \
        .orderBy(c("events").desc(), "event_type")


def event_summary(ev: DataFrame) -> DataFrame:
    """Session starts by persona, purchases, abandonments, abandonment rate, recoveries."""
    et = c("event_type")
    g = ev.agg(
        F.count(F.lit(1)).alias("total_events"),
        F.count_distinct("session_id").alias("sessions"),
        F.count_distinct("user_id").alias("users"),
        *[count_when((et == "session_start") & (c("persona") == p)).alias(f"{p}_starts") for p in K.PERSONAS],
        count_when(et == "purchase").alias("purchases"),
        count_when(et == "cart_abandoned").alias("abandonments"),
        count_when(et == "session_recovered").alias("recoveries"))
    return g.withColumn("abandonment_rate", pct("abandonments", c("abandonments") + c("purchases")))


def event_funnel(ev: DataFrame) -> DataFrame:
    """Product view -> cart -> checkout -> purchase counts and step ratios."""
    et = c("event_type")
    g = ev.agg(count_when(et == "product_view").alias("product_views"),
               count_when(et == "add_to_cart").alias("cart_adds"),
               count_when(et == "checkout_initiated").alias("checkouts"),
               count_when(et == "purchase").alias("purchases"))
    return g.select("*", pct("cart_adds", "product_views").alias("view_to_cart_pct"),
                    pct("checkouts", "cart_adds").alias("cart_to_checkout_pct"),
                    pct("purchases", "checkouts").alias("checkout_to_purchase_pct"),
                    pct("purchases", "product_views").alias("view_to_purchase_pct"))


def session_quality(sess: DataFrame) -> DataFrame:
    """Average duration, pages, products, cart and the bounce rate."""
    g = sess.agg(F.count(F.lit(1)).alias("sessions"),
                 num_avg(c("session_duration_seconds"), 2).alias("avg_duration_seconds"),
                 num_avg(c("page_views"), 2).alias("avg_page_views"),
                 num_avg(c("products_viewed"), 2).alias("avg_products_viewed"),
                 money_avg(c("cart_value"), 2).alias("avg_cart_value"),
                 count_when(c("bounce")).alias("bounces"))
    return g.withColumn("bounce_rate", pct("bounces", "sessions"))


def session_mix(sess: DataFrame) -> DataFrame:
    """Device and browser shares of sessions."""
    pairs = F.explode(F.array(*[F.struct(F.lit(d).alias("dimension"), c(d).alias("value"))
                                for d in ("device_type", "browser")]))
    u = sess.select(pairs.alias("p")).groupBy("p.dimension", "p.value").agg(F.count(F.lit(1)).alias("sessions"))
    u = u.withColumn("_total", F.sum("sessions").over(Window.partitionBy("dimension")))  # a few grouped rows
    return u.select("dimension", "value", "sessions", pct("sessions", "_total").alias("share_pct"))


def live_headline(preds: DataFrame, hours: int, as_of: str) -> DataFrame:
    """Total, high-risk count and share, mean probability, interventions and share."""
    g = predictions_since(preds, hours, as_of).agg(
        F.count(F.lit(1)).alias("total_predictions"),
        count_when(is_high_risk("risk_level")).alias("high_risk_count"),
        prob_avg(c("abandonment_probability")).alias("avg_probability"),
        count_when(c("intervention_triggered")).alias("interventions"))
    return g.select("*", F.coalesce(pct("high_risk_count", "total_predictions", 1), F.lit(0.0)).alias("high_risk_pct"),
                    F.coalesce(pct("interventions", "total_predictions", 1), F.lit(0.0)).alias("intervention_pct"))


def roi(impact: DataFrame) -> DataFrame:
    """Potential recovery (15 % of value at risk), cost ($2 each), ROI % and label."""
    potential = round_half_up(c("total_at_risk_value") * K.ROI_RECOVERY_SHARE, 2)
    cost = round_half_up(c("interventions_triggered") * K.ROI_COST_PER_INTERVENTION, 2)
    out = impact.select("total_at_risk_value", "interventions_triggered",
                        potential.alias("potential_recovery"), cost.alias("intervention_cost"))
    r = F.coalesce(round_half_up(F.try_divide((c("potential_recovery") - c("intervention_cost")) * 100.0,
                                              c("intervention_cost")), 2), F.lit(0.0))
    return out.withColumn("roi_pct", r).withColumn("roi_label", roi_label("roi_pct"))


def service_counters(preds: DataFrame) -> DataFrame:
    """Predictions served, high-risk count and percentage (2 dp)."""
    g = preds.agg(F.count(F.lit(1)).alias("total_predictions"),
                  count_when(is_high_risk("risk_level")).alias("high_risk_count"))
    return g.withColumn("high_risk_percentage",
                        F.coalesce(pct("high_risk_count", "total_predictions"), F.lit(0.0)))


def class_balance(df: DataFrame, label: str = "abandoned") -> DataFrame:
    """Rows per label value and the label mean."""
    per = df.groupBy(c(label).alias("label")).agg(F.count(F.lit(1)).alias("rows"))
    whole = Window.partitionBy(F.lit(1))  # one row for each label
    per = per.withColumn("_total", F.sum("rows").over(whole)) \
        .withColumn("_pos", F.sum(c("rows") * c("label").cast("long")).over(whole))
    return per.select(
        "label", "rows", pct("rows", "_total").alias("share_pct"),
        round_half_up(c("_pos") / c("_total"), 4).alias("label_mean"))
