"""Registered queries: one per operator id of the inventory.

``QUERIES[name](spark, sf_dir) -> DataFrame`` always starts from the given
parquet tables; ``ORACLE[name]`` is the DuckDB twin (absent for operators
that SQL cannot express, e.g. model training).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cartflow.operators import sessions as S
from cartflow.operators.scoring import fixed_predictions, risk_levels
from cartflow.plans.oracle import q
from cartflow.sources.fixture import load_events, storefront_events

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = q(sql)
        return fn
    return deco


# Shared inputs -------------------------------------------------------------

def events(spark, sf):
    return load_events(spark, sf)


def unsessioned(spark, sf):
    """Events for reports that use no session id: one read, no shuffle."""
    return storefront_events(read_table(spark, sf, "events"))


def sessions(spark, sf):
    return S.session_records(events(spark, sf))


def snaps(spark, sf):
    return S.snapshots(events(spark, sf))


def preds(spark, sf):
    return fixed_predictions(snaps(spark, sf))


# W / C: sessions -------------------------------------------------------------

@register("sessionize", "SELECT event_id, user_id, ts, event_type, session_id FROM ev")
def q_sessionize(spark, sf):
    return events(spark, sf).select("event_id", "user_id", "ts", "event_type", "session_id")


@register("session_records", "SELECT * FROM sess")
def q_session_records(spark, sf):
    return sessions(spark, sf)


@register("running_cart",
          "SELECT session_id, event_id, ts, event_type, cart_value_running FROM rc")
def q_running_cart(spark, sf):
    return S.running_cart(events(spark, sf)).select("session_id", "event_id", "ts", "event_type",
                                                   "cart_value_running")


SNAP_COLS = ["session_id", "event_id", "ts", "start_time", "device_type", "browser", "page_views",
             "products_viewed", "product_view_count", "searches", "cart_additions", "cart_removals",
             "cart_value", "is_converted", "purchase_value", "is_cart_abandoned", "abandonment_reason",
             "time_in_cart_seconds", "checkout_initiated", "persona", "session_duration_seconds",
             "avg_time_per_page", "bounce"]
FEATURE_COLS = ["session_id", "event_id", "engagement_score", "cart_engagement", "time_per_product",
                "cart_to_checkout_rate", "pages_per_minute", "unique_product_ratio"]


@register("snapshots", f"SELECT {', '.join(SNAP_COLS)} FROM snap")
def q_snapshots(spark, sf):
    return snaps(spark, sf).select(*SNAP_COLS)


@register("serving_features", f"SELECT {', '.join(FEATURE_COLS)} FROM snap")
def q_serving_features(spark, sf):
    return snaps(spark, sf).select(*FEATURE_COLS)


# Scoring -------------------------------------------------------------

from cartflow import constants as K  # noqa: E402
from cartflow.operators import reports as R  # noqa: E402
from cartflow.plans.oracle import HIGH, cw, mavg, msum, navg, pavg, pct, risk_case, rh, since  # noqa: E402

H, AS_OF = K.REPORT_HOURS, K.AS_OF
PRED_COLS = ("prediction_id, session_id, user_id, prediction_timestamp, abandonment_probability, predicted_abandoned, "
             "risk_level, intervention_triggered, intervention_type, model_version, prediction_latency_ms")


@register("predictions", f"SELECT {PRED_COLS} FROM preds")
def q_predictions(spark, sf):
    return preds(spark, sf)


@register("risk_levels", f"""
SELECT session_id, event_id, abandonment_probability, abandonment_probability > 0.5 AS will_abandon,
  {risk_case('abandonment_probability', 1)} AS risk_level, {risk_case('abandonment_probability', 2)} AS confidence,
  {risk_case('abandonment_probability', 3)} AS recommended_intervention,
  {risk_case('abandonment_probability', 1)} IN ('HIGH', 'CRITICAL') AS intervention_triggered
FROM preds0""")
def q_risk_levels(spark, sf):
    return risk_levels(snaps(spark, sf))


@register("scorable", "SELECT session_id, event_id, cart_value FROM snap WHERE cart_value > 0")
def q_scorable(spark, sf):
    from cartflow.operators.scoring import scorable
    return scorable(snaps(spark, sf)).select("session_id", "event_id", "cart_value")


# P: projections and filters ----------------------------------------------------

P1_COLS = ("CAST(start_time AS DATE) AS abandonment_date, CAST(hour(start_time) AS INTEGER) AS abandonment_hour, "
           "CAST(dayofweek(start_time) AS INTEGER) AS day_of_week, session_id, user_id, persona, device_type, "
           "cart_value, cart_additions AS items_in_cart, abandonment_reason, time_in_cart_seconds, "
           "checkout_initiated, page_views, session_duration_seconds, products_viewed, start_time, last_activity")


@register("abandonment_detail", f"SELECT {P1_COLS} FROM sess WHERE is_cart_abandoned ORDER BY start_time DESC")
def q_p1(spark, sf):
    return R.abandonment_detail(sessions(spark, sf))


@register("high_value_abandoned", f"""
SELECT session_id, user_id, cart_value, abandonment_reason, device_type, time_in_cart_seconds
FROM (SELECT {P1_COLS} FROM sess WHERE is_cart_abandoned) v
WHERE cart_value > 100 ORDER BY cart_value DESC, session_id ASC LIMIT 10""")
def q_p2(spark, sf):
    return R.high_value_abandoned(sessions(spark, sf))


@register("predictions_since", f"SELECT {PRED_COLS} FROM preds WHERE {since('prediction_timestamp', H)}")
def q_p3(spark, sf):
    return R.predictions_since(preds(spark, sf), H, AS_OF)


@register("urgent_predictions", f"""
SELECT p.prediction_id, p.session_id, p.risk_level, p.abandonment_probability, s.persona
FROM preds p LEFT JOIN sess s ON p.session_id = s.session_id
WHERE {since('p.prediction_timestamp', H)} AND p.risk_level IN ('HIGH', 'CRITICAL') AND p.intervention_triggered
  AND s.persona IS NOT NULL AND NOT s.is_converted""")
def q_p4(spark, sf):
    return R.urgent_predictions(preds(spark, sf), sessions(spark, sf), H, AS_OF)


J1_SQL = f"""
SELECT p.prediction_id, p.session_id, p.prediction_timestamp, p.abandonment_probability, p.predicted_abandoned,
  p.risk_level, p.intervention_triggered, p.intervention_type, p.prediction_latency_ms,
  s.cart_value, s.page_views, s.cart_additions, s.device_type, s.persona, s.is_converted
FROM preds p LEFT JOIN sess s ON p.session_id = s.session_id
WHERE {since('p.prediction_timestamp', H)}"""


@register("display_high_risk", f"""
SELECT session_id AS "Session", strftime(prediction_timestamp, '%H:%M:%S') AS "Time", risk_level AS "Risk",
  CAST({rh('abandonment_probability * 100', 1)} AS VARCHAR) || '%' AS "Probability",
  '$' || CAST({rh('cart_value', 2)} AS VARCHAR) AS "Cart $", device_type AS "Device", persona AS "User Type",
  intervention_type AS "Recommended Action"
FROM ({J1_SQL}) j WHERE risk_level IN ('HIGH', 'CRITICAL')
ORDER BY prediction_timestamp DESC, prediction_id DESC LIMIT 20""")
def q_p6(spark, sf):
    return R.display_high_risk(preds(spark, sf), sessions(spark, sf), H, AS_OF)


# J: joins ------------------------------------------------------------------------

@register("predictions_in_range", J1_SQL + " ORDER BY p.prediction_timestamp DESC")
def q_j1(spark, sf):
    return R.predictions_in_range(preds(spark, sf), sessions(spark, sf), H, AS_OF)


@register("live_predictions", f"""
SELECT * EXCLUDE (prediction_id) FROM ({J1_SQL}) j ORDER BY prediction_timestamp DESC, session_id ASC LIMIT 100""")
def q_j2(spark, sf):
    return R.live_predictions(preds(spark, sf), sessions(spark, sf), H, AS_OF)


# G: aggregations -------------------------------------------------------------------

@register("conversion_funnel_daily", f"""
SELECT CAST(start_time AS DATE) AS funnel_date, persona, device_type,
  count(*) AS total_sessions, {cw('page_views > 0')} AS browsing_sessions,
  {cw('products_viewed > 0')} AS product_viewed_sessions, {cw('cart_additions > 0')} AS cart_active_sessions,
  {cw('checkout_initiated')} AS checkout_sessions, {cw('is_converted')} AS purchased_sessions,
  {cw('is_cart_abandoned')} AS abandoned_sessions,
  {msum('cart_value')} AS total_cart_value, {msum('purchase_value')} AS total_purchase_value,
  {mavg('cart_value')} AS avg_cart_value, {mavg('purchase_value')} AS avg_purchase_value,
  {pct(cw('is_converted'), cw('cart_additions > 0'))} AS conversion_rate,
  {pct(cw('is_cart_abandoned'), cw('cart_additions > 0'))} AS abandonment_rate
FROM sess GROUP BY 1, 2, 3 ORDER BY funnel_date DESC, persona""")
def q_g1(spark, sf):
    return R.conversion_funnel_daily(sessions(spark, sf))


G2_SQL = f"""
SELECT abandonment_reason, count(*) AS total_abandonments, {mavg('cart_value')} AS avg_cart_value,
  {msum('cart_value')} AS total_lost_value, {navg('time_in_cart_seconds')} AS avg_time_in_cart,
  {navg('page_views')} AS avg_page_views,
  {cw("device_type = 'mobile'")} AS mobile_count, {cw("device_type = 'desktop'")} AS desktop_count,
  {cw("device_type = 'tablet'")} AS tablet_count,
  {cw("persona = 'window_shopper'")} AS window_shopper_count, {cw("persona = 'intent_buyer'")} AS intent_buyer_count,
  {cw("persona = 'cart_abandoner'")} AS cart_abandoner_count
FROM sess WHERE is_cart_abandoned GROUP BY abandonment_reason
ORDER BY total_abandonments DESC, abandonment_reason ASC NULLS LAST"""


@register("abandonment_reasons", G2_SQL)
def q_g2(spark, sf):
    return R.abandonment_reasons(sessions(spark, sf))


@register("top_reasons", G2_SQL + " LIMIT 5")
def q_g2_top(spark, sf):
    return R.top_reasons(sessions(spark, sf))


@register("risk_distribution", f"""
SELECT risk_level, count(*) AS count, {pavg('abandonment_probability')} AS avg_probability
FROM preds WHERE {since('prediction_timestamp', H)} GROUP BY risk_level""")
def q_g3(spark, sf):
    return R.risk_distribution(preds(spark, sf), H, AS_OF)


@register("hourly_predictions", f"""
SELECT date_trunc('hour', prediction_timestamp) AS hour, count(*) AS total_predictions,
  {cw(HIGH)} AS high_risk_count, {pavg('abandonment_probability')} AS avg_probability,
  {cw('intervention_triggered')} AS interventions_triggered
FROM preds WHERE {since('prediction_timestamp', H)} GROUP BY 1 ORDER BY 1""")
def q_g4(spark, sf):
    return R.hourly_predictions(preds(spark, sf), H, AS_OF)


@register("session_kpis", f"""
SELECT count(*) AS total_sessions, {cw('is_converted')} AS converted_sessions,
  {cw('cart_value > 0 AND NOT is_converted')} AS abandoned_sessions, {mavg('cart_value', 2)} AS avg_cart_value,
  {navg('session_duration_seconds', 0)} AS avg_duration, {navg('page_views')} AS avg_page_views
FROM sess WHERE {since('updated_at', H)}""")
def q_g5(spark, sf):
    return R.session_kpis(sessions(spark, sf), H, AS_OF)


SWP = f"""(SELECT s.*, p.* EXCLUDE (session_id, user_id) FROM sess s LEFT JOIN preds p ON s.session_id = p.session_id
  WHERE {since('s.updated_at', H)} AND p.prediction_timestamp IS NOT NULL)"""


@register("persona_performance", f"""
SELECT persona, count(*) AS sessions, {cw('is_converted')} AS conversions,
  {pavg('abandonment_probability')} AS avg_abandon_prob, {cw(HIGH)} AS high_risk_count,
  {mavg('cart_value', 2)} AS avg_cart_value
FROM {SWP} j WHERE persona IS NOT NULL GROUP BY persona ORDER BY sessions DESC""")
def q_g6(spark, sf):
    return R.persona_performance(preds(spark, sf), sessions(spark, sf), H, AS_OF)


@register("abandonment_by_device", f"""
SELECT device_type, count(*) AS total_sessions, {cw(HIGH)} AS high_risk_sessions,
  {mavg('cart_value')} AS avg_cart_value, {pct(cw(HIGH), 'count(*)')} AS high_risk_rate
FROM {SWP} j GROUP BY device_type ORDER BY high_risk_rate DESC""")
def q_g7(spark, sf):
    return R.abandonment_by_device(preds(spark, sf), sessions(spark, sf), H, AS_OF)


@register("conversion_funnel", f"""
SELECT count(*) AS total_sessions, {cw('page_views > 0')} AS with_pageviews,
  {cw('products_viewed > 0')} AS viewed_products, {cw('cart_additions > 0')} AS added_to_cart,
  {cw('checkout_initiated')} AS initiated_checkout, {cw('is_converted')} AS purchased,
  {pct(cw('is_converted'), cw('cart_additions > 0'))} AS cart_to_purchase_rate
FROM sess WHERE {since('updated_at', H)}""")
def q_g8(spark, sf):
    return R.conversion_funnel(sessions(spark, sf), H, AS_OF)


@register("intervention_effectiveness", f"""
SELECT p.risk_level, p.intervention_type, count(*) AS total_interventions,
  {cw('s.is_converted')} AS successful_conversions,
  {pct(cw('s.is_converted'), 'count(*)')} AS conversion_rate
FROM preds p LEFT JOIN sess s ON p.session_id = s.session_id
WHERE p.intervention_triggered AND {since('p.prediction_timestamp', H)}
GROUP BY p.risk_level, p.intervention_type HAVING count(*) >= 3 ORDER BY conversion_rate DESC""")
def q_g9(spark, sf):
    return R.intervention_effectiveness(preds(spark, sf), sessions(spark, sf), H, AS_OF)


@register("latency_stats", f"""
SELECT *, CASE WHEN avg_latency_ms < 100 THEN 'Good' ELSE 'Slow' END AS avg_verdict,
  CASE WHEN p95_latency_ms < 200 THEN 'Good' ELSE 'Slow' END AS p95_verdict
FROM (SELECT count(*) AS total_predictions, {navg('prediction_latency_ms')} AS avg_latency_ms,
  min(prediction_latency_ms) AS min_latency_ms, max(prediction_latency_ms) AS max_latency_ms,
  {rh('quantile_cont(prediction_latency_ms, 0.95)', 4)} AS p95_latency_ms
  FROM preds WHERE {since('prediction_timestamp', H)})""")
def q_g10(spark, sf):
    return R.latency_stats(preds(spark, sf), H, AS_OF)


G11_SQL = f"""
SELECT {cw(HIGH)} AS high_risk_predictions, {cw('intervention_triggered')} AS interventions_triggered,
  {msum(f'CASE WHEN {HIGH} THEN s.cart_value ELSE 0.0 END')} AS total_at_risk_value,
  {mavg(f'CASE WHEN {HIGH} THEN s.cart_value END')} AS avg_at_risk_cart_value,
  {cw('intervention_triggered AND s.is_converted')} AS recovered_carts,
  {msum('CASE WHEN intervention_triggered AND s.is_converted THEN s.purchase_value ELSE 0.0 END')} AS recovered_revenue
FROM preds p LEFT JOIN sess s ON p.session_id = s.session_id
WHERE {since('p.prediction_timestamp', H)}"""


@register("business_impact", G11_SQL)
def q_g11(spark, sf):
    return R.business_impact(preds(spark, sf), sessions(spark, sf), H, AS_OF)


@register("abandonment_rate_by_persona", f"""
SELECT persona, count(*) AS total_sessions, {cw('is_cart_abandoned')} AS abandoned,
  {pct(cw('is_cart_abandoned'), 'count(*)')} AS abandonment_rate
FROM sess WHERE persona IS NOT NULL GROUP BY persona ORDER BY abandonment_rate DESC""")
def q_g13(spark, sf):
    return R.abandonment_rate_by_persona(sessions(spark, sf))


@register("outcome_summary", f"""
SELECT *, {pct('purchased', 'total_sessions')} AS purchased_pct, {pct('abandoned', 'total_sessions')} AS abandoned_pct,
  {pct('browsing', 'total_sessions')} AS browsing_pct
FROM (SELECT count(*) AS total_sessions, {cw('is_converted')} AS purchased,
  {cw('cart_value > 0 AND NOT is_converted')} AS abandoned, {cw('cart_value > 0')} AS with_cart,
  {cw('cart_value <= 0 AND NOT is_converted')} AS browsing FROM sess)""")
def q_g14(spark, sf):
    return R.outcome_summary(sessions(spark, sf))


@register("persona_outcomes", f"""
SELECT persona, count(*) AS total, {cw('is_converted')} AS converted,
  {cw('cart_value > 0 AND NOT is_converted')} AS abandoned, {pct(cw('is_converted'), 'count(*)')} AS conversion_rate
FROM sess WHERE persona IS NOT NULL GROUP BY persona ORDER BY persona""")
def q_g15(spark, sf):
    return R.persona_outcomes(sessions(spark, sf))


@register("event_mix", f"""
SELECT event_type, count(*) AS events, {pct('count(*)', '(SELECT count(*) FROM ev)')} AS share_pct
FROM ev GROUP BY event_type""")
def q_g16(spark, sf):
    return R.event_mix(unsessioned(spark, sf))


@register("event_summary", f"""
SELECT *, {pct('abandonments', 'abandonments + purchases')} AS abandonment_rate FROM (
SELECT count(*) AS total_events, count(DISTINCT session_id) AS sessions, count(DISTINCT user_id) AS users,
  {cw("event_type = 'session_start' AND persona = 'window_shopper'")} AS window_shopper_starts,
  {cw("event_type = 'session_start' AND persona = 'intent_buyer'")} AS intent_buyer_starts,
  {cw("event_type = 'session_start' AND persona = 'cart_abandoner'")} AS cart_abandoner_starts,
  {cw("event_type = 'purchase'")} AS purchases, {cw("event_type = 'cart_abandoned'")} AS abandonments,
  {cw("event_type = 'session_recovered'")} AS recoveries FROM ev)""")
def q_g16b(spark, sf):
    return R.event_summary(events(spark, sf))


@register("event_funnel", f"""
SELECT *, {pct('cart_adds', 'product_views')} AS view_to_cart_pct, {pct('checkouts', 'cart_adds')} AS cart_to_checkout_pct,
  {pct('purchases', 'checkouts')} AS checkout_to_purchase_pct, {pct('purchases', 'product_views')} AS view_to_purchase_pct
FROM (SELECT {cw("event_type = 'product_view'")} AS product_views, {cw("event_type = 'add_to_cart'")} AS cart_adds,
  {cw("event_type = 'checkout_initiated'")} AS checkouts, {cw("event_type = 'purchase'")} AS purchases FROM ev)""")
def q_g17(spark, sf):
    return R.event_funnel(unsessioned(spark, sf))


@register("session_quality", f"""
SELECT *, {pct('bounces', 'sessions')} AS bounce_rate FROM (
SELECT count(*) AS sessions, {navg('session_duration_seconds', 2)} AS avg_duration_seconds,
  {navg('page_views', 2)} AS avg_page_views, {navg('products_viewed', 2)} AS avg_products_viewed,
  {mavg('cart_value', 2)} AS avg_cart_value, {cw('bounce')} AS bounces FROM sess)""")
def q_g18(spark, sf):
    return R.session_quality(sessions(spark, sf))


@register("session_mix", f"""
SELECT dimension, value, sessions, {pct('sessions', '(SELECT count(*) FROM sess)')} AS share_pct FROM (
  SELECT 'device_type' AS dimension, device_type AS value, count(*) AS sessions FROM sess GROUP BY device_type
  UNION ALL
  SELECT 'browser' AS dimension, browser AS value, count(*) AS sessions FROM sess GROUP BY browser)""")
def q_g18b(spark, sf):
    return R.session_mix(sessions(spark, sf))


@register("live_headline", f"""
SELECT *, COALESCE({pct('high_risk_count', 'total_predictions', 1)}, 0.0) AS high_risk_pct,
  COALESCE({pct('interventions', 'total_predictions', 1)}, 0.0) AS intervention_pct FROM (
SELECT count(*) AS total_predictions, {cw(HIGH)} AS high_risk_count,
  {pavg('abandonment_probability')} AS avg_probability, {cw('intervention_triggered')} AS interventions
FROM preds WHERE {since('prediction_timestamp', H)})""")
def q_g19(spark, sf):
    return R.live_headline(preds(spark, sf), H, AS_OF)


@register("roi", f"""
SELECT *, CASE WHEN roi_pct > 100 THEN 'Excellent' WHEN roi_pct > 50 THEN 'Good' ELSE 'Low' END AS roi_label FROM (
SELECT *, COALESCE({rh('(potential_recovery - intervention_cost) * 100.0 / NULLIF(intervention_cost, 0)', 2)}, 0.0)
  AS roi_pct FROM (
SELECT total_at_risk_value, interventions_triggered,
  {rh('total_at_risk_value * CAST(0.15 AS DOUBLE)', 2)} AS potential_recovery,
  {rh('interventions_triggered * CAST(2.0 AS DOUBLE)', 2)} AS intervention_cost
FROM ({G11_SQL}) b))""")
def q_g20(spark, sf):
    return R.roi(R.business_impact(preds(spark, sf), sessions(spark, sf), H, AS_OF))


@register("service_counters", f"""
SELECT count(*) AS total_predictions, {cw(HIGH)} AS high_risk_count,
  COALESCE({pct(cw(HIGH), 'count(*)')}, 0.0) AS high_risk_percentage FROM preds""")
def q_g21(spark, sf):
    return R.service_counters(preds(spark, sf))


@register("class_balance", f"""
SELECT label, count(*) AS rows, {pct('count(*)', '(SELECT count(*) FROM sess)')} AS share_pct,
  (SELECT {rh('CAST(count(CASE WHEN cart_value > 0 AND NOT is_converted THEN 1 END) AS DOUBLE) / count(*)', 4)}
   FROM sess) AS label_mean
FROM (SELECT cart_value > 0 AND NOT is_converted AS label FROM sess) GROUP BY label""")
def q_g22(spark, sf):
    from cartflow.operators.sessions import training_features
    return R.class_balance(training_features(sessions(spark, sf)), "abandoned")


# W3, W4, C19, C9 -------------------------------------------------------------------

from cartflow.operators import outcomes as O  # noqa: E402
from cartflow.operators import rollups as RU  # noqa: E402
from cartflow.plans.oracle import AS_OF as AS_OF_SQL, WRUN  # noqa: E402


@register("session_state", f"""
SELECT session_id, event_id, user_id, ts, event_type, cart_value_running AS cart_value,
  CAST(item_count AS BIGINT) AS item_count,
  COALESCE(last_value(CASE WHEN event_type = 'add_to_cart' THEN 'cart_active'
                           WHEN event_type = 'remove_from_cart' AND item_count = 0 THEN 'interested'
                           WHEN event_type = 'checkout_initiated' THEN 'checkout_initiated'
                           WHEN event_type = 'purchase' THEN 'purchased'
                           WHEN event_type = 'cart_abandoned' THEN 'abandoned'
                           WHEN event_type = 'session_recovered' THEN 'recovering' END IGNORE NULLS) OVER {WRUN},
           CASE WHEN sum(CASE WHEN event_type = 'page_view' THEN 1 ELSE 0 END) OVER {WRUN} >= 3
                  OR sum(CASE WHEN event_type = 'product_view' THEN 1 ELSE 0 END) OVER {WRUN} >= 2
                THEN 'interested' ELSE 'browsing' END) AS session_state
FROM (SELECT *, total - LEAST(0, min(total) OVER (PARTITION BY session_id, cart_no ORDER BY ts, event_id)) AS item_count
      FROM (SELECT *, sum(CASE event_type WHEN 'add_to_cart' THEN 1 WHEN 'remove_from_cart' THEN -1 ELSE 0 END)
                        OVER (PARTITION BY session_id, cart_no ORDER BY ts, event_id) AS total
            FROM (SELECT *, sum(CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END) OVER {WRUN} AS cart_no FROM rc) c) t) i""")
def q_w3(spark, sf):
    return S.session_state(events(spark, sf))


@register("session_edges", """
SELECT session_id, first(event_id ORDER BY ts, event_id) AS first_event_id,
  first(event_type ORDER BY ts, event_id) AS first_event_type, min(ts) AS first_ts,
  last(event_id ORDER BY ts, event_id) AS last_event_id, last(event_type ORDER BY ts, event_id) AS last_event_type,
  max(ts) AS last_ts
FROM ev GROUP BY session_id""")
def q_w4(spark, sf):
    return S.session_edges(events(spark, sf))


CART_LINES_SQL = f"""
SELECT session_id, user_id, product_id, net AS quantity, {rh('price', 2)} AS price,
  {rh('CAST(price AS DECIMAL(12,2)) * net', 2)} AS line_value, last_updated
FROM (SELECT session_id, product_id, min(user_id) AS user_id,
        CAST(sum(CASE WHEN event_type = 'add_to_cart' THEN CAST(COALESCE(quantity, 1) AS BIGINT)
                      ELSE -CAST(COALESCE(quantity, 1) AS BIGINT) END) AS BIGINT) AS net,
        last(price ORDER BY ts, event_id) AS price, max(ts) AS last_updated
      FROM (SELECT *, sum(CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END) OVER {WRUN} AS cart_no,
                   sum(CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END) OVER (PARTITION BY session_id) AS carts FROM ev)
      WHERE event_type IN ('add_to_cart', 'remove_from_cart') AND cart_no = carts GROUP BY session_id, product_id)
WHERE net > 0"""


@register("cart_lines", CART_LINES_SQL)
def q_c19_lines(spark, sf):
    return S.cart_lines(events(spark, sf))


@register("cart_state", f"""
SELECT session_id, min(user_id) AS user_id, count(*) AS item_count, CAST(sum(quantity) AS BIGINT) AS total_quantity,
  {rh('sum(CAST(line_value AS DECIMAL(24,2)))', 2)} AS total_value, max(last_updated) AS last_updated
FROM ({CART_LINES_SQL}) l GROUP BY session_id""")
def q_c19(spark, sf):
    return S.cart_state(events(spark, sf))


@register("training_features", f"""
SELECT session_id, cart_value > 0 AND NOT is_converted AS abandoned,
  {rh('page_views * CAST(0.3 AS DOUBLE) + products_viewed * CAST(0.4 AS DOUBLE) + searches * CAST(0.3 AS DOUBLE)', 4)}
    AS train_engagement_score,
  cart_additions - cart_removals AS cart_engagement,
  {rh('session_duration_seconds / (products_viewed + 1)', 4)} AS time_per_product,
  {rh('CAST(checkout_initiated AS INTEGER) / (cart_additions + 1)', 4)} AS cart_to_checkout_rate,
  {rh('page_views / (session_duration_seconds / CAST(60.0 AS DOUBLE) + 1)', 4)} AS pages_per_minute,
  {rh('unique_products_viewed / (products_viewed + 1)', 4)} AS unique_product_ratio
FROM sess""")
def q_c9(spark, sf):
    return S.training_features(sessions(spark, sf)).select(
        "session_id", "abandoned", "train_engagement_score", "cart_engagement", "time_per_product",
        "cart_to_checkout_rate", "pages_per_minute", "unique_product_ratio")


# J4, J6, T6, G12 --------------------------------------------------------------------

def _before(a_ts, a_id, b_ts, b_id, strict=False):
    op = "<" if strict else "<="
    return f"({a_ts} < {b_ts} OR ({a_ts} = {b_ts} AND {a_id} {op} {b_id}))"


LABELS_SQL = f"""
(SELECT p.*, CASE WHEN ab THEN 'abandoned' WHEN np_ts IS NOT NULL THEN 'converted' END AS actual_outcome,
   CASE WHEN ab THEN predicted_abandoned WHEN np_ts IS NOT NULL THEN NOT predicted_abandoned END
     AS was_prediction_correct
 FROM (SELECT p.*, n.np_ts, fa.fa_ts IS NOT NULL AND (
         {_before('fa.fa_ts', 'fa.fa_id', 'p.prediction_timestamp', 'p.prediction_id')} OR n.np_ts IS NULL
         OR {_before('fa.fa_ts', 'fa.fa_id', 'n.np_ts', 'n.np_id', strict=True)}) AS ab
       FROM preds p
       JOIN (SELECT pid, np_ts, np_id FROM (
               SELECT *, first_value(CASE WHEN kind = 0 THEN ts END IGNORE NULLS) OVER wf AS np_ts,
                         first_value(CASE WHEN kind = 0 THEN event_id END IGNORE NULLS) OVER wf AS np_id
               FROM (SELECT session_id, prediction_timestamp AS ts, prediction_id AS event_id, 1 AS kind,
                            prediction_id AS pid FROM preds
                     UNION ALL SELECT session_id, ts, event_id, 0, NULL FROM ev WHERE event_type = 'purchase') u
               WINDOW wf AS (PARTITION BY session_id ORDER BY ts, event_id, kind
                             ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING))
             WHERE kind = 1) n ON n.pid = p.prediction_id
       LEFT JOIN (SELECT session_id, first(ts ORDER BY ts, event_id) AS fa_ts,
                         first(event_id ORDER BY ts, event_id) AS fa_id
                  FROM ev WHERE event_type = 'cart_abandoned' GROUP BY session_id) fa
         ON fa.session_id = p.session_id) p)"""


def labelled(spark, sf):
    return O.label_outcomes(preds(spark, sf), events(spark, sf))


@register("label_outcomes", f"SELECT {PRED_COLS}, actual_outcome, was_prediction_correct FROM {LABELS_SQL} l")
def q_j4(spark, sf):
    cols = [x.strip() for x in PRED_COLS.split(",")] + ["actual_outcome", "was_prediction_correct"]
    return labelled(spark, sf).select(*cols)


@register("model_accuracy", f"""
SELECT *, COALESCE({pct('true_positives', 'true_positives + false_positives')}, 0.0) AS precision,
  COALESCE({pct('true_positives', 'true_positives + false_negatives')}, 0.0) AS recall FROM (
SELECT count(*) AS total_predictions, {cw('was_prediction_correct')} AS correct_predictions,
  {cw('predicted_abandoned AND was_prediction_correct')} AS true_positives,
  {cw('predicted_abandoned AND NOT was_prediction_correct')} AS false_positives,
  {cw('NOT predicted_abandoned AND NOT was_prediction_correct')} AS false_negatives,
  {pct(cw('was_prediction_correct'), 'count(*)')} AS accuracy_rate
FROM {LABELS_SQL} l WHERE was_prediction_correct IS NOT NULL AND {since('prediction_timestamp', H)})""")
def q_g12(spark, sf):
    return R.model_accuracy(labelled(spark, sf), H, AS_OF)


RECOVERY_SQL = f"""
(SELECT session_id, user_id, event_id AS abandonment_event_id, ts AS abandonment_time,
   {rh('COALESCE(cart_value, 0.0)', 2)} AS cart_value, abandonment_reason, time_in_cart_seconds,
   COALESCE(rec, FALSE) AS recovered, CASE WHEN rec THEN np_ts END AS recovery_time,
   CASE WHEN rec THEN gap END AS recovery_seconds, CASE WHEN rec THEN {rh('np_val', 2)} END AS recovery_value
 FROM (SELECT *, date_sub('second', ts, np_ts) AS gap,
              np_ts IS NOT NULL AND date_sub('second', ts, np_ts) >= {K.RECOVERY_DELAY_MIN_SECONDS} AS rec
       FROM (SELECT u.*, first_value(CASE WHEN kind = 0 THEN ts END IGNORE NULLS) OVER wf AS np_ts,
                    first_value(CASE WHEN kind = 0 THEN val END IGNORE NULLS) OVER wf AS np_val
             FROM (SELECT session_id, user_id, ts, event_id, 1 AS kind, cart_value, abandonment_reason,
                          time_in_cart_seconds, CAST(NULL AS DOUBLE) AS val FROM ev WHERE event_type = 'cart_abandoned'
                   UNION ALL
                   SELECT session_id, NULL, ts, event_id, 0, NULL, NULL, NULL, COALESCE(cart_value, 0.0)
                   FROM ev WHERE event_type = 'purchase') u
             WINDOW wf AS (PARTITION BY session_id ORDER BY ts, event_id, kind
                           ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING))
       WHERE kind = 1))"""


@register("attribute_recovery", f"SELECT * FROM {RECOVERY_SQL} r")
def q_j6(spark, sf):
    return O.attribute_recovery(events(spark, sf))


@register("detect_abandonment", f"""
SELECT session_id, user_id, event_id AS last_event_id, ts AS last_activity,
  ts + INTERVAL {K.CART_ABANDONMENT_IDLE_SECONDS} SECOND AS detected_at, cart_value,
  GREATEST(cart_additions - cart_removals, 0) AS items_count, next_ts AS next_activity
FROM (SELECT *, lead(ts) OVER (PARTITION BY session_id ORDER BY ts, event_id) AS next_ts FROM snap)
WHERE cart_value > 0 AND NOT is_converted
  AND date_sub('second', ts, COALESCE(next_ts, {AS_OF_SQL})) >= {K.CART_ABANDONMENT_IDLE_SECONDS}""")
def q_t6(spark, sf):
    return O.detect_abandonment(snaps(spark, sf), AS_OF)


# R: roll-ups ----------------------------------------------------------------------------

def _mode_sql(src: str, col: str, name: str) -> str:
    return (f"(SELECT user_id, first({col} ORDER BY n DESC, {col} ASC) AS {name} FROM "
            f"(SELECT user_id, {col}, count(*) AS n FROM {src} AND {col} IS NOT NULL GROUP BY user_id, {col}) "
            f"GROUP BY user_id)")


@register("user_profiles", f"""
SELECT s.user_id, total_sessions, total_page_views, total_products_viewed,
  COALESCE(total_purchases, 0) AS total_purchases, {rh('COALESCE(revenue, 0)', 2)} AS total_revenue,
  COALESCE({rh('CAST(COALESCE(revenue, 0) AS DOUBLE) / NULLIF(CAST(COALESCE(total_purchases, 0) AS DOUBLE), 0)', 2)},
           0.0) AS avg_order_value,
  avg_session_duration, total_time_on_site, total_cart_additions, total_cart_abandonments,
  COALESCE({pct('total_cart_abandonments', 'cart_sessions')}, 0.0) AS cart_abandonment_rate,
  CAST(date_diff('day', CAST(last_seen AS DATE), CAST({AS_OF_SQL} AS DATE)) AS INTEGER) AS days_since_last_visit,
  CAST(date_diff('day', CAST(last_purchase AS DATE), CAST({AS_OF_SQL} AS DATE)) AS INTEGER) AS days_since_last_purchase,
  {rh('CAST(COALESCE(total_purchases, 0) AS DOUBLE) / CAST(GREATEST(1, active_days) AS DOUBLE)', 2)}
    AS purchase_frequency,
  favorite_category, device_preference,
  COALESCE({rh('CAST(psum AS DOUBLE) * 100.0 / NULLIF(CAST(pn AS DOUBLE), 0)', 2)}, 0.0) AS churn_risk_score,
  first_seen, last_seen
FROM (SELECT user_id, count(*) AS total_sessions, CAST(sum(page_views) AS BIGINT) AS total_page_views,
        CAST(sum(products_viewed) AS BIGINT) AS total_products_viewed,
        {rh('CAST(sum(session_duration_seconds) AS DOUBLE) / CAST(count(*) AS DOUBLE)', 2)} AS avg_session_duration,
        CAST(sum(session_duration_seconds) AS BIGINT) AS total_time_on_site,
        CAST(sum(cart_additions) AS BIGINT) AS total_cart_additions,
        {cw('is_cart_abandoned')} AS total_cart_abandonments, {cw('cart_additions > 0')} AS cart_sessions,
        count(DISTINCT CAST(start_time AS DATE)) AS active_days, min(start_time) AS first_seen,
        max(last_activity) AS last_seen
      FROM sess GROUP BY user_id) s
LEFT JOIN (SELECT user_id, count(*) AS total_purchases, sum(CAST(COALESCE(cart_value, 0.0) AS DECIMAL(18,2))) AS revenue,
             max(ts) AS last_purchase FROM ev WHERE event_type = 'purchase' GROUP BY user_id) b ON b.user_id = s.user_id
LEFT JOIN (SELECT user_id, sum(CAST(abandonment_probability AS DECIMAL(18,4))) AS psum,
             count(abandonment_probability) AS pn FROM preds GROUP BY user_id) r ON r.user_id = s.user_id
LEFT JOIN {_mode_sql("ev WHERE event_type IN ('product_view', 'add_to_cart', 'purchase')", 'category',
                     'favorite_category')} f ON f.user_id = s.user_id
LEFT JOIN {_mode_sql('sess WHERE TRUE', 'device_type', 'device_preference')} d ON d.user_id = s.user_id""")
def q_r1(spark, sf):
    ev = events(spark, sf)
    snap = S.snapshots(ev)
    return RU.user_profiles(S.session_records(ev), ev, fixed_predictions(snap), AS_OF)


AMT = "CAST(COALESCE(price, 0) AS DECIMAL(12,2)) * CAST(COALESCE(quantity, 1) AS DECIMAL(10,0))"


def _win(hours):
    return f"(ts >= {AS_OF_SQL} - INTERVAL {hours} HOUR AND ts <= {AS_OF_SQL})"


@register("product_metrics", f"""
SELECT *, COALESCE({pct('total_cart_additions', 'total_views')}, 0.0) AS view_to_cart_rate,
  COALESCE({pct('total_purchases', 'total_cart_additions')}, 0.0) AS cart_to_purchase_rate,
  COALESCE({pct('total_purchases', 'total_views')}, 0.0) AS overall_conversion_rate,
  CAST(views_last_hour + 3 * cart_additions_last_hour + 5 * purchases_last_hour AS DOUBLE) AS trending_score
FROM (SELECT product_id, min(category) AS category, {rh('last(price ORDER BY ts, event_id)', 2)} AS price,
  {cw("event_type = 'product_view'")} AS total_views,
  {cw("event_type = 'product_view' AND " + _win(1))} AS views_last_hour,
  {cw("event_type = 'product_view' AND " + _win(24))} AS views_last_day,
  {cw("event_type = 'add_to_cart'")} AS total_cart_additions,
  {cw("event_type = 'add_to_cart' AND " + _win(1))} AS cart_additions_last_hour,
  {cw("event_type = 'purchase'")} AS total_purchases,
  {cw("event_type = 'purchase' AND " + _win(1))} AS purchases_last_hour,
  COALESCE({rh(f"sum(CASE WHEN event_type = 'purchase' THEN {AMT} END)", 2)}, 0.0) AS total_revenue,
  max(CASE WHEN event_type = 'product_view' THEN ts END) AS last_viewed,
  max(CASE WHEN event_type = 'purchase' THEN ts END) AS last_purchased
FROM ev WHERE product_id IS NOT NULL GROUP BY product_id)""")
def q_r2(spark, sf):
    return RU.product_metrics(unsessioned(spark, sf), AS_OF)


@register("category_metrics", f"""
SELECT category, total_views, total_purchases, {rh('COALESCE(rev, 0)', 2)} AS total_revenue,
  views_last_hour, purchases_last_hour, {rh('COALESCE(rev_h, 0)', 2)} AS revenue_last_hour,
  COALESCE({pct('total_purchases', 'total_views')}, 0.0) AS conversion_rate,
  COALESCE({rh('CAST(COALESCE(rev, 0) AS DOUBLE) / NULLIF(CAST(total_purchases AS DOUBLE), 0)', 2)}, 0.0)
    AS avg_order_value,
  COALESCE({rh('CAST(COALESCE(rev_h, 0) AS DOUBLE) * CAST(active_hours AS DOUBLE) / NULLIF(CAST(COALESCE(rev, 0) AS DOUBLE), 0)', 2)},
           0.0) AS momentum_score
FROM (SELECT category, {cw("event_type = 'product_view'")} AS total_views,
  {cw("event_type = 'purchase'")} AS total_purchases,
  sum(CASE WHEN event_type = 'purchase' THEN {AMT} END) AS rev,
  {cw("event_type = 'product_view' AND " + _win(1))} AS views_last_hour,
  {cw("event_type = 'purchase' AND " + _win(1))} AS purchases_last_hour,
  sum(CASE WHEN event_type = 'purchase' AND {_win(1)} THEN {AMT} END) AS rev_h,
  count(DISTINCT CASE WHEN event_type = 'purchase' THEN date_trunc('hour', ts) END) AS active_hours
FROM ev WHERE category IS NOT NULL GROUP BY category)""")
def q_r3(spark, sf):
    return RU.category_metrics(unsessioned(spark, sf), AS_OF)


@register("cart_abandonments", f"""
SELECT r.abandonment_event_id, r.session_id, r.user_id, r.cart_value,
  GREATEST(s.cart_additions - s.cart_removals, 0) AS item_count, r.abandonment_time,
  s.session_duration_seconds AS session_duration, s.page_views AS pages_viewed, r.abandonment_reason,
  r.time_in_cart_seconds, s.device_type, s.checkout_initiated, s.persona,
  {rh('m.pp * 100', 2)} AS churn_probability, COALESCE(m.pt, FALSE) AS intervention_triggered,
  m.pi AS intervention_type, r.recovered, r.recovery_time, r.recovery_value
FROM {RECOVERY_SQL} r
LEFT JOIN sess s ON s.session_id = r.session_id
LEFT JOIN (SELECT aid, pp, pt, pi FROM (
    SELECT *, last_value(CASE WHEN kind = 0 THEN p END IGNORE NULLS) OVER w AS pp,
              last_value(CASE WHEN kind = 0 THEN t END IGNORE NULLS) OVER w AS pt,
              last_value(CASE WHEN kind = 0 THEN it END IGNORE NULLS) OVER w AS pi,
              last_value(CASE WHEN kind = 0 THEN event_id END IGNORE NULLS) OVER w AS pid
    FROM (SELECT session_id, prediction_timestamp AS ts, prediction_id AS event_id, 0 AS kind,
                 abandonment_probability AS p, intervention_triggered AS t, intervention_type AS it, NULL AS aid
          FROM preds
          UNION ALL
          SELECT session_id, ts, event_id, 1, NULL, NULL, NULL, event_id FROM ev WHERE event_type = 'cart_abandoned') u
    WINDOW w AS (PARTITION BY session_id ORDER BY ts, event_id, kind
                 ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))
  WHERE kind = 1) m ON m.aid = r.abandonment_event_id""")
def q_r4(spark, sf):
    ev = events(spark, sf)
    snap = S.snapshots(ev)
    return RU.cart_abandonments(ev, S.session_records(ev), fixed_predictions(snap))


@register("recent_events", f"""
SELECT event_id, ts AS timestamp, event_type, user_id, session_id, product_id, category,
  {rh('COALESCE(cart_value, CAST(price AS DECIMAL(12,2)) * COALESCE(quantity, 1))', 2)} AS event_value, device_type
FROM ev WHERE {since('ts', K.RECENT_EVENTS_RETENTION_DAYS * 24)}""")
def q_r5(spark, sf):
    return RU.recent_events(events(spark, sf), AS_OF)


# T: streaming (replayed from a Spark-derived file stream with availableNow) ----------

def _replayed(spark, ev, build, output_mode, name, schema, close_after=()):
    """An ordered replay with a watermark of minutes, and what its batches wrote."""
    from cartflow.streaming.runner import read_sink, run_ordered_to
    out, _ = run_ordered_to(spark, ev, build, output_mode, name, close_after=close_after)
    return read_sink(spark, out, schema)


@register("stream_sessions", "SELECT * FROM sess")
def q_t1(spark, sf):
    from cartflow.streaming.sessions import RECORD_SCHEMA, latest_per_key, stream_sessions
    rows = _replayed(spark, events(spark, sf), stream_sessions, "update", "sessions", RECORD_SCHEMA)
    return latest_per_key(rows, ["session_id"])


@register("hopping_counts", """
SELECT window_start, window_start + INTERVAL 5 MINUTE AS window_end, event_type, count(*) AS events
FROM (SELECT event_type, time_bucket(INTERVAL 1 MINUTE, ts) - r.j * INTERVAL 1 MINUTE AS window_start
      FROM ev, range(5) r(j)) GROUP BY ALL""")
def q_t3(spark, sf):
    from cartflow.streaming.sessions import latest_per_key
    from cartflow.streaming.windows import hopping_counts
    rows = _replayed(spark, events(spark, sf), hopping_counts, "update", "hop",
                     "window_start timestamp, window_end timestamp, event_type string, events long")
    return latest_per_key(rows, ["window_start", "event_type"])


@register("sliding_by_key", """
SELECT window_start, window_start + INTERVAL 5 MINUTE AS window_end, key, count(*) AS events
FROM (SELECT COALESCE(CASE WHEN event_id % 7 > 0 THEN session_id END, 'unknown') AS key,
             time_bucket(INTERVAL 1 MINUTE, ts) - r.j * INTERVAL 1 MINUTE AS window_start
      FROM ev, range(5) r(j)) GROUP BY ALL""")
def q_t3_key(spark, sf):
    """Windows per key; every seventh event has lost session and user, so that 'unknown' is a hot key."""
    from cartflow.streaming.runner import CLOSING_SESSION, closing_seconds
    from cartflow.streaming.windows import sliding_by_key
    known = F.col("event_id") % 7 > 0
    ev = events(spark, sf).select("event_id", "ts", "event_type", F.when(known, F.col("session_id")).alias("session_id"),
                                  F.when(known, F.col("user_id")).alias("user_id"))
    rows = _replayed(spark, ev, sliding_by_key, "append", "sliding",
                     "window_start timestamp, window_end timestamp, key string, events long", closing_seconds())
    return rows.where(F.col("key") != CLOSING_SESSION).drop("_batch")


@register("hourly_tumbling", """
SELECT date_trunc('hour', ts) AS hour, event_type, count(*) AS events FROM ev GROUP BY ALL""")
def q_t11(spark, sf):
    from cartflow.streaming.sessions import latest_per_key
    from cartflow.streaming.windows import hourly_tumbling
    rows = _replayed(spark, events(spark, sf), hourly_tumbling, "update", "hour",
                     "hour timestamp, event_type string, events long")
    return latest_per_key(rows, ["hour", "event_type"])


@register("dedup_events", "SELECT event_id, ts, event_type, session_id FROM ev")
def q_t12(spark, sf):
    from cartflow.streaming.windows import dedup_events
    ev = events(spark, sf).select("event_id", "ts", "event_type", "session_id")
    # At-least-once delivery: every event arrives twice.
    return _replayed(spark, ev.unionByName(ev), dedup_events, "append", "dedup",
                     "event_id long, ts timestamp, event_type string, session_id string").drop("_batch")


@register("system_metrics")
def q_t14(spark, sf):
    from cartflow.streaming.metrics import progress_log, system_metrics
    from cartflow.streaming.runner import run_ordered_to
    from cartflow.streaming.windows import hourly_tumbling
    with progress_log(spark) as log:
        run_ordered_to(spark, events(spark, sf), hourly_tumbling, "update", "metrics")
    return system_metrics(spark, log)


# M: learning jobs (rows-only: no SQL twin for model fitting) ---------------------------

_MODELS: dict = {}


_FRAMES: dict = {}


def _learn_data(spark, sf):
    from cartflow.learn import models as L
    frame = L.training_frame(sessions(spark, sf))
    return L.stratified_split(frame, 0.2, 42)


def _stored_learn_data(spark, sf):
    """The split of a training frame that is written once per session and folder, for the many jobs of the models."""
    from cartflow.learn import models as L
    from cartflow.session import stored
    key = (spark.sparkContext.applicationId, sf)
    if key not in _FRAMES:
        _FRAMES[key] = stored(L.training_frame(sessions(spark, sf)), "learn-data")
    return L.stratified_split(_FRAMES[key], 0.2, 42)


def _fitted(spark, sf, kind):
    """Fitted models are memoised per process (driver-side model objects only)."""
    from cartflow.learn import grids as G
    from cartflow.learn import models as L
    key = (spark.sparkContext.applicationId, sf, kind)
    if key not in _MODELS:
        train, _ = _stored_learn_data(spark, sf)
        if kind == "forest":
            _MODELS[key] = L.train_forest(train, G.SMALL_FOREST_GRID, folds=3)
        elif kind == "boosted":
            _MODELS[key] = L.train_boosted(train, G.SMALL_BOOSTED_GRID, folds=3)
        else:
            _MODELS[key] = L.train_stacked(train, folds=3)
    return _MODELS[key]


def _metrics(spark, sf, kind):
    from cartflow.learn import models as L
    _, test = _stored_learn_data(spark, sf)
    if kind == "stacked":
        bases, meta, names = _fitted(spark, sf, kind)
        return L.evaluate(L.predict_stacked(bases, meta, names, test), "stacked")
    return L.evaluate(_fitted(spark, sf, kind).transform(test), kind)


TEST_ROW = "CAST('0x' || substr(md5('42:' || session_id), 1, 8) AS BIGINT) % 10000 < 2000"


def _frame_sql():
    """The training frame with its split, over the session table."""
    w = K.TRAIN_ENGAGEMENT_WEIGHTS
    counts = ["page_views", "products_viewed", "unique_products_viewed", "searches", "cart_additions", "cart_removals",
              "cart_value", "session_duration_seconds", "avg_time_per_page"]
    d = {x: f"CAST({x} AS DOUBLE)" for x in [*counts, "checkout_initiated"]}
    d["checkout_initiated"] = "CAST(CAST(checkout_initiated AS INTEGER) AS DOUBLE)"
    engaged = " + ".join(f"{d[x]} * CAST({w[x]} AS DOUBLE)" for x in ("page_views", "products_viewed", "searches"))
    derived = {
        "engagement_score": engaged, "cart_engagement": f"{d['cart_additions']} - {d['cart_removals']}",
        "time_per_product": f"{d['session_duration_seconds']} / ({d['products_viewed']} + 1)",
        "cart_to_checkout_rate": f"{d['checkout_initiated']} / ({d['cart_additions']} + 1)",
        "pages_per_minute": f"{d['page_views']} / ({d['session_duration_seconds']} / CAST(60 AS DOUBLE) + 1)",
        "unique_product_ratio": f"{d['unique_products_viewed']} / ({d['products_viewed']} + 1)"}
    cols = [f"{d[x]} AS {x}" for x in counts] + [f"{e} AS {x}" for x, e in derived.items()]
    cols += [f"COALESCE(CAST({x} AS VARCHAR), 'nan') AS {x}" for x in K.CATEGORICAL_FEATURES]
    cols += [f"CAST(CAST({x} AS INTEGER) AS DOUBLE) AS {x}" for x in K.BINARY_FEATURES]
    return (f"(SELECT session_id, {', '.join(cols)}, CAST(CAST(cart_value > 0 AND NOT is_converted AS INTEGER) AS DOUBLE)"
            f" AS label, {TEST_ROW} AS is_test FROM sess)")


def _matrix_sql():
    f = _frame_sql()
    moments = ", ".join(f"avg({x}) AS m_{x}, stddev_samp({x}) AS s_{x}" for x in K.NUMERIC_FEATURES)
    cols = [rh(f"CASE WHEN s_{x} > 0 THEN ({x} - m_{x}) / s_{x} ELSE 0 END", 6) + f" AS {x}"
            for x in K.NUMERIC_FEATURES]
    kinds = ", ".join(f"list_sort(list(DISTINCT {x})) AS l_{x}" for x in K.CATEGORICAL_FEATURES)
    cols += [f"CAST(COALESCE(list_position(l_{x}, {x}) - 1, len(l_{x})) AS DOUBLE) AS {x}"
             for x in K.CATEGORICAL_FEATURES]
    return (f"SELECT session_id, label, {', '.join([*cols, *K.BINARY_FEATURES])} FROM {f} f, "
            f"(SELECT {moments}, {kinds} FROM {f} WHERE NOT is_test) m")


@register("feature_matrix", _matrix_sql())
def q_m1(spark, sf):
    from pyspark.ml import Pipeline
    from pyspark.ml.functions import vector_to_array
    from cartflow.functions.exprs import round_half_up
    from cartflow.learn import models as L
    train, test = _learn_data(spark, sf)
    model = Pipeline(stages=L.feature_pipeline()).fit(train)
    out = model.transform(train.unionByName(test)).withColumn("_f", vector_to_array("features"))
    cols = [round_half_up(F.col("_f")[i], 6) if x in K.NUMERIC_FEATURES else F.col("_f")[i]
            for i, x in enumerate(L.FEATURE_NAMES)]
    return out.select("session_id", "label", *[c.alias(x) for c, x in zip(cols, L.FEATURE_NAMES)])


@register("stratified_split", f"""
SELECT CASE WHEN is_test THEN 'test' ELSE 'train' END AS split, label, count(*) AS rows
FROM {_frame_sql()} GROUP BY ALL""")
def q_m2(spark, sf):
    train, test = _learn_data(spark, sf)
    t = train.withColumn("split", F.lit("train")).unionByName(test.withColumn("split", F.lit("test")))
    return t.groupBy("split", "label").agg(F.count(F.lit(1)).alias("rows"))


@register("train_forest")
def q_m3(spark, sf):
    return _metrics(spark, sf, "forest")


@register("train_boosted")
def q_m4(spark, sf):
    return _metrics(spark, sf, "boosted")


@register("train_stacked")
def q_m5(spark, sf):
    return _metrics(spark, sf, "stacked")


@register("feature_importance")
def q_m7(spark, sf):
    from cartflow.learn import models as L
    return L.feature_importance(spark, _fitted(spark, sf, "forest"), 10)


@register("meta_weights")
def q_m7b(spark, sf):
    from cartflow.learn import models as L
    _, meta, names = _fitted(spark, sf, "stacked")
    return L.meta_weights(spark, meta, names)


@register("compare_models")
def q_m8(spark, sf):
    from cartflow.learn import models as L
    m = _metrics(spark, sf, "forest").unionByName(_metrics(spark, sf, "boosted")) \
        .unionByName(_metrics(spark, sf, "stacked"))
    return L.compare_models(m)


def _with_cart(spark, sf):
    """P5: every session with something in its cart."""
    from cartflow.learn import models as L
    return L.training_frame(sessions(spark, sf)).where("cart_value > 0")


@register("score_sessions")
def q_m9(spark, sf):
    from cartflow.learn import models as L
    return L.score(_with_cart(spark, sf), _fitted(spark, sf, "forest"))


@register("save_load_model")
def q_s15(spark, sf):
    from cartflow.learn import models as L
    from cartflow.session import fresh_dir
    path = fresh_dir(spark, "model")
    L.save_model(_fitted(spark, sf, "forest"), path)
    return L.score(_with_cart(spark, sf), L.load_model(path))


# S: sources, sinks and the table layer ----------------------------------------------------

from cartflow.sources import catalog as SC  # noqa: E402
from cartflow.sources import events as SE  # noqa: E402
from cartflow.sources import tables as TB  # noqa: E402
from cartflow.sources.fixture import read_table  # noqa: E402

SNAP_KEEP = ["session_id", "event_id", "ts", "cart_value", "page_views"]


@register("insert_if_absent", """
SELECT session_id, event_id, ts, cart_value, page_views
FROM (SELECT *, row_number() OVER (PARTITION BY session_id ORDER BY ts, event_id) AS rn FROM snap)
WHERE rn = 1 AND session_id NOT IN (SELECT session_id FROM sess WHERE start_time < TIMESTAMP '2024-01-10 00:00:00')""")
def q_s5(spark, sf):
    ev = events(spark, sf)
    target = S.session_records(ev).filter(F.col("start_time") < F.to_timestamp(F.lit("2024-01-10 00:00:00")))
    return TB.insert_if_absent(S.snapshots(ev).select(*SNAP_KEEP), target, ["session_id"], ["ts", "event_id"])


@register("upsert_latest", f"""
SELECT * EXCLUDE (rn), ts + INTERVAL {K.SESSION_CACHE_TTL_SECONDS} SECOND AS expires_at
FROM (SELECT session_id, event_id, ts, cart_value, page_views,
             row_number() OVER (PARTITION BY session_id ORDER BY ts DESC, event_id DESC) AS rn FROM snap)
WHERE rn = 1 AND ts + INTERVAL {K.SESSION_CACHE_TTL_SECONDS} SECOND > {AS_OF_SQL}""")
def q_s6(spark, sf):
    snap = snaps(spark, sf).select(*SNAP_KEEP)
    return TB.upsert_latest(snap, None, ["session_id"], ["ts", "event_id"], K.SESSION_CACHE_TTL_SECONDS, "ts",
                            AS_OF).drop("rn")


@register("run_query", f"""
SELECT risk_level, count(*) AS n, {pavg('abandonment_probability')} AS avg_probability FROM preds
WHERE prediction_timestamp >= TIMESTAMP '2024-01-24 00:00:00' AND abandonment_probability >= 0.5
GROUP BY risk_level""")
def q_s7(spark, sf):
    import datetime as _dt
    sql = ("SELECT risk_level, count(*) AS n, CAST(ROUND(CAST(CAST(sum(CAST(abandonment_probability AS "
           "DECIMAL(18,4))) AS DOUBLE) / count(abandonment_probability) AS DECIMAL(38,12)), 4) AS DOUBLE) "
           "AS avg_probability FROM preds_view WHERE prediction_timestamp >= :since "
           "AND abandonment_probability >= :min_p GROUP BY risk_level")
    return TB.run_query(spark, sql, {"since": _dt.datetime(2024, 1, 24), "min_p": 0.5},
                        {"preds_view": preds(spark, sf)})


TRAIN_SQL = ("SELECT session_id, user_id, start_time, CAST(NULL AS TIMESTAMP) AS end_time, last_activity, "
             "device_type, browser, page_views, products_viewed, unique_products_viewed, searches, cart_additions, "
             "cart_removals, cart_value, is_converted, purchase_value, is_cart_abandoned, abandonment_reason, "
             "time_in_cart_seconds, checkout_initiated, persona, session_duration_seconds, avg_time_per_page, "
             "bounce, start_time AS created_at, updated_at, cart_value > 0 AND NOT is_converted AS abandoned "
             "FROM sess ORDER BY start_time")


@register("export_training", TRAIN_SQL)
def q_s9(spark, sf):
    from cartflow.session import fresh_dir
    folder = fresh_dir(spark, "export")
    paths = TB.export_training(sessions(spark, sf), folder, "20240131_000000")
    return TB.load_training(spark, paths[1])


MIGRATED = [("is_cart_abandoned", "boolean", False), ("abandonment_reason", "string", None),
            ("time_in_cart_seconds", "int", 0), ("checkout_initiated", "boolean", False),
            ("persona", "string", None)]


@register("evolve_schema", """
SELECT * EXCLUDE (is_cart_abandoned, abandonment_reason, time_in_cart_seconds, checkout_initiated, persona),
  FALSE AS is_cart_abandoned, CAST(NULL AS VARCHAR) AS abandonment_reason, CAST(0 AS INTEGER) AS time_in_cart_seconds,
  FALSE AS checkout_initiated, CAST(NULL AS VARCHAR) AS persona
FROM sess""")
def q_s12(spark, sf):
    old = sessions(spark, sf).drop(*[m[0] for m in MIGRATED])
    return TB.evolve_schema(TB.evolve_schema(old, MIGRATED), MIGRATED)  # idempotent


@register("describe_columns")
def q_s13(spark, sf):
    sessions(spark, sf).createOrReplaceTempView("v_user_sessions")
    try:
        return TB.describe_columns(spark, "v_user_sessions", [m[0] for m in MIGRATED])
    finally:
        spark.catalog.dropTempView("v_user_sessions")


@register("purge_older_than", """
SELECT * FROM orders WHERE o_orderdate >= TIMESTAMP '2001-08-01 00:00:00' - INTERVAL 8760 HOUR""")
def q_s14(spark, sf):
    return TB.purge_older_than(read_table(spark, sf, "orders"), "o_orderdate", 365, "2001-08-01 00:00:00")


@register("retain_by_day", """
SELECT event_id, CAST(ts AS TIMESTAMP) AS ts, user_id, event_type, value FROM events
WHERE ts >= TIMESTAMP '2024-01-23 12:00:00'""")
def q_s14_days(spark, sf):
    """A table by day, of which retention drops folders; the cutoff cuts one day in the middle."""
    from cartflow.session import fresh_dir
    path = fresh_dir(spark, "by-day")
    ev = read_table(spark, sf, "events").select("event_id", F.col("ts").cast("timestamp").alias("ts"), "user_id",
                                                "event_type", "value")
    TB.write_by_day(ev, path, "ts")
    TB.retain_days(spark, path, "ts", 7, "2024-01-30 12:00:00")
    return spark.read.parquet(path).drop("day")


@register("validate_events", """
SELECT event_id, session_id, user_id, event_type, ts,
  CASE WHEN event_type IN ('add_to_cart', 'remove_from_cart') THEN COALESCE(quantity, 1) ELSE quantity END AS quantity,
  COALESCE(device_type, 'desktop') AS device_type
FROM ev""")
def q_s3(spark, sf):
    raw = SE.encode_events(events(spark, sf))
    decoded, _ = SE.decode_events(raw)
    valid, _ = SE.validate_events(decoded)
    return valid.select(F.col("event_id").cast("long").alias("event_id"), "session_id", "user_id", "event_type", "ts",
                        "quantity", "device_type")


@register("rejected_events", f"""
SELECT CASE event_id % 5 WHEN 0 THEN 'invalid json' WHEN 1 THEN 'field of the wrong type'
    WHEN 2 THEN 'timestamp missing or invalid' WHEN 3 THEN 'unknown event_type' ELSE 'session_id missing' END AS reason,
  count(*) AS events
FROM ev GROUP BY 1""")
def q_s3_rejects(spark, sf):
    """S2/S3 on events that are each broken in one way, picked by their id; counts of the reasons given."""
    raw = SE.encode_events(events(spark, sf).withColumn("event_id", F.concat(F.lit("evt_"), F.col("event_id"))))
    kind = F.pmod(F.get_json_object("value", "$.event_id").substr(5, 20).cast("long"), F.lit(5))
    v = F.col("value")
    broken = F.when(kind == 0, F.concat(F.lit("{"), v)) \
        .when(kind == 1, F.regexp_replace(v, r'"user_id":\d+', '"user_id":"someone"')) \
        .when(kind == 2, F.regexp_replace(v, r'"timestamp":"[^"]*"', '"timestamp":"not a time"')) \
        .when(kind == 3, F.regexp_replace(v, r'"event_type":"[^"]*"', '"event_type":"dance"')) \
        .otherwise(F.regexp_replace(v, r'"session_id":"[^"]*",?', ""))
    decoded, unread = SE.decode_events(raw.select(broken.alias("value")))
    _, invalid = SE.validate_events(decoded)
    reasons = unread.select("reason").unionByName(invalid.select(F.explode("reasons").alias("reason")))
    return reasons.groupBy("reason").agg(F.count(F.lit(1)).alias("events"))


@register("write_keyed_json")
def q_s4(spark, sf):
    return SE.encode_events(events(spark, sf))


def _catalogue(spark, sf):
    part = read_table(spark, sf, "part")
    raw = part.select(F.to_json(F.struct(
        F.col("p_partkey").alias("id"), F.col("p_name").alias("title"), F.col("p_retailprice").alias("price"),
        F.col("p_type").alias("category"), F.col("p_brand").alias("description"),
        F.struct((F.col("p_size").cast("double") / 10.0).alias("rate"), F.col("p_size").alias("count"))
        .alias("rating"))).alias("value"))
    parsed = raw.select(F.from_json("value", SC.PRODUCT_RAW_SCHEMA).alias("p")).select("p.*")
    return SC.flatten_products(parsed, AS_OF)


@register("flatten_products", f"""
SELECT 'prod_' || CAST(p_partkey AS VARCHAR) || '_' || substr(md5(CAST(p_partkey AS VARCHAR) || '|' || p_name), 1, 8)
    AS event_id, {AS_OF_SQL} AS timestamp, p_partkey AS product_id, p_name AS title, p_retailprice AS price,
  p_type AS category, p_brand AS description, CAST(NULL AS VARCHAR) AS image,
  CAST(p_size AS DOUBLE) / 10.0 AS rating_rate, p_size AS rating_count, 100 AS stock_quantity
FROM part""")
def q_s16(spark, sf):
    return _catalogue(spark, sf)


@register("categories", "SELECT DISTINCT p_type AS category FROM part WHERE p_type IS NOT NULL")
def q_s17(spark, sf):
    return SC.categories(_catalogue(spark, sf))


_STREAM_RUNS: dict = {}


def _scored_stream(spark, sf):
    """Ordered replay through the stateful fold and the multi-sink (run once per session and folder)."""
    from cartflow.session import fresh_dir
    from cartflow.streaming.runner import closing_seconds, run_ordered, start_multi_sink
    from cartflow.streaming.sessions import fold_stream, multi_sink
    key = (spark.sparkContext.applicationId, sf)
    if key not in _STREAM_RUNS:
        out = fresh_dir(spark, "stream-multi")
        run_ordered(spark, events(spark, sf),
                    lambda s: start_multi_sink(fold_stream(s, snapshots=True), multi_sink(out, label=True)), slices=4,
                    close_after=closing_seconds())
        _STREAM_RUNS[key] = out
    return _STREAM_RUNS[key]


@register("stream_predictions")
def q_t8(spark, sf):
    return _of_run(spark, sf, "predictions", PREDICTION_SCHEMA)


@register("stream_scores")
def q_t8_model(spark, sf):
    """The stream's session records scored with a trained forest; the latest score of each session."""
    from cartflow.session import fresh_dir
    from cartflow.streaming.models import ModelScorer, ModelShelf
    from cartflow.streaming.runner import read_sink, run_ordered, start_multi_sink
    from cartflow.streaming.sessions import fold_stream, latest_per_key, multi_sink
    shelf = ModelShelf(spark, fresh_dir(spark, "models"))
    shelf.publish(_fitted(spark, sf, "forest"), K.DEFAULT_MODEL_VERSION)
    out = fresh_dir(spark, "stream-scores")
    run_ordered(spark, events(spark, sf), lambda s: start_multi_sink(
        fold_stream(s), multi_sink(out, scorer=ModelScorer(shelf, "scores"))), slices=3)
    rows = read_sink(spark, f"{out}/predictions", PREDICTION_SCHEMA + ", confidence string")
    return latest_per_key(rows, ["session_id"])


PREDICTION_SCHEMA = (
    "prediction_id long, session_id string, user_id long, prediction_timestamp timestamp, abandonment_probability double, "
    "predicted_abandoned boolean, risk_level string, intervention_triggered boolean, intervention_type string, "
    "model_version string, prediction_latency_ms int")

LABELLED = ("prediction_id, session_id, user_id, prediction_timestamp, abandonment_probability, predicted_abandoned, "
            "risk_level, intervention_triggered, intervention_type, model_version, actual_outcome, "
            "was_prediction_correct")


@register("stream_label_outcomes")
def q_t9(spark, sf):
    """Every committed event with a cart is scored, and its prediction closed when the outcome arrives."""
    from cartflow.streaming.merge import labelled_predictions
    got = labelled_predictions(spark, _scored_stream(spark, sf))
    if got is None:
        got = spark.createDataFrame([], PREDICTION_SCHEMA + ", actual_outcome string, was_prediction_correct boolean")
    return got.where("session_id <> 'closing'").select(*LABELLED.split(", "))


ORACLE["stream_label_outcomes"] = f"SELECT {LABELLED} FROM ({ORACLE['label_outcomes']})"


@register("stream_latest_sessions", "SELECT * FROM sess")
def q_t9_latest(spark, sf):
    """S6 on a stream: the session table that the sink's batches keep."""
    from cartflow.streaming.merge import KeyedTable
    from cartflow.streaming.sessions import RECORD_SCHEMA
    got = KeyedTable(spark, f"{_scored_stream(spark, sf)}/latest_sessions", ["session_id"], ["last_activity"]).read()
    if got is None:
        got = spark.createDataFrame([], RECORD_SCHEMA)
    return got.where("session_id <> 'closing'").select(*[f.split()[0] for f in RECORD_SCHEMA.split(", ")])


@register("decoded_outcomes", f"""
SELECT 'evt_' || CAST(prediction_id AS VARCHAR) AS prediction_id, * EXCLUDE (prediction_id)
FROM (SELECT {LABELLED} FROM {LABELS_SQL} l)""")
def q_decoded(spark, sf):
    """S2, S3, W5, J4 on JSON events with text ids: decoded, validated, scored and labelled.

    Decoded events and predictions are each read several times by the next step, so they are stored.
    """
    from cartflow.session import stored
    raw = SE.encode_events(events(spark, sf).withColumn("event_id", F.concat(F.lit("evt_"), F.col("event_id"))))
    valid = stored(SE.validate_events(SE.decode_events(raw)[0])[0], "decoded-events")
    preds = stored(fixed_predictions(S.snapshots(valid)), "decoded-predictions")
    return O.label_outcomes(preds, valid).select(*LABELLED.split(", "))


IDLE_COLUMNS = "session_id, user_id, last_activity, detected_at, cart_value, items_count"
RECOVERY_COLUMNS = ("session_id, abandonment_event_id, abandonment_time, recovered, recovery_time, recovery_seconds, "
                    "recovery_value")


def _of_run(spark, sf, name, schema):
    from cartflow.streaming.runner import read_sink
    return read_sink(spark, f"{_scored_stream(spark, sf)}/{name}", schema)


@register("stream_abandonments")
def q_t6s(spark, sf):
    found = _of_run(spark, sf, "abandonments", "session_id string, user_id long, last_activity timestamp, "
                    "detected_at timestamp, cart_value double, items_count long")
    # The run is closed after AS_OF; the report is as of AS_OF.
    return found.where(F.col("detected_at") <= F.to_timestamp(F.lit(AS_OF))).drop("_batch")


ORACLE["stream_abandonments"] = f"SELECT {IDLE_COLUMNS} FROM ({ORACLE['detect_abandonment']})"


@register("stream_recoveries")
def q_t7(spark, sf):
    return _of_run(spark, sf, "recoveries", "session_id string, abandonment_event_id long, "
                   "abandonment_time timestamp, recovered boolean, recovery_time timestamp, recovery_seconds long, "
                   "recovery_value double").drop("_batch")


ORACLE["stream_recoveries"] = f"SELECT {RECOVERY_COLUMNS} FROM ({ORACLE['attribute_recovery']})"


@register("list_views")
def q_s13b(spark, sf):
    own = TB.register_views(sessions(spark, sf))
    try:
        return TB.list_views(spark, "v_").where(F.col("table_name").isin(own))
    finally:
        for name in own:
            spark.catalog.dropTempView(name)
