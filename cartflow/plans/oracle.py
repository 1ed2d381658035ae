"""DuckDB SQL twins of the registered queries (the correctness oracle).

Every statement starts from the raw ``events`` view and re-derives the
storefront events, sessions, snapshots and predictions with plain window SQL
(the obvious single-node formulation), so it checks the Spark code paths
(segmented scans, partial aggregates) independently.
"""

from __future__ import annotations

from cartflow import constants as K


def rh(expr: str, d: int) -> str:
    """Round half away from zero through DECIMAL, as double (see round_half_up)."""
    return f"CAST(ROUND(CAST(({expr}) AS DECIMAL(38,12)), {d}) AS DOUBLE)"


def sdiv(a: str, b: str) -> str:
    return f"COALESCE(CAST(({a}) AS DOUBLE) / NULLIF(CAST(({b}) AS DOUBLE), 0), 0.0)"


def pct(num: str, den: str, d: int = 2) -> str:
    return rh(f"CAST(({num}) AS DOUBLE) * 100.0 / NULLIF(CAST(({den}) AS DOUBLE), 0)", d)


def _lit_list(values) -> str:
    return "[" + ", ".join("'" + v.replace("'", "''") + "'" for v in values) + "]"


def _sq(v: str) -> str:
    return "'" + v.replace("'", "''") + "'"


def risk_case(p: str, field: int) -> str:
    """CASE over the risk bands; field 1 = level, 2 = confidence, 3 = intervention."""
    parts = [f"WHEN {p} >= {band[0]} THEN {_sq(band[field])}" for band in K.RISK_BANDS]
    return "CASE " + " ".join(parts) + " END"


def cw(cond: str) -> str:
    return f"count(CASE WHEN {cond} THEN 1 END)"


def msum(x: str) -> str:
    return f"CAST(sum(CAST({x} AS DECIMAL(18,2))) AS DOUBLE)"


def mavg(x: str, d: int = 4) -> str:
    return rh(f"CAST(sum(CAST({x} AS DECIMAL(18,2))) AS DOUBLE) / NULLIF(CAST(count({x}) AS DOUBLE), 0)", d)


def navg(x: str, d: int = 4) -> str:
    return rh(f"CAST(sum(CAST({x} AS BIGINT)) AS DOUBLE) / NULLIF(CAST(count({x}) AS DOUBLE), 0)", d)


def pavg(x: str, d: int = 4) -> str:
    return rh(f"CAST(sum(CAST({x} AS DECIMAL(18,4))) AS DOUBLE) / NULLIF(CAST(count({x}) AS DOUBLE), 0)", d)


HIGH = "risk_level IN ('HIGH', 'CRITICAL')"


GAP_US = K.SESSION_GAP_SECONDS * 1_000_000
AS_OF = f"TIMESTAMP '{K.AS_OF}'"


def since(ts: str, hours: int = K.REPORT_HOURS) -> str:
    return f"{ts} >= {AS_OF} - INTERVAL {hours} HOUR"


ORD = "ORDER BY ts, event_id"
WRUN = f"(PARTITION BY session_id {ORD} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"

PRELUDE = f"""
ev0 AS (
  SELECT event_id, CAST(ts AS TIMESTAMP) AS ts, user_id, value, k,
    CASE WHEN event_type = 'view' AND k % 2 = 0 THEN 'page_view'
         WHEN event_type = 'view' THEN 'product_view'
         WHEN event_type = 'signup' AND k % 3 = 0 THEN 'search'
         WHEN event_type = 'signup' THEN 'product_view'
         WHEN event_type = 'click' AND k < 70 THEN 'add_to_cart'
         WHEN event_type = 'click' THEN 'remove_from_cart'
         WHEN event_type = 'error' AND k % 2 = 0 THEN 'checkout_initiated'
         WHEN event_type = 'error' THEN 'cart_abandoned'
         ELSE event_type END AS event_type
  FROM (SELECT *, CAST(json_extract(props, '$.k') AS INTEGER) AS k FROM events)
),
ev1 AS (
  SELECT event_id, ts, user_id, event_type,
    CASE WHEN hp THEN k END AS product_id,
    CASE WHEN hp THEN {_lit_list(K.CATEGORIES)}[k % 4 + 1] END AS category,
    CASE WHEN hp THEN value END AS price,
    CASE WHEN event_type IN ('add_to_cart', 'remove_from_cart', 'purchase') THEN CAST(k % 3 + 1 AS INTEGER) END AS quantity,
    CASE WHEN event_type IN ('purchase', 'cart_abandoned') THEN value END AS cart_value,
    CASE WHEN user_id % 10 < 5 THEN 'desktop' WHEN user_id % 10 < 9 THEN 'mobile' ELSE 'tablet' END AS device_type,
    {_lit_list(K.BROWSERS)}[k % 5 + 1] AS browser,
    CASE WHEN user_id % 20 < 12 THEN 'window_shopper' WHEN user_id % 20 < 17 THEN 'intent_buyer'
         ELSE 'cart_abandoner' END AS persona,
    CASE WHEN event_type = 'cart_abandoned' THEN {_lit_list(K.ABANDONMENT_REASONS)}[k % 8 + 1] END AS abandonment_reason,
    CASE WHEN event_type = 'cart_abandoned' THEN CAST(k * 30 AS INTEGER) END AS time_in_cart_seconds,
    k
  FROM (SELECT *, event_type IN ('product_view', 'add_to_cart', 'remove_from_cart', 'purchase') AS hp FROM ev0)
),
ev2 AS (
  SELECT *, CASE WHEN prev_ts IS NULL OR epoch_us(ts) - epoch_us(prev_ts) >= {GAP_US} THEN 1 ELSE 0 END AS new_flag
  FROM (SELECT *, lag(ts) OVER (PARTITION BY user_id {ORD}) AS prev_ts FROM ev1)
),
ev AS (
  SELECT * EXCLUDE (prev_ts, new_flag),
    'sess_' || CAST(user_id AS VARCHAR) || '_' ||
      CAST(sum(new_flag) OVER (PARTITION BY user_id {ORD} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS VARCHAR)
      AS session_id
  FROM ev2
),
evd AS (
  SELECT *,
    CASE WHEN event_type = 'add_to_cart' THEN amt WHEN event_type = 'remove_from_cart' THEN -amt
         ELSE CAST(0 AS DECIMAL(24,2)) END AS delta
  FROM (SELECT *, CAST(CAST(COALESCE(price, 0) AS DECIMAL(12,2)) * CAST(COALESCE(quantity, 1) AS DECIMAL(10,0))
                       AS DECIMAL(24,2)) AS amt FROM ev)
),
rc0 AS (SELECT *, sum(delta) OVER {WRUN} AS cart_s FROM evd),
rc AS (
  SELECT * EXCLUDE (amt), min(cart_s) OVER {WRUN} AS cart_m,
    {rh("cart_s - LEAST(0, min(cart_s) OVER " + WRUN + ")", 2)} AS cart_value_running
  FROM rc0
),
sess0 AS (
  SELECT session_id, min(user_id) AS user_id,
    COALESCE(max(ts) FILTER (WHERE event_type = 'session_start'), min(ts)) AS start_time,
    max(ts) AS last_activity,
    COALESCE(first(device_type {ORD}), 'desktop') AS device_type,
    COALESCE(first(browser {ORD}), 'Unknown') AS browser,
    count(*) FILTER (WHERE event_type = 'page_view') AS page_views,
    count(DISTINCT CASE WHEN event_type = 'product_view' THEN product_id END) AS products_viewed,
    count(*) FILTER (WHERE event_type = 'product_view') AS product_view_count,
    count(*) FILTER (WHERE event_type = 'search') AS searches,
    count(*) FILTER (WHERE event_type = 'add_to_cart') AS cart_additions,
    count(*) FILTER (WHERE event_type = 'remove_from_cart') AS cart_removals,
    sum(delta) AS cart_total, min(cart_s) AS cart_min,
    bool_or(event_type = 'purchase') AS is_converted,
    last(COALESCE(cart_value, 0.0) {ORD}) FILTER (WHERE event_type = 'purchase') AS pval,
    bool_or(event_type = 'cart_abandoned') AS is_cart_abandoned,
    last(abandonment_reason {ORD}) FILTER (WHERE event_type = 'cart_abandoned') AS abandonment_reason,
    last(time_in_cart_seconds {ORD}) FILTER (WHERE event_type = 'cart_abandoned') AS tic,
    bool_or(event_type = 'checkout_initiated') AS checkout_initiated,
    last(persona {ORD}) FILTER (WHERE event_type = 'session_start' AND persona IS NOT NULL) AS pers_start,
    last(persona {ORD}) FILTER (WHERE persona IS NOT NULL) AS pers_any,
    count(*) AS event_count
  FROM rc0 GROUP BY session_id
),
sess AS (
  SELECT session_id, user_id, start_time, last_activity, device_type, browser,
    page_views, products_viewed, products_viewed AS unique_products_viewed, product_view_count,
    searches, cart_additions, cart_removals,
    {rh("cart_total - LEAST(0, cart_min)", 2)} AS cart_value,
    is_converted, {rh("COALESCE(pval, 0.0)", 2)} AS purchase_value,
    dur AS session_duration_seconds,
    {rh(sdiv("dur", "page_views"), 2)} AS avg_time_per_page,
    (page_views <= 1 AND dur < 30) AS bounce,
    is_cart_abandoned, abandonment_reason, COALESCE(tic, 0) AS time_in_cart_seconds,
    checkout_initiated, COALESCE(pers_start, pers_any) AS persona,
    last_activity AS updated_at, event_count
  FROM (SELECT *, date_sub('second', start_time, last_activity) AS dur FROM sess0)
),
snap0 AS (
  SELECT *,
    CAST(sum(CASE WHEN event_type = 'page_view' THEN 1 ELSE 0 END) OVER {WRUN} AS BIGINT) AS page_views,
    CAST(sum(CASE WHEN event_type = 'product_view' AND product_id IS NOT NULL AND fv = 1 THEN 1 ELSE 0 END) OVER {WRUN} AS BIGINT)
      AS products_viewed,
    CAST(sum(CASE WHEN event_type = 'product_view' THEN 1 ELSE 0 END) OVER {WRUN} AS BIGINT) AS product_view_count,
    CAST(sum(CASE WHEN event_type = 'search' THEN 1 ELSE 0 END) OVER {WRUN} AS BIGINT) AS searches,
    CAST(sum(CASE WHEN event_type = 'add_to_cart' THEN 1 ELSE 0 END) OVER {WRUN} AS BIGINT) AS cart_additions,
    CAST(sum(CASE WHEN event_type = 'remove_from_cart' THEN 1 ELSE 0 END) OVER {WRUN} AS BIGINT) AS cart_removals,
    CAST(sum(CASE WHEN event_type = 'checkout_initiated' THEN 1 ELSE 0 END) OVER {WRUN} AS BIGINT) > 0 AS checkout_initiated,
    CAST(sum(CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END) OVER {WRUN} AS BIGINT) > 0 AS is_converted,
    CAST(sum(CASE WHEN event_type = 'cart_abandoned' THEN 1 ELSE 0 END) OVER {WRUN} AS BIGINT) > 0 AS is_cart_abandoned,
    last_value(CASE WHEN event_type = 'purchase' THEN COALESCE(cart_value, 0.0) END IGNORE NULLS) OVER {WRUN} AS pval,
    last_value(CASE WHEN event_type = 'cart_abandoned' THEN abandonment_reason END IGNORE NULLS) OVER {WRUN} AS reason,
    last_value(CASE WHEN event_type = 'cart_abandoned' THEN COALESCE(time_in_cart_seconds, 0) END IGNORE NULLS)
      OVER {WRUN} AS tic,
    last_value(CASE WHEN event_type = 'session_start' THEN persona END IGNORE NULLS) OVER {WRUN} AS pers_start,
    last_value(persona IGNORE NULLS) OVER {WRUN} AS pers_any,
    last_value(CASE WHEN event_type = 'session_start' THEN ts END IGNORE NULLS) OVER {WRUN} AS start_ts,
    first_value(device_type) OVER {WRUN} AS dev, first_value(browser) OVER {WRUN} AS brw,
    first_value(ts) OVER {WRUN} AS first_ts
  FROM (SELECT *, CASE WHEN event_type = 'product_view' THEN
               row_number() OVER (PARTITION BY session_id, product_id, event_type {ORD}) END AS fv FROM rc)
),
snap1 AS (
  SELECT session_id, event_id, user_id, ts, event_type, k,
    COALESCE(start_ts, first_ts) AS start_time,
    COALESCE(dev, 'desktop') AS device_type, COALESCE(brw, 'Unknown') AS browser,
    page_views, products_viewed, products_viewed AS unique_products_viewed, product_view_count, searches,
    cart_additions, cart_removals, cart_value_running AS cart_value, is_converted,
    {rh("COALESCE(pval, 0.0)", 2)} AS purchase_value, is_cart_abandoned, reason AS abandonment_reason,
    COALESCE(tic, 0) AS time_in_cart_seconds, checkout_initiated,
    COALESCE(pers_start, pers_any) AS persona,
    date_sub('second', COALESCE(start_ts, first_ts), ts) AS session_duration_seconds
  FROM snap0
),
snap AS (
  SELECT *,
    {rh(sdiv("session_duration_seconds", "page_views"), 2)} AS avg_time_per_page,
    (page_views <= 1 AND session_duration_seconds < 30) AS bounce,
    {rh("LEAST(1.0, 0.35 * " + sdiv("products_viewed", "page_views") + " + 0.2 * CAST(cart_additions AS DOUBLE) + 0.2 * "
        + sdiv("cart_value", "CAST(GREATEST(1, cart_additions) AS DOUBLE) * 40.0") + " + 0.15 * "
        + sdiv("page_views", "CAST(session_duration_seconds AS DOUBLE) / 60.0")
        + " + 0.1 * CASE WHEN (page_views <= 1 AND session_duration_seconds < 30) THEN 0.0 ELSE 1.0 END)", 4)}
      AS engagement_score,
    CAST(cart_additions - cart_removals AS BIGINT) AS cart_engagement,
    {rh(sdiv("session_duration_seconds", "products_viewed"), 2)} AS time_per_product,
    {rh(sdiv("CAST(checkout_initiated AS INTEGER)", "cart_additions"), 2)} AS cart_to_checkout_rate,
    {rh(sdiv("page_views", "CAST(session_duration_seconds AS DOUBLE) / 60.0"), 2)} AS pages_per_minute,
    {rh(sdiv("unique_products_viewed", "products_viewed"), 2)} AS unique_product_ratio
  FROM snap1
),
preds0 AS (
  SELECT *, {rh("1.0 / (1.0 + exp(-z))", 4)} AS abandonment_probability
  FROM (SELECT *, CAST(0.9 AS DOUBLE) - CAST(2.2 AS DOUBLE) * CASE WHEN checkout_initiated THEN CAST(1 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END
                  + CAST(0.01 AS DOUBLE) * cart_value - CAST(0.35 AS DOUBLE) * CAST(cart_engagement AS DOUBLE)
                  + CAST(0.4 AS DOUBLE) * CASE WHEN COALESCE(persona, 'window_shopper') = 'cart_abandoner'
                                          THEN CAST(1 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END AS z
        FROM snap WHERE cart_value > 0)
),
preds AS (
  SELECT event_id AS prediction_id, session_id, user_id, ts AS prediction_timestamp, abandonment_probability,
    abandonment_probability > 0.5 AS predicted_abandoned,
    {risk_case("abandonment_probability", 1)} AS risk_level,
    {risk_case("abandonment_probability", 1)} IN ('HIGH', 'CRITICAL') AS intervention_triggered,
    {risk_case("abandonment_probability", 3)} AS intervention_type,
    'fixed_logit_v1' AS model_version,
    CAST(2 * k AS INTEGER) AS prediction_latency_ms
  FROM preds0
)
"""


def q(body: str) -> str:
    return "WITH " + PRELUDE.strip() + "\n" + body.strip()
