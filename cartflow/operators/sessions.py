"""Session records and per-event snapshots.

Everything is a grouped aggregate or a segmented scan; no Python runs per row.
Cart amounts are summed as DECIMAL so results are exact and identical in any
engine; the floored cart value uses

    cart_n = S_n - least(0, min_{k<=n} S_k),   S = running sum of +-price*qty

which equals the fold ``cart = max(0, cart + delta)`` for any deltas.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartflow import constants as K
from cartflow.functions.exprs import round_half_up, safe_div, seconds_between
from cartflow.operators.scan import segmented_scan, time_bucket

SESSION_BUCKET_SECONDS = 3600
ORDER = ["ts", "event_id"]


def _et(name: str) -> Column:
    return F.col("event_type") == name


def _ordkey() -> Column:
    return F.struct(F.col("ts"), F.col("event_id"))


def cart_delta() -> Column:
    """Signed cart change of an event: +price*qty on add, -price*qty on remove."""
    amount = F.coalesce(F.col("price"), F.lit(0.0)).cast("decimal(12,2)") * \
        F.coalesce(F.col("quantity"), F.lit(1)).cast("decimal(10,0)")
    zero = F.lit(0).cast("decimal(12,2)")
    return (F.when(_et("add_to_cart"), amount).when(_et("remove_from_cart"), -amount)
            .otherwise(zero)).cast("decimal(24,2)")


def _with_bucket(ev: DataFrame, bucket_seconds: int) -> DataFrame:
    return ev.withColumn("_ss_bucket", time_bucket("ts", bucket_seconds))


def running_cart(ev: DataFrame, bucket_seconds: int = SESSION_BUCKET_SECONDS) -> DataFrame:
    """Every event with the session's cart value right after it."""
    df = _with_bucket(ev, bucket_seconds).withColumn("_delta", cart_delta())
    df = segmented_scan(df, ["session_id"], ORDER, "_ss_bucket",
                        sums={"_cart_s": F.col("_delta")}, min_of_sums={"_cart_m": "_cart_s"})
    cart = F.col("_cart_s") - F.least(F.lit(0).cast("decimal(24,2)"), F.col("_cart_m"))
    return df.withColumn("cart_value_running", round_half_up(cart, 2)).drop(
        "_ss_bucket", "_delta", "_cart_s", "_cart_m")


def _session_scan(df: DataFrame, bucket_seconds: int, product_flag: Column, final_only: bool = False) -> DataFrame:
    """Every session counter, flag and last/first value as of each event (one scan).

    With ``final_only`` one row per session: its state after the last event.
    """
    df = _with_bucket(df, bucket_seconds).withColumn("_delta", cart_delta())
    ind = lambda name: F.when(_et(name), 1).otherwise(0)
    return segmented_scan(
        df, ["session_id"], ORDER, "_ss_bucket",
        sums={"_pv": ind("page_view"), "_prod": product_flag, "_pvc": ind("product_view"),
              "_srch": ind("search"), "_add": ind("add_to_cart"), "_rem": ind("remove_from_cart"),
              "_chk": ind("checkout_initiated"), "_buy": ind("purchase"), "_abd": ind("cart_abandoned"),
              "_n": F.lit(1), "_cart_s": F.col("_delta")},
        min_of_sums={"_cart_m": "_cart_s"},
        lasts={"_pval": F.when(_et("purchase"), F.coalesce(F.col("cart_value"), F.lit(0.0))),
               "_reason": F.when(_et("cart_abandoned"), F.col("abandonment_reason")),
               "_tic": F.when(_et("cart_abandoned"), F.coalesce(F.col("time_in_cart_seconds"), F.lit(0))),
               "_pers_start": F.when(_et("session_start"), F.col("persona")),
               "_pers_any": F.col("persona"),
               "_start_ts": F.when(_et("session_start"), F.col("ts"))},
        firsts={"_dev": F.col("device_type"), "_brw": F.col("browser"), "_first_ts": F.col("ts")},
        mark_last=None if final_only else "_is_last",
        final_only=final_only, keep=["ts", "user_id"],
    )


def _record_columns() -> list[Column]:
    start = F.coalesce(F.col("_start_ts"), F.col("_first_ts"))
    cart = round_half_up(F.col("_cart_s") - F.least(F.lit(0).cast("decimal(24,2)"), F.col("_cart_m")), 2)
    return [
        start.alias("start_time"),
        F.coalesce(F.col("_dev"), F.lit("desktop")).alias("device_type"),
        F.coalesce(F.col("_brw"), F.lit("Unknown")).alias("browser"),
        F.col("_pv").alias("page_views"),
        F.col("_pvc").alias("product_view_count"),
        F.col("_srch").alias("searches"),
        F.col("_add").alias("cart_additions"),
        F.col("_rem").alias("cart_removals"),
        cart.alias("cart_value"),
        (F.col("_buy") > 0).alias("is_converted"),
        round_half_up(F.coalesce(F.col("_pval"), F.lit(0.0)), 2).alias("purchase_value"),
        (F.col("_abd") > 0).alias("is_cart_abandoned"),
        F.col("_reason").alias("abandonment_reason"),
        F.coalesce(F.col("_tic"), F.lit(0)).alias("time_in_cart_seconds"),
        (F.col("_chk") > 0).alias("checkout_initiated"),
        F.coalesce(F.col("_pers_start"), F.col("_pers_any")).alias("persona"),
        seconds_between(start, F.col("ts")).alias("session_duration_seconds"),
    ]


def session_records(ev: DataFrame, bucket_seconds: int = SESSION_BUCKET_SECONDS) -> DataFrame:
    """One record per session (the user_sessions table).

    The record is the session's state after its last event, taken from the
    segmented scan's per-bucket table (``final_only``): events are shuffled
    once and never joined back.  Distinct products come from a separate hash
    aggregate on (session, product) joined by session id.
    """
    last = _session_scan(ev, bucket_seconds, F.lit(0), final_only=True)
    rec = last.select("session_id", "user_id", F.col("ts").alias("last_activity"),
                      F.col("_n").alias("event_count"), *_record_columns())
    products = (ev.filter(_et("product_view") & F.col("product_id").isNotNull())
                .groupBy("session_id").agg(F.count_distinct("product_id").alias("_np")))
    rec = rec.join(products, "session_id", "left").withColumn("products_viewed", F.coalesce(F.col("_np"), F.lit(0)))
    dur = F.col("session_duration_seconds")
    return rec.select(
        "session_id", "user_id", "start_time", "last_activity", "device_type", "browser",
        "page_views", "products_viewed", F.col("products_viewed").alias("unique_products_viewed"),
        "product_view_count", "searches", "cart_additions", "cart_removals", "cart_value",
        "is_converted", "purchase_value", "session_duration_seconds",
        round_half_up(safe_div(dur, F.col("page_views")), 2).alias("avg_time_per_page"),
        ((F.col("page_views") <= 1) & (dur < 30)).alias("bounce"),
        "is_cart_abandoned", "abandonment_reason", "time_in_cart_seconds", "checkout_initiated", "persona",
        F.col("last_activity").alias("updated_at"), "event_count",
    )


def _first_view_flag(ev: DataFrame) -> DataFrame:
    """Mark the first view of each product within a session (for running distinct counts)."""
    views = (ev.filter(_et("product_view") & F.col("product_id").isNotNull())
             .groupBy("session_id", "product_id")
             .agg(F.min(_ordkey()).alias("_first_view")))
    out = ev.join(views, ["session_id", "product_id"], "left")
    flag = F.when(_et("product_view") & (_ordkey() == F.col("_first_view")), 1).otherwise(0)
    return out.withColumn("_new_product", flag).drop("_first_view")


def serving_features(page_views: Column, products: Column, unique_products: Column, adds: Column,
                     removes: Column, cart_value: Column, duration: Column, checkout: Column,
                     bounce: Column) -> dict[str, Column]:
    """Features the scorer receives, with the service's rounding."""
    w = K.ENGAGEMENT_WEIGHTS
    ppm = safe_div(page_views, duration.cast("double") / 60.0)
    engagement = F.least(
        F.lit(1.0),
        F.lit(w["products_per_page"]) * safe_div(products, page_views)
        + F.lit(w["cart_additions"]) * adds.cast("double")
        + F.lit(w["cart_value_per_add"]) * safe_div(cart_value, F.greatest(F.lit(1), adds).cast("double")
                                                    * K.CART_VALUE_PER_ADD_NORM)
        + F.lit(w["pages_per_minute"]) * ppm
        + F.lit(w["not_bounce"]) * F.when(bounce, 0.0).otherwise(1.0))
    return {
        "engagement_score": round_half_up(engagement, 4),
        "cart_engagement": (adds - removes).cast("long"),
        "time_per_product": round_half_up(safe_div(duration, products), 2),
        "cart_to_checkout_rate": round_half_up(safe_div(checkout.cast("int"), adds), 2),
        "pages_per_minute": round_half_up(ppm, 2),
        "unique_product_ratio": round_half_up(safe_div(unique_products, products), 2),
    }


def snapshots(ev: DataFrame, bucket_seconds: int = SESSION_BUCKET_SECONDS) -> DataFrame:
    """The session record as of every event, with serving features.

    This is what the streaming job scores at each tick: one row per event.
    The fixture's ``k`` is passed on where the events carry it.
    """
    own = [c for c in ("k",) if c in ev.columns]
    df = _session_scan(_first_view_flag(ev), bucket_seconds, F.col("_new_product"))
    df = df.select("session_id", "event_id", "user_id", "ts", "event_type", *own, *_record_columns(),
                   F.col("_prod").alias("products_viewed"), F.col("_prod").alias("unique_products_viewed"))
    bounce = (F.col("page_views") <= 1) & (F.col("session_duration_seconds") < 30)
    feats = serving_features(F.col("page_views"), F.col("products_viewed"), F.col("unique_products_viewed"),
                             F.col("cart_additions"), F.col("cart_removals"), F.col("cart_value"),
                             F.col("session_duration_seconds"), F.col("checkout_initiated"), bounce)
    df = df.withColumn("avg_time_per_page",
                       round_half_up(safe_div(F.col("session_duration_seconds"), F.col("page_views")), 2))
    df = df.withColumn("bounce", bounce)
    for name, e in feats.items():
        df = df.withColumn(name, e)
    return df


def running_items(ev: DataFrame, bucket_seconds: int = SESSION_BUCKET_SECONDS) -> DataFrame:
    """Every event with ``item_count``, the entries in the cart right after it.

    An add puts one entry in, a removal takes one out (of an empty cart none),
    and a purchase clears the cart.  The clearings number the session's carts
    with one scan; within a cart the count is the floored running sum.
    """
    ind = lambda name: F.when(_et(name), 1).otherwise(0)
    df = segmented_scan(_with_bucket(ev, bucket_seconds), ["session_id"], ORDER, "_ss_bucket",
                        sums={"_cart_no": ind("purchase")})
    step = F.when(_et("add_to_cart"), 1).when(_et("remove_from_cart"), -1).otherwise(0)
    df = segmented_scan(df, ["session_id", "_cart_no"], ORDER, "_ss_bucket", sums={"_in": step},
                        min_of_sums={"_low": "_in"})
    return df.withColumn("item_count", F.col("_in") - F.least(F.lit(0), F.col("_low"))) \
        .drop("_ss_bucket", "_cart_no", "_in", "_low")


def session_state(ev: DataFrame, bucket_seconds: int = SESSION_BUCKET_SECONDS) -> DataFrame:
    """Journey state after every event.

    Hard transitions: add -> cart_active, a removal that takes the last item
    of the cart (counted since the last purchase) -> interested, checkout ->
    checkout_initiated, purchase -> purchased, abandonment -> abandoned,
    recovery -> recovering.  Before any hard transition the state is
    interested once the session has >= 3 page views or >= 2 product views,
    else browsing.
    """
    rc = running_items(running_cart(ev, bucket_seconds), bucket_seconds)
    hard = (F.when(_et("add_to_cart"), "cart_active")
            .when(_et("remove_from_cart") & (F.col("item_count") == 0), "interested")
            .when(_et("checkout_initiated"), "checkout_initiated")
            .when(_et("purchase"), "purchased")
            .when(_et("cart_abandoned"), "abandoned")
            .when(_et("session_recovered"), "recovering"))
    ind = lambda name: F.when(_et(name), 1).otherwise(0)
    df = _with_bucket(rc, bucket_seconds)
    df = segmented_scan(df, ["session_id"], ORDER, "_ss_bucket",
                        sums={"_pv": ind("page_view"), "_pvc": ind("product_view")},
                        lasts={"_hard": hard})
    soft = F.when((F.col("_pv") >= 3) | (F.col("_pvc") >= 2), "interested").otherwise("browsing")
    return df.select("session_id", "event_id", "user_id", "ts", "event_type",
                     F.col("cart_value_running").alias("cart_value"), "item_count",
                     F.coalesce(F.col("_hard"), soft).alias("session_state"))


def session_edges(ev: DataFrame) -> DataFrame:
    """First and last event of every session (ties broken by event id)."""
    o = _ordkey()
    first = F.min_by(F.struct("event_id", "event_type", "ts"), o)
    last = F.max_by(F.struct("event_id", "event_type", "ts"), o)
    g = ev.groupBy("session_id").agg(first.alias("f"), last.alias("l"))
    return g.select("session_id",
                    F.col("f.event_id").alias("first_event_id"), F.col("f.event_type").alias("first_event_type"),
                    F.col("f.ts").alias("first_ts"),
                    F.col("l.event_id").alias("last_event_id"), F.col("l.event_type").alias("last_event_type"),
                    F.col("l.ts").alias("last_ts"))


def cart_lines(ev: DataFrame) -> DataFrame:
    """C19 items: one row per (session, product) still in the cart; a purchase clears it.

    The cart is kept as rows, not as a collected array, so a session with any
    number of products never has to fit in one value.
    """
    qty = F.coalesce(F.col("quantity"), F.lit(1)).cast("long")
    signed = F.when(_et("add_to_cart"), qty).when(_et("remove_from_cart"), -qty)
    bought = ev.filter(_et("purchase")).groupBy("session_id").agg(F.max(_ordkey()).alias("_bought"))
    cart_ev = ev.filter(_et("add_to_cart") | _et("remove_from_cart")).join(bought, "session_id", "left") \
        .filter(F.col("_bought").isNull() | (_ordkey() > F.col("_bought")))
    g = cart_ev.groupBy("session_id", "product_id").agg(
        F.min("user_id").alias("user_id"),
        F.sum(signed).alias("_net"),
        F.max_by("price", _ordkey()).alias("price"),
        F.max("ts").alias("last_updated"))
    g = g.filter(F.col("_net") > 0)
    return g.select("session_id", "user_id", "product_id", F.col("_net").alias("quantity"),
                    round_half_up("price", 2).alias("price"),
                    round_half_up(F.col("price").cast("decimal(12,2)") * F.col("_net"), 2).alias("line_value"),
                    "last_updated")


def cart_state(ev: DataFrame) -> DataFrame:
    """Per session the cart's item count, total value and last update."""
    lines = cart_lines(ev)
    return lines.groupBy("session_id").agg(
        F.min("user_id").alias("user_id"),
        F.count(F.lit(1)).alias("item_count"),
        F.sum("quantity").alias("total_quantity"),
        round_half_up(F.sum(F.col("line_value").cast("decimal(24,2)")), 2).alias("total_value"),
        F.max("last_updated").alias("last_updated"))


def training_features(sess: DataFrame) -> DataFrame:
    """The training loader's engineered features and the abandonment label."""
    w = K.TRAIN_ENGAGEMENT_WEIGHTS
    c = F.col
    return sess.select(
        "*",
        ((c("cart_value") > 0) & ~c("is_converted")).alias("abandoned"),
        round_half_up(c("page_views") * w["page_views"] + c("products_viewed") * w["products_viewed"]
                      + c("searches") * w["searches"], 4).alias("train_engagement_score"),
        (c("cart_additions") - c("cart_removals")).alias("cart_engagement"),
        round_half_up(c("session_duration_seconds") / (c("products_viewed") + 1), 4).alias("time_per_product"),
        round_half_up(c("checkout_initiated").cast("int") / (c("cart_additions") + 1), 4).alias("cart_to_checkout_rate"),
        round_half_up(c("page_views") / (c("session_duration_seconds") / 60.0 + 1), 4).alias("pages_per_minute"),
        round_half_up(c("unique_products_viewed") / (c("products_viewed") + 1), 4).alias("unique_product_ratio"),
    )
