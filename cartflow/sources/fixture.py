"""Adapter from the given ``events`` table to storefront events.

The test ``events`` table is ``(event_id, ts, user_id, event_type, value,
props)`` with ``props = {"k": n}``.  It carries no session, device, product or
cart columns, so one deterministic mapping derives them (FIXTURES.md §2).
The same mapping is written in DuckDB SQL in ``cartflow.plans.oracle``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cartflow import constants as K


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _pick(values: list[str], idx) -> F.Column:
    arr = F.array(*[F.lit(v) for v in values])
    return F.element_at(arr, (idx % len(values)).cast("int") + 1)


def storefront_events(raw: DataFrame) -> DataFrame:
    """Map raw ``events`` rows to storefront events (no session id yet)."""
    k = F.from_json(F.col("props"), "k INT").getField("k")
    u = F.col("user_id")
    t = F.col("event_type")
    etype = (F.when((t == "view") & (k % 2 == 0), "page_view")
             .when(t == "view", "product_view")
             .when((t == "signup") & (k % 3 == 0), "search")
             .when(t == "signup", "product_view")
             .when((t == "click") & (k < 70), "add_to_cart")
             .when(t == "click", "remove_from_cart")
             .when((t == "error") & (k % 2 == 0), "checkout_initiated")
             .when(t == "error", "cart_abandoned")
             .otherwise(t))
    df = raw.select(
        F.col("event_id"),
        F.col("ts").cast("timestamp").alias("ts"),
        u.alias("user_id"),
        etype.alias("event_type"),
        F.col("value"),
        k.alias("k"),
    )
    et = F.col("event_type")
    has_product = et.isin("product_view", "add_to_cart", "remove_from_cart", "purchase")
    has_qty = et.isin("add_to_cart", "remove_from_cart", "purchase")
    has_cart = et.isin("purchase", "cart_abandoned")
    abandoned = et == "cart_abandoned"
    kk = F.col("k")
    return df.select(
        "event_id", "ts", "user_id", "event_type",
        F.when(has_product, kk).alias("product_id"),
        F.when(has_product, _pick(K.CATEGORIES, kk)).alias("category"),
        F.when(has_product, F.col("value")).alias("price"),
        F.when(has_qty, (kk % 3 + 1).cast("int")).alias("quantity"),
        F.when(has_cart, F.col("value")).alias("cart_value"),
        (F.when(u % 10 < 5, "desktop").when(u % 10 < 9, "mobile").otherwise("tablet")).alias("device_type"),
        _pick(K.BROWSERS, kk).alias("browser"),
        (F.when(u % 20 < 12, "window_shopper").when(u % 20 < 17, "intent_buyer")
         .otherwise("cart_abandoner")).alias("persona"),
        F.when(abandoned, _pick(K.ABANDONMENT_REASONS, kk)).alias("abandonment_reason"),
        F.when(abandoned, (kk * 30).cast("int")).alias("time_in_cart_seconds"),
        kk.alias("k"),
    )


def load_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Storefront events with session ids (12 h inactivity gap per user)."""
    from cartflow.operators.sessionize import sessionize
    raw = read_table(spark, sf_dir, "events")
    return sessionize(storefront_events(raw), gap_seconds=K.SESSION_GAP_SECONDS)
