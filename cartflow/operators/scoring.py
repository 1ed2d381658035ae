"""Risk scoring (C10-C13, M9 output shape) and the predictions table.

``fixed_scorer`` is a fixed-coefficient logistic score.  It is not a trained
model; it exists so that every report over predictions can be compared with
SQL.  Trained Spark ML models produce the same columns through
``cartflow.learn.models.score``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartflow import constants as K
from cartflow.functions.exprs import (is_high_risk, risk_confidence, risk_intervention, risk_level,
                                      round_half_up)


def scorable(snap: DataFrame) -> DataFrame:
    """P5: only sessions with a cart are sent to the scorer."""
    return snap.filter(F.col("cart_value") > 0)


def fixed_probability(snap: DataFrame) -> Column:
    c = F.col
    z = (F.lit(0.9) - 2.2 * F.when(c("checkout_initiated"), 1.0).otherwise(0.0) + 0.01 * c("cart_value")
         - 0.35 * c("cart_engagement").cast("double")
         + 0.4 * F.when(F.coalesce(c("persona"), F.lit("window_shopper")) == "cart_abandoner", 1.0).otherwise(0.0))
    return round_half_up(F.lit(1.0) / (F.lit(1.0) + F.exp(-z)), 4)


def risk_columns(p: Column) -> dict[str, Column]:
    """C10/C12 from a probability column."""
    return {
        "will_abandon": p > K.WILL_ABANDON_THRESHOLD,
        "risk_level": risk_level(p),
        "confidence": risk_confidence(p),
        "recommended_intervention": risk_intervention(p),
    }


def predictions_from_probability(scored: DataFrame, prob_col: str, model_version: str,
                                 latency: Column | None = None) -> DataFrame:
    """Shape scored snapshots as the ml_predictions table (one row per tick, Q4)."""
    p = F.col(prob_col)
    lvl = risk_level(p)
    lat = latency if latency is not None else F.lit(None).cast("int")
    return scored.select(
        F.col("event_id").alias("prediction_id"), "session_id", "user_id",
        F.col("ts").alias("prediction_timestamp"),
        p.alias("abandonment_probability"),
        (p > K.WILL_ABANDON_THRESHOLD).alias("predicted_abandoned"),
        lvl.alias("risk_level"),
        is_high_risk(lvl).alias("intervention_triggered"),
        risk_intervention(p).alias("intervention_type"),
        F.lit(model_version).alias("model_version"),
        lat.alias("prediction_latency_ms"),
    )


def fixed_predictions(snap: DataFrame) -> DataFrame:
    """Predictions of the fixed scorer for every snapshot with a cart.

    The fixture's snapshots carry a number ``k`` that stands for the latency; others have none.
    """
    s = scorable(snap).withColumn("_p", fixed_probability(scorable(snap)))
    latency = (F.col("k") * 2).cast("int") if "k" in snap.columns else None
    return predictions_from_probability(s, "_p", "fixed_logit_v1", latency)


def risk_levels(snap: DataFrame) -> DataFrame:
    """C10/C12 per scored snapshot: probability, flag, level, confidence, intervention."""
    s = scorable(snap)
    p = fixed_probability(s)
    s = s.select("session_id", "event_id", p.alias("abandonment_probability"))
    for name, e in risk_columns(F.col("abandonment_probability")).items():
        s = s.withColumn(name, e)
    return s.withColumn("intervention_triggered", is_high_risk(F.col("risk_level")))


def feature_violations(features: DataFrame) -> DataFrame:
    """Reasons a feature row would be refused by the scorer (empty = valid)."""
    c = F.col
    non_neg = ["page_views", "products_viewed", "unique_products_viewed", "searches", "cart_additions",
               "cart_removals", "cart_value", "session_duration_seconds", "avg_time_per_page",
               "time_per_product", "pages_per_minute"]
    unit = ["engagement_score", "cart_to_checkout_rate", "unique_product_ratio"]
    required = non_neg + unit + ["session_id", "cart_engagement", "device_type", "browser", "persona",
                                 "bounce", "checkout_initiated"]
    checks = [F.when(c(x).isNull(), F.lit(f"{x} missing")) for x in required]
    checks += [F.when(c(x) < 0, F.lit(f"{x} < 0")) for x in non_neg + unit]
    checks += [F.when(c(x) > 1, F.lit(f"{x} > 1")) for x in unit]
    return features.withColumn("violations", F.filter(F.array(*checks), lambda x: x.isNotNull()))
