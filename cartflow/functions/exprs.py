"""Scalar expressions (C-operators): all JVM-side column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from cartflow import constants as K


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def round_half_up(c: str | Column, digits: int) -> Column:
    """Round half away from zero on the decimal value, returned as double.

    Rounding a double directly differs between engines (1.005 is stored as
    1.00499...); going through DECIMAL(38,12) gives the same answer in Spark,
    DuckDB and PostgreSQL.
    """
    return F.round(col(c).cast("decimal(38,12)"), digits).cast("double")


def safe_div(a: str | Column, b: str | Column) -> Column:
    """a / b as double, 0 when b is 0 or NULL."""
    return F.coalesce(F.try_divide(col(a).cast("double"), col(b).cast("double")), F.lit(0.0))


def pct(num: str | Column, den: str | Column, digits: int = 2) -> Column:
    """round(100 * num / nullif(den, 0), digits); NULL when den is 0."""
    return round_half_up(F.try_divide(col(num).cast("double") * 100.0, col(den).cast("double")), digits)


def seconds_between(start: str | Column, end: str | Column) -> Column:
    """Whole seconds from start to end, truncated toward zero."""
    return F.timestamp_diff("SECOND", col(start), col(end))


def since(ts: str | Column, hours: int, as_of: str) -> Column:
    """Time-range predicate ``ts >= as_of - hours``."""
    return col(ts) >= (F.to_timestamp(F.lit(as_of)) - F.make_interval(hours=F.lit(hours)))


# --- risk (C10, C12) -----------------------------------------------------

def risk_level(p: str | Column) -> Column:
    e = None
    for lo, level, _, _ in K.RISK_BANDS:
        e = (F.when(col(p) >= lo, F.lit(level)) if e is None else e.when(col(p) >= lo, F.lit(level)))
    return e


def risk_confidence(p: str | Column) -> Column:
    e = None
    for lo, _, conf, _ in K.RISK_BANDS:
        e = (F.when(col(p) >= lo, F.lit(conf)) if e is None else e.when(col(p) >= lo, F.lit(conf)))
    return e


def risk_intervention(p: str | Column) -> Column:
    e = None
    for lo, _, _, text in K.RISK_BANDS:
        e = (F.when(col(p) >= lo, F.lit(text)) if e is None else e.when(col(p) >= lo, F.lit(text)))
    return e


def is_high_risk(level: str | Column) -> Column:
    return col(level).isin(*K.HIGH_RISK_LEVELS)


def risk_rank(level: str | Column) -> Column:
    """CRITICAL=1, HIGH=2, MEDIUM=3, LOW=4, else NULL (report order)."""
    e = None
    for i, lv in enumerate(K.RISK_ORDER, 1):
        e = F.when(col(level) == lv, F.lit(i)) if e is None else e.when(col(level) == lv, F.lit(i))
    return e


# --- category codes (C11) ------------------------------------------------

def code_of(c: str | Column, mapping: dict[str, int]) -> Column:
    """Case-insensitive fixed code; unknown or NULL -> 0."""
    m = F.create_map(*[x for kv in mapping.items() for x in (F.lit(kv[0]), F.lit(kv[1]))])
    return F.coalesce(F.try_element_at(m, F.lower(col(c))), F.lit(0))


# --- latency verdict (C14) and ROI (G20) ---------------------------------

def latency_verdict_avg(avg_ms: str | Column) -> Column:
    """C14: 'Good' when the average latency is under target, else 'Slow'."""
    return F.when(col(avg_ms) < K.LATENCY_TARGET_AVG_MS, F.lit("Good")).otherwise(F.lit("Slow"))


def latency_verdict_p95(p95_ms: str | Column) -> Column:
    """C14: 'Good' when the p95 latency is under target, else 'Slow'."""
    return F.when(col(p95_ms) < K.LATENCY_TARGET_P95_MS, F.lit("Good")).otherwise(F.lit("Slow"))


def roi_label(roi: str | Column) -> Column:
    return (F.when(col(roi) > K.ROI_EXCELLENT, F.lit("Excellent"))
            .when(col(roi) > K.ROI_GOOD, F.lit("Good")).otherwise(F.lit("Low")))
