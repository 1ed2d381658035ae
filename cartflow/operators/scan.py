"""Skew-safe ordered scans (running aggregates per key).

A plain ``Window.partitionBy(key).orderBy(ts)`` puts every row of a key into
one task: a single hot user or session (a bot, a replayed feed) then holds up
the whole job.  ``segmented_scan`` splits each key into *buckets* (normally a
time bucket of the event time), runs the window inside ``(key, bucket)`` and
carries the prefix of earlier buckets over from a small per-bucket aggregate
(one row per key and bucket).  The result is exactly the running aggregate
over the whole key in order; no task ever sees more than one bucket of one
key.

Supported running aggregates (all inclusive of the current row unless noted):

* ``sums``         running sum of an expression;
* ``min_of_sums``  running minimum of one of those running sums (used for the
                   cart value floored at zero);
* ``lasts``        last non-null value of an expression;
* ``prevs``        value of an expression on the previous row (exclusive);
* ``firsts``       value of an expression on the first row of the key.

``descending=True`` scans in reverse order (then "last" means "next").
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def time_bucket(ts: str | Column, seconds: int) -> Column:
    """Bucket number of a timestamp column (floor of epoch / seconds)."""
    c = F.col(ts) if isinstance(ts, str) else ts
    return F.floor(F.unix_micros(c) / F.lit(seconds * 1_000_000)).cast("long")


def segmented_scan(df: DataFrame, keys: Sequence[str], order: Sequence[str], bucket: str,
                   sums: Mapping[str, Column] | None = None,
                   min_of_sums: Mapping[str, str] | None = None,
                   lasts: Mapping[str, Column] | None = None,
                   prevs: Mapping[str, Column] | None = None,
                   firsts: Mapping[str, Column] | None = None,
                   descending: bool = False, mark_last: str | None = None,
                   final_only: bool = False, keep: Sequence[str] = ()) -> DataFrame:
    """Add running-aggregate columns over ``keys`` in ``order``.

    ``bucket`` names an existing column that is monotone in ``order`` within a
    key (e.g. ``time_bucket("ts", 3600)``).  Keeping the same bucket column
    between consecutive scans lets Spark reuse the hash partitioning, so a
    chain of scans costs one shuffle of the large side.  ``mark_last`` names a
    boolean column set on the last row of every key (in scan order).

    The per-bucket carry is read off each bucket's last row (no aggregate),
    so no string or struct aggregation buffer forces a sort-based aggregate.

    ``final_only=True`` returns one row per key: the running values after its
    last row plus the ``keep`` columns of that row.  It is computed from the
    per-bucket table alone, so the events are never joined back.
    """
    sums = dict(sums or {})
    min_of_sums = dict(min_of_sums or {})
    lasts = dict(lasts or {})
    prevs = dict(prevs or {})
    firsts = dict(firsts or {})
    part = [*keys, bucket]
    ordcols = [F.col(c).desc() if descending else F.col(c).asc() for c in order]

    w = Window.partitionBy(*part).orderBy(*ordcols)
    wrun = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)

    # Inside (key, bucket): running values, plus the row number and a flag on
    # the bucket's last row, so it can be picked without an aggregate.
    # All window expressions of one pass go into a single select so that
    # Catalyst evaluates them in one Window operator over one sort.
    exprs = [F.row_number().over(w).alias("_sc_rn"), F.lead(F.lit(1)).over(w).isNull().alias("_sc_end")]
    exprs += [F.sum(e).over(wrun).alias(f"_sc_ls_{n}") for n, e in sums.items()]
    exprs += [F.last(e, ignorenulls=True).over(wrun).alias(f"_sc_ll_{n}") for n, e in lasts.items()]
    exprs += [F.lag(e).over(w).alias(f"_sc_lp_{n}") for n, e in prevs.items()]
    exprs += [e.alias(f"_sc_lv_{n}") for n, e in prevs.items()]
    exprs += [F.first(e).over(wrun).alias(f"_sc_lf_{n}") for n, e in firsts.items()]
    local = df.select("*", *exprs)
    if min_of_sums:
        local = local.select("*", *[F.min(f"_sc_ls_{src}").over(wrun).alias(f"_sc_lm_{n}")
                                    for n, src in min_of_sums.items()])

    # One row per (key, bucket): its last row carries what later buckets need.
    sel = [F.col(c) for c in part]
    sel += [F.col(f"_sc_ls_{n}").alias(f"_sc_B_{n}") for n in sums]
    sel += [F.col(f"_sc_lm_{n}").alias(f"_sc_M_{n}") for n in min_of_sums]
    sel += [F.col(f"_sc_ll_{n}").alias(f"_sc_L_{n}") for n in lasts]
    sel += [F.col(f"_sc_lv_{n}").alias(f"_sc_P_{n}") for n in prevs]
    sel += [F.col(f"_sc_lf_{n}").alias(f"_sc_F_{n}") for n in firsts]
    if final_only:
        sel += [F.col(c) for c in keep if c not in part]
    per_bucket = local.filter(F.col("_sc_end")).select(*sel)

    bord = F.col(bucket).desc() if descending else F.col(bucket).asc()
    wb = Window.partitionBy(*keys).orderBy(bord)
    wprev = wb.rowsBetween(Window.unboundedPreceding, -1)
    wall = wb.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    carry = per_bucket
    for name in sums:
        carry = carry.withColumn(f"_sc_O_{name}", F.sum(f"_sc_B_{name}").over(wprev))
    for name in lasts:
        carry = carry.withColumn(f"_sc_PL_{name}", F.last(f"_sc_L_{name}", ignorenulls=True).over(wprev))
    for name in prevs:
        carry = carry.withColumn(f"_sc_PP_{name}", F.lag(f"_sc_P_{name}").over(wb))
    for name in firsts:
        carry = carry.withColumn(f"_sc_FF_{name}", F.first(f"_sc_F_{name}").over(wall))
    if mark_last or final_only:
        carry = carry.withColumn("_sc_LB", F.lead(F.col(bucket)).over(wb).isNull())
    for name, src in min_of_sums.items():
        cand = F.coalesce(F.col(f"_sc_O_{src}"), F.lit(0)) + F.col(f"_sc_M_{name}")
        carry = carry.withColumn(f"_sc_PM_{name}", F.min(cand).over(wprev))
    if final_only:
        fin = carry.filter(F.col("_sc_LB"))
        outs = [F.col(c) for c in keys] + [F.col(c) for c in keep if c not in part]
        outs += [(F.coalesce(F.col(f"_sc_O_{n}"), F.lit(0)) + F.col(f"_sc_B_{n}")).alias(n) for n in sums]
        outs += [F.least(F.col(f"_sc_PM_{n}"), F.coalesce(F.col(f"_sc_O_{src}"), F.lit(0)) + F.col(f"_sc_M_{n}"))
                 .alias(n) for n, src in min_of_sums.items()]
        outs += [F.coalesce(F.col(f"_sc_L_{n}"), F.col(f"_sc_PL_{n}")).alias(n) for n in lasts]
        outs += [F.col(f"_sc_P_{n}").alias(n) for n in prevs]
        outs += [F.col(f"_sc_FF_{n}").alias(n) for n in firsts]
        return fin.select(*outs)
    keep_cols = [*part] + [c for c in carry.columns
                           if c.startswith(("_sc_O_", "_sc_PL_", "_sc_PP_", "_sc_FF_", "_sc_PM_", "_sc_LB"))]
    carry = carry.select(*keep_cols)

    out = local.join(carry, on=part, how="inner")
    for name in sums:
        out = out.withColumn(name, F.coalesce(F.col(f"_sc_O_{name}"), F.lit(0)) + F.col(f"_sc_ls_{name}"))
    for name, src in min_of_sums.items():
        here = F.coalesce(F.col(f"_sc_O_{src}"), F.lit(0)) + F.col(f"_sc_lm_{name}")
        out = out.withColumn(name, F.least(F.col(f"_sc_PM_{name}"), here))
    for name in lasts:
        out = out.withColumn(name, F.coalesce(F.col(f"_sc_ll_{name}"), F.col(f"_sc_PL_{name}")))
    for name in prevs:
        out = out.withColumn(name, F.when(F.col("_sc_rn") == 1, F.col(f"_sc_PP_{name}"))
                             .otherwise(F.col(f"_sc_lp_{name}")))
    for name in firsts:
        out = out.withColumn(name, F.col(f"_sc_FF_{name}"))
    if mark_last:
        out = out.withColumn(mark_last, F.col("_sc_end") & F.col("_sc_LB"))
    return out.drop(*[c for c in out.columns if c.startswith("_sc_")])
