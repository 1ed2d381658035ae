"""Benchmark: headline cartflow jobs at $BENCH_SF_DIR on local[$BENCH_CPUS].

Mirrors how the system runs: one job turns raw events into the session,
snapshot and prediction tables (written as parquet in the shared scratch
folder), then every report runs over those tables.  Each step is forced with
the ``noop`` sink (or a parquet write) and timed.  Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from cartflow import constants as K  # noqa: E402
from cartflow.operators import outcomes as O  # noqa: E402
from cartflow.operators import reports as R  # noqa: E402
from cartflow.operators import rollups as RU  # noqa: E402
from cartflow.operators import sessions as S  # noqa: E402
from cartflow.operators.scoring import fixed_predictions  # noqa: E402
from cartflow.session import fresh_dir, get_spark  # noqa: E402
from cartflow.sources.fixture import load_events  # noqa: E402


def run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    spark = get_spark(f"local[{cpus}]", shuffle_partitions=cpus * 2,
                      extra={"spark.driver.memory": os.environ.get("BENCH_DRIVER_MEMORY", "16g")})
    out = fresh_dir(spark, "bench")
    times: dict[str, float] = {}

    def timed(name, fn):
        t0 = time.perf_counter()
        fn()
        times[name] = round(time.perf_counter() - t0, 3)

    # Warm-up on the smallest data so JVM start-up is not billed to the first query.
    warm = load_events(spark, "/root/testdata/sf0.001")
    for df in (warm, S.session_records(warm), fixed_predictions(S.snapshots(warm))):
        run(df)

    # 1. events -> tables
    timed("events_sessionize", lambda: load_events(spark, sf_dir).write.mode("overwrite").parquet(f"{out}/ev"))
    ev = spark.read.parquet(f"{out}/ev")
    timed("session_records", lambda: S.session_records(ev).write.mode("overwrite").parquet(f"{out}/sess"))
    timed("snapshots_predictions",
          lambda: fixed_predictions(S.snapshots(ev)).write.mode("overwrite").parquet(f"{out}/preds"))
    sess = spark.read.parquet(f"{out}/sess")
    preds = spark.read.parquet(f"{out}/preds")
    n_events = ev.count()

    h, as_of = K.REPORT_HOURS, K.AS_OF
    reports = {
        "abandonment_detail": lambda: R.abandonment_detail(sess),
        "conversion_funnel_daily": lambda: R.conversion_funnel_daily(sess),
        "abandonment_reasons": lambda: R.abandonment_reasons(sess),
        "risk_distribution": lambda: R.risk_distribution(preds, h, as_of),
        "hourly_predictions": lambda: R.hourly_predictions(preds, h, as_of),
        "predictions_in_range": lambda: R.predictions_in_range(preds, sess, h, as_of),
        "persona_performance": lambda: R.persona_performance(preds, sess, h, as_of),
        "abandonment_by_device": lambda: R.abandonment_by_device(preds, sess, h, as_of),
        "intervention_effectiveness": lambda: R.intervention_effectiveness(preds, sess, h, as_of),
        "latency_stats": lambda: R.latency_stats(preds, h, as_of),
        "business_impact": lambda: R.business_impact(preds, sess, h, as_of),
        "label_outcomes": lambda: O.label_outcomes(preds, ev),
        "attribute_recovery": lambda: O.attribute_recovery(ev),
        "user_profiles": lambda: RU.user_profiles(sess, ev, preds, as_of),
        "product_metrics": lambda: RU.product_metrics(ev, as_of),
        "cart_abandonments": lambda: RU.cart_abandonments(ev, sess, preds),
        "event_mix": lambda: R.event_mix(ev),
    }
    for name, build in reports.items():
        timed(name, lambda b=build: run(b()))

    # 3. streaming session records over the same events, replayed slice by slice with a watermark of minutes
    from cartflow.streaming.runner import run_ordered_to
    from cartflow.streaming.sessions import stream_sessions
    timed("stream_sessions", lambda: run_ordered_to(spark, ev, stream_sessions, "update", "bench-sessions", slices=4))

    # 4. batch scoring of every session with a fitted forest (fit not timed)
    from pyspark.ml import Pipeline
    from pyspark.ml.classification import RandomForestClassifier
    from cartflow.learn import models as L
    frame = L.training_frame(sess)
    model = Pipeline(stages=[*L.feature_pipeline(),
                             RandomForestClassifier(labelCol=L.LABEL, numTrees=50, maxDepth=10, seed=42)]).fit(frame)
    timed("batch_scoring", lambda: run(L.score(frame, model)))
    n_sessions = sess.count()

    # A fixed job that depends on the machine only, so that rounds on other machines compare.
    from pyspark.sql import functions as F
    start = time.time()
    spark.range(200_000_000).select(F.sum(F.xxhash64("id") % 1000)).collect()
    calibration = round(time.time() - start, 3)

    total = round(sum(times.values()), 3)
    build_sec = times["events_sessionize"] + times["session_records"] + times["snapshots_predictions"]
    print(json.dumps({
        "metric": "total_sec",
        "value": total,
        "unit": "sec",
        "queries": times,
        "calibration_sec": calibration,
        "sf": sf_dir.rstrip("/").rsplit("sf", 1)[-1],
        "events": n_events,
        "events_to_tables_events_per_sec": round(n_events / build_sec, 1) if build_sec else None,
        "stream_events_per_sec": round(n_events / times["stream_sessions"], 1),
        "scoring_sessions_per_sec": round(n_sessions / times["batch_scoring"], 1),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
