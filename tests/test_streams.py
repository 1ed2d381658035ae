"""Keyed state, the session fold, the sink's merges, metrics and late rows on streams."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from cartflow.plans.catalog import LABELLED, QUERIES, events
from cartflow.session import fresh_dir
from cartflow.streaming.keyed import process_events
from cartflow.streaming.merge import KeyedTable, labelled_predictions
from cartflow.streaming.runner import closing_seconds, run_bounded, run_ordered, start_multi_sink
from cartflow.streaming.sessions import fold_stream, latest_per_key, multi_sink


def rows(df):
    return sorted(map(str, df.collect()))


def replay(spark, ev, slices, ids="long", wrap=lambda sink: sink):
    out = fresh_dir(spark, "stream-test")
    run_ordered(spark, ev, lambda s: start_multi_sink(fold_stream(s, snapshots=True),
                                                      wrap(multi_sink(out, ids=ids, label=True))),
                slices=slices, close_after=closing_seconds())
    return out


@pytest.mark.parametrize("slices", [2, 8])
def test_results_do_not_depend_on_micro_batches_or_replays(spark, small_dir, slices):
    """Detections, recoveries, sessions and labels equal the batch's, even if batches are delivered twice."""
    def twice(sink):
        def run(batch, batch_id):
            sink(batch, batch_id)
            if slices == 2 and batch_id % 2 == 0:
                sink(batch, batch_id)
        return run
    out = replay(spark, events(spark, small_dir), slices, wrap=twice)
    for name, query in (("abandonments", "stream_abandonments"), ("recoveries", "stream_recoveries")):
        want = QUERIES[query](spark, small_dir)
        got = spark.read.parquet(f"{out}/{name}").select(*want.columns)
        if name == "abandonments":
            got = got.where("detected_at <= timestamp'2024-01-31 00:00:00'")
        assert rows(got) == rows(want)
    batch = QUERIES["session_records"](spark, small_dir)
    cols = ["session_id", "cart_value", "is_converted", "page_views", "products_viewed", "last_activity"]
    last = latest_per_key(spark.read.parquet(f"{out}/sessions"), ["session_id"]).where("session_id <> 'closing'")
    kept = KeyedTable(spark, f"{out}/latest_sessions", ["session_id"], ["last_activity"]).read()
    assert rows(last.select(*cols)) == rows(batch.select(*cols))
    assert rows(kept.where("session_id <> 'closing'").select(*cols)) == rows(batch.select(*cols))
    cols = LABELLED.split(", ")
    want = QUERIES["label_outcomes"](spark, small_dir).select(*cols)
    assert rows(labelled_predictions(spark, out).select(*cols)) == rows(want)
    # Ended sessions leave nothing in the keyed tables.
    for name, keys in (("open_predictions", ["prediction_id"]), ("first_abandonments", ["session_id"])):
        assert KeyedTable(spark, f"{out}/{name}", keys, ["ts"]).read().count() == 0


def test_text_ids_and_events_after_2024(spark):
    """Decoded events have text ids; the run's end follows the data."""
    t0 = dt.datetime(2031, 5, 1)
    at = lambda m: t0 + dt.timedelta(minutes=m)
    data = [("s", "evt_a", at(0), 1, "add_to_cart", 5, 10.0, 2, None), ("s", "evt_b", at(1), 1, "cart_abandoned", None, None, None, 20.0),
            ("s", "evt_c", at(30), 1, "purchase", None, None, None, 20.0), ("t", "evt_d", at(2), 2, "add_to_cart", 6, 3.0, None, None)]
    ev = spark.createDataFrame(data, "session_id string, event_id string, ts timestamp, user_id long, event_type string, "
                                     "product_id int, price double, quantity int, cart_value double")
    for c in ("device_type", "browser", "persona", "abandonment_reason"):
        ev = ev.withColumn(c, F.lit(None).cast("string"))
    ev = ev.withColumn("time_in_cart_seconds", F.lit(None).cast("int"))
    out = replay(spark, ev, 2, ids="string")
    got = labelled_predictions(spark, out).where("session_id <> 'closing'").collect()
    from cartflow.operators import outcomes as O, sessions as S
    from cartflow.operators.scoring import fixed_predictions
    want = O.label_outcomes(fixed_predictions(S.snapshots(ev)), ev).collect()
    key = lambda r: (r.prediction_id, r.actual_outcome, r.was_prediction_correct, r.abandonment_probability)
    assert sorted(map(key, got), key=str) == sorted(map(key, want), key=str)
    found = spark.read.parquet(f"{out}/recoveries").collect()
    assert [(r.abandonment_event_id, r.recovered, r.recovery_seconds) for r in found] == [("evt_b", True, 1740)]
    idle = spark.read.parquet(f"{out}/abandonments").collect()
    assert sorted((r.session_id, r.cart_value) for r in idle) == [("s", 20.0), ("t", 3.0)]


def test_products_beyond_the_few(spark):
    """Distinct products are exact however many a session views and however batches cut it."""
    from cartflow.streaming import sessions as SS
    t0 = dt.datetime(2024, 3, 1)
    data = [("s", i, t0 + dt.timedelta(minutes=i), 1, "product_view", i % 45, 1.0, None, None) for i in range(120)]
    ev = spark.createDataFrame(data, "session_id string, event_id long, ts timestamp, user_id long, event_type string, "
                                     "product_id int, price double, quantity int, cart_value double")
    for c in ("device_type", "browser", "persona", "abandonment_reason"):
        ev = ev.withColumn(c, F.lit(None).cast("string"))
    ev = ev.withColumn("time_in_cart_seconds", F.lit(None).cast("int"))
    assert SS.FEW < 45
    out = replay(spark, ev, 3)
    last = latest_per_key(spark.read.parquet(f"{out}/sessions"), ["session_id"]).where("session_id = 's'").first()
    assert (last.products_viewed, last.product_view_count) == (45, 120)


def test_empty_table(spark, small_dir):
    out = replay(spark, events(spark, small_dir).limit(0), 2)
    assert labelled_predictions(spark, out) is None


def test_user_function_over_keyed_state(spark):
    """Running totals with get, put, update and delete; a key that is reset starts anew."""
    path = fresh_dir(spark, "keyed-in")
    data = [("a", 1, "add"), ("a", 2, "add"), ("b", 5, "add"), ("a", 0, "reset"), ("a", 7, "add")]
    for i, row in enumerate(data):
        spark.createDataFrame([row], "key string, n long, what string").coalesce(1).write.mode("append").parquet(path)

    def total(key, event, store):
        if event["what"] == "reset":
            store.delete("sum")
        else:
            store.update("sum", lambda v: ((v[0] if v else 0) + event["n"],))
        store.put("seen", ((store.get("seen", (0,))[0] + 1),))
        yield key[0], (store.get("sum") or (None,))[0], store.get("seen")[0], ",".join(sorted(store.names()))

    stream = spark.readStream.schema("key string, n long, what string").option("maxFilesPerTrigger", 1).parquet(path)
    out, _ = run_bounded(process_events(stream, ["key"], total, "key string, total long, seen long, names string",
                                        "v long"), "update", "keyed")
    got = spark.read.parquet(out).select("key", "total", "seen", "names").collect()
    assert sorted(map(tuple, got), key=str) == sorted([
        ("a", 1, 1, "seen,sum"), ("a", 3, 2, "seen,sum"), ("b", 5, 1, "seen,sum"), ("a", None, 3, "seen"),
        ("a", 7, 4, "seen,sum")], key=str)


def test_keyed_table_replays_and_compaction(spark):
    path = fresh_dir(spark, "keyed-table")
    t = KeyedTable(spark, path, ["k"], ["at"], compact_every=3)
    frame = lambda *r: spark.createDataFrame(list(r), "k string, at long, v long")
    gone = lambda *k: spark.createDataFrame([(x,) for x in k], "k string")
    want = {}
    for b in range(11):
        new, out = [("x", b, b), ("x", b - 1, -1), (f"y{b}", 0, b)], [f"y{b - 2}"]
        for _ in range(2 if b % 2 else 1):  # a replay
            t.apply(frame(*new), b, gone(*out))
        want.update({"x": b, f"y{b}": b})
        want.pop(out[0], None)
        assert {r.k: r.v for r in t.read().collect()} == want
    bases, deltas = t._folders()
    assert bases and len(deltas) < 8


def test_late_rows_go_to_the_side_table(spark):
    """They are the rows that a stateful operator drops."""
    from cartflow.streaming.metrics import LateRows, progress_log, system_metrics
    from cartflow.streaming.windows import hopping_counts
    path, out = fresh_dir(spark, "late-in"), fresh_dir(spark, "late-out")
    t0 = dt.datetime(2024, 1, 1)
    schema, late = "ts timestamp, event_type string, id long", {3: 300, 5: 300}  # batch: minutes behind
    sink = LateRows(spark, out, 600)
    for i in range(6):
        data = [(t0 + dt.timedelta(minutes=30 * i), "x", i)]
        if i in late:
            data += [(t0 + dt.timedelta(minutes=30 * i - late[i]), "x", 1000 + i),
                     (t0 + dt.timedelta(minutes=30 * i - 35), "x", 2000 + i)]  # as late as the delay allows
        spark.createDataFrame(data, schema).coalesce(1).write.mode("append").parquet(path)
    read = lambda: spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(path)
    with progress_log(spark) as log:
        q = read().writeStream.option("checkpointLocation", fresh_dir(spark, "ckpt")).trigger(availableNow=True) \
            .foreachBatch(lambda b, i: sink.split(b, i).write.mode("overwrite").parquet(f"{out}/kept/_batch={i}")).start()
        q.awaitTermination()
        run_bounded(hopping_counts(read(), size="1 minute"), "update", "late")
    assert sorted(r.id for r in spark.read.parquet(f"{out}/late").collect()) == [1003, 1005]
    assert spark.read.parquet(f"{out}/kept").count() == 8
    dropped = system_metrics(spark, log).where("metric_name = 'rows_dropped_by_watermark'").agg(F.sum("metric_value"))
    assert dropped.first()[0] == 2


def test_no_report_of_a_long_run_is_lost(spark):
    from cartflow.streaming.metrics import progress_log, reports, system_metrics
    path = fresh_dir(spark, "long-in")
    spark.range(105).repartitionByRange(105, "id").write.mode("append").parquet(path)
    stream = spark.readStream.schema("id long").option("maxFilesPerTrigger", 1).parquet(path)
    with progress_log(spark) as log:
        run_bounded(stream, "append", "long")
    found = reports(spark, log).where("numInputRows > 0")
    assert found.select("batchId").distinct().count() == found.count() > 100
    assert system_metrics(spark, log).where("metric_name = 'input_rows'").agg(F.sum("metric_value")).first()[0] == 105


def test_trained_models_switch_between_batches(spark, small_dir):
    """Every score of the stream is the batch score by the model of its batch; a replay keeps its model."""
    from pyspark.ml import Pipeline
    from pyspark.ml.classification import LogisticRegression
    from cartflow.learn import models as L
    from cartflow.streaming.models import ModelScorer, ModelShelf
    sess = QUERIES["session_records"](spark, small_dir).persist()
    train = L.training_frame(sess)
    fit = lambda c: Pipeline(stages=[*L.feature_pipeline(), LogisticRegression(labelCol=L.LABEL, regParam=c)]).fit(train)
    models = {"v1": fit(0.1), "v2": fit(5.0)}
    shelf = ModelShelf(spark, fresh_dir(spark, "shelf"))
    shelf.publish(models["v1"], "v1")
    out = fresh_dir(spark, "stream-models")

    def switching(batch, batch_id):
        sink = multi_sink(out, scorer=ModelScorer(shelf, "run"))
        sink(batch, batch_id)
        if batch_id == 1:
            shelf.publish(models["v2"], "v2")
            sink(batch, batch_id)
    run_ordered(spark, events(spark, small_dir), lambda s: start_multi_sink(fold_stream(s), switching), slices=3)
    got = latest_per_key(spark.read.parquet(f"{out}/predictions"), ["session_id"]).collect()
    want = {(r.session_id, r.model_version): r for v, m in models.items()
            for r in L.score(train.where("cart_value > 0"), m, v).collect()}
    last = {r.session_id for r in sess.where("cart_value > 0").collect()}
    got = [r for r in got if r.session_id in last]
    assert {r.session_id for r in got} == last and {r.model_version for r in got} == {"v1", "v2"}
    for r in got:
        w = want[r.session_id, r.model_version]
        if w.prediction_timestamp == r.prediction_timestamp:
            assert (r.abandonment_probability, r.risk_level, r.confidence) == (
                w.abandonment_probability, w.risk_level, w.confidence)
    assert sum(want[r.session_id, r.model_version].prediction_timestamp == r.prediction_timestamp for r in got) == len(got)


def test_sessions_of_one_bucket_share_a_state(spark, small_dir):
    """Many sessions in few state values: the records are the batch's, and closed sessions leave no state."""
    from cartflow.streaming.keyed import ordered_fold
    from cartflow.streaming.runner import run_ordered_to
    from cartflow.streaming.sessions import EVENT_COLS, SessionFold, record_from_accumulator
    build = lambda s: record_from_accumulator(ordered_fold(
        s.select(*EVENT_COLS), "session_id", SessionFold(True, False), buckets=2).where("kind = 'record'"))
    out, q = run_ordered_to(spark, events(spark, small_dir), build, "update", "buckets", slices=2,
                            close_after=closing_seconds())
    last = latest_per_key(spark.read.parquet(out), ["session_id"]).where("session_id <> 'closing'")
    want = QUERIES["session_records"](spark, small_dir)
    assert rows(last.select(*want.columns)) == rows(want)
    assert q.lastProgress["stateOperators"][0]["numRowsTotal"] <= 2


def test_a_keyed_table_is_read_in_one_scan(spark):
    """However many batches wrote to it; columns that came later are null in the earlier rows."""
    path = fresh_dir(spark, "keyed-scan")
    t = KeyedTable(spark, path, ["k"], ["at"], compact_every=100)
    for b in range(5):
        t.apply(spark.createDataFrame([("x", b), (f"y{b}", b)], "k string, at long"), b)
    t.apply(spark.createDataFrame([("x", 9, 1.5)], "k string, at long, v double"), 5)
    plan = t.read()._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation [") == 1
    assert sorted(map(tuple, t.read().select("k", "at", "v").collect()), key=str) == sorted(
        [("x", 9, 1.5), *[(f"y{b}", b, None) for b in range(5)]], key=str)
    schema = t.read().schema
    again = KeyedTable(spark, path, ["k"], ["at"], compact_every=100, schema=schema)
    assert rows(again.read()) == rows(t.read())
    assert rows(again.read(before=2).select("k", "at")) == rows(
        spark.createDataFrame([("x", 1), ("y0", 0), ("y1", 1)], "k string, at long"))


def test_steps_run_side_by_side_and_their_errors_come_out(spark):
    import threading
    from cartflow.streaming.merge import at_once
    met, done = threading.Barrier(2, timeout=20), []

    def meet():
        met.wait()
        done.append(spark.range(3).count())
    at_once(spark, [meet, meet])
    assert done == [3, 3]
    with pytest.raises(ZeroDivisionError):
        at_once(spark, [lambda: 1 // 0, lambda: done.append(4)])
    assert done == [3, 3, 4]


def test_the_sink_leaves_the_stream_its_settings(spark):
    """Its shuffles are cut to the batch's rows; the stream's own number of partitions is there again, also after an error."""
    from cartflow.streaming.sessions import SessionFold
    conf, seen = "spark.sql.shuffle.partitions", []
    names = [f.split()[0] for f in SessionFold.OUT.split(", ")]
    row = [{"kind": "record", "session_id": "s", "cart_cents": 100, "last_ts": 0, "first_ts": 0, "buy": False, "abd": False,
            "chk": False}.get(n, 0 if n in ("pv", "pvc", "np", "srch", "add", "rem", "n") else None) for n in names]
    batch = spark.createDataFrame([tuple(row)], SessionFold.OUT)
    before = spark.conf.get(conf)

    def scorer(records, batch_id):
        seen.append(spark.conf.get(conf))
        raise ValueError("no score")
    with pytest.raises(ValueError):
        multi_sink(fresh_dir(spark, "sink-settings"), scorer=scorer)(batch, 0)
    assert seen == ["1"] and spark.conf.get(conf) == before != "1"
