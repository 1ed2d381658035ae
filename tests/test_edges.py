"""Hand-made edge rows (FIXTURES.md §4) with hand-computed answers."""

import datetime as dt

from pyspark.sql import functions as F

from cartflow.operators import sessions as S
from cartflow.operators.outcomes import attribute_recovery, detect_abandonment, label_outcomes
from cartflow.operators.sessionize import sessionize
from cartflow.functions.exprs import risk_level
from cartflow.sources.events import decode_events, validate_events
from conftest import events_df

T0 = dt.datetime(2024, 1, 1, 10, 0, 0)


def t(sec):
    return T0 + dt.timedelta(seconds=sec)


def ev(i, sec, et, sid="s1", **kw):
    return {"event_id": i, "ts": t(sec), "user_id": 7, "session_id": sid, "event_type": et, **kw}


def record(spark, rows):
    return S.session_records(events_df(spark, rows)).collect()[0]


def test_remove_before_add(spark):
    r = record(spark, [ev(1, 0, "remove_from_cart", price=10.0, quantity=1),
                       ev(2, 5, "add_to_cart", price=5.0, quantity=2)])
    assert r.cart_value == 10.0


def test_floor(spark):
    r = record(spark, [ev(1, 0, "add_to_cart", price=5.0, quantity=1),
                       ev(2, 5, "remove_from_cart", price=8.0, quantity=1),
                       ev(3, 9, "add_to_cart", price=3.0, quantity=1)])
    assert r.cart_value == 3.0


def test_purchase_twice(spark):
    r = record(spark, [ev(1, 0, "purchase", cart_value=20.0), ev(2, 60, "purchase", cart_value=30.0)])
    assert r.purchase_value == 30.0 and r.is_converted


def test_no_session_start_and_bounce(spark):
    r = record(spark, [ev(1, 0, "page_view")])
    assert r.start_time == t(0) and r.bounce and r.session_duration_seconds == 0


def test_zero_pages(spark):
    df = events_df(spark, [ev(1, 0, "add_to_cart", price=5.0), ev(2, 100, "add_to_cart", price=5.0)])
    r = S.snapshots(df).orderBy("ts").collect()[-1]
    assert r.avg_time_per_page == 0.0 and r.pages_per_minute == 0.0


def test_session_start_sets_start_and_persona(spark):
    r = record(spark, [ev(1, 0, "page_view", persona="intent_buyer"),
                       ev(2, 10, "session_start", persona="cart_abandoner"),
                       ev(3, 70, "page_view")])
    assert r.start_time == t(10) and r.persona == "cart_abandoner" and r.session_duration_seconds == 60


def test_missing_session_id_rejected(spark):
    df = events_df(spark, [ev(1, 0, "page_view", sid=None), ev(2, 0, "page_view")])
    valid, rejects = validate_events(df)
    assert valid.count() == 1
    assert rejects.collect()[0].reasons == ["session_id missing"]


def test_bad_json_goes_to_rejects(spark):
    raw = spark.createDataFrame([('{"a":',), ('{"event_id": 1, "event_type": "page_view"}',)], "value string")
    good, bad = decode_events(raw)
    assert good.count() == 1 and bad.count() == 1


def test_exact_gap_starts_new_session(spark):
    rows = [ev(1, 0, "page_view", sid=None), ev(2, 12 * 3600, "page_view", sid=None),
            ev(3, 12 * 3600 + 12 * 3600 - 1, "page_view", sid=None)]
    out = sessionize(events_df(spark, rows).drop("session_id")).orderBy("event_id").collect()
    assert [r.session_id for r in out] == ["sess_7_1", "sess_7_2", "sess_7_2"]


def test_equal_ts_ordered_by_event_id(spark):
    rows = [ev(2, 0, "add_to_cart", price=8.0), ev(1, 0, "remove_from_cart", price=8.0)]
    # event 1 (remove) comes first: floor at 0, then +8
    assert record(spark, rows).cart_value == 8.0


def _preds(spark, rows):
    return spark.createDataFrame(rows, "prediction_id long, session_id string, prediction_timestamp timestamp, "
                                       "predicted_abandoned boolean")


def test_outcome_abandon_then_purchase(spark):
    e = events_df(spark, [ev(10, 10, "cart_abandoned"), ev(11, 30, "purchase", cart_value=9.0)])
    p = _preds(spark, [(1, "s1", t(0), True), (2, "s1", t(20), False)])
    out = {r.prediction_id: r for r in label_outcomes(p, e).collect()}
    assert out[1].actual_outcome == "abandoned" and out[1].was_prediction_correct
    assert out[2].actual_outcome == "abandoned" and out[2].was_prediction_correct is False


def test_outcome_purchase_then_abandon(spark):
    e = events_df(spark, [ev(10, 10, "purchase", cart_value=9.0), ev(11, 30, "cart_abandoned")])
    p = _preds(spark, [(1, "s1", t(0), True)])
    r = label_outcomes(p, e).collect()[0]
    assert r.actual_outcome == "converted" and r.was_prediction_correct is False


def test_open_prediction_stays_null(spark):
    e = events_df(spark, [ev(10, 10, "page_view")])
    r = label_outcomes(_preds(spark, [(1, "s1", t(0), True)]), e).collect()[0]
    assert r.actual_outcome is None and r.was_prediction_correct is None


def test_recovery_needs_delay(spark):
    e = events_df(spark, [ev(1, 0, "cart_abandoned", cart_value=50.0), ev(2, 100, "purchase", cart_value=50.0),
                          ev(3, 1000, "cart_abandoned", sid="s2", cart_value=20.0),
                          ev(4, 1400, "purchase", sid="s2", cart_value=25.0)])
    out = {r.session_id: r for r in attribute_recovery(e).collect()}
    assert out["s1"].recovered is False
    assert out["s2"].recovered and out["s2"].recovery_seconds == 400 and out["s2"].recovery_value == 25.0


def test_idle_cart_detected(spark):
    e = events_df(spark, [ev(1, 0, "add_to_cart", price=10.0), ev(2, 60, "page_view"),
                          ev(3, 2000, "page_view")])
    d = detect_abandonment(S.snapshots(e), "2024-01-01 12:00:00").orderBy("last_activity").collect()
    assert [r.last_event_id for r in d] == [2, 3]
    assert d[0].detected_at == t(60 + 900)


def test_probability_edges(spark):
    df = spark.createDataFrame([(0.5,), (0.7,), (0.85,), (0.4999,)], "p double")
    out = df.select(risk_level("p").alias("r"), (F.col("p") > 0.5).alias("w")).collect()
    assert [r.r for r in out] == ["MEDIUM", "HIGH", "CRITICAL", "LOW"]
    assert out[0].w is False


def test_purchase_clears_the_cart(spark):
    """Items and journey state against a plain fold; a purchase in the middle, removals from an empty cart."""
    import datetime as dt
    import random

    from conftest import events_df
    from cartflow.operators import sessions as S
    rng = random.Random(4)
    t0 = dt.datetime(2024, 1, 1)
    kinds = ["add_to_cart", "remove_from_cart", "remove_from_cart", "purchase", "page_view", "session_recovered"]
    rows, want, lines = [], {}, {}
    for s in range(6):
        items, state, pages, cart = 0, None, 0, {}
        for i in range(40):
            kind = rng.choice(kinds)
            product = rng.randrange(3)
            rows.append({"event_id": 100 * s + i, "ts": t0 + dt.timedelta(minutes=7 * i), "user_id": s, "session_id": f"s{s}",
                         "event_type": kind, "product_id": product, "price": 2.5, "quantity": 1})
            if kind == "add_to_cart":
                items, state = items + 1, "cart_active"
                cart[product] = cart.get(product, 0) + 1
            elif kind == "remove_from_cart":
                items = max(0, items - 1)
                state = "interested" if items == 0 else state
                cart[product] = cart.get(product, 0) - 1
            elif kind == "purchase":
                items, state, cart = 0, "purchased", {}
            elif kind == "page_view":
                pages += 1
            else:
                state = "recovering"
            want[100 * s + i] = (items, state or ("interested" if pages >= 3 else "browsing"))
        lines.update({(f"s{s}", p): n for p, n in cart.items() if n > 0})
    ev = events_df(spark, rows)
    assert {r.event_id: (r.item_count, r.session_state) for r in S.session_state(ev).collect()} == want
    assert {(r.session_id, r.product_id): r.quantity for r in S.cart_lines(ev).collect()} == lines
