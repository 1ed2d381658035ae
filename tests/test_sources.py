"""Flatteners (S16-S19), keying (T4) and table-layer merges (S5, S6, S12) on hand-made rows."""

import datetime as dt
import json

from pyspark.sql import functions as F

from cartflow.sources import catalog as SC
from cartflow.sources import tables as TB
from cartflow.sources.events import event_key


def test_flatten_weather_first_entry_and_default_location(spark):
    rows = [json.dumps({"weather": [{"id": 800, "main": "Clear", "description": "clear sky", "icon": "01d"},
                                    {"id": 500, "main": "Rain", "description": "light rain", "icon": "10d"}],
                        "main": {"temp": 22.5, "feels_like": 21.0, "humidity": 65, "pressure": 1012},
                        "wind": {"speed": 3.5}, "name": "New York"}),
            json.dumps({"weather": [{"main": "Snow", "description": "snow"}], "main": {"temp": -1.0},
                        "wind": {"speed": 1.0}})]
    raw = spark.createDataFrame([(r,) for r in rows], "v string") \
        .select(F.from_json("v", SC.WEATHER_RAW_SCHEMA).alias("w")).select("w.*")
    out = {r.location: r for r in SC.flatten_weather(raw).collect()}
    assert out["New York"].weather_condition == "Clear" and out["New York"].humidity == 65
    assert out["Unknown"].weather_condition == "Snow" and out["Unknown"].temperature == -1.0
    assert all(r.event_id.startswith("weather_") for r in out.values())


def test_flatten_finance_latest_bar_and_change(spark):
    t = dt.datetime(2024, 1, 2)
    bars = spark.createDataFrame([
        ("AAPL", t, 100.0, 110.0, 99.0, 105.0, 10, 1e9),
        ("AAPL", t + dt.timedelta(days=1), 105.0, 112.0, 104.0, 110.25, 12, 1e9),
        ("MSFT", t, 200.0, 201.0, 190.0, 190.0, 5, None)], SC.BAR_SCHEMA)
    out = {r.symbol: r for r in SC.flatten_finance(bars).collect()}
    assert out["AAPL"].current_price == 110.25 and out["AAPL"].change_percent == 5.0
    assert out["MSFT"].change_percent == -5.0 and out["MSFT"].market_cap is None


def test_products_catalogue(spark):
    raw = spark.createDataFrame([(1, "A", 9.5, "electronics", None, None, (4.1, 120), None),
                                 (2, "B", 3.0, "jewelery", "d", "i", (3.0, 5), 7)], SC.PRODUCT_RAW_SCHEMA)
    p = SC.flatten_products(raw, "2024-01-31 00:00:00")
    r = {x.product_id: x for x in p.collect()}
    assert r[1].rating_rate == 4.1 and r[1].stock_quantity == 100 and r[2].stock_quantity == 7
    assert r[1].event_id.startswith("prod_1_") and len(r[1].event_id) == len("prod_1_") + 8
    assert [x.category for x in SC.categories(p).collect()] == ["electronics", "jewelery"]
    assert SC.products_by_category(p, "jewelery").count() == 1 and SC.product_by_id(p, 1).count() == 1


def test_event_key_fallbacks(spark):
    df = spark.createDataFrame([("s", 1), (None, 2), (None, None)], "session_id string, user_id long")
    assert [r.k for r in df.select(event_key(F.col("session_id"), F.col("user_id")).alias("k")).collect()] == \
        ["s", "2", "unknown"]


def test_insert_if_absent_keeps_first_and_skips_existing(spark):
    t = dt.datetime(2024, 1, 1)
    new = spark.createDataFrame([("a", t, 1), ("a", t + dt.timedelta(1), 2), ("b", t, 3), ("c", t, 4)],
                                "k string, ts timestamp, v int")
    target = spark.createDataFrame([("c",)], "k string")
    out = {r.k: r.v for r in TB.insert_if_absent(new, target, ["k"], ["ts"]).collect()}
    assert out == {"a": 1, "b": 3}


def test_upsert_latest_with_expiry(spark):
    t = dt.datetime(2024, 1, 1, 10)
    old = spark.createDataFrame([("a", t, 1), ("b", t, 2)], "k string, ts timestamp, v int")
    new = spark.createDataFrame([("a", t + dt.timedelta(minutes=50), 9)], "k string, ts timestamp, v int")
    out = TB.upsert_latest(new, old, ["k"], ["ts"], 3600, "ts", "2024-01-01 11:30:00").collect()
    assert [(r.k, r.v) for r in out] == [("a", 9)]       # b expired at 11:00


def test_evolve_schema_is_idempotent(spark):
    df = spark.createDataFrame([(1,)], "x int")
    spec = [("flag", "boolean", False), ("note", "string", None)]
    once = TB.evolve_schema(df, spec)
    twice = TB.evolve_schema(once, spec)
    assert once.columns == twice.columns == ["x", "flag", "note"]
    assert twice.collect()[0].flag is False


def _event(**more):
    return json.dumps({"event_id": "evt_0a1b", "timestamp": "2024-01-05T10:00:00.250000Z", "user_id": 7,
                       "session_id": "s1", "event_type": "add_to_cart", "price": 2.5} | more)


def test_events_with_text_ids_and_rejects_with_reasons(spark):
    from cartflow.sources.events import decode_events, validate_events
    rows = [_event(), "no json", _event(price="cheap"), _event(timestamp="not a time"), _event(session_id=None),
            _event(event_type="session_end", total_page_views=4, converted=False), "[1, 2]"]
    good, unread = decode_events(spark.createDataFrame([(r,) for r in rows], "value string"))
    valid, invalid = validate_events(good)
    got = {r.event_type: r for r in valid.collect()}
    assert got["add_to_cart"].event_id == "evt_0a1b" and got["add_to_cart"].quantity == 1
    assert got["add_to_cart"].ts == dt.datetime(2024, 1, 5, 10, 0, 0, 250000)
    assert got["session_end"].total_page_views == 4 and got["session_end"].converted is False
    assert sorted(r.reason for r in unread.collect()) == ["field of the wrong type", "invalid json", "invalid json"]
    assert sorted(r.reasons[0] for r in invalid.collect()) == ["session_id missing", "timestamp missing or invalid"]


def test_truncate_counts_and_empties(spark):
    from cartflow.session import fresh_dir
    path = fresh_dir(spark, "truncate")
    spark.range(5).write.mode("overwrite").parquet(path)
    assert tuple(TB.truncate(spark, path).first()) == (5, 0)
    assert spark.read.parquet(path).schema.names == ["id"] and spark.read.parquet(path).count() == 0


def test_cents_round_half_up_like_the_batch_cast(spark):
    from cartflow.streaming.sessions import _cents
    prices = [0.125, 2.345, 2.355, 0.005, 19.99, 1.0]
    batch = [int(r.c * 100) for r in spark.createDataFrame([(p,) for p in prices], "p double").select(
        F.col("p").cast("decimal(10,2)").alias("c")).collect()]
    assert [_cents(p, 1) for p in prices] == batch


def test_retention_touches_only_old_days(spark):
    import datetime as dt
    import glob
    import os

    from cartflow.session import fresh_dir
    from cartflow.sources.tables import retain_days, write_by_day
    path = fresh_dir(spark, "days")
    t0 = dt.datetime(2024, 1, 1)
    rows = [(i, t0 + dt.timedelta(hours=6 * i)) for i in range(40)] + [(100, None)]
    write_by_day(spark.createDataFrame(rows, "id long, at timestamp"), path, "at")
    files = lambda: {f: os.stat(f).st_mtime_ns for f in glob.glob(path.removeprefix("file:") + "/day=*/part-*")}
    before = files()
    done = {r.day: r.action for r in retain_days(spark, path, "at", 3, "2024-01-08 15:00:00").collect()}
    after = files()
    assert done == {f"2024-01-0{d}": "dropped" for d in range(1, 5)} | {"2024-01-05": "trimmed",
                                                                        "__HIVE_DEFAULT_PARTITION__": "dropped"}
    cut = dt.datetime(2024, 1, 5, 15)
    assert sorted(r.id for r in spark.read.parquet(path).collect()) == [i for i, t in rows if t and t >= cut]
    later = {f: m for f, m in before.items() if "day=2024-01-05" not in f and f.split("day=")[1][:10] > "2024-01-05"
             and "HIVE" not in f}
    assert later and {f: m for f, m in after.items() if "2024-01-05" not in f} == later
    retain_days(spark, path, "at", 3, "2024-02-08 15:00:00")
    assert spark.read.schema("id long, at timestamp").parquet(path).count() == 0


def test_an_event_is_parsed_once(spark):
    """Filters on parsed fields do not repeat the parse."""
    from cartflow.sources import events as SE
    raw = spark.createDataFrame([('{"event_id":"a"}',)], "value string").where("length(value) > 0")
    valid, _ = SE.validate_events(SE.decode_events(raw)[0])
    plan = valid._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json(") == 1
