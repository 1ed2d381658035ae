"""The continuously updated session record.

``SessionFold`` keys the event stream by session id.  Its state is the folded
accumulator (counters, flags, floored cart in cents, viewed products, the
abandonments not settled yet) and the events newer than the watermark.  Each micro-batch folds, in (ts, event_id)
order, every waiting event the watermark has passed, and emits a provisional
record folded over the others too (update mode).  Because only rows behind the
watermark are committed, the final record equals the batch ``session_records``
whatever order the micro-batches arrive in.  A timer reports a cart left idle;
a session idle for the session gap is closed and all its state is cleared.

Event ids may be whole numbers or text; they order events as in batch.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from decimal import ROUND_HALF_UP, Decimal

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartflow import constants as K
from cartflow.streaming.keyed import OrderedFold, ordered_fold

EVENT_COLS = ["session_id", "event_id", "ts", "user_id", "event_type", "product_id", "price", "quantity",
              "cart_value", "device_type", "browser", "persona", "abandonment_reason", "time_in_cart_seconds"]

RECORD_SCHEMA = (
    "session_id string, user_id long, start_time timestamp, last_activity timestamp, device_type string, "
    "browser string, page_views long, products_viewed long, unique_products_viewed long, "
    "product_view_count long, searches long, cart_additions long, cart_removals long, cart_value double, "
    "is_converted boolean, purchase_value double, session_duration_seconds long, avg_time_per_page double, "
    "bounce boolean, is_cart_abandoned boolean, abandonment_reason string, time_in_cart_seconds int, "
    "checkout_initiated boolean, persona string, updated_at timestamp, event_count long")

ACC_FIELDS = ("user_id long, first_ts long, start_ts long, last_ts long, dev string, brw string, pv long, pvc long, "
              "np long, srch long, add long, rem long, cart_cents long, buy boolean, pval double, abd boolean, "
              "reason string, tic int, chk boolean, pers_start string, pers_any string, n long")
ACC_NAMES = [f.split()[0] for f in ACC_FIELDS.split(", ")]
ROWS_A_TASK, BYTES_A_TASK = 50_000, 4 << 20   # what a task of the sink's shuffles gets of a batch and of the kept tables
FEW = 32   # products of a session that are kept with its counters; further ones are packed apart


def _cents(price, qty) -> int:
    p = 0 if price is None or pd.isna(price) else int(Decimal(repr(float(price))).scaleb(2).quantize(Decimal(1), ROUND_HALF_UP))
    q = 1 if qty is None or pd.isna(qty) else int(qty)
    return p * q


def _idle_gap(acc: dict, ts: int) -> bool:
    """Whether the cart was left idle between the last committed event and ``ts`` and not reported yet."""
    return (acc["n"] > 0 and acc["cart_cents"] > 0 and not acc["buy"] and acc["idle_at"] != acc["last_ts"]
            and (ts - acc["last_ts"]) // 1_000_000 >= K.CART_ABANDONMENT_IDLE_SECONDS)


def _fold(acc: dict, e: dict) -> None:
    """Apply one event to the counters, flags and cart (``SessionFold`` keeps products and abandonments)."""
    et, ts = e["event_type"], e["ts_us"]
    if acc["n"] == 0:
        acc["user_id"], acc["first_ts"] = e["user_id"], ts
        acc["dev"], acc["brw"] = e["device_type"], e["browser"]
    acc["n"] += 1
    acc["last_ts"] = ts
    if e["persona"] is not None:
        acc["pers_any"] = e["persona"]
    if et == "session_start":
        acc["start_ts"] = ts
        if e["persona"] is not None:
            acc["pers_start"] = e["persona"]
    elif et == "page_view":
        acc["pv"] += 1
    elif et == "product_view":
        acc["pvc"] += 1
    elif et == "add_to_cart":
        acc["add"] += 1
        acc["cart_cents"] += _cents(e["price"], e["quantity"])
    elif et == "remove_from_cart":
        acc["rem"] += 1
        acc["cart_cents"] = max(0, acc["cart_cents"] - _cents(e["price"], e["quantity"]))
    elif et == "search":
        acc["srch"] += 1
    elif et == "checkout_initiated":
        acc["chk"] = True
    elif et == "purchase":
        acc["buy"] = True
        acc["pval"] = 0.0 if e["cart_value"] is None else float(e["cart_value"])
    elif et == "cart_abandoned":
        acc["abd"] = True
        if e["abandonment_reason"] is not None:
            acc["reason"] = e["abandonment_reason"]
        acc["tic"] = 0 if e["time_in_cart_seconds"] is None else int(e["time_in_cart_seconds"])


class SessionFold(OrderedFold):
    """Session records, and the rows that committed events bring about, each once:

    ``record``    the session as of all events seen (provisional until the watermark passes them)
    ``snapshot``  the session right after a committed event (W5), with ``snapshots=True``
    ``outcome``   a committed purchase or abandonment
    ``idle``      a cart left idle (T6)
    ``recovery``  an abandonment settled by the next purchase, or by the session's end (T7)
    ``closed``    the session's end
    """

    EVENT = ("ts_us long, event_id string, user_id long, event_type string, product_id long, price double, "
             "quantity int, cart_value double, device_type string, browser string, persona string, "
             "abandonment_reason string, time_in_cart_seconds int")
    OUT = ("kind string, session_id string, " + ACC_FIELDS
           + ", event_id string, event_type string, at_us long, until_us long, value double")

    def __init__(self, numeric_ids: bool, snapshots: bool):
        self.NUMERIC_IDS, self.snapshots = numeric_ids, snapshots

    def start(self) -> dict:
        zero = dict.fromkeys(["pv", "pvc", "np", "srch", "add", "rem", "cart_cents", "n"], 0)
        return dict.fromkeys(ACC_NAMES) | zero | {"buy": False, "abd": False, "chk": False, "idle_at": None,
                                                  "unsettled": [], "few": [], "more": b""}

    # A session's first viewed products stand beside its counters; further ones are packed apart, as bytes that are
    # unpacked only to look up a product that is not among the first.

    def _more(self, acc: dict) -> set:
        if isinstance(acc["more"], bytes):
            acc["more"] = set(pickle.loads(acc["more"])) if acc["more"] else set()
        return acc["more"]

    def _viewed(self, acc: dict, product: int) -> bool:
        return product in acc["few"] or acc["np"] > FEW and product in self._more(acc)

    def _view(self, acc: dict, product: int) -> None:
        if self._viewed(acc, product):
            return
        if acc["np"] < FEW:
            acc["few"].append(product)
        else:
            self._more(acc).add(product)
        acc["np"] += 1

    def pack(self, acc: dict) -> None:
        if not isinstance(acc["more"], bytes):
            acc["more"] = pickle.dumps(sorted(acc["more"]), 4) if acc["more"] else b""

    def _row(self, kind: str, key: str, acc: dict, event_id=None, event_type=None, at=None, until=None, value=None):
        return (kind, key, *[acc[n] for n in ACC_NAMES], event_id, event_type, at, until, value)

    def commit(self, key: str, acc: dict, e: dict) -> Iterator[tuple]:
        ts = e["ts_us"]
        if _idle_gap(acc, ts):
            yield self._idle(key, acc)
        _fold(acc, e)
        et, product = e["event_type"], e["product_id"]
        if et == "product_view" and product is not None:
            self._view(acc, int(product))
        if et in ("purchase", "cart_abandoned"):
            yield self._row("outcome", key, acc, e["event_id"], et, ts, None, e["cart_value"])
        if et == "purchase" and acc["unsettled"]:
            for at, event_id in acc["unsettled"]:
                yield self._row("recovery", key, acc, event_id, et, at, ts, acc["pval"])
            acc["unsettled"] = []
        if et == "cart_abandoned":
            acc["unsettled"].append((ts, e["event_id"]))
        if self.snapshots:
            yield self._row("snapshot", key, acc, e["event_id"], et, ts)

    def _idle(self, key: str, acc: dict) -> tuple:
        acc["idle_at"] = acc["last_ts"]
        return self._row("idle", key, acc, at=acc["last_ts"] + K.CART_ABANDONMENT_IDLE_SECONDS * 1_000_000)

    def ahead(self, key: str, acc: dict, events: list[dict]) -> dict:
        seen = dict(acc)
        viewed = {int(e["product_id"]) for e in events
                  if e["event_type"] == "product_view" and e["product_id"] is not None}
        seen["np"] += sum(not self._viewed(acc, p) for p in viewed)
        for e in events:
            _fold(seen, e)
        return seen

    def view(self, key: str, ahead: dict) -> Iterator[tuple]:
        yield self._row("record", key, ahead)

    def deadline(self, acc: dict, ahead: dict, events: list[dict]) -> int:
        """An idle cart is reported after a while; every session is closed after the gap."""
        idle = ahead["cart_cents"] > 0 and not ahead["buy"] and (bool(events) or acc["idle_at"] != acc["last_ts"])
        wait = K.CART_ABANDONMENT_IDLE_SECONDS if idle else K.SESSION_GAP_SECONDS
        return ahead["last_ts"] // 1000 + wait * 1000

    def woken(self, key: str, acc: dict, wm_ms: int) -> Iterator[tuple]:
        if acc["cart_cents"] > 0 and not acc["buy"] and acc["idle_at"] != acc["last_ts"] \
                and acc["last_ts"] // 1000 + K.CART_ABANDONMENT_IDLE_SECONDS * 1000 <= wm_ms:
            yield self._idle(key, acc)
        if acc["last_ts"] // 1000 + K.SESSION_GAP_SECONDS * 1000 > wm_ms:
            return
        if acc["unsettled"]:  # never bought again
            for at, event_id in acc["unsettled"]:
                yield self._row("recovery", key, acc, event_id, None, at)
        yield self._row("closed", key, acc)
        self.done = True


def record_from_accumulator(df: DataFrame) -> DataFrame:
    """The session record from the folded accumulator, with the batch path's expressions."""
    from cartflow.functions.exprs import round_half_up, safe_div
    c = F.col
    start_us = F.coalesce(c("start_ts"), c("first_ts"))
    dur = ((c("last_ts") - start_us) / F.lit(1_000_000)).cast("long")   # truncates toward zero
    return df.select(
        "session_id", "user_id", F.timestamp_micros(start_us).alias("start_time"),
        F.timestamp_micros("last_ts").alias("last_activity"),
        F.coalesce("dev", F.lit("desktop")).alias("device_type"),
        F.coalesce("brw", F.lit("Unknown")).alias("browser"),
        c("pv").alias("page_views"), c("np").alias("products_viewed"), c("np").alias("unique_products_viewed"),
        c("pvc").alias("product_view_count"), c("srch").alias("searches"), c("add").alias("cart_additions"),
        c("rem").alias("cart_removals"), (c("cart_cents") / F.lit(100.0)).alias("cart_value"),
        c("buy").alias("is_converted"),
        round_half_up(F.coalesce("pval", F.lit(0.0)), 2).alias("purchase_value"),
        dur.alias("session_duration_seconds"),
        round_half_up(safe_div(dur, c("pv")), 2).alias("avg_time_per_page"),
        ((c("pv") <= 1) & (dur < 30)).alias("bounce"),
        c("abd").alias("is_cart_abandoned"), c("reason").alias("abandonment_reason"),
        F.coalesce("tic", F.lit(0)).alias("time_in_cart_seconds"), c("chk").alias("checkout_initiated"),
        F.coalesce("pers_start", "pers_any").alias("persona"),
        F.timestamp_micros("last_ts").alias("updated_at"), c("n").alias("event_count"))


def id_type(events: DataFrame) -> str:
    """The type of the event ids: whole numbers order as numbers, all else as text."""
    kind = dict(events.dtypes)["event_id"]
    return "long" if kind in ("bigint", "int", "smallint", "tinyint") else "string"


def fold_stream(events: DataFrame, watermark: str = "10 minutes", snapshots: bool = False) -> DataFrame:
    """The stateful fold; ids come out as text."""
    fold = SessionFold(id_type(events) == "long", snapshots)
    return ordered_fold(events.select(*EVENT_COLS).where("session_id is not null"), "session_id", fold, watermark)


def stream_sessions(events: DataFrame, watermark: str = "10 minutes") -> DataFrame:
    """Streaming session records (update mode), one row per session per micro-batch.

    Python does only the order-dependent fold and returns the accumulator;
    every derived column is a JVM expression shared with the batch path.
    """
    return record_from_accumulator(fold_stream(events, watermark).filter(F.col("kind") == "record"))


def snapshots_from_fold(folded: DataFrame, ids: str = "string") -> DataFrame:
    """W5 (stream): the session right after each committed event, with the serving features."""
    from cartflow.operators.sessions import serving_features
    rows = folded.filter(F.col("kind") == "snapshot")
    rec = record_from_accumulator(rows.withColumn("session_id", F.struct("session_id", "event_id", "event_type", "at_us")))
    rec = rec.select("session_id.*", *[c for c in rec.columns if c not in ("session_id", "updated_at", "event_count")])
    c = F.col
    feats = serving_features(c("page_views"), c("products_viewed"), c("unique_products_viewed"), c("cart_additions"),
                             c("cart_removals"), c("cart_value"), c("session_duration_seconds"),
                             c("checkout_initiated"), c("bounce"))
    return rec.withColumn("event_id", c("event_id").cast(ids)).withColumn("ts", F.timestamp_micros("at_us")) \
        .select("*", *[e.alias(n) for n, e in feats.items()]).drop("at_us")


def outcomes_from_fold(folded: DataFrame, ids: str = "string") -> DataFrame:
    """Committed purchases and abandonments, as events."""
    return folded.filter(F.col("kind") == "outcome").select(
        "session_id", F.col("event_id").cast(ids).alias("event_id"), F.timestamp_micros("at_us").alias("ts"),
        "event_type", F.col("value").alias("cart_value"))


def abandonments_from_fold(folded: DataFrame) -> DataFrame:
    """T6 (stream): one row per cart left idle, at last activity + the idle threshold."""
    return folded.filter(F.col("kind") == "idle").select(
        "session_id", "user_id", F.timestamp_micros("last_ts").alias("last_activity"),
        F.timestamp_micros("at_us").alias("detected_at"), (F.col("cart_cents") / F.lit(100.0)).alias("cart_value"),
        F.greatest(F.col("add") - F.col("rem"), F.lit(0)).alias("items_count"))


def recoveries_from_fold(folded: DataFrame, min_delay_seconds: int = K.RECOVERY_DELAY_MIN_SECONDS,
                         ids: str = "string") -> DataFrame:
    """T7 (stream): each abandonment settled by the session's next purchase; recovered when
    the purchase came at least ``min_delay_seconds`` later (J6's rule)."""
    d = folded.filter(F.col("kind") == "recovery")
    gap = ((F.col("until_us") - F.col("at_us")) / F.lit(1_000_000)).cast("long")
    rec = F.coalesce(gap >= min_delay_seconds, F.lit(False))
    return d.select("session_id", F.col("event_id").cast(ids).alias("abandonment_event_id"),
                    F.timestamp_micros("at_us").alias("abandonment_time"),
                    rec.alias("recovered"),
                    F.when(rec, F.timestamp_micros("until_us")).alias("recovery_time"),
                    F.when(rec, gap).alias("recovery_seconds"),
                    F.when(rec, F.col("value")).alias("recovery_value"))


def fixed_tick_scorer(rec: DataFrame, batch_id: int) -> DataFrame:
    """The fixed-coefficient scorer on session records (one prediction per tick)."""
    from cartflow.operators.scoring import fixed_probability, predictions_from_probability
    from cartflow.operators.sessions import serving_features
    feats = serving_features(F.col("page_views"), F.col("products_viewed"), F.col("unique_products_viewed"),
                             F.col("cart_additions"), F.col("cart_removals"), F.col("cart_value"),
                             F.col("session_duration_seconds"), F.col("checkout_initiated"), F.col("bounce"))
    scored = rec.select("*", *[e.alias(n) for n, e in feats.items()])
    scored = scored.withColumn("_p", fixed_probability(scored)) \
        .withColumn("event_id", F.xxhash64("session_id", F.lit(batch_id))).withColumn("ts", F.col("last_activity"))
    return predictions_from_probability(scored, "_p", "fixed_logit_v1")


def multi_sink(out: str, ids: str = "long", scorer=fixed_tick_scorer, label: bool = False):
    """One foreachBatch that writes, per micro-batch and tagged with its id,
    the session updates (S6 keeps the latest of each), a prediction for every
    updated session with a cart (one per tick, as the studied system logs
    them), the idle-cart detections and the settled recoveries.

    ``scorer(records, batch_id)`` makes the tick predictions.  With ``label``
    (and a fold with snapshots) every committed event with a cart is scored
    too, and outcomes close open predictions as they come (J4 on streams).
    """
    from cartflow.operators.scoring import fixed_predictions
    from cartflow.streaming.merge import KeyedTable, OutcomeMerge, at_once, stored_bytes

    def sink(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        partitions = spark.conf.get("spark.sql.shuffle.partitions")
        batch = batch.persist()
        try:
            rows = {r["kind"]: r["count"] for r in batch.groupBy("kind").count().collect()}  # six at most
            kinds = set(rows)
            # A stateful query plans without AQE, so small shuffles are cut down here; a task costs more than few rows.
            tasks = -(-sum(rows.values()) // ROWS_A_TASK) - (-stored_bytes(spark, out) // BYTES_A_TASK)
            spark.conf.set("spark.sql.shuffle.partitions", max(1, min(int(partitions), tasks)))

            # A retried batch overwrites its own folders; what a batch does not bring is not written.
            def write(df: DataFrame, name: str) -> None:
                df.write.mode("overwrite").parquet(f"{out}/{name}/_batch={batch_id}")

            steps = []
            if "record" in kinds:
                rec = record_from_accumulator(batch.filter(F.col("kind") == "record"))
                latest = KeyedTable(spark, f"{out}/latest_sessions", ["session_id"], ["last_activity", "event_count"])
                steps += [lambda: write(rec, "sessions"), lambda: latest.apply(rec, batch_id),
                          lambda: write(scorer(rec.filter(F.col("cart_value") > 0), batch_id), "predictions")]
            if "idle" in kinds:
                steps.append(lambda: write(abandonments_from_fold(batch), "abandonments"))
            if "recovery" in kinds:
                steps.append(lambda: write(recoveries_from_fold(batch, ids=ids), "recoveries"))
            if label and kinds & {"snapshot", "outcome", "closed"}:
                preds = fixed_predictions(snapshots_from_fold(batch, ids))
                closed = batch.filter(F.col("kind") == "closed").select("session_id")
                steps.insert(0, lambda: OutcomeMerge(spark, out).apply(
                    preds, outcomes_from_fold(batch, ids), closed, batch_id, settles=bool(kinds & {"outcome", "closed"})))
            at_once(spark, steps)
        finally:
            spark.conf.set("spark.sql.shuffle.partitions", partitions)
            batch.unpersist()
    return sink


def latest_per_key(df: DataFrame, keys: list[str], order_col: str = "_batch") -> DataFrame:
    """S6 on read: keep the newest row per key (merge-on-read of an append log).

    A keyed aggregate (``max_by`` over the batch id), combined map-side, so a
    key written by every micro-batch is still reduced before the shuffle.
    """
    others = [c for c in df.columns if c not in keys and c != order_col]
    row = F.max_by(F.struct(*[F.col(c) for c in others]), F.col(order_col)).alias("_row")
    return df.groupBy(*keys).agg(row).select(*keys, "_row.*")
