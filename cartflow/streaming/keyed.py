"""Keyed state with user functions, in RocksDB state stores.

``KeyedStore``      named values of one key: get, put, update(fn), delete, with an
                    optional time to live (processing time).
``process_events``  U1: a user function over every event of a key, in order of
                    arrival, with a ``KeyedStore``; yields result rows.
``OrderedFold``     an ordered fold in event time: a key's events wait until
                    the watermark passes them, then are folded in (time, id)
                    order, each once, whatever micro-batch brought them; a
                    user's deadline wakes an idle key.

State lives in RocksDB on the executors and in its change log in the
checkpoint; nothing is kept of a key once its fold clears it.  The values of a
``KeyedStore`` are read and written one by one.  The keys of an ``OrderedFold``
share state by hash bucket, which comes and goes with the bucket's rows: a call
to the state store for each key took most of the time of a run.
"""

from __future__ import annotations

import pickle
from bisect import bisect_right
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def use_rocksdb(spark: SparkSession) -> None:
    """``transformWithState`` needs the RocksDB state store; set before a query starts."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)


class KeyedStore:
    """Named values of one key (T5): ``get``, ``put``, ``update(fn)`` (U3) and ``delete``."""

    def __init__(self, handle: StatefulProcessorHandle, schema: str, ttl_ms: int | None = None):
        self._map = handle.getMapState("store", "name string", schema, ttl_ms)

    def get(self, name: str, default: tuple | None = None) -> tuple | None:
        return self._map.getValue((name,)) if self._map.containsKey((name,)) else default

    def put(self, name: str, value: tuple) -> None:
        self._map.updateValue((name,), value)

    def update(self, name: str, fn: Callable[[tuple | None], tuple | None]) -> tuple | None:
        """Replace a value by ``fn`` of it; a result of None deletes it."""
        value = fn(self.get(name))
        if value is None:
            self.delete(name)
        else:
            self.put(name, value)
        return value

    def delete(self, name: str) -> None:
        if self._map.containsKey((name,)):
            self._map.removeKey((name,))

    def names(self) -> list[str]:
        return [k[0] for k in self._map.keys()]


def frame(rows: list[tuple], columns: list[str]) -> pd.DataFrame:
    """Result rows; values stay Python objects, so nulls do not turn whole numbers into floats."""
    return pd.DataFrame(rows, columns=columns, dtype=object)


class _EventProcessor(StatefulProcessor):
    def __init__(self, fn, store_schema: str, columns: list[str], ttl_ms: int | None):
        self.fn, self.store_schema, self.columns, self.ttl_ms = fn, store_schema, columns, ttl_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.store = KeyedStore(handle, self.store_schema, self.ttl_ms)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        for part in rows:
            names = list(part.columns)
            out = []
            for values in part.itertuples(index=False, name=None):
                out.extend(self.fn(key, dict(zip(names, values)), self.store))
            if out:
                yield frame(out, self.columns)

    def close(self) -> None:
        pass


def process_events(stream: DataFrame, keys: list[str], fn, output_schema: str, store_schema: str,
                   ttl_ms: int | None = None) -> DataFrame:
    """``fn(key, event, store)`` for every event yields result tuples.

    ``store_schema`` is that of one stored value; with ``ttl_ms`` a value
    expires that long after it was last put.
    """
    use_rocksdb(stream.sparkSession)
    columns = [f.split()[0] for f in output_schema.split(",")]
    return stream.groupBy(*keys).transformWithStateInPandas(
        _EventProcessor(fn, store_schema, columns, ttl_ms), outputStructType=output_schema, outputMode="update",
        timeMode="processingTime" if ttl_ms else "none")


BUCKETS = 256      # state values that the keys of an ordered fold share
OUT_ROWS = 10_000  # result rows handed over at once


class OrderedFold:
    """An ordered fold of a key's events in event time.

    Keys are dealt to buckets by hash.  A bucket's state is one value with an
    entry for each live key (its accumulator and waiting events, packed, and
    the time it is to be woken); the bucket's timeout is the earliest of these
    times.  It is read and written once when the bucket has rows or its
    timeout expires; only the keys with rows, or due, are unpacked.

    A subclass names the event columns (``EVENT``, a schema whose first two
    fields are ``ts_us long`` and ``event_id string``) and the result's columns
    (``OUT``), and defines

    ``start()``                  a new accumulator: a dict of plain values, whose names are always the same
    ``commit(key, acc, e)``      fold one event, yield result tuples
    ``ahead(key, acc, es)``      an accumulator with the events still waiting folded too; ``acc`` stays as it is
    ``view(key, ahead)``         result tuples for that accumulator
    ``deadline(acc, ahead, es)`` when, in ms, an idle key is to be woken
    ``woken(key, acc, ms)``      result tuples; returns by ``self.done = True`` that the key's state can go
    ``pack(acc)``                makes the accumulator's values plain again before it is stored
    """

    EVENT, OUT = "", ""
    NUMERIC_IDS = False

    def prepare(self) -> None:
        """Names that every call needs; ``ordered_fold`` has it done once."""
        self.acc_names = list(self.start())
        fields = [f.split() for f in self.EVENT.split(",")]
        self.names = [n for n, _ in fields]
        self.out = [f.split()[0] for f in self.OUT.split(",")]
        # Whole numbers beside nulls would arrive as floats: ints fit these, longs come as text.
        self.casts = [int if n != "ts_us" and t in ("long", "int") else None for n, t in fields]

    def pack(self, acc: dict) -> None:
        pass

    def _order(self, e: tuple):
        return e[0], int(e[1]) if self.NUMERIC_IDS else e[1]

    def _unpack(self, entry: tuple | None) -> tuple[dict, list[tuple]]:
        if entry is None:
            return self.start(), []
        values, events = pickle.loads(entry[1])
        return dict(zip(self.acc_names, values)), events

    def _entry(self, acc: dict, due: int, events: list[tuple]) -> tuple[int, bytes]:
        self.pack(acc)
        return due, pickle.dumps(([acc[n] for n in self.acc_names], events), 4)

    def _rows(self, parts: Iterator[pd.DataFrame]) -> dict[str, list[tuple]]:
        """New events by key."""
        out: dict[str, list[tuple]] = {}
        for part in parts:
            columns = []
            for n, cast in zip(self.names, self.casts):
                column = part[n]
                values = column.tolist()
                if column.dtype.kind not in "iub":
                    values = [None if v is None or v != v else cast(v) if cast else v for v in values]
                columns.append(values)
            for key, e in zip(part["fold_key"].tolist(), zip(*columns)):
                out.setdefault(key, []).append(e)
        return out

    def _dicts(self, events: list[tuple]) -> list[dict]:
        return [dict(zip(self.names, e)) for e in events]

    def _arrived(self, k: str, keys: dict, new: list[tuple], wm: int) -> Iterator[tuple]:
        """Commit what the watermark has passed and show the key as of all its events."""
        acc, waiting = self._unpack(keys.get(k))
        events = sorted(waiting + new, key=self._order)
        cut = bisect_right(events, wm * 1000, key=lambda e: e[0])
        for e in self._dicts(events[:cut]):
            yield from self.commit(k, acc, e)
        keep = self._dicts(events[cut:])
        ahead = self.ahead(k, acc, keep)
        yield from self.view(k, ahead)
        keys[k] = self._entry(acc, max(self.deadline(acc, ahead, keep), wm + 1), events[cut:])

    def _due(self, k: str, keys: dict, wm: int) -> Iterator[tuple]:
        """Wake a key: the watermark has passed all its events, which wait in order."""
        acc, waiting = self._unpack(keys[k])
        for e in self._dicts(waiting):
            yield from self.commit(k, acc, e)
        self.done = False
        yield from self.woken(k, acc, wm)
        if self.done:
            del keys[k]
        else:
            keys[k] = self._entry(acc, max(self.deadline(acc, acc, []), wm + 1), [])

    def step(self, bucket, parts: Iterator[pd.DataFrame], state) -> Iterator[pd.DataFrame]:
        wm = state.getCurrentWatermarkMs()
        keys = pickle.loads(state.get[0]) if state.exists else {}
        out: list[tuple] = []
        new = {} if state.hasTimedOut else self._rows(parts)
        for k, events in new.items():
            out.extend(self._arrived(k, keys, events, wm))
            if len(out) >= OUT_ROWS:
                yield frame(out, self.out)
                out = []
        for k in [k for k, (due, _) in keys.items() if due <= wm]:
            out.extend(self._due(k, keys, wm))
            if len(out) >= OUT_ROWS:
                yield frame(out, self.out)
                out = []
        if keys:
            state.update((pickle.dumps(keys, 4),))
            state.setTimeoutTimestamp(min(due for due, _ in keys.values()))
        elif state.exists:
            state.remove()
        if out:
            yield frame(out, self.out)


def ordered_fold(stream: DataFrame, key: str, fold: OrderedFold, watermark: str = "10 minutes",
                 buckets: int = BUCKETS) -> DataFrame:
    """Run an ``OrderedFold`` over a stream with a ``ts`` column; its columns are the fold's ``OUT``.

    A micro-batch reads and writes the state of every bucket it touches: with
    very many live keys and small batches, take more buckets.
    """
    from pyspark.sql import functions as F
    use_rocksdb(stream.sparkSession)
    fold.prepare()
    names = [f.split() for f in fold.EVENT.split(",")]
    ev = stream.withWatermark("ts", watermark)
    ev = ev.select(F.pmod(F.xxhash64(key), F.lit(buckets)).alias("fold_bucket"), F.col(key).alias("fold_key"), "ts",
                   *[(F.unix_micros("ts") if n == "ts_us" else F.col(n).cast(t).cast("string") if t == "long"
                      else F.col(n).cast(t)).alias(n) for n, t in names])
    return ev.groupBy("fold_bucket").applyInPandasWithState(fold.step, fold.OUT, "keys binary", "update",
                                                            "EventTimeTimeout")
