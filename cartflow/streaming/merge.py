"""Keyed tables that micro-batches change, and outcome labels on streams.

``KeyedTable`` is a base and one delta for each micro-batch since; a reader
merges them, the latest row of a key wins, and every few batches the merge
becomes the new base.  A batch reads the table as it was before it, so a
replayed batch replaces its own delta and changes nothing else.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cartflow.sources.tables import insert_if_absent, upsert_latest

COMPACT_EVERY = 8


class KeyedTable:
    """A table keyed by ``keys``; within a batch the latest row by ``order`` wins (S6), between batches the later one.

    ``schema`` is that of the rows; without it a read looks into the files, which takes a job.
    """

    def __init__(self, spark: SparkSession, path: str, keys: Sequence[str], order: Sequence[str],
                 compact_every: int = COMPACT_EVERY, schema: T.StructType | None = None):
        self.spark, self.path, self.keys, self.order = spark, path.rstrip("/"), list(keys), list(order)
        self.compact_every, self.schema = compact_every, schema

    def _folders(self) -> tuple[dict[int, str], dict[int, str]]:
        """Complete bases and deltas by batch."""
        jvm, conf = self.spark._jvm, self.spark._jsc.hadoopConfiguration()
        root = jvm.org.apache.hadoop.fs.Path(self.path)
        fs = root.getFileSystem(conf)
        found: dict[str, dict[int, str]] = {"base": {}, "delta": {}}
        for status in fs.listStatus(root) if fs.exists(root) else ():
            m = re.fullmatch(r"(base|delta)-(\d+)", status.getPath().getName())
            if m and fs.exists(jvm.org.apache.hadoop.fs.Path(status.getPath(), "_SUCCESS")):
                found[m[1]][int(m[2])] = f"{self.path}/{m[0]}"
        return found["base"], found["delta"]

    def read(self, before: int | None = None) -> DataFrame | None:
        """The table before a batch (None: after all of them); None if nothing was written yet."""
        bases, deltas = self._folders()
        base = max((b for b in bases if before is None or b < before), default=-1)
        paths = [bases[base]] if base >= 0 else []
        paths += [p for d, p in sorted(deltas.items()) if d > base and (before is None or d < before)]
        if not paths:
            return None
        # One scan of all folders: a plan with a branch for each would grow with them.
        reader = self.spark.read.option("mergeSchema", True) if self.schema is None else \
            self.spark.read.schema(T.StructType([*self.schema.fields, T.StructField("_deleted", T.BooleanType())]))
        rows = reader.parquet(*paths)
        if len(paths) > 1:
            folder = F.regexp_extract("_metadata.file_path", r"/(?:base|delta)-(\d+)/[^/]*$", 1)
            rows = upsert_latest(rows.withColumn("_version", folder.cast("long")), None, self.keys, ["_version"]) \
                .drop("_version")
        return rows.where("not _deleted").drop("_deleted")

    def apply(self, rows: DataFrame, batch_id: int, deleted: DataFrame | None = None) -> None:
        """Upsert ``rows`` and delete the keys in ``deleted`` as one batch."""
        delta = upsert_latest(rows, None, self.keys, self.order).withColumn("_deleted", F.lit(False))
        if deleted is not None:
            gone = deleted.select(*self.keys).distinct()
            delta = delta.join(gone, self.keys, "left_anti") \
                .unionByName(gone.withColumn("_deleted", F.lit(True)), allowMissingColumns=True)
        delta.write.mode("overwrite").parquet(f"{self.path}/delta-{batch_id}")
        bases, deltas = self._folders()
        if sum(max(bases, default=-1) < d <= batch_id for d in deltas) >= self.compact_every:
            self._compact(batch_id)

    def _compact(self, batch_id: int) -> None:
        self.read(before=batch_id + 1).withColumn("_deleted", F.lit(False)) \
            .write.mode("overwrite").parquet(f"{self.path}/base-{batch_id}")
        # The base before it stays, for a replay of this batch; what is older than that can go.
        bases, deltas = self._folders()
        kept = max((b for b in bases if b < batch_id), default=-1)
        jvm, conf = self.spark._jvm, self.spark._jsc.hadoopConfiguration()
        for version, path in [*bases.items(), *deltas.items()]:
            if version < kept or (version == kept and "/delta-" in path):
                p = jvm.org.apache.hadoop.fs.Path(path)
                p.getFileSystem(conf).delete(p, True)


class OutcomeMerge:
    """J4 on a stream: predictions stay open until a purchase or abandonment of their session arrives.

    The open predictions and the sessions' first abandonments are keyed tables,
    which hold live sessions only: a session that ends takes its rows out.
    Closed predictions are appended, each batch to a folder of its own.
    """

    def __init__(self, spark: SparkSession, out: str):
        self.spark, self.out = spark, out

    def apply(self, predictions: DataFrame, outcomes: DataFrame, closed: DataFrame, batch_id: int,
              settles: bool = True) -> None:
        """Merge one batch: new predictions, committed outcome events and ended sessions, all in commit order.

        Without outcomes and ended sessions (``settles`` False) only predictions of sessions that were abandoned
        before can close.
        """
        from cartflow.operators.outcomes import label_outcomes
        spark, out = self.spark, f"{self.out}/labelled/_batch={batch_id}"
        first_schema = T.StructType([outcomes.schema[c] for c in ("session_id", "ts", "event_id")])
        open_table = KeyedTable(spark, f"{self.out}/open_predictions", ["prediction_id"], ["prediction_timestamp"],
                                schema=predictions.schema)
        first_table = KeyedTable(spark, f"{self.out}/first_abandonments", ["session_id"], ["ts"], schema=first_schema)
        before, known = open_table.read(batch_id), first_table.read(batch_id)
        # What several steps read is computed once.
        kept = [] if before is None else [before.persist()]
        new = insert_if_absent(predictions, before, ["prediction_id"], ["prediction_timestamp"]) \
            .select(*predictions.columns).persist()  # S5
        kept.append(new)
        try:
            first = outcomes.where("event_type = 'cart_abandoned'").groupBy("session_id").agg(
                F.min(F.struct("ts", "event_id")).alias("f")).select("session_id", "f.ts", "f.event_id")
            if known is not None:
                kept.append(known.persist())
                first = first.join(known.select("session_id"), "session_id", "left_anti")
            first = first.persist()
            kept.append(first)
            sticky = first if known is None else first.unionByName(known.select(*first.columns))
            abandoned = sticky.withColumn("event_type", F.lit("cart_abandoned")) \
                .withColumn("cart_value", F.lit(None).cast("double"))
            events = outcomes.where("event_type = 'purchase'").unionByName(abandoned.select(*outcomes.columns)).persist()
            kept.append(events)
            candidates = new if before is None or not settles else new.unionByName(before.select(*new.columns))
            # Only sessions that an event or their end touches can change.
            touched = events.select("session_id", F.lit(False).alias("_ended")) \
                .unionByName(closed.select("session_id", F.lit(True).alias("_ended"))) \
                .groupBy("session_id").agg(F.max("_ended").alias("_ended"))
            changing = candidates.join(touched, "session_id").persist()
            kept.append(changing)

            def label() -> None:
                label_outcomes(changing, events) \
                    .where("actual_outcome is not null or _ended") \
                    .select(*predictions.columns, "actual_outcome", "was_prediction_correct") \
                    .write.mode("overwrite").parquet(out)
                done = spark.read.schema(labelled_schema(predictions)).parquet(out).select("prediction_id")
                open_table.apply(new, batch_id, deleted=done)

            at_once(spark, [label] + [lambda: first_table.apply(first, batch_id, deleted=closed)] * settles)
        finally:
            for frame in kept:
                frame.unpersist()


def at_once(spark: SparkSession, steps: Sequence[Callable[[], None]]) -> None:
    """Run steps that do not need each other side by side; all have ended when an error is raised."""
    with ThreadPoolExecutor(max(1, len(steps))) as pool:
        for running in [pool.submit(inheritable_thread_target(spark)(step)) for step in steps]:
            running.result()


def stored_bytes(spark: SparkSession, out: str) -> int:
    """Size of a sink's keyed tables, as far as batches read them again."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    paths = [jvm.org.apache.hadoop.fs.Path(f"{out}/{name}")
             for name in ("open_predictions", "first_abandonments", "latest_sessions")]
    return sum(fs.getContentSummary(p).getLength() for p in paths for fs in [p.getFileSystem(conf)] if fs.exists(p))


def labelled_schema(predictions: DataFrame) -> T.StructType:
    return T.StructType([*predictions.schema.fields, T.StructField("actual_outcome", T.StringType()),
                         T.StructField("was_prediction_correct", T.BooleanType())])


def labelled_predictions(spark: SparkSession, out: str) -> DataFrame | None:
    """All predictions of a run with their labels; those still open have none."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{out}/labelled")
    if not path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path):
        return None
    done = spark.read.parquet(f"{out}/labelled").drop("_batch")
    left = KeyedTable(spark, f"{out}/open_predictions", ["prediction_id"], ["prediction_timestamp"]).read()
    return done if left is None else done.unionByName(left, allowMissingColumns=True)
