"""Every batch's report in a table, and late rows in a side table.

``progress_log`` listens to the session's streaming queries and writes each
report to a file of its own in the shared folder, named after run and batch,
so no report is lost however long a query runs and a repeated one replaces
itself.  ``late_rows`` splits a micro-batch by the watermark it ran under.
"""

from __future__ import annotations

import threading
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

from cartflow.session import fresh_dir

REPORT = ("runId string, batchId long, timestamp string, numInputRows double, inputRowsPerSecond double, "
          "processedRowsPerSecond double, durationMs map<string,double>, "
          "stateOperators array<struct<numRowsTotal:double,numRowsDroppedByWatermark:double,numRowsUpdated:double>>, "
          "observedMetrics map<string,map<string,double>>")


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A small text file in any store that Spark reaches."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    out = p.getFileSystem(spark._jsc.hadoopConfiguration()).create(p, True)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()


class ProgressLog(StreamingQueryListener):
    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder
        self.started, self.ended, self.changed = 0, 0, threading.Condition()

    def onQueryStarted(self, event) -> None:
        with self.changed:
            self.started += 1

    def onQueryProgress(self, event) -> None:
        p = event.progress
        write_text(self.spark, f"{self.folder}/{p.runId}-{p.batchId:012d}.json", p.json.replace("\\n", " "))

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        with self.changed:
            self.ended += 1
            self.changed.notify_all()

    def wait(self, seconds: float = 60) -> None:
        """Until the reports of all queries that have started and ended are written."""
        with self.changed:
            self.changed.wait_for(lambda: self.ended >= self.started, seconds)


@contextmanager
def progress_log(spark: SparkSession, folder: str | None = None) -> Iterator[str]:
    """Log the reports of the queries that run inside; yields the folder of the log."""
    folder = folder or fresh_dir(spark, "progress")
    log = ProgressLog(spark, folder)
    spark.streams.addListener(log)
    try:
        yield folder
    finally:
        log.wait()
        spark.streams.removeListener(log)


def reports(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.schema(REPORT).json(folder)


def system_metrics(spark: SparkSession, folder: str) -> DataFrame:
    """One row per batch and metric (name, value, unit, time), read from a progress log."""
    state = F.coalesce(F.col("stateOperators"), F.array().cast(
        "array<struct<numRowsTotal:double,numRowsDroppedByWatermark:double,numRowsUpdated:double>>"))

    def total(field: str):
        return F.aggregate(state, F.lit(0.0), lambda a, s: a + F.coalesce(s[field], F.lit(0.0)))

    values = [("input_rows", F.col("numInputRows"), "rows"),
              ("input_rows_per_second", F.col("inputRowsPerSecond"), "rows/s"),
              ("processed_rows_per_second", F.col("processedRowsPerSecond"), "rows/s"),
              ("trigger_execution_ms", F.col("durationMs")["triggerExecution"], "ms"),
              ("state_rows", total("numRowsTotal"), "rows"),
              ("rows_dropped_by_watermark", total("numRowsDroppedByWatermark"), "rows")]
    metrics = F.explode(F.array(*[F.struct(F.lit(n).alias("metric_name"),
                                           F.round(F.coalesce(v, F.lit(0.0)), 2).alias("metric_value"),
                                           F.lit(u).alias("metric_unit")) for n, v, u in values]))
    return reports(spark, folder).select(F.to_timestamp("timestamp").alias("timestamp"),
                                         F.col("batchId").alias("batch_id"), metrics.alias("m")) \
        .select("timestamp", "batch_id", "m.*")


class LateRows:
    """A sink that splits every micro-batch by the watermark it ran under.

    A stateful operator drops rows at or behind the largest event time of all
    earlier batches less the delay (Spark may lag a batch behind and drop
    fewer).  This sink finds those rows, writes
    them to ``late`` and hands the others on.  Each batch leaves its largest
    event time in a folder of its own, so a replayed batch finds the same.
    """

    def __init__(self, spark: SparkSession, out: str, delay_seconds: int, ts: str = "ts"):
        self.spark, self.out, self.delay, self.ts = spark, out, delay_seconds, ts

    def watermark_us(self, batch_id: int) -> int | None:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.out}/high")
        if not path.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(path):
            return None
        high = self.spark.read.schema("us long, _batch long").parquet(f"{self.out}/high") \
            .where(F.col("_batch") < batch_id).agg(F.max("us")).first()[0]
        # Spark keeps the watermark in whole milliseconds.
        return None if high is None else (high // 1000 - self.delay * 1000) * 1000

    def split(self, batch: DataFrame, batch_id: int) -> DataFrame:
        """Writes the late rows and the batch's largest time; returns the rows in time."""
        us = F.unix_micros(self.ts)
        wm = self.watermark_us(batch_id)
        late = F.lit(False) if wm is None else F.coalesce(us <= wm, F.lit(False))
        batch.where(late).write.mode("overwrite").parquet(f"{self.out}/late/_batch={batch_id}")
        batch.agg(F.max(us).alias("us")).write.mode("overwrite").parquet(f"{self.out}/high/_batch={batch_id}")
        return batch.where(~late)
