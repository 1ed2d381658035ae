"""Sources, sinks and bounded runs for the streaming operators.

* ``replay_source``  writes a Spark-derived DataFrame as time-ordered parquet
  files in the shared scratch folder and opens it as a file stream (the
  test stand-in for the Kafka topic; ``kafka_source`` builds the real one).
* ``run_bounded``    T13: ``trigger(availableNow=True)`` with a checkpoint in
  the scratch folder; every micro-batch is appended by ``foreachBatch`` with
  its batch id, so a retried batch rewrites identical rows (idempotent).
* ``run_ordered``    replays a table slice by slice in event time, closing events last.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cartflow.session import fresh_dir


def replay_source(spark: SparkSession, df: DataFrame, files: int = 8,
                  max_files_per_trigger: int = 2) -> DataFrame:
    """Write ``df`` as ``files`` time-range files and read it back as a stream."""
    path = fresh_dir(spark, "replay")
    df.repartitionByRange(files, "ts").write.mode("overwrite").parquet(path)
    return (spark.readStream.schema(df.schema).option("maxFilesPerTrigger", max_files_per_trigger)
            .parquet(path))


CLOSING_SESSION = "closing"


def closing_seconds(watermark_seconds: int = 600) -> list[int]:
    """When closing events must come after the last event: the first passes all idle carts, the second all sessions."""
    from cartflow import constants as K
    return [K.CART_ABANDONMENT_IDLE_SECONDS + watermark_seconds + 60, K.SESSION_GAP_SECONDS + watermark_seconds + 60]


def run_ordered_to(spark: SparkSession, df: DataFrame, build, output_mode: str, name: str, slices: int = 8,
                   close_after: list[int] = ()) -> tuple[str, object]:
    """``run_ordered`` of ``build(stream)`` with each batch in a folder of its own: (output folder, finished query)."""
    out, ckpt = fresh_dir(spark, f"stream-{name}"), fresh_dir(spark, f"ckpt-{name}")

    def sink(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out}/_batch={batch_id}")

    q = run_ordered(spark, df, lambda s: build(s).writeStream.outputMode(output_mode)
                    .option("checkpointLocation", ckpt).foreachBatch(sink).start(), slices, close_after)
    return out, q


def run_ordered(spark: SparkSession, df: DataFrame, start_query, slices: int = 8, close_after: list[int] = ()):
    """Replay ``df`` in event-time order: slice i is appended and fully
    processed before slice i+1, so the watermark and event-time timers
    advance as in a live feed.  ``df`` is computed once into a staging table
    partitioned by slice; each append then reads only its own partition.
    ``start_query(stream)`` must start and return the streaming query.
    After each number of seconds in ``close_after`` past the last event, one
    event of the session ``CLOSING_SESSION`` arrives, which moves the
    watermark past all that is left.  An empty table brings no micro-batch.
    """
    stage, path = fresh_dir(spark, "replay-stage"), fresh_dir(spark, "replay-ordered")
    df.withColumn("_us", F.unix_micros("ts")).write.mode("overwrite").parquet(f"{stage}/all")
    whole = spark.read.parquet(f"{stage}/all")
    bounds = whole.select(F.min("_us").alias("lo"), F.max("_us").alias("hi")).first()
    q = start_query(spark.readStream.schema(df.schema).parquet(path))
    try:
        if bounds.lo is None:
            return q
        lo, hi = int(bounds.lo), int(bounds.hi) + 1
        step = -(-(hi - lo) // slices)
        sl = F.least(F.floor((F.col("_us") - F.lit(lo)) / F.lit(step)), F.lit(slices - 1)).cast("int")
        whole.withColumn("_slice", sl).drop("_us").write.mode("overwrite").partitionBy("_slice").parquet(f"{stage}/cut")
        staged = spark.read.parquet(f"{stage}/cut")
        for i in range(slices):
            staged.filter(F.col("_slice") == i).select(*df.columns).write.mode("append").parquet(path)
            q.processAllAvailable()
        for after in close_after:
            at = F.timestamp_micros(F.lit(hi - 1 + after * 1_000_000))
            last = spark.range(1).select(*[
                {"ts": at, "session_id": F.lit(CLOSING_SESSION), "event_id": F.lit("0"),
                 "event_type": F.lit("page_view")}.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name)
                for f in df.schema.fields])
            last.write.mode("append").parquet(path)
            q.processAllAvailable()
    finally:
        q.stop()
    return q


def start_multi_sink(stream: DataFrame, sink, name: str = "multi"):
    """Start a stream whose every micro-batch goes to one foreachBatch sink."""
    ckpt = fresh_dir(stream.sparkSession, f"ckpt-{name}")
    return stream.writeStream.outputMode("update").option("checkpointLocation", ckpt).foreachBatch(sink).start()


def kafka_source(spark: SparkSession, servers: str, topics: str, starting: str = "earliest") -> DataFrame:
    """Subscribe to topics from the earliest offset (needs the Kafka connector jar)."""
    return (spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers)
            .option("subscribe", topics).option("startingOffsets", starting).load())


def run_bounded(stream: DataFrame, output_mode: str = "update", name: str = "out",
                processing_time: str | None = None, timeout: float | None = None) -> tuple[str, object]:
    """Run a streaming query over everything available, each batch in a folder of its own.

    Returns (output folder, finished query).  ``processing_time`` switches to
    a periodic trigger (T2: the 60 s tick), which runs for ``timeout`` seconds
    and is then stopped.
    """
    spark = stream.sparkSession
    out = fresh_dir(spark, f"stream-{name}")
    ckpt = fresh_dir(spark, f"ckpt-{name}")

    def sink(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out}/_batch={batch_id}")  # a retried batch replaces itself

    w = stream.writeStream.outputMode(output_mode).option("checkpointLocation", ckpt).foreachBatch(sink)
    w = w.trigger(processingTime=processing_time) if processing_time else w.trigger(availableNow=True)
    if processing_time and timeout is None:
        raise ValueError("a periodic trigger needs a timeout")
    q = w.start()
    if not q.awaitTermination(timeout) if timeout is not None else q.awaitTermination():
        q.stop()
    return out, q


def read_sink(spark: SparkSession, out: str, schema: str) -> DataFrame:
    """Read a bounded run's output (empty frame when no batch produced rows)."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    path = jvm.org.apache.hadoop.fs.Path(out)
    fs = path.getFileSystem(conf)
    if not fs.exists(path) or not any(f.getPath().getName().startswith("_batch=") for f in fs.listStatus(path)):
        return spark.createDataFrame([], schema + ", _batch int")
    return spark.read.parquet(out)
