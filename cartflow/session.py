"""SparkSession construction and the shared scratch folder."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings every cartflow job relies on: UTC event time (session boundaries and
# date buckets are computed in UTC), ANSI arithmetic, AQE for runtime
# coalescing and skew-join splitting.
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_spark(master: str | None = None, shuffle_partitions: int | None = None,
              app_name: str = "cartflow", extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with cartflow's settings.

    On a cluster, pass ``master=None`` and let spark-submit decide; size
    ``shuffle_partitions`` to the data (about 128-256 MB of shuffle per task).
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(BASE_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    for k, v in conf.items():
        if not k.startswith("spark.ui") and not k.startswith("spark.driver"):
            try:
                spark.conf.set(k, v)
            except Exception:  # static conf of an existing session
                pass
    spark.sparkContext.setLogLevel("WARN")
    ship_package(spark)
    return spark


_SHIPPED: set = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``cartflow`` importable on executors (Python workers do not see the
    driver's ``sys.path``): zip the package once and ``addPyFile`` it."""
    import zipfile
    sc = spark.sparkContext
    key = sc.applicationId
    if key in _SHIPPED:
        return
    pkg = os.path.dirname(os.path.abspath(__file__))
    out = os.path.join(tempfile.mkdtemp(prefix="cartflow-pkg-"), "cartflow.zip")
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        for root, _, files in os.walk(pkg):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(root, f)
                    z.write(full, os.path.relpath(full, os.path.dirname(pkg)))
    sc.addPyFile(out)
    # The driver's own helper processes (of stateful streaming) know no added files; they look along this path.
    sc.environment["PYTHONPATH"] = os.pathsep.join(p for p in (out, sc.environment.get("PYTHONPATH")) if p)
    _SHIPPED.add(key)


def scratch_dir(spark: SparkSession, name: str | None = None) -> str:
    """Shared folder for materialised tables and checkpoints.

    Uses the cluster's ``spark.checkpoint.dir``.  Where it is unset, a
    single-machine master (tests) gets a temporary folder; a cluster must set it.
    """
    base = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if not base:
        base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        base = spark.sparkContext.getCheckpointDir()
    if not base:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = tempfile.mkdtemp(prefix="cartflow-")
        spark.sparkContext.setCheckpointDir(base)
        spark.conf.set("spark.checkpoint.dir", base)
        base = spark.sparkContext.getCheckpointDir() or base
    if name is None:
        return base
    sub = f"{base.rstrip('/')}/{name}"
    path = spark._jvm.org.apache.hadoop.fs.Path(sub)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).mkdirs(path)
    return sub


def fresh_dir(spark: SparkSession, prefix: str) -> str:
    """A new, unique sub-folder of the scratch folder (never reused)."""
    import uuid
    return scratch_dir(spark, f"{prefix}-{uuid.uuid4().hex[:12]}")


def stored(frame, prefix: str):
    """``frame`` as a table in the shared folder, so that what reads it several times does not repeat its lineage."""
    path = fresh_dir(frame.sparkSession, prefix)
    frame.write.mode("overwrite").parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)
