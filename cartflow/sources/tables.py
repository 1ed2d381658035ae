"""Table layer (S5-S14) on plain parquet folders and temp views.

Merges are keyed aggregates (partial aggregation combines a hot key
map-side) plus anti joins; nothing is collected to the driver.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cartflow.functions.exprs import since

TRAINING_COLUMNS = [
    "session_id", "user_id", "start_time", "end_time", "last_activity", "device_type", "browser", "page_views",
    "products_viewed", "unique_products_viewed", "searches", "cart_additions", "cart_removals", "cart_value",
    "is_converted", "purchase_value", "is_cart_abandoned", "abandonment_reason", "time_in_cart_seconds",
    "checkout_initiated", "persona", "session_duration_seconds", "avg_time_per_page", "bounce",
    "created_at", "updated_at",
]

TRAINING_SCHEMA = T.StructType([
    T.StructField("session_id", T.StringType()), T.StructField("user_id", T.LongType()),
    T.StructField("start_time", T.TimestampType()), T.StructField("end_time", T.TimestampType()),
    T.StructField("last_activity", T.TimestampType()), T.StructField("device_type", T.StringType()),
    T.StructField("browser", T.StringType()), T.StructField("page_views", T.LongType()),
    T.StructField("products_viewed", T.LongType()), T.StructField("unique_products_viewed", T.LongType()),
    T.StructField("searches", T.LongType()), T.StructField("cart_additions", T.LongType()),
    T.StructField("cart_removals", T.LongType()), T.StructField("cart_value", T.DoubleType()),
    T.StructField("is_converted", T.BooleanType()), T.StructField("purchase_value", T.DoubleType()),
    T.StructField("is_cart_abandoned", T.BooleanType()), T.StructField("abandonment_reason", T.StringType()),
    T.StructField("time_in_cart_seconds", T.IntegerType()), T.StructField("checkout_initiated", T.BooleanType()),
    T.StructField("persona", T.StringType()), T.StructField("session_duration_seconds", T.LongType()),
    T.StructField("avg_time_per_page", T.DoubleType()), T.StructField("bounce", T.BooleanType()),
    T.StructField("created_at", T.TimestampType()), T.StructField("updated_at", T.TimestampType()),
    T.StructField("abandoned", T.BooleanType()),
])


def _first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str], latest: bool) -> DataFrame:
    others = [c for c in df.columns if c not in keys]
    o = F.struct(*[F.col(c) for c in order])
    row = F.struct(*[F.col(c) for c in others])
    pick = F.max_by(row, o) if latest else F.min_by(row, o)
    return df.groupBy(*keys).agg(pick.alias("_row")).select(*keys, "_row.*")


def insert_if_absent(new: DataFrame, target: DataFrame | None, keys: Sequence[str],
                     order: Sequence[str]) -> DataFrame:
    """Rows to append so that the table keeps the *first* row per key.

    Within ``new`` the earliest row per key (by ``order``) wins; keys already
    in ``target`` are skipped (ON CONFLICT DO NOTHING).
    """
    first = _first_per_key(new, keys, order, latest=False)
    if target is None:
        return first
    return first.join(target.select(*keys).distinct(), list(keys), "left_anti")


def upsert_latest(new: DataFrame, target: DataFrame | None, keys: Sequence[str], order: Sequence[str],
                  expire_seconds: int | None = None, ts_col: str | None = None,
                  as_of: str | None = None) -> DataFrame:
    """Keep the latest row per key; with ``expire_seconds`` drop entries expired at ``as_of``."""
    both = new if target is None else target.unionByName(new, allowMissingColumns=True)
    latest = _first_per_key(both, keys, order, latest=True)
    if expire_seconds is not None:
        latest = latest.withColumn("expires_at", F.col(ts_col) + F.make_interval(secs=F.lit(expire_seconds)))
        if as_of is not None:
            latest = latest.filter(F.col("expires_at") > F.to_timestamp(F.lit(as_of)))
    return latest


def run_query(spark: SparkSession, sql: str, params: Mapping[str, object] | None = None,
              views: Mapping[str, DataFrame] | None = None) -> DataFrame:
    """Named-parameter SQL over registered views (``:name`` markers)."""
    for name, df in (views or {}).items():
        df.createOrReplaceTempView(name)
    return spark.sql(sql, args=dict(params or {}))


def append_rows(df: DataFrame, path: str, partition_by: Sequence[str] | None = None) -> None:
    """One all-or-nothing append (a failed job leaves no committed files)."""
    w = df.write.mode("append")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def training_export(sess: DataFrame) -> DataFrame:
    """The 26 exported session columns plus ``abandoned``, ordered by start time."""
    df = sess.withColumn("end_time", F.lit(None).cast("timestamp")) \
             .withColumn("created_at", F.col("start_time"))
    return df.select(*TRAINING_COLUMNS,
                     ((F.col("cart_value") > 0) & ~F.col("is_converted")).alias("abandoned")).orderBy("start_time")


CSV_TS_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"


def export_training(sess: DataFrame, folder: str, stamp: str) -> list[str]:
    """Header CSV written twice: a time-stamped copy and the 'latest' copy."""
    df = training_export(sess)
    paths = [f"{folder}/training_data_{stamp}", f"{folder}/training_data_latest"]
    df.write.mode("overwrite").option("header", True).option("timestampFormat", CSV_TS_FORMAT).csv(paths[0])
    # The second copy is made from the first, so the lineage and its sort run once.
    load_training(sess.sparkSession, paths[0]).write.mode("overwrite").option("header", True) \
        .option("timestampFormat", CSV_TS_FORMAT).csv(paths[1])
    return paths


def load_training(spark: SparkSession, path: str) -> DataFrame:
    """Read the exported CSV with its declared schema."""
    return (spark.read.schema(TRAINING_SCHEMA).option("header", True).option("timestampFormat", CSV_TS_FORMAT)
            .csv(path))


def read_jdbc(spark: SparkSession, url: str, table: str, partition_column: str, lower: int, upper: int,
              partitions: int, props: Mapping[str, str]) -> DataFrame:
    """Partitioned JDBC scan (needs the driver jar; parquet is the default store)."""
    return spark.read.jdbc(url, table, column=partition_column, lowerBound=lower, upperBound=upper,
                           numPartitions=partitions, properties=dict(props))


def evolve_schema(df: DataFrame, spec: Sequence[tuple[str, str, object]]) -> DataFrame:
    """Add each (name, type, default) column that is missing; idempotent."""
    for name, typ, default in spec:
        if name not in df.columns:
            df = df.withColumn(name, F.lit(default).cast(typ))
    return df


def describe_columns(spark: SparkSession, table: str, names: Sequence[str] | None = None) -> DataFrame:
    """Name and type of the chosen columns of a table or view, sorted by name."""
    cols = [(c.name, c.dataType) for c in spark.catalog.listColumns(table)
            if names is None or c.name in names]
    return spark.createDataFrame(sorted(cols), "column_name string, data_type string")


def list_views(spark: SparkSession, prefix: str = "v_") -> DataFrame:
    """temp/permanent views whose name starts with ``prefix``, sorted."""
    names = sorted(t.name for t in spark.catalog.listTables() if t.tableType in ("TEMPORARY", "VIEW")
                   and t.name.startswith(prefix))
    return spark.createDataFrame([(n,) for n in names], "table_name string")


def register_views(sess: DataFrame) -> list[str]:
    """The three analytical views over the session table, as temp views."""
    from cartflow.operators import reports as R
    views = {"v_cart_abandonment_analysis": R.abandonment_detail(sess),
             "v_conversion_funnel": R.conversion_funnel_daily(sess),
             "v_abandonment_reasons": R.abandonment_reasons(sess)}
    for name, df in views.items():
        df.createOrReplaceTempView(name)
    return sorted(views)


def purge_older_than(df: DataFrame, ts_col: str, days: int, as_of: str) -> DataFrame:
    """Keep the last ``days`` days before ``as_of``."""
    return df.filter(since(ts_col, days * 24, as_of))


def truncate(spark: SparkSession, path: str) -> DataFrame:
    """Delete all rows of the Parquet table at ``path``; its row counts before and after."""
    table = spark.read.parquet(path)
    before = table.count()
    spark.createDataFrame([], table.schema).write.mode("overwrite").parquet(path)
    after = spark.read.schema(table.schema).parquet(path).count()
    return spark.createDataFrame([(before, after)], "rows_before long, rows_after long")


def write_by_day(df: DataFrame, path: str, ts_col: str) -> None:
    """A table partitioned by day; only the days that ``df`` holds are replaced."""
    df.withColumn("day", F.to_date(ts_col)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic") \
        .partitionBy("day").parquet(path)


def retain_days(spark: SparkSession, path: str, ts_col: str, days: int, as_of: str) -> DataFrame:
    """``purge_older_than`` on a table written by day; (day, action) of what changed.

    Days before the cutoff lose their folder, and no row of them is read; the
    day of the cutoff is written anew without its older rows; later days are
    not touched.  Rows without a time are older than any.
    """
    import datetime as dt

    from cartflow.session import fresh_dir
    cut = dt.datetime.fromisoformat(as_of) - dt.timedelta(days=days)
    root = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = root.getFileSystem(spark._jsc.hadoopConfiguration())
    done = []
    for status in fs.listStatus(root):
        name = status.getPath().getName()
        if not name.startswith("day="):
            continue
        day = name[4:]
        if day == "__HIVE_DEFAULT_PARTITION__" or dt.date.fromisoformat(day) < cut.date():
            fs.delete(status.getPath(), True)
            done.append((day, "dropped"))
        elif dt.date.fromisoformat(day) == cut.date() and cut.time() != dt.time():
            rows = spark.read.parquet(path).where(F.col("day") == F.lit(cut.date())) \
                .where(F.col(ts_col) >= F.to_timestamp(F.lit(str(cut)))).drop("day")
            kept = fresh_dir(spark, "retained")
            rows.write.mode("overwrite").parquet(kept)  # a table cannot be read and replaced at once
            kept = spark.read.schema(rows.schema).parquet(kept)
            if kept.isEmpty():
                fs.delete(status.getPath(), True)
            else:
                write_by_day(kept, path, ts_col)
            done.append((day, "trimmed"))
    return spark.createDataFrame(sorted(done), "day string, action string")
