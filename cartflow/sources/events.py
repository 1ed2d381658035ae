"""Event decoding, validation and keyed JSON output."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cartflow import constants as K

# Wide nullable schema of a storefront event (fields vary by event type).
EVENT_SCHEMA = T.StructType([
    T.StructField("event_id", T.StringType()),
    T.StructField("timestamp", T.StringType()),
    T.StructField("user_id", T.LongType()),
    T.StructField("session_id", T.StringType()),
    T.StructField("event_type", T.StringType()),
    T.StructField("device_type", T.StringType()),
    T.StructField("browser", T.StringType()),
    T.StructField("session_state", T.StringType()),
    T.StructField("product_id", T.IntegerType()),
    T.StructField("category", T.StringType()),
    T.StructField("price", T.DoubleType()),
    T.StructField("quantity", T.IntegerType()),
    T.StructField("cart_value", T.DoubleType()),
    T.StructField("items_count", T.IntegerType()),
    T.StructField("persona", T.StringType()),
    T.StructField("abandonment_reason", T.StringType()),
    T.StructField("time_in_cart_seconds", T.IntegerType()),
    T.StructField("recovery_time_seconds", T.IntegerType()),
    T.StructField("payment_method", T.StringType()),
    T.StructField("search_query", T.StringType()),
    T.StructField("results_count", T.IntegerType()),
    T.StructField("page_url", T.StringType()),
    T.StructField("referrer", T.StringType()),
    T.StructField("time_on_page", T.IntegerType()),
    T.StructField("recovered_from_abandonment", T.BooleanType()),
    T.StructField("total_page_views", T.IntegerType()),
    T.StructField("session_duration", T.IntegerType()),
    T.StructField("converted", T.BooleanType()),
    T.StructField("cart_abandoned", T.BooleanType()),
    T.StructField("recovered_from_intervention", T.BooleanType()),
])


def encode_events(ev: DataFrame, key_col: str = "session_id") -> DataFrame:
    """(key, value) rows with a JSON value, ready for a Kafka-style sink.

    ``ts`` is written as ISO-8601 text with a trailing ``Z`` like the producer.
    """
    cols = [c for c in EVENT_SCHEMA.fieldNames() if c in ev.columns]
    value = F.to_json(F.struct(*[F.col(c) for c in cols],
                               F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'").alias("timestamp")))
    return ev.select(F.col(key_col).cast("string").alias("key"), value.alias("value"))


def kafka_sink_options(servers: str, topic: str) -> dict[str, str]:
    """Producer settings of the studied system (acks=all, gzip, linger 10 ms, 16 KB batches)."""
    return {"kafka.bootstrap.servers": servers, "topic": topic, "kafka.acks": "all",
            "kafka.compression.type": "gzip", "kafka.linger.ms": "10", "kafka.batch.size": "16384"}


def decode_events(raw: DataFrame, value_col: str = "value") -> tuple[DataFrame, DataFrame]:
    """bytes/text -> typed columns.

    Rows that are no JSON objects, or hold a value of the wrong type, go to
    the reject output with their reason; a time that cannot be read becomes
    null and is rejected by ``validate_events``.
    """
    text = F.col(value_col).cast("string")
    schema = T.StructType([*EVENT_SCHEMA.fields, T.StructField("_corrupt", T.StringType())])
    # A generator keeps the parse in one place; filters on its fields would otherwise each repeat it.
    parsed = raw.select(text.alias("_raw"), F.explode(F.array(
        F.from_json(text, schema, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"}))).alias("e"))
    bad = F.col("e").isNull() | F.col("e._corrupt").isNotNull()
    good = parsed.filter(~bad).select("e.*").drop("_corrupt") \
        .withColumn("ts", F.try_to_timestamp(F.regexp_replace("timestamp", "Z$", "")))
    no_object = F.try_parse_json("_raw").isNull() | ~F.col("_raw").rlike(r"^\s*\{")
    reason = F.when(no_object, "invalid json").otherwise("field of the wrong type")
    rejects = parsed.filter(bad).select(F.col("_raw").alias("value"), reason.alias("reason"))
    return good, rejects


def event_key(session_id: Column, user_id: Column) -> Column:
    """T4: session id, else user id, else 'unknown'."""
    return F.coalesce(session_id, user_id.cast("string"), F.lit("unknown"))


def validate_events(ev: DataFrame) -> tuple[DataFrame, DataFrame]:
    """S3: required fields and enums; defaults quantity=1, device_type='desktop'.

    Returns (valid rows, rejects with an array of reasons).  A row without a
    session id is rejected (the fold drops it).
    """
    c = F.col
    reasons = F.filter(F.array(
        F.when(c("event_id").isNull(), F.lit("event_id missing")),
        F.when(c("ts").isNull(), F.lit("timestamp missing or invalid")),
        F.when(c("user_id").isNull(), F.lit("user_id missing")),
        F.when(c("session_id").isNull(), F.lit("session_id missing")),
        F.when(c("event_type").isNull() | ~c("event_type").isin(*K.EVENT_TYPES), F.lit("unknown event_type")),
        F.when(c("device_type").isNotNull() & ~c("device_type").isin(*K.DEVICE_TYPES), F.lit("unknown device_type")),
        F.when(c("price") < 0, F.lit("negative price")),
        F.when(c("quantity") < 0, F.lit("negative quantity")),
    ), lambda x: x.isNotNull())
    tagged = ev.withColumn("_reasons", reasons)
    valid = tagged.filter(F.size("_reasons") == 0).drop("_reasons") \
        .withColumn("quantity", F.when(c("event_type").isin("add_to_cart", "remove_from_cart"),
                                       F.coalesce(c("quantity"), F.lit(1))).otherwise(c("quantity"))) \
        .withColumn("device_type", F.coalesce(c("device_type"), F.lit("desktop")))
    rejects = tagged.filter(F.size("_reasons") > 0).withColumnRenamed("_reasons", "reasons")
    return valid, rejects
