import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.join(ROOT, "tests"))

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from cartflow.session import get_spark
    s = get_spark("local[4]", 4, app_name="cartflow-tests")
    if not s.sparkContext.getCheckpointDir():
        d = tempfile.mkdtemp(prefix="cartflow-test-")
        s.sparkContext.setCheckpointDir(d)
        s.conf.set("spark.checkpoint.dir", d)
    yield s
    s.stop()


@pytest.fixture(scope="session")
def small_dir():
    return SMALL


def events_df(spark, rows):
    """Storefront events from dict rows (missing columns are NULL)."""
    from pyspark.sql import types as T
    schema = T.StructType([
        T.StructField("event_id", T.LongType()), T.StructField("ts", T.TimestampType()),
        T.StructField("user_id", T.LongType()), T.StructField("session_id", T.StringType()),
        T.StructField("event_type", T.StringType()), T.StructField("product_id", T.IntegerType()),
        T.StructField("category", T.StringType()), T.StructField("price", T.DoubleType()),
        T.StructField("quantity", T.IntegerType()), T.StructField("cart_value", T.DoubleType()),
        T.StructField("device_type", T.StringType()), T.StructField("browser", T.StringType()),
        T.StructField("persona", T.StringType()), T.StructField("abandonment_reason", T.StringType()),
        T.StructField("time_in_cart_seconds", T.IntegerType()), T.StructField("k", T.IntegerType()),
    ])
    data = [tuple(r.get(f.name) for f in schema.fields) for r in rows]
    return spark.createDataFrame(data, schema)
