"""Catalogue, weather and market-data flatteners.

Each takes decoded JSON rows (one column per top-level field) and returns the
flat event the studied system publishes.  Ids are deterministic here
(``prod_<id>_<8 hex of md5>``) instead of random.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

PRODUCT_RAW_SCHEMA = T.StructType([
    T.StructField("id", T.LongType()), T.StructField("title", T.StringType()),
    T.StructField("price", T.DoubleType()), T.StructField("category", T.StringType()),
    T.StructField("description", T.StringType()), T.StructField("image", T.StringType()),
    T.StructField("rating", T.StructType([T.StructField("rate", T.DoubleType()),
                                          T.StructField("count", T.IntegerType())])),
    T.StructField("stock_quantity", T.IntegerType()),
])

WEATHER_RAW_SCHEMA = T.StructType([
    T.StructField("name", T.StringType()),
    T.StructField("weather", T.ArrayType(T.StructType([
        T.StructField("id", T.IntegerType()), T.StructField("main", T.StringType()),
        T.StructField("description", T.StringType()), T.StructField("icon", T.StringType())]))),
    T.StructField("main", T.StructType([
        T.StructField("temp", T.DoubleType()), T.StructField("feels_like", T.DoubleType()),
        T.StructField("humidity", T.IntegerType()), T.StructField("pressure", T.IntegerType())])),
    T.StructField("wind", T.StructType([T.StructField("speed", T.DoubleType())])),
    T.StructField("dt", T.LongType()),
])

BAR_SCHEMA = "symbol string, ts timestamp, open double, high double, low double, close double, " \
             "volume long, market_cap double"


def flatten_products(raw: DataFrame, ingested_at: str) -> DataFrame:
    """Product JSON -> ProductEvent; the nested rating is lifted, stock defaults to 100."""
    c = F.col
    return raw.select(
        F.concat(F.lit("prod_"), c("id").cast("string"), F.lit("_"),
                 F.substring(F.md5(F.concat_ws("|", c("id").cast("string"), c("title"))), 1, 8)).alias("event_id"),
        F.to_timestamp(F.lit(ingested_at)).alias("timestamp"),
        c("id").alias("product_id"), "title", "price", "category", "description", "image",
        c("rating.rate").alias("rating_rate"), c("rating.count").alias("rating_count"),
        F.coalesce(c("stock_quantity"), F.lit(100)).alias("stock_quantity"))


def products_by_category(products: DataFrame, category: str) -> DataFrame:
    """The products of one category."""
    return products.filter(F.col("category") == category)


def categories(products: DataFrame) -> DataFrame:
    """The distinct categories, sorted."""
    return products.select("category").where(F.col("category").isNotNull()).distinct().orderBy("category")


def product_by_id(products: DataFrame, product_id: int) -> DataFrame:
    """Lookup by id."""
    return products.filter(F.col("product_id") == product_id)


def flatten_weather(raw: DataFrame) -> DataFrame:
    """Weather JSON -> WeatherEvent (first weather entry; location default 'Unknown')."""
    c = F.col
    first = F.get(c("weather"), 0)
    return raw.select(
        F.concat(F.lit("weather_"), F.substring(F.md5(F.to_json(F.struct(*raw.columns))), 1, 8)).alias("event_id"),
        F.coalesce(c("name"), F.lit("Unknown")).alias("location"),
        c("main.temp").alias("temperature"), c("main.feels_like").alias("feels_like"),
        c("main.humidity").alias("humidity"), first.getField("main").alias("weather_condition"),
        first.getField("description").alias("weather_description"), c("wind.speed").alias("wind_speed"))


def flatten_finance(bars: DataFrame) -> DataFrame:
    """Latest bar per symbol -> FinanceEvent, change % = (close - open) / open * 100."""
    c = F.col
    latest = bars.groupBy("symbol").agg(F.max_by(F.struct(*[c(x) for x in bars.columns]), c("ts")).alias("b"))
    b = lambda x: c(f"b.{x}")
    return latest.select(
        F.concat(F.lit("fin_"), c("symbol")).alias("event_id"), b("ts").alias("timestamp"), "symbol",
        b("close").alias("current_price"), b("open").alias("open_price"), b("high").alias("high_price"),
        b("low").alias("low_price"), b("volume").alias("volume"), b("market_cap").alias("market_cap"),
        F.round(F.try_divide(b("close") - b("open"), b("open")) * 100, 2).alias("change_percent"))
