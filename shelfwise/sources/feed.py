"""The nested sales feed: one document per store and date with an array of products."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfwise.functions.calendar import week_key
from shelfwise.functions.text import PRODUCT_LABEL, STORE_LABEL, numbered_label
from shelfwise.operators.rows import dedup
from shelfwise.schemas import FEED

def read_feed(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame:
    """``multi_line`` reads one JSON array per file; large feeds should be JSON lines, which split."""
    return spark.read.schema(FEED).option("multiLine", multi_line).json(path)


def flatten_feed(df: DataFrame, order: str = "date") -> dict[str, DataFrame]:
    """Stores, products, SKUs, forecasts and transactions of the feed.

    The feed is an ordered file; a table has no order, so "first document" here
    means the first by ``order`` within the store.
    """
    lines = df.select("*", F.explode_outer("products").alias("item")).select(
        "store_id",
        "date",
        F.col("item.id").alias("id"),
        F.col("item.id").try_cast("bigint").alias("product_id"),
        "item.weekly_forecast",
        "item.weekly_sale",
    )
    items = lines.where(F.col("id").isNotNull())

    variety = items.groupBy("store_id").agg(
        F.count_distinct("id").alias("num_distinct_skus"),
        F.count_distinct(F.coalesce(F.col("product_id").cast("string"), "id")).alias("num_distinct_products"),
    )
    heads = dedup(df.select("store_id", "store_name", "lat", "lon", "country", order), ["store_id"], [order])
    stores = heads.join(variety, "store_id", "left").select(
        "store_id",
        F.coalesce("store_name", numbered_label(STORE_LABEL, F.col("store_id"))).alias("store_name"),
        F.coalesce("lat", F.lit(0.0)).alias("latitude"),
        F.coalesce("lon", F.lit(0.0)).alias("longitude"),
        F.coalesce("country", F.lit("Global")).alias("country"),
        F.coalesce("num_distinct_skus", F.lit(0)).alias("num_distinct_skus"),
        F.coalesce("num_distinct_products", F.lit(0)).alias("num_distinct_products"),
    )

    sku = F.concat(F.lit("SKU-"), F.col("id"))
    product_name = numbered_label(PRODUCT_LABEL, F.col("id"), "SKU-")
    products = (
        items.where(F.col("product_id").isNotNull())
        .groupBy("product_id")
        .agg(F.min("id").alias("id"))
        .select("product_id", product_name.alias("product_name"))
    )
    skus = items.select(sku.alias("sku"), "product_id").distinct()

    year, week = week_key(F.to_date("date"), "iso")
    forecasts = items.select(
        "store_id",
        sku.alias("sku"),
        product_name.alias("product_name"),
        year.alias("year"),
        week.alias("week"),
        F.round("weekly_forecast").cast("int").alias("predicted_quantity"),
        F.round("weekly_sale").cast("int").alias("actual_quantity"),
    )
    transactions = items.where(F.col("weekly_sale") > 0).select(
        "store_id",
        "product_id",
        sku.alias("sku"),
        F.to_date("date").alias("date"),
        F.greatest(F.lit(1), F.round("weekly_sale").cast("int")).alias("quantity"),
    )
    return {
        "stores": stores,
        "products": products,
        "skus": skus,
        "forecasts": forecasts,
        "transactions": transactions,
    }
