"""The nightly feature job: transactions, products and stores to the daily feature table."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from typing import Any

from pyspark.sql import DataFrame

from shelfwise.operators import aggregate, clean, dims, features
from shelfwise.session import stage
from shelfwise.sources.tables import write_features

Stage = Callable[[DataFrame, str], DataFrame]


def lazily(df: DataFrame, label: str) -> DataFrame:
    """A stage that does not write: the branches compute the frame again."""
    return df


def product_table(products: DataFrame, staging: Stage = stage) -> DataFrame:
    """The cleaned products as the feature job needs them, staged so that their size is known."""
    cleaned = clean.clean_products(products)
    return staging(cleaned.select("product_id", "sku_prod", "usd_price", *aggregate.ATTRIBUTES), "products")


def sold_lines(tables: Mapping[str, DataFrame], staging: Stage = stage) -> DataFrame:
    """The combined lines of the cleaned transactions, staged: the only scan of the transactions."""
    return staging(aggregate.combined_lines(clean.clean_transactions(tables["transactions"])), "lines")


def daily_sales(tables: Mapping[str, DataFrame], staging: Stage = stage) -> DataFrame:
    """Sales per (store, SKU, day), without attributes."""
    products = product_table(tables["products"], staging)
    return aggregate.daily_totals(dims.priced_lines(sold_lines(tables, staging), products))


def flagship_features(tables: Mapping[str, DataFrame], extended: bool = False, staging: Stage = stage) -> DataFrame:
    """The feature table.

    The transactions are read once and added up on the map side, so a best-seller
    is reduced where it is read; daily totals and store variety both start from
    those lines. The daily table is staged because two branches need it: the
    per-series figures and the windows, which share the partitioning on (store,
    SKU) with the join between them. Products and stores are staged too: Spark
    then sees their true size, and joins the wide table with them without
    shuffling it on a skewed id if they are small.
    """
    lines = sold_lines(tables, staging)
    products = product_table(tables["products"], staging)
    stores = staging(
        clean.clean_stores(tables["stores"], lines).select(
            "store_id", *aggregate.PLACES, "num_distinct_products", "num_distinct_skus"
        ),
        "stores",
    )
    daily = staging(aggregate.daily_totals(dims.priced_lines(lines, products)), "daily")
    # One join on the product id brings both its coverage and its attributes.
    sold = features.product_coverage(daily).join(
        products.select("product_id", *aggregate.ATTRIBUTES), "product_id", "left"
    )
    out = features.window_features(daily, extended)
    out = features.coverage_lifespan(out, daily, staging(sold, "sold"))
    return features.project_features(dims.describe(out, None, stores), extended)


def run_features(
    tables: Mapping[str, DataFrame], sinks: Sequence[Mapping[str, Any]], extended: bool = True
) -> DataFrame:
    """Compute the feature table, write it to every sink, and return its health figures."""
    table = stage(flagship_features(tables, extended), "features")
    write_features(table, sinks, keep=False)
    return aggregate.check_features(table, "1970-01-01")
