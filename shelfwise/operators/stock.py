"""Stock allocation: serving order lines from limited stock."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise.operators.rows import accept_in_order

# Fixed value: stock assumed where no source knows the item.
ASSUMED_STOCK = 100


def allocate_stock(
    stock: DataFrame, orders: DataFrame, order: Sequence[str], local: DataFrame | None = None
) -> DataFrame:
    """Decide line by line whether an order fits the stock of its (store, SKU).

    Available is the greater of ``stock`` and ``local``, where a SKU that
    ``local`` does not know counts as 100 pieces there; without ``local``, stock
    of an unknown SKU counts as 100. Lines without store or SKU are refused.
    """
    keys = ["store_id", "sku"]
    known = stock.select(*keys, F.col("quantity").alias("_stock"))
    lines = orders.join(known, keys, "left")
    if local is None:
        available = F.coalesce("_stock", F.lit(ASSUMED_STOCK))
    else:
        lines = lines.join(local.select(*keys, F.col("quantity").alias("_local")), keys, "left")
        available = F.greatest(F.coalesce("_stock", F.lit(0)), F.coalesce("_local", F.lit(ASSUMED_STOCK)))
    keyed = F.col("store_id").isNotNull() & F.col("sku").isNotNull()
    lines = lines.select(*orders.columns, F.when(keyed, available).cast("bigint").alias("available"))
    return accept_in_order(lines, keys, order, "quantity", "available")


def merge_order_lines(
    lines: DataFrame, stock: DataFrame, order: Sequence[str] = ("line_no",), by: Sequence[str] = ("order_id", "sku")
) -> tuple[DataFrame, DataFrame]:
    """Merge the lines of an order per SKU; returns (merged lines, refused lines).

    Quantities add up and the last price counts. A line that would take the total
    above the SKU's stock is refused; unknown SKUs have no stock. ``stock`` has
    one row per SKU (that of the order's store).
    """
    lines = lines.join(stock.select("sku", F.col("quantity").alias("_stock")), "sku", "left")
    lines = lines.withColumn("available", F.coalesce("_stock", F.lit(0)).cast("bigint")).drop("_stock")
    served = accept_in_order(lines, list(by), list(order), "quantity", "available")
    merged = (
        served.where("accepted")
        .groupBy(*by)
        .agg(
            F.sum("quantity").alias("quantity"),
            F.max_by("price", F.struct(*order)).alias("price"),
            F.count(F.lit(1)).alias("n_lines"),
        )
    )
    return merged, served.where(~F.col("accepted")).drop("left")
