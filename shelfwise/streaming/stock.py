"""Stock as a stream of signed changes."""

from __future__ import annotations

from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from shelfwise.operators.maintain import sale_deltas
from shelfwise.streaming import runs

NOW: dict[str, Any] = {"availableNow": True}
KEYS = ["store_id", "sku"]
NET = "store_id INT, sku STRING, net BIGINT"


def movements(sales: DataFrame, imports: DataFrame) -> DataFrame:
    """Sales and imports as one stream of changes: store_id, sku, quantity."""
    sold = sale_deltas(sales).select("store_id", "sku", F.col("quantity").cast("bigint").alias("quantity"))
    came = imports.where(F.col("quantity_imported") > 0).select(
        "store_id", "sku", F.col("quantity_imported").cast("bigint").alias("quantity")
    )
    return sold.unionByName(came)


def stock_stream(
    changes: DataFrame, path: str, checkpoint: str, fold_every: int = runs.EVERY, trigger: dict[str, Any] = NOW
) -> StreamingQuery:
    """Write, per batch, the net change of each (store, SKU) that moved; batches
    are put together as ``runs`` says.

    A hot key is added up on the map side of every batch.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        net = batch.groupBy(*KEYS).agg(F.sum("quantity").cast("bigint").alias("net"))
        net = net.withColumn("store_id", F.col("store_id").cast("int"))
        runs.write(net, path, batch_id, NET, runs.adding(KEYS), fold_every)

    return (
        changes.writeStream.option("checkpointLocation", checkpoint).foreachBatch(write).trigger(**trigger).start()
    )


def on_hand(spark: SparkSession, path: str, opening: DataFrame) -> DataFrame:
    """Opening stock plus the net change of each key, with a flag on stock below zero."""
    moved = runs.adding(KEYS)(runs.read(spark, path, NET))
    quantity = F.coalesce("quantity", F.lit(0)) + F.coalesce("net", F.lit(0))
    return (
        opening.select("store_id", "sku", "quantity")
        .join(moved, KEYS, "full")
        .select("store_id", "sku", quantity.alias("quantity"))
        .withColumn("warn", F.col("quantity") < 0)
    )
