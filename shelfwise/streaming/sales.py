"""Sales streams: duplicate removal, daily sums and the refresh of touched feature series."""

from __future__ import annotations

from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from shelfwise.operators import features
from shelfwise.operators.rows import dedup
from shelfwise.session import stage
from shelfwise.streaming import runs
from shelfwise.streaming.stock import NOW

SERIES = ["store_id", "sku"]
KEYS = [*SERIES, "date"]
DAYS = "store_id INT, sku STRING, date DATE, qty BIGINT"
FIRST = "store_id INT, sku STRING, date DATE"
#: Rows before a day that its window features can need: lags reach 28 rows back, frames 30 days.
REACH = 30


def dedup_stream(
    tx: DataFrame,
    path: str,
    checkpoint: str,
    key: str = "transaction_id",
    fold_every: int = runs.EVERY,
    buckets: int = runs.BUCKETS,
    trigger: dict[str, Any] = NOW,
) -> StreamingQuery:
    """Append to ``path`` the first arrival of each key, however late a copy or a new key comes.

    Copies inside a batch are reduced by an aggregate. The keys that arrived are
    kept in a narrow index beside ``path``, in ``buckets`` by their hash; a batch
    opens its own buckets only, in a number of runs that grows with the logarithm
    of the batches, and takes out what is stored by an anti-join on the key. A
    batch that runs again replaces its own folders.
    """
    columns, index = tx.columns, f"{path}-keys"
    kind = f"{key} {dict(tx.dtypes)[key]}"

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        rest = [name for name in columns if name != key]
        rows = stage(dedup(batch, [key], rest or [key]).select(*columns), "arrived")
        own = runs.buckets_in(rows, [key], buckets)
        # Runs are put together before this batch writes its own, so the earlier batches are read as they were left.
        stored = runs.read(spark, index, kind, runs.left(batch_id, fold_every), own)
        fresh = rows.join(stored, key, "left_anti")
        fresh.select(*columns).write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")
        arrived = spark.read.schema(kind).parquet(f"{path}/batch_id={batch_id}")
        runs.write(arrived, index, batch_id, kind, runs.together, fold_every, [key], buckets)

    return tx.writeStream.option("checkpointLocation", checkpoint).foreachBatch(write).trigger(**trigger).start()


def daily_sums(tx: DataFrame, time: str = "transaction_date") -> DataFrame:
    """Quantity per (store, SKU, day)."""
    sold = tx.where(F.col("quantity") > 0)
    keys = [F.col("store_id").cast("int").alias("store_id"), "sku", F.to_date(time).alias("date")]
    return sold.groupBy(*keys).agg(F.sum("quantity").cast("bigint").alias("qty"))


def daily_stream(
    tx: DataFrame,
    path: str,
    checkpoint: str,
    time: str = "transaction_date",
    refreshed: str | None = None,
    fold_every: int = runs.EVERY,
    buckets: int = runs.BUCKETS,
    trigger: dict[str, Any] = NOW,
) -> StreamingQuery:
    """Write each batch's own daily sums below ``path``; late rows add to their day. Read the result with ``days``.

    With ``refreshed``, each batch also writes there the feature rows that its
    days change, and nothing else; read them with ``newest_features``. A batch
    opens the buckets of its own series only.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        runs.write(daily_sums(batch, time), path, batch_id, DAYS, runs.adding(KEYS), fold_every, SERIES, buckets)
        if refreshed:
            touched = runs.read(spark, path, DAYS, [(1, batch_id)])
            own = runs.buckets_in(touched, SERIES, buckets)
            daily = days(spark, path, runs.cover(batch_id, fold_every) + [(1, batch_id)], own)
            rows = refresh_features(touched, daily).withColumn("written", F.lit(batch_id).cast("bigint"))
            schema = ", ".join(f"`{name}` {kind}" for name, kind in rows.dtypes)
            runs.write(rows, f"{refreshed}/rows", batch_id, schema, runs.newest(KEYS, "written"), fold_every)
            first = touched.groupBy(*SERIES).agg(F.min("date").alias("date"))
            runs.write(first, f"{refreshed}/first", batch_id, FIRST, first_days, fold_every)

    return tx.writeStream.option("checkpointLocation", checkpoint).foreachBatch(write).trigger(**trigger).start()


def first_days(rows: DataFrame) -> DataFrame:
    return rows.groupBy(*SERIES).agg(F.min("date").alias("date"))


def days(spark: SparkSession, path: str, which: list[tuple[int, int]] | None = None, buckets: list[int] | None = None) -> DataFrame:
    """The daily table as of the last batch, or of the runs ``which`` and the series in ``buckets``."""
    summed = runs.adding(KEYS)(runs.read(spark, path, DAYS, which, buckets))
    return summed.withColumn("qty", F.col("qty").cast("double"))


def refresh_features(touched: DataFrame, daily: DataFrame, extended: bool = True) -> DataFrame:
    """New window features of the series that got new or late days, from the first such day on.

    Lags count selling rows and the target mean runs over all earlier rows, so
    every later day of a touched series may change; other series and earlier days
    cannot. The windows see the rows to renew and the ``REACH`` ones before them;
    what lies further back enters the target mean as one count and one sum.
    """
    since = touched.groupBy(*SERIES).agg(F.min("date").alias("_since"))
    series = daily.select(*KEYS, "qty").join(since, SERIES)
    old = series.where(F.col("date") < F.col("_since"))
    back = F.row_number().over(W.partitionBy(*SERIES).orderBy(F.desc("date")))
    tail = old.withColumn("_back", back).where(F.col("_back") <= REACH).drop("_back")
    before = old.groupBy(*SERIES).agg(F.count(F.lit(1)).alias("_days"), F.sum("qty").alias("_sold"))
    out = features.window_features(series.where(F.col("date") >= F.col("_since")).unionByName(tail), extended)
    renewed = F.col("date") >= F.col("_since")
    if extended:
        earlier = features.by_day().rowsBetween(W.unboundedPreceding, -1)
        own = {"_n": F.count(F.when(renewed, 1)).over(earlier), "_q": F.sum(F.when(renewed, F.col("qty"))).over(earlier)}
        out = out.withColumns(own).join(before, SERIES, "left")
        n, sold = (F.coalesce(a, F.lit(0)) + F.coalesce(b, F.lit(0)) for a, b in (("_n", "_days"), ("_q", "_sold")))
        mean = F.round(sold / F.when(n > 0, n), 4)
        out = out.withColumn("target_encoding_store_sku", F.coalesce(mean, F.lit(0.0))).drop("_n", "_q", "_days", "_sold")
    return out.where(renewed).drop("_since")


def newest_features(spark: SparkSession, refreshed: str, extended: bool = True) -> DataFrame:
    """The feature rows as of the last batch, with the coverage and lifespans that the series have by now.

    A new store or an earlier first day changes these in every row of a SKU;
    they are joined from one row per series instead of being rewritten.
    """
    empty = spark.createDataFrame([], "store_id INT, sku STRING, date DATE, qty DOUBLE")
    kinds = features.window_features(empty, extended).dtypes
    schema = ", ".join(f"`{name}` {kind}" for name, kind in [*kinds, ("written", "bigint")])
    rows = runs.newest(KEYS, "written")(runs.read(spark, f"{refreshed}/rows", schema)).drop("written")
    return features.lifespan(rows, features.series_table(runs.read(spark, f"{refreshed}/first", FIRST)))
