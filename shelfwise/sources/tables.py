"""Table scans, existence probes, dated snapshots and the feature sinks."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from typing import Any

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfwise.schemas import lower_names
from shelfwise.session import one_value


def read_table(
    spark: SparkSession,
    src: str,
    name: str,
    fmt: str = "parquet",
    opts: Mapping[str, Any] | None = None,
    schema: T.StructType | None = None,
) -> DataFrame:
    """Scan one table with lower-cased column names.

    ``src`` is a folder for file formats and the connection URL for ``jdbc``.
    A JDBC scan is split over tasks by ``partitionColumn``, ``lowerBound``,
    ``upperBound`` and ``numPartitions``; without them it would be one task, so
    they are required. Credentials come in through ``opts`` only.
    """
    opts = dict(opts or {})
    reader = spark.read
    if schema is not None:
        reader = reader.schema(schema)
    if fmt == "jdbc":
        split = {"partitionColumn", "lowerBound", "upperBound", "numPartitions"}
        if not split <= opts.keys():
            raise ValueError(f"a jdbc scan needs {', '.join(sorted(split))}")
        return lower_names(reader.format("jdbc").options(url=src, dbtable=name, **opts).load())
    path = f"{src.rstrip('/')}/{name}"
    suffix = f".{fmt}"
    if opts.pop("single_file", False):
        path += suffix
    return lower_names(reader.format(fmt).options(**opts).load(path))


def read_or_empty(spark: SparkSession, name: str, schema: T.StructType) -> DataFrame:
    """The catalog table, or no rows of ``schema`` when there is no such table."""
    return spark.read.table(name) if spark.catalog.tableExists(name) else spark.createDataFrame([], schema)


def snapshot_tables(tables: Mapping[str, DataFrame], base: str, day: dt.date) -> dict[str, str]:
    """Land each table under ``base/<day>/<table>``; a second run of the day replaces the first."""
    paths = {name: f"{base.rstrip('/')}/{day:%Y-%m-%d}/{name}" for name in tables}
    # The tables are independent jobs; a small pool lets the cluster overlap them.
    with ThreadPoolExecutor(max_workers=max(1, len(paths))) as pool:
        jobs = [pool.submit(tables[name].write.mode("overwrite").parquet, path) for name, path in paths.items()]
        for job in jobs:
            job.result()
    return paths


def latest_snapshot(daily: DataFrame) -> DataFrame:
    """Rows of the newest date. The date is a scalar subquery, so a date-partitioned scan is pruned by it."""
    return daily.where(F.col("date") == one_value(daily, F.max("date")))


def require_snapshot(daily: DataFrame) -> DataFrame:
    """The latest snapshot, or an error when the feature table holds no date."""
    newest = daily.agg(F.max("date").alias("date")).first()["date"]
    if newest is None:
        raise ValueError("the feature table is empty or has no valid dates")
    return daily.where(F.col("date") == F.lit(newest))


def active_pairs(daily: DataFrame) -> DataFrame:
    return latest_snapshot(daily).select("store_id", "sku").distinct()


def write_features(df: DataFrame, sinks: Sequence[Mapping[str, Any]], keep: bool = True) -> None:
    """Write the same feature frame to one or several stores.

    A file sink ``{"path": ...}`` is partitioned by date and replaces only the
    dates it is given, so running a night twice leaves no duplicates. A JDBC
    sink ``{"url": ..., "table": ..., "opts": {...}}`` appends through four
    connections in batches of 10,000 rows. With several sinks the frame is kept
    on executor disks between the writes instead of being computed again.
    """
    reuse = keep and len(sinks) > 1
    if reuse:
        df = df.persist(StorageLevel.DISK_ONLY)
    try:
        for sink in sinks:
            if "path" in sink:
                # A rebalance puts each date into one task, merges small ones and splits a heavy date.
                (
                    df.hint("rebalance", F.col("date"))
                    .write.mode("overwrite")
                    .option("partitionOverwriteMode", "dynamic")
                    .partitionBy("date")
                    .parquet(sink["path"])
                )
            else:
                opts = {"batchsize": "10000", "numPartitions": "4"} | dict(sink.get("opts", {}))
                (
                    df.coalesce(4)
                    .write.format("jdbc")
                    .mode("append")
                    .options(url=sink["url"], dbtable=sink["table"], **opts)
                    .save()
                )
    finally:
        if reuse:
            df.unpersist()


def replace_partitions_at(df: DataFrame, path: str, part_cols: Sequence[str]) -> None:
    """Overwrite exactly the partitions present in ``df`` below ``path``."""
    (
        df.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*part_cols)
        .parquet(path)
    )
