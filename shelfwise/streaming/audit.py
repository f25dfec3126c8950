"""Audit events counted per action class and interval."""

from __future__ import annotations

from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from shelfwise.functions.text import action_class
from shelfwise.streaming import runs
from shelfwise.streaming.stock import NOW

KEYS = ["start", "action_class"]
COUNTS = "start TIMESTAMP, action_class STRING, n BIGINT"


def audit_counts(log: DataFrame, every: str = "1 hour", slide: str | None = None, time: str = "timestamp") -> DataFrame:
    """Events per class in tumbling (or, with ``slide``, sliding) windows; plain timestamps are read as UTC."""
    moment = F.col(time).cast("timestamp")
    window = F.window(moment, every, slide) if slide else F.window(moment, every)
    return (
        log.groupBy(window.alias("window"), action_class(F.col("action")).alias("action_class"))
        .agg(F.count(F.lit(1)).alias("n"))
        .select(F.col("window.start").alias("start"), "action_class", "n")
    )


def audit_stream(
    log: DataFrame,
    path: str,
    checkpoint: str,
    every: str = "1 hour",
    slide: str | None = None,
    fold_every: int = runs.EVERY,
    trigger: dict[str, Any] = NOW,
) -> StreamingQuery:
    """Write each batch's own counts; late events add to their interval. Read the result with ``counts``."""

    def write(batch: DataFrame, batch_id: int) -> None:
        runs.write(audit_counts(batch, every, slide), path, batch_id, COUNTS, runs.adding(KEYS), fold_every)

    return log.writeStream.option("checkpointLocation", checkpoint).foreachBatch(write).trigger(**trigger).start()


def counts(spark: SparkSession, path: str) -> DataFrame:
    """Events per interval and class over all batches."""
    return runs.adding(KEYS)(runs.read(spark, path, COUNTS))
