"""Session set-up and the shared scratch folder used to cut lineage."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Streaming state lives on local disk next to the executor, not on its heap.
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
}


OWN_SCRATCH = "shelfwise.scratch.dir"


def build_session(app: str = "shelfwise", master: str | None = None, **conf: object) -> SparkSession:
    """A session with the settings the library relies on; keyword names use ``__`` for dots."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = SETTINGS | {key.replace("__", "."): str(value) for key, value in conf.items()}
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_dir(spark: SparkSession) -> str:
    """This run's shared folder for staged tables, below ``spark.checkpoint.dir`` as the cluster names it.

    There is no silent fallback: a machine-local path would be lost with its
    machine. Where the cluster names no folder, a caller can name one as
    ``shelfwise.scratch.dir``, which Spark lets a running session set. All tables
    of a run lie in one folder named after the application, which can expire as a
    whole.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get(OWN_SCRATCH, None)
    if not folder:
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return f"{folder.rstrip('/')}/{spark.sparkContext.applicationId}"


def stage(df: DataFrame, label: str = "frame") -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    Used where one expensive frame feeds several branches: the lineage is cut,
    a lost executor costs nothing, later readers prune columns, and Spark knows
    the true size of the table when it picks a join strategy.
    """
    spark = df.sparkSession
    path = f"{scratch_dir(spark)}/{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def stage_by(df: DataFrame, key: str, label: str = "frame") -> DataFrame:
    """As ``stage``, in buckets of ``key``: a join by it leaves these rows where they are and moves the other side only.

    For wide rows that several joins read. ``df`` should be partitioned by ``key``
    already, so that each bucket is one file. The catalog knows the table only
    while it is read back; its files lie with the other staged ones.
    """
    spark = df.sparkSession
    name = f"{label}_{uuid.uuid4().hex}"
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    df.write.bucketBy(buckets, key).option("path", f"{scratch_dir(spark)}/{name}").saveAsTable(name, format="parquet")
    staged = spark.table(name)
    spark.sql(f"DROP TABLE {name}")
    return staged


def one_value(df: DataFrame, value: Column) -> Column:
    """An aggregate of ``df`` as a scalar subquery, usable in any other frame's expressions."""
    return df.agg(value.alias("value")).scalar()


def count_of(df: DataFrame) -> Column:
    return one_value(df, F.count(F.lit(1)))
