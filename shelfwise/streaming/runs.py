"""Tables that grow by micro-batches, kept as runs.

Every batch writes a run of its own, and nothing is held in state or dropped for
being late. Whenever ``every`` runs of one size lie side by side, they are put
together into one run ``every`` times as large, so a reader of n batches opens
about ``every * log(n)`` folders and a row is rewritten ``log(n)`` times in all,
however long the stream runs. Runs that went into a larger one may be deleted.

A batch first puts together what earlier batches left and then writes its own
run, so a run is complete once a later one begins. Writing twice gives the same
folders: a batch that runs again repeats its steps.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

EVERY = 8
BUCKETS = 64
BUCKET = "bucket"
Combine = Callable[[DataFrame], DataFrame]


def folder(path: str, size: int, first: int) -> str:
    return f"{path}/size={size}/first={first}"


def cover(batches: int, every: int = EVERY) -> list[tuple[int, int]]:
    """(size, first batch) of the runs that hold the batches before number ``batches``, largest first."""
    size, start, out = 1, 0, []
    while size * every <= batches:
        size *= every
    while start < batches:
        if start + size <= batches:
            out.append((size, start))
            start += size
        else:
            size //= every
    return out


def left(batches: int, every: int = EVERY) -> list[tuple[int, int]]:
    """The runs that hold the batches before number ``batches`` while that batch hasn't begun to write yet.

    The last batch's run may have completed others that are not put together yet.
    """
    return cover(batches - 1, every) + [(1, batches - 1)] if batches else []


def written(spark: SparkSession, path: str) -> list[tuple[int, int]]:
    """The runs to read now, for a reader beside the stream: a run that is put together counts once a later run begins."""
    root = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = root.getFileSystem(spark._jsc.hadoopConfiguration())

    def numbers(at, name: str) -> list[int]:
        names = [s.getPath().getName() for s in files.listStatus(at) if s.isDirectory()] if files.exists(at) else []
        return sorted(int(n.removeprefix(f"{name}=")) for n in names if n.startswith(f"{name}="))

    sizes = numbers(root, "size")
    found = {size: set(numbers(spark._jvm.org.apache.hadoop.fs.Path(f"{path}/size={size}"), "first")) for size in sizes}
    last = max((max(f) for f in found.values() if f), default=-1)
    out, start = [], 0
    while start <= last:
        size = next((s for s in reversed(sizes) if start in found[s] and (s == 1 or start + s <= last)), None)
        if size is None:
            raise ValueError(f"{path} has no run that begins with batch {start}")
        out.append((size, start))
        start += size
    return out


def read(spark: SparkSession, path: str, schema: str, which: Sequence[tuple[int, int]] | None = None, buckets: Sequence[int] | None = None) -> DataFrame:
    """The rows of the runs ``which`` (by default of all batches), only those of ``buckets`` if given; other folders are not listed."""
    which = written(spark, path) if which is None else which
    if not which:
        return spark.createDataFrame([], schema)
    kinds = f"{schema}, size BIGINT, first BIGINT" + (f", {BUCKET} INT" if buckets is not None else "")
    rows = spark.read.schema(kinds).option("basePath", path).parquet(*(folder(path, *run) for run in which))
    if buckets is not None:
        rows = rows.where(F.col(BUCKET).isin(*buckets))
    return rows.drop("size", "first", BUCKET)


def write(rows: DataFrame, path: str, batch_id: int, schema: str, combine: Combine, every: int = EVERY, keys: Sequence[str] = (), buckets: int = BUCKETS) -> None:
    """Write the run of batch ``batch_id`` after putting together the runs that earlier batches completed.

    ``combine`` makes the rows of one run out of those of several. With ``keys``,
    runs are laid out in folders by a hash of them, so that ``read`` opens some
    buckets only.
    """
    spark, size = rows.sparkSession, every
    while batch_id and batch_id % size == 0:
        parts = [(size // every, batch_id - size + k * (size // every)) for k in range(every)]
        _put(combine(read(spark, path, schema, parts)), folder(path, size, batch_id - size), keys, buckets)
        size *= every
    _put(rows, folder(path, 1, batch_id), keys, buckets)


def _put(rows: DataFrame, to: str, keys: Sequence[str], buckets: int) -> None:
    if keys:
        laid = rows.withColumn(BUCKET, bucket_of(keys, buckets))
        laid.repartition(BUCKET).write.mode("overwrite").partitionBy(BUCKET).parquet(to)
    else:
        rows.write.mode("overwrite").parquet(to)


def bucket_of(keys: Sequence[str], buckets: int = BUCKETS):
    return F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")


def buckets_in(rows: DataFrame, keys: Sequence[str], buckets: int = BUCKETS) -> list[int]:
    """The buckets that ``rows`` fall into; their number is the parameter's at most."""
    return sorted(r[0] for r in rows.select(bucket_of(keys, buckets)).distinct().collect())


def adding(keys: Sequence[str]) -> Combine:
    """Combine by adding up all columns besides ``keys``."""

    def combine(rows: DataFrame) -> DataFrame:
        sums = [F.sum(name).cast(kind).alias(name) for name, kind in rows.dtypes if name not in keys]
        return rows.groupBy(*keys).agg(*sums)

    return combine


def newest(keys: Sequence[str], by: str) -> Combine:
    """Combine by keeping, of the rows with one key, the one with the greatest ``by``."""

    def combine(rows: DataFrame) -> DataFrame:
        rest = [name for name in rows.columns if name not in keys]
        last = rows.groupBy(*keys).agg(F.max_by(F.struct(*rest), by).alias("_last"))
        return last.select(*keys, "_last.*").select(*rows.columns)

    return combine


def together(rows: DataFrame) -> DataFrame:
    """Combine rows that have nothing to add up."""
    return rows
