"""Helpers the text operators share: internal column names, staged tables, Arrow batches as byte arrays, bounded samples."""

from __future__ import annotations

import ctypes
import functools
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfwise.session import stage, stage_by

__all__ = ["fresh", "keyed", "stage", "stage_by", "give_back", "tidy", "byte_view", "cuts", "bounded_sample", "crc_mod", "table"]

PIECE_BYTES = 1 << 20
#: Rows that Spark hands to Python at a time, at most; texts can be long.
BATCH_ROWS = 2000
BATCH_SETTING = "spark.sql.execution.arrow.maxRecordsPerBatch"


def fresh(df: DataFrame, *bases: str) -> list[str]:
    """Column names that ``df`` does not have, so that extra columns of the input can never clash."""
    taken = {c.lower() for c in df.columns}
    out = []
    for base in bases:
        name = f"_{base}"
        while name in taken:
            name = f"_{name}"
        taken.add(name)
        out.append(name)
    return out


def give_back() -> None:
    """Hand freed memory back to the system; the allocators keep it otherwise, and it counts for this process."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def tidy(run: Callable) -> Callable:
    """A function for ``mapInArrow`` that gives freed memory back when its task ends, so that idle workers hold little."""

    @functools.wraps(run)
    def tidied(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            give_back()

    return tidied


def small_batches(df: DataFrame) -> DataFrame:
    """``df``, in a session that hands no more than ``BATCH_ROWS`` rows at a time to Python."""
    conf = df.sparkSession.conf
    if not 0 < int(conf.get(BATCH_SETTING, "10000")) <= BATCH_ROWS:
        conf.set(BATCH_SETTING, str(BATCH_ROWS))
    return df


def keyed(df: DataFrame, **columns: str) -> DataFrame:
    """Only the named input columns, under internal names: ``keyed(df, id="doc_id", text="text")``."""
    small_batches(df)
    return df.select(*(F.col(f"`{source}`").alias(name) for name, source in columns.items()))


def table(spark, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def crc_mod(column: Column, modulus: int) -> Column:
    """The fold of a row: crc32 of the id's decimal text, modulo ``modulus``."""
    return F.crc32(column.cast("string").cast("binary")) % modulus


def byte_view(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """A string column as one byte array and the offsets of its rows; null is the empty text."""
    column = column.cast(pa.large_binary())
    if column.null_count:
        column = column.fill_null(b"")
    _, offsets, data = column.buffers()
    bounds = np.frombuffer(offsets, np.int64, len(column) + 1, column.offset * 8) if offsets else np.zeros(len(column) + 1, np.int64)
    raw = np.frombuffer(data, np.uint8) if data else np.zeros(0, np.uint8)
    return raw[bounds[0] : bounds[-1]], bounds - bounds[0]


def cuts(offsets: np.ndarray, limit: int = PIECE_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of at most ``limit`` bytes each; a longer row stands alone."""
    low, rows = 0, len(offsets) - 1
    while low < rows:
        high = int(np.searchsorted(offsets, offsets[low] + limit, "right")) - 1
        high = max(high, low + 1)
        yield low, high
        low = high


def bounded_sample(df: DataFrame, rows: dict, by: str, seed: int = 1, cut: Column | None = None) -> DataFrame:
    """At most ``rows[value]`` rows of ``df`` (id, ``by``, text) for every value of ``by``, chosen by the hash of the id.

    Of repeated rows, with one id and value, the one whose text hashes lowest is
    taken, before anything is collected; of each text only ``cut`` is read, if given.

    Only ids are ordered; the other columns follow by a join with those few ids.
    Their number is bounded by the parameter ``rows``, so they may be broadcast.
    As hashes are even, those below a share of their range, twice as many as are
    wanted and some more, hold the first ones; all values take the same two passes.
    """
    spark, kinds = df.sparkSession, df.select("id", by).schema
    ids = df.where(F.col(by).isNotNull() & F.col("id").isNotNull()).select("id", by, F.xxhash64(F.lit(seed), "id").alias("order")).distinct()
    found = {r[by]: r["count"] for r in ids.groupBy(by).count().collect() if r[by] in rows}
    top = [(value, min(2**63 - 1, int((2 * rows[value] + 100) / n * 2**64) - 2**63)) for value, n in found.items()]
    top = spark.createDataFrame(top, T.StructType([kinds[by], T.StructField("top", T.LongType())]))
    first: dict = {value: [] for value in found}
    for r in ids.join(F.broadcast(top), by).where("order <= top").select("order", "id", by).collect():
        first[r[by]].append((r["order"], r["id"]))
    chosen = [(i, value) for value, some in first.items() for _, i in sorted(some)[: rows[value]]]
    chosen = F.broadcast(spark.createDataFrame(chosen, kinds))
    # By the id alone first: that filters before any join inside ``df``.
    picked = df.join(chosen.select("id"), "id", "left_semi").join(chosen, ["id", by], "left_semi")
    picked = picked.select("id", by, (F.col("text") if cut is None else cut).alias("text"))
    one = F.min(F.struct(F.xxhash64("text").alias("order"), "text")).alias("one")
    return picked.groupBy("id", by).agg(one).select("id", by, "one.text")


def whole_groups(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Batches sorted by ``keys``, regrouped so that no group is cut; each table holds one or many whole groups."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not len(batch):
            continue
        if held:
            edge = group_starts(pa.Table.from_batches([held[-1].slice(len(held[-1]) - 1), batch]), keys)
            cut = next((e - 1 for e in edge[::-1].tolist() if e > 0), None)
        else:
            cut = group_starts(pa.Table.from_batches([batch]), keys)[-1]
        if cut is not None:
            if cut or held:
                yield pa.Table.from_batches([*held, batch.slice(0, cut)])
            held = []
            batch = batch.slice(cut)
        held.append(batch)
    if held:
        yield pa.Table.from_batches(held)


def group_starts(rows: pa.Table, keys: list[str]) -> np.ndarray:
    """Where the groups of consecutive rows with equal ``keys`` begin."""
    new = np.zeros(rows.num_rows, bool)
    new[:1] = True
    for key in keys:
        values = rows.column(key).to_numpy()
        new[1:] |= values[1:] != values[:-1]
    return np.flatnonzero(new)
