"""Row-level helpers shared by the other operators: de-duplication, ranks and greedy acceptance."""

from __future__ import annotations

import functools
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, WindowSpec
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfwise.session import stage


def dedup(df: DataFrame, key: Sequence[str], order: Sequence[str | Column], keep: str = "first") -> DataFrame:
    """One row per key: the first or last by ``order``.

    The order must be total within a key. The pick is an aggregate, so a key
    with very many copies is reduced before the shuffle instead of being sorted
    in one task.
    """
    if keep not in ("first", "last"):
        raise ValueError("keep must be 'first' or 'last'")
    pick = F.min_by if keep == "first" else F.max_by
    rest = [name for name in df.columns if name not in key]
    if not rest:
        return df.distinct()
    best = pick(F.struct(*rest), F.struct(*order)).alias("_best")
    return df.groupBy(*key).agg(best).select(*key, "_best.*").select(*df.columns)


def ranked(df: DataFrame, order: Sequence[str], position: str, within: Sequence[str] = ()) -> DataFrame:
    """Number the rows 0, 1, 2, ... in ``order``, separately for each value of ``within``.

    A global sort is range-partitioned by Spark, so no task sees all rows, not
    even when one value of ``within`` holds most of them. The sorted rows are
    staged once with their place inside their task; the rows per task (as many
    numbers as there were tasks) then give each task its starting offset.
    """
    place = F.monotonically_increasing_id()
    staged = stage(df.orderBy(*within, *order).withColumn("_place", place), "ranked")
    # The upper bits of the id are the task number, the lower 33 the row number in the task.
    staged = staged.withColumn("_task", F.shiftright("_place", 33))
    sizes = staged.groupBy(*within, "_task").agg(
        F.count(F.lit(1)).alias("_rows"), F.min("_place").alias("_first")
    )
    before = W.partitionBy(*within).orderBy("_task").rowsBetween(W.unboundedPreceding, -1)
    if not within:
        before = W.partitionBy(F.lit(0)).orderBy("_task").rowsBetween(W.unboundedPreceding, -1)
    starts = sizes.select(
        *within, "_task", "_first", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_start")
    )
    # The join key holds the task, so even one huge group is spread over its tasks.
    return (
        staged.join(starts, [*within, "_task"])
        .withColumn(position, F.col("_start") + F.col("_place") - F.col("_first"))
        .select(*df.columns, position)
    )


def accept_in_order(
    lines: DataFrame, keys: Sequence[str], order: Sequence[str], quantity: str, available: str
) -> DataFrame:
    """Serve lines in order while supply lasts; a line that asks for too much is refused, later ones may still fit.

    Adds ``accepted`` and ``left`` (the supply after the line; null for refused
    lines). ``available`` is the supply of the key, repeated on each line; it
    must be the same on all lines of a key, and ``order`` must be total. Lines
    with a null in their key are refused.

    Lines are range-partitioned by key and order, and one pass over each sorted
    chunk serves its lines. That settles all keys that lie in one chunk. A key
    that goes on in the next chunk, of which there is one per chunk at most, is
    served by ``_in_rounds`` instead, so a hot key is no single task.
    """
    columns = lines.columns
    whole = functools.reduce(lambda a, b: a & b, (F.col(name).isNotNull() for name in keys))
    supply = {"_asked": F.col(quantity).cast("bigint"), "_supply": F.when(whole, F.col(available)).cast("bigint"), "_chunk": F.spark_partition_id()}
    # Staged first: range partitioning reads its input twice, once for a sample.
    spread = stage(lines, "lines").repartitionByRange(*keys, *order).sortWithinPartitions(*keys, *order).withColumns(supply)
    schema = T.StructType([*spread.schema.fields, T.StructField("accepted", T.BooleanType()), T.StructField("left", T.LongType())])
    served = stage(spread.mapInArrow(_pass(list(keys)), schema), "served")
    key = F.struct(*keys)
    edges = served.groupBy("_chunk").agg(F.array(F.min(key), F.max(key)).alias("ends"))
    ends = edges.select("_chunk", F.explode("ends").alias("end")).distinct()
    on_edge = ends.groupBy("end").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    # Lines with a null in their key are refused wherever they are.
    torn = stage(on_edge.select("end.*").dropna(), "torn")
    out = served.select(*columns, "accepted", "left")
    if torn.isEmpty():
        return out
    # A torn key's first chunk is settled too; the others begin with what it leaves.
    mine = stage(served.join(torn, list(keys), "left_semi").select(*served.columns), "torn-lines")
    first = mine.groupBy(*keys).agg(F.min("_chunk").alias("_first"))
    mine = mine.join(first, list(keys))
    rest = F.coalesce(F.min("left"), F.max("_supply")).alias("_rest")
    carried = mine.where("_chunk = _first").groupBy(*keys).agg(rest)
    later = mine.where("_chunk > _first").drop("accepted", "left", "_supply", "_first").join(carried.withColumnRenamed("_rest", "_supply"), list(keys))
    settled = mine.where("_chunk = _first").select(*out.columns).unionByName(_in_rounds(later, keys, order, columns))
    return out.join(torn, list(keys), "left_anti").select(*out.columns).unionByName(settled)


def _pass(keys: list[str]):
    """For ``mapInArrow`` over sorted lines: each key's lines are served from its supply, in order."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, left = None, 0
        for batch in batches:
            key = list(zip(*(batch.column(name).to_pylist() for name in keys)))
            accepted, after = [], []
            for own, asked, supply in zip(key, batch.column("_asked").to_pylist(), batch.column("_supply").to_pylist()):
                if own != last:
                    last, left = own, supply or 0
                fits = asked is not None and supply is not None and 0 < asked <= left
                if fits:
                    left -= asked
                accepted.append(fits)
                after.append(left if fits else None)
            made = [pa.array(accepted, pa.bool_()), pa.array(after, pa.int64())]
            yield pa.RecordBatch.from_arrays([*batch.columns, *made], [*batch.schema.names, "accepted", "left"])

    return run


def _in_rounds(lines: DataFrame, keys: Sequence[str], order: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """The rule of ``accept_in_order`` for lines with ``_asked``, ``_supply`` and ``_chunk``, by running sums.

    All lines before the first one that does not fit are served, and as supply
    only shrinks, every later line that asks for more than is left is refused at
    once. What remains asks for less than the refused line did, so there are at
    most as many rounds as different quantities. Sums run inside chunks and are
    carried on from chunk to chunk. A round stages its lines once, with what
    became of them.
    """
    place, asked = F.struct(*order), F.col("_asked")
    possible = F.coalesce((asked > 0) & (asked <= F.col("_supply")), F.lit(False))
    inside = chunk_window(keys, order).rowsBetween(W.unboundedPreceding, W.currentRow)
    state = stage(lines.withColumns({"_waits": possible, "_left": F.col("_supply"), "accepted": F.lit(False), "left": F.lit(None).cast("bigint")}), "round")
    decided = []
    while True:
        decided.append(state.where("NOT _waits").select(*columns, "accepted", "left"))
        waiting = state.where("_waits")
        if waiting.isEmpty():
            break
        sizes = waiting.groupBy(*keys, "_chunk").agg(F.sum("_asked").alias("_total"))
        before = sizes.select(
            *keys, "_chunk", F.coalesce(F.sum("_total").over(earlier_chunks(keys)), F.lit(0)).alias("_before")
        )
        summed = waiting.withColumn("_inside", F.sum("_asked").over(inside)).join(before, [*keys, "_chunk"])
        summed = summed.withColumn("_sum", F.col("_before") + F.col("_inside")).drop("_before", "_inside")
        stops = summed.where(F.col("_sum") > F.col("_left")).groupBy(*keys)
        stops = stops.agg(F.min(place).alias("_stop"), F.min("_sum").alias("_over"), F.min_by("_asked", place).alias("_at"))
        marked = summed.join(stops, list(keys), "left")
        served = F.col("_stop").isNull() | (place < F.col("_stop"))
        # The running sum just before the stopping line is what was served.
        rest = F.col("_left") - F.col("_over") + F.col("_at")
        turn = {
            "accepted": served,
            "left": F.when(served, F.col("_left") - F.col("_sum")),
            "_waits": ~served & (asked <= rest),
            "_left": F.when(served, F.col("_left")).otherwise(rest),
        }
        state = stage(marked.withColumns(turn).drop("_sum", "_stop", "_over", "_at"), "round")
    out = decided[0]
    for part in decided[1:]:
        out = out.unionByName(part)
    return out


def chunked(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Cut the rows of each key, in order, into chunks numbered by ``_chunk``, and stage them.

    The cut follows Spark's range partitioning on key and order: chunk sizes are
    even, and a hot key spans many chunks instead of filling one task. Running
    values are then computed inside chunks and carried from chunk to chunk; a key
    has at most as many chunks as there were tasks.
    """
    spread = df.repartitionByRange(*keys, *order)
    return stage(spread.withColumn("_chunk", F.spark_partition_id()), "chunked")


def chunk_window(keys: Sequence[str], order: Sequence[str]) -> WindowSpec:
    return W.partitionBy(*keys, "_chunk").orderBy(*order)


def earlier_chunks(keys: Sequence[str]) -> WindowSpec:
    return W.partitionBy(*keys).orderBy("_chunk").rowsBetween(W.unboundedPreceding, -1)


def running_low(df: DataFrame, keys: Sequence[str], order: Sequence[str], amount: str) -> DataFrame:
    """Per key the ``total`` of an amount and the ``low`` its running sum reaches (at most 0)."""
    inside = chunk_window(keys, order).rowsBetween(W.unboundedPreceding, W.currentRow)
    chunks = (
        chunked(df, keys, order)
        .withColumn("_running", F.sum(amount).over(inside))
        .groupBy(*keys, "_chunk")
        .agg(F.sum(amount).alias("_total"), F.min("_running").alias("_low"))
        .withColumn("_before", F.coalesce(F.sum("_total").over(earlier_chunks(keys)), F.lit(0)))
    )
    return chunks.groupBy(*keys).agg(
        F.sum("_total").alias("total"),
        F.least(F.lit(0), F.min(F.col("_before") + F.col("_low"))).alias("low"),
    )
