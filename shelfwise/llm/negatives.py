"""Hard-negative mining with segment summaries.

Vectors become integers (floor of 256 times each component), a score is their
inner product. A vector is cut into segments, and each segment's mean and
standard deviation are stored beside it, for coarse and for fine segments. For a
segment of w components the product of two vectors is w times the product of the
means, plus or minus at most w times the product of the deviations. Summed up,
that bounds a score from below and above.

An anchor meets the rows in blocks. The coarse bounds of all rows come first;
those that can't be among the best, or lie outside the window that is asked for,
go; the rest is bounded again by the fine segments; what is left is scored
exactly. Bounds are used with a margin for rounding, so no row is lost by them.

Rows and anchors are dealt out in blocks of bounded size, a task meets one block
of each, and windows merge the blocks' best. First the positives are found, among
the rows of an anchor's label, then the negatives, among all others.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfwise.llm.common import group_starts, small_batches, stage, tidy, whole_groups

#: Components of a segment, from coarse to fine.
SEGMENTS = (16, 4)
#: Rows of a block: at most, and the fewest of which a block is made to keep more tasks busy.
BLOCK, LEAST, SPREAD = 8192, 512, 16
ANCHORS = 1024
#: Pairs of one step within a task.
STEP = 1 << 21
#: Sums of products below this bound are exact in double precision.
EXACT = float(1 << 53)
SCALE = 256


def _sizes(width: int, segment: int) -> np.ndarray:
    return np.diff(np.append(np.arange(0, width, segment), width)).astype(float)


def summaries(vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Means and standard deviations of all segments of the rows, coarse ones first."""
    means, spreads = [], []
    for segment in SEGMENTS:
        starts, sizes = np.arange(0, vectors.shape[1], segment), _sizes(vectors.shape[1], segment)
        mean = np.add.reduceat(vectors, starts, axis=1) / sizes
        rest = vectors - np.repeat(mean, sizes.astype(int), axis=1)
        means.append(mean)
        spreads.append(np.sqrt(np.add.reduceat(rest * rest, starts, axis=1) / sizes))
    return np.concatenate(means, axis=1), np.concatenate(spreads, axis=1)


def _matrix(column: pa.ChunkedArray) -> np.ndarray:
    flat = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return flat.flatten().to_numpy().reshape(len(flat), -1)


def _summarise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For ``mapInArrow`` over (id, label, vector): whole numbers and their summaries."""
    for batch in batches:
        if not len(batch):
            continue
        vectors = np.floor(SCALE * _matrix(batch.column(2)))
        if (np.einsum("ij,ij->i", vectors, vectors) >= EXACT).any():
            raise ValueError("a vector is too long for whole scores: its squares sum up to 2^53 or more")
        lists = (vectors, *summaries(vectors))
        made = [pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1, dtype=np.int32) * x.shape[1]), pa.array(x.reshape(-1))) for x in lists]
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *made], ["id", "label", "vector", "means", "spreads"])


class Side:
    """Some rows' whole vectors and summaries."""

    def __init__(self, rows: pa.Table):
        self.ids, self.labels = rows.column("id").to_numpy(), rows.column("label").to_numpy()
        self.vectors, self.means, self.spreads = (_matrix(rows.column(c)) for c in ("vector", "means", "spreads"))
        self.length = np.sqrt(np.einsum("ij,ij->i", self.vectors, self.vectors))

    def some(self, which: slice) -> Side:
        part = object.__new__(Side)
        part.__dict__.update({k: v[which] for k, v in self.__dict__.items()})
        return part

    def level(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        """Means and deviations of level ``n``, times the root of the segment's size: their products sum up to the bounds."""
        width = self.vectors.shape[1]
        counts = [-(-width // segment) for segment in SEGMENTS]
        own = slice(sum(counts[:n]), sum(counts[: n + 1]))
        root = np.sqrt(_sizes(width, SEGMENTS[n]))
        return self.means[:, own] * root, self.spreads[:, own] * root


def bounds(asks: Side, rows: Side, n: int, pairs: tuple[np.ndarray, np.ndarray] | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Lower and upper bounds of scores by the segments of level ``n``: of all pairs as a matrix, or of ``pairs``."""
    (am, ad), (rm, rd) = asks.level(n), rows.level(n)
    if pairs is None:
        centre, reach = am @ rm.T, ad @ rd.T
        slack = 1e-12 * asks.length[:, None] * rows.length + 1e-6
    else:
        a, r = pairs
        centre, reach = np.einsum("ps,ps->p", am[a], rm[r]), np.einsum("ps,ps->p", ad[a], rd[r])
        slack = 1e-12 * asks.length[a] * rows.length[r] + 1e-6
    return centre - reach - slack, centre + reach + slack


def _largest(values: np.ndarray, k: int) -> float:
    """The ``k``-th largest; minus infinity if there are fewer."""
    return float(np.partition(values, len(values) - k)[len(values) - k]) if len(values) >= k else -np.inf


def scores(asks: Side, rows: Side, alive: np.ndarray, narrow) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """For each anchor with rows left: its number, theirs, and their exact scores.

    ``alive`` marks the pairs to look at. ``narrow(anchor, lower, upper)`` says
    which of an anchor's rows with these bounds have to stay; it is asked on each
    level, coarse first.
    """
    for n in range(len(SEGMENTS)):
        # A matrix product of all pairs is cheaper than the single pairs where many are left.
        dense = n == 0 or np.count_nonzero(alive) > alive.size // 8
        if dense:
            lower, upper = bounds(asks, rows, n)
        for a in range(len(alive)):
            left = np.flatnonzero(alive[a])
            if len(left):
                low, high = (lower[a, left], upper[a, left]) if dense else bounds(asks, rows, n, (np.full(len(left), a), left))
                alive[a, left] = narrow(a, low, high)
    dense = np.count_nonzero(alive) > alive.size // 8
    if dense:
        exact = asks.vectors @ rows.vectors.T
    for a in range(len(alive)):
        left = np.flatnonzero(alive[a])
        if len(left):
            yield a, left, exact[a, left] if dense else rows.vectors[left] @ asks.vectors[a]


def _best(ids: np.ndarray, found: np.ndarray, k: int) -> np.ndarray:
    """Places of the ``k`` best: high scores first, ties by the smaller id."""
    some = np.flatnonzero(found >= _largest(found, k))
    return some[np.lexsort((ids[some], -found[some]))][:k]


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Table, Side, Side]]:
    """(anchors' rows, anchors, rows) of each pair of blocks, in steps of bounded size."""
    keys = ["part", "shard", "crowd"]
    for table in whole_groups(batches, keys):
        starts = group_starts(table, keys).tolist()
        for low, high in zip(starts, [*starts[1:], table.num_rows]):
            group = table.slice(low, high - low)
            first = int(np.count_nonzero(~group.column("asks").to_numpy()))
            if 0 < first < len(group):
                rows, asking = Side(group.slice(0, first)), group.slice(first)
                asks, step = Side(asking), max(1, STEP // first)
                for at in range(0, len(asking), step):
                    yield asking.slice(at, step), asks.some(slice(at, at + step)), rows


def _positives(k: int):
    """For ``mapInArrow``: each anchor's best rows of its label in a block."""

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, asks, rows in _blocks(batches):
            out = [(np.zeros(0, np.int64),) * 3]
            alive = (asks.labels[:, None] == rows.labels) & (asks.ids[:, None] != rows.ids)
            for a, left, found in scores(asks, rows, alive, lambda _, low, high: high >= _largest(low, k)):
                best = _best(rows.ids[left], found, k)
                out.append((np.full(len(best), asks.ids[a]), rows.ids[left[best]], found[best].astype(np.int64)))
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*out)], ["anchor_id", "positive_id", "positive_score"])

    return run


def _negatives(k: int, least: int, most: int):
    """For ``mapInArrow``: for each anchor and positive, the best rows of other labels in a block whose scores lie in the window."""

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["anchor_id", "positive_id", "positive_score", "negative_id", "negative_score"]
        for asking, asks, rows in _blocks(batches):
            positives = [[(p["positive_id"], p["positive_score"]) for p in some] for some in asking.column("positives").to_pylist()]
            # Whole scores s with least * p <= 100 * s <= most * p.
            windows = [np.array([(-(-least * p // 100), most * p // 100) for _, p in some], float).reshape(-1, 2) for some in positives]

            def narrow(a: int, low: np.ndarray, high: np.ndarray) -> np.ndarray:
                stay = np.zeros(len(low), bool)
                for bottom, top in windows[a]:
                    sure = low[(low >= bottom) & (high <= top)]
                    stay |= (high >= max(bottom, _largest(sure, k))) & (low <= top)
                return stay

            out = [(np.zeros(0, np.int64),) * 5]
            alive = asks.labels[:, None] != rows.labels
            for a, left, found in scores(asks, rows, alive, narrow):
                for (positive, score), (bottom, top) in zip(positives[a], windows[a]):
                    inside = np.flatnonzero((found >= bottom) & (found <= top))
                    best = inside[_best(rows.ids[left[inside]], found[inside], k)]
                    one = np.ones(len(best), np.int64)
                    out.append((asks.ids[a] * one, positive * one, score * one, rows.ids[left[best]], found[best].astype(np.int64)))
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*out)], names)

    return run


def _met(rows: DataFrame, anchors: DataFrame, part: Column, block: int) -> DataFrame:
    """Every block of ``rows`` with every block of ``anchors`` that have the same ``part``, dealt out and sorted, rows first."""
    rows, anchors = rows.withColumn("part", part), anchors.withColumn("part", part)
    shards = rows.groupBy("part").agg(F.ceil(F.count(F.lit(1)) / block).cast("int").alias("shards"))
    crowds = anchors.groupBy("part").agg(F.ceil(F.count(F.lit(1)) / ANCHORS).cast("int").alias("crowds"))
    grid = stage(shards.join(crowds, "part"), "grid")

    def own(n: str) -> Column:
        return F.pmod(F.xxhash64("id"), F.col(n)).cast("int")

    def every(n: str) -> Column:
        return F.explode(F.sequence(F.lit(0), F.col(n) - 1))

    there = rows.join(grid, "part").withColumn("shard", own("shards")).withColumn("crowd", every("crowds")).withColumn("asks", F.lit(False))
    asking = anchors.join(grid, "part").withColumn("crowd", own("crowds")).withColumn("shard", every("shards")).withColumn("asks", F.lit(True))
    both = there.unionByName(asking, allowMissingColumns=True).drop("shards", "crowds")
    return both.repartition("part", "shard", "crowd").sortWithinPartitions("part", "shard", "crowd", "asks", "id")


def usable(vectors: DataFrame, id_col: str, vector_col: str, label: Column) -> DataFrame:
    """(id, label, vector) of the rows that take part, one an id: of rows with one id, the smallest label and vector."""
    rows = small_batches(vectors).select(F.col(f"`{id_col}`").cast("long").alias("id"), label.cast("long").alias("label"), F.col(f"`{vector_col}`").cast("array<double>").alias("vector"))
    finite = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    good = rows.where(F.col("id").isNotNull() & F.col("label").isNotNull() & F.col("vector").isNotNull() & finite & (F.size("vector") > 0))
    width = good.groupBy(F.size("vector").alias("width")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "width").limit(1).collect()
    good = good.where(F.size("vector") == (width[0]["width"] if width else 0))
    return good.groupBy("id").agg(F.min(F.struct("label", "vector")).alias("row")).select("id", "row.label", "row.vector")


def mine(
    vectors: DataFrame, is_anchor: Column, label: Column, positives: int = 5, negatives: int = 10, window: tuple[int, int] = (30, 90), id_col: str = "vec_id", vector_col: str = "embedding"
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) for every anchor and positive.

    ``is_anchor`` is a condition on ``id``, ``label`` a column of ``vectors``.
    Positives are an anchor's best other rows of its label; negatives the best
    rows of other labels whose score has a share of the positive's within
    ``window``, in per cent. Ties go to the smaller id. Rows with a null id, label,
    vector or component, a component that isn't finite, no components, or another
    number of them than most rows have (ties: the smaller number) take no part;
    vectors of zeros do. Of rows with one id the one with the smallest label and
    vector takes part. Scores are exact; a vector whose whole components' squares
    sum up to 2^53 or more is an error. Positives without negatives give no row,
    an empty table gives none.
    """
    kinds = "id long, label long, vector array<double>, means array<double>, spreads array<double>"
    rows = stage(usable(vectors, id_col, vector_col, label).mapInArrow(_summarise, kinds), "summaries")
    block = min(BLOCK, max(LEAST, rows.count() // SPREAD))
    anchors = rows.where(is_anchor)
    found = _met(rows, anchors, F.col("label"), block).mapInArrow(_positives(positives), "anchor_id long, positive_id long, positive_score long")
    first = F.row_number().over(Window.partitionBy("anchor_id").orderBy(F.desc("positive_score"), "positive_id"))
    best = found.withColumn("place", first).where(F.col("place") <= positives)
    some = best.groupBy(F.col("anchor_id").alias("id")).agg(F.collect_list(F.struct("positive_id", "positive_score")).alias("positives"))
    asking = stage(anchors.join(some, "id"), "anchors")
    names = ("anchor_id", "positive_id", "positive_score", "negative_id", "negative_score")
    found = _met(rows, asking, F.lit(0), block).mapInArrow(_negatives(negatives, *window), ", ".join(f"{c} long" for c in names))
    rank = F.row_number().over(Window.partitionBy("anchor_id", "positive_id").orderBy(F.desc("negative_score"), "negative_id"))
    out = found.withColumn("rank", rank).where(F.col("rank") <= negatives)
    return out.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
