"""Approximate nearest neighbours by learned partitions.

On a bounded sample, the graph of nearest neighbours is cut into parts of equal
size by recursive spectral bisection with swaps along the cut. A small
classifier, trained in numpy, learns a vector's part. Every vector is filed
under its few most probable parts; a query goes to its ``probes`` most probable
parts and is reranked there by exact distance in double precision.

Parts are dealt out in blocks of about ``BLOCK`` vectors, so a part that many
equal vectors fall into is no single task; each block gives a query's best, and
a window over the query merges them.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfwise.llm.common import group_starts, keyed, stage, tidy, whole_groups

BLOCK = 4096


@dataclass(frozen=True)
class Settings:
    sample: int = 4096  # vectors the index is learned from
    parts: int = 64  # at most; each has ``least`` vectors of the sample or more
    least: int = 64
    filings: int = 3  # parts that a vector is filed under
    probes: int = 24  # parts that a query looks into
    links: int = 10
    hidden: int = 64
    steps: int = 600
    batch: int = 256
    rate: float = 0.01
    seed: int = 5


@dataclass(frozen=True)
class Router:
    """Standardise, one hidden layer, softmax over the parts."""

    centre: np.ndarray
    scale: np.ndarray
    params: tuple[np.ndarray, ...]

    @property
    def parts(self) -> int:
        return len(self.params[3])

    def logits(self, vectors: np.ndarray) -> np.ndarray:
        w, b, v, c = self.params
        return np.maximum((vectors - self.centre) * self.scale @ w + b, 0) @ v + c


def neighbour_graph(vectors: np.ndarray, links: int) -> tuple[np.ndarray, np.ndarray]:
    """Edges (a, b), in both directions, between each vector and its nearest ones."""
    n, square = len(vectors), (vectors**2).sum(1)
    links, ends = min(links, n - 1), []
    for low in range(0, n, 512):
        far = square + square[low : low + 512, None] - 2 * vectors[low : low + 512] @ vectors.T
        far[np.arange(len(far)), np.arange(low, low + len(far))] = np.inf
        ends.append(np.argpartition(far, links - 1, axis=1)[:, :links])
    a, b = np.repeat(np.arange(n), links), np.concatenate(ends).reshape(-1)
    pair = np.unique(np.concatenate((a * n + b, b * n + a)))
    return pair // n, pair % n


def balanced_parts(n: int, a: np.ndarray, b: np.ndarray, parts: int, seed: int = 0) -> np.ndarray:
    """A part for each of ``n`` nodes of the graph; ``parts`` is a power of two and sizes differ by one at most per cut."""
    part, rng, count = np.zeros(n, np.int64), np.random.default_rng(seed), 1
    while count < parts:
        inside = part[a] == part[b]
        x, y = a[inside], b[inside]
        degree = np.maximum(np.bincount(x, minlength=n), 1)
        members = np.bincount(part, minlength=count)
        # Second eigenvectors of all parts at once: smooth along edges, and take out each part's mean.
        side = rng.normal(size=n)
        for _ in range(60):
            side = 0.5 * side + 0.5 * np.bincount(x, side[y], n) / degree
            side -= (np.bincount(part, side, count) / members)[part]
            side /= np.sqrt(np.bincount(part, side**2, count) / members + 1e-30)[part]
        order = np.lexsort((side, part))
        rank = np.empty(n, np.int64)
        rank[order] = np.arange(n) - np.repeat(np.cumsum(members) - members, members)
        half = (rank >= (members // 2)[part]).astype(np.int64)
        for _ in range(5):
            # Swap the pairs, one from each side, that gain most edges; sizes stay.
            across = np.bincount(x, half[x] != half[y], n)
            gain = 2 * across - degree
            best = np.lexsort((-gain, half, part))
            key = (part * 2 + half)[best]
            place = np.arange(n) - np.searchsorted(key, key)
            table = np.full((count, 2, int(members.max())), -np.inf)
            who = np.zeros((count, 2, int(members.max())), np.int64)
            table[part[best], half[best], place], who[part[best], half[best], place] = gain[best], best
            swap = (table[:, 0] > 0) & (table[:, 1] > 0)
            swap[:, 1 + swap.shape[1] // 20 :] = False
            half[who[:, 0][swap]], half[who[:, 1][swap]] = 1, 0
        part, count = part * 2 + half, count * 2
    return part


def learn(vectors: np.ndarray, settings: Settings = Settings()) -> Router:
    """Cut the sample's graph and train the classifier on its parts."""
    n, width = vectors.shape
    parts = 1
    while parts * 2 <= settings.parts and n // (parts * 2) >= settings.least:
        parts *= 2
    centre = vectors.mean(0) if n else np.zeros(width)
    scale = 1 / (vectors.std() + 1e-9) * np.ones(width) if n else np.ones(width)
    rng = np.random.default_rng(settings.seed)
    params = [rng.normal(0, width**-0.5, (width, settings.hidden)), np.zeros(settings.hidden), rng.normal(0, settings.hidden**-0.5, (settings.hidden, parts)), np.zeros(parts)]
    if parts > 1:
        label = balanced_parts(n, *neighbour_graph(vectors, settings.links), parts, settings.seed)
        x = (vectors - centre) * scale
        first, second = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
        for step in range(1, settings.steps + 1):
            some = rng.integers(0, n, settings.batch)
            w, b, v, c = params
            hidden = np.maximum(x[some] @ w + b, 0)
            z = hidden @ v + c
            p = np.exp(z - z.max(1, keepdims=True))
            p /= p.sum(1, keepdims=True)
            p[np.arange(len(some)), label[some]] -= 1
            p /= len(some)
            back = (p @ v.T) * (hidden > 0)
            grads = [x[some].T @ back + 1e-4 * w, back.sum(0), hidden.T @ p + 1e-4 * v, p.sum(0)]
            for q, g, m, s in zip(params, grads, first, second):
                m += 0.1 * (g - m)
                s += 0.01 * (g * g - s)
                q -= settings.rate * (m / (1 - 0.9**step)) / (np.sqrt(s / (1 - 0.99**step)) + 1e-8)
    return Router(centre, scale, tuple(params))


def usable(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(id, vector) of the rows that take part: an id, and components that are all finite and not all zero.

    Vectors whose number of components isn't the table's most frequent one (ties:
    the smallest) have no distance to the rest and take no part either.
    """
    rows = keyed(vectors, id=id_col, vector=vector_col).select(F.col("id").cast("long"), F.col("vector").cast("array<double>").alias("vector"))
    finite = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    good = rows.where(F.col("id").isNotNull() & F.col("vector").isNotNull() & finite & F.exists("vector", lambda x: x != 0))
    width = good.groupBy(F.size("vector").alias("width")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "width").limit(1).collect()
    return good.where(F.size("vector") == (width[0]["width"] if width else 0))


def _matrix(column: pa.ChunkedArray) -> np.ndarray:
    flat = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return flat.flatten().to_numpy().reshape(len(flat), -1)


def _route(router: Router, probes: int):
    """For ``mapInArrow`` over (id, vector): a row for each of the ``probes`` most probable parts."""
    probes = min(probes, router.parts)

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not len(batch):
                continue
            logits = router.logits(_matrix(batch.column(1)))
            best = np.argsort(-logits, axis=1, kind="stable")[:, :probes]
            rows = batch.take(pa.array(np.repeat(np.arange(len(batch)), probes)))
            yield pa.RecordBatch.from_arrays([*rows.columns, pa.array(best.reshape(-1).astype(np.int32))], ["id", "vector", "part"])

    return run


def _rerank(k: int):
    """For ``mapInArrow`` over (part, block, asks, id, vector), candidates first: each query's best of the block."""

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in whole_groups(batches, ["part", "block"]):
            starts = group_starts(rows, ["part", "block"])
            asks, ids = rows.column("asks").to_numpy(), rows.column("id").to_numpy()
            vectors = _matrix(rows.column("vector"))
            query, found, score = [], [], []
            for low, high in zip(starts.tolist(), [*starts[1:].tolist(), len(ids)]):
                first = low + int(np.count_nonzero(~asks[low:high]))
                # Sorted by id and vector, equal rows follow each other; one is enough.
                known, there = ids[low:first], vectors[low:first]
                new = np.ones(len(known), bool)
                new[1:] = (known[1:] != known[:-1]) | (there[1:] != there[:-1]).any(1)
                known, there = known[new], there[new]
                for q in range(first, high):
                    far = np.sqrt(((there - vectors[q]) ** 2).sum(1))
                    far[known == ids[q]] = np.inf
                    near = np.arange(len(far))
                    if len(far) > k:
                        near = np.flatnonzero(far <= np.partition(far, k - 1)[k - 1])
                    near = near[np.lexsort((known[near], far[near]))][:k]
                    near = near[far[near] < np.inf]
                    query.append(np.full(len(near), ids[q]))
                    found.append(known[near])
                    score.append(far[near])
            if query:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(query)), pa.array(np.concatenate(found)), pa.array(np.concatenate(score))], ["query_id", "id", "score"])

    return run


def nearest(vectors: DataFrame, is_query: Column, k: int = 10, settings: Settings = Settings(), id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(query_id, rank, id_col, score): the ``k`` nearest found, by Euclidean distance, for rows that satisfy ``is_query``.

    ``is_query`` is a condition on ``id``. Every usable row is filed and can be
    found; a query never finds its own id. Ties go to the smaller id. Null, zero
    and non-finite vectors take no part; equal rows are found once. An empty
    table gives an empty result.
    """
    rows = stage(usable(vectors, id_col, vector_col), "vectors")
    chosen = rows.select("id", F.xxhash64(F.lit(settings.seed), "id").alias("order")).distinct().orderBy("order", "id").limit(settings.sample)
    got = rows.join(F.broadcast(chosen.select("id")), "id", "left_semi").limit(2 * settings.sample).collect()
    got.sort(key=lambda r: (r.id, r.vector))
    sample = np.array([r.vector for r in got]) if got else np.zeros((0, 1))
    router = learn(sample, settings)
    schema = "id long, vector array<double>, part int"
    filed = stage(rows.mapInArrow(_route(router, settings.filings), schema), "filed")
    blocks = filed.groupBy("part").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("blocks"))
    block = F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int").alias("block")
    there = filed.join(F.broadcast(blocks), "part").select("part", block, F.lit(False).alias("asks"), "id", "vector")
    asking = rows.where(is_query).mapInArrow(_route(router, settings.probes), schema).join(F.broadcast(blocks), "part")
    asking = asking.select("part", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"), F.lit(True).alias("asks"), "id", "vector")
    dealt = there.union(asking).repartition("part", "block").sortWithinPartitions("part", "block", "asks", "id", "vector")
    best = dealt.mapInArrow(_rerank(k), "query_id long, id long, score double").distinct()
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy("score", "id"))
    return best.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", F.col("id").alias(id_col), "score")
