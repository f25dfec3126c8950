"""Best-fit packing of token sequences, in bulk-synchronous rounds.

``token_pieces`` turns texts into pieces of at most ``capacity`` tokens;
``pack`` places rows with a length into sequences of that capacity.

A round range-sorts what is unplaced and the gaps of the open sequences by size,
sweeps both upwards so that every gap takes the largest unplaced row that fits
(its successor, seen from the row), settles who gets which gap by rank, and
updates the gaps. Rounds repeat; where no gap fits any row, new sequences are
opened: one for each row over half the capacity, else as many as the volume
left needs. A gap that would hold several of the largest row left counts as so
many gaps, so that short rows do not need a round each.

Rows of equal length are interchangeable, and so are gaps of equal size. A rank
within the length class therefore stands for a row, and a round works on runs of
ranks: its cost depends on the capacity, not on the rows. Tasks give the ranks
(within a partition, then by the sums of the partitions before it), look up
their rows' runs, and a window over each sequence gives the offsets. What the
driver sees is one count per length, at most ``capacity`` of them.
"""

from __future__ import annotations

import base64
import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfwise.llm.common import fresh, keyed, stage, tidy

RANK_BITS = 44


@functools.lru_cache(maxsize=2)
def _encoder(path: str, pattern: str, specials: tuple[tuple[str, int], ...]):
    import tiktoken

    with open(path, "rb") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
    return tiktoken.Encoding("pieces", pat_str=pattern, mergeable_ranks=ranks, special_tokens=dict(specials))


def token_pieces(
    docs: DataFrame,
    path: str,
    pattern: str,
    specials: dict[str, int],
    capacity: int = 2048,
    end_id: int = 0,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """(id_col, piece, start, length, ids) with ids as little-endian unsigned 32-bit numbers.

    A document is its tokens and ``end_id``; null counts as the empty text, so
    every row has at least one piece. Only longer documents are cut, so that all
    pieces but the first are full. ``path`` holds the byte-pair ranks on every
    worker and ``specials`` the strings that are one token inside a text.
    Repeated rows give their own pieces; other columns are not read.
    """
    rows = keyed(docs, id=id_col, text=text_col)
    kind = rows.schema["id"].dataType.simpleString()
    special = tuple(sorted(specials.items()))

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(path, pattern, special)
        for batch in batches:
            for low in range(0, len(batch), 256):
                part, out = batch.slice(low, 256), ([], [], [], [], [])
                for i, text in enumerate(part.column(1).to_pylist()):
                    ids = np.append(encoder.encode_to_numpy(text or "", allowed_special="all").astype("<u4"), np.array([end_id], "<u4"))
                    first = len(ids) % capacity or capacity
                    starts = [0, *range(first, len(ids), capacity)]
                    for piece, (a, b) in enumerate(zip(starts, [*starts[1:], len(ids)])):
                        for values, value in zip(out, (i, piece, a, b - a, ids[a:b].tobytes())):
                            values.append(value)
                at, pieces, start, length, ids = out
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).take(pa.array(at, pa.int64())), pa.array(pieces, pa.int32()), pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(ids, pa.binary())],
                    ["id", "piece", "start", "length", "ids"],
                )

    return rows.mapInArrow(run, f"id {kind}, piece int, start long, length long, ids binary").withColumnRenamed("id", id_col)


class Runs:
    """Rounds of best fit over length classes; ``placed`` collects (length, first rank, count, first sequence)."""

    def __init__(self, counts: dict[int, int], capacity: int):
        self.capacity, self.left = capacity, np.zeros(capacity + 1, np.int64)
        for length, count in counts.items():
            self.left[length] = count
        self.next_rank = np.zeros(capacity + 1, np.int64)
        self.low = self.high = self.gap = np.zeros(0, np.int64)  # open sequences low..high-1 have this gap
        self.opened, self.rounds, self.placed = 0, 0, []

    def run(self) -> np.ndarray:
        sizes = np.arange(self.capacity + 1)
        while self.left.any():
            if not self.round():
                wanted = int(self.left[self.capacity // 2 + 1 :].sum()) or -(-int((sizes * self.left).sum()) // self.capacity)
                self.low, self.high = np.append(self.low, self.opened), np.append(self.high, self.opened + wanted)
                self.gap, self.opened = np.append(self.gap, self.capacity), self.opened + wanted
        return np.array(self.placed, np.int64).reshape(-1, 4)

    def slots(self) -> list[tuple[int, int, int]]:
        """(size, first sequence, end) of what the gaps offer, by size; a wide gap offers several slots."""
        largest, out = int(self.left.nonzero()[0][-1]), []
        for low, high, gap in zip(self.low.tolist(), self.high.tolist(), self.gap.tolist()):
            whole = max(1, gap // largest)
            out += [(largest, low, high)] * (whole - 1)
            out.append((gap - (whole - 1) * largest, low, high))
        return sorted(out)

    def round(self) -> bool:
        if not len(self.low):
            return False
        stack, taken, size = [], [], 0
        present = self.left.nonzero()[0].tolist()
        waiting = 0
        for slot, low, high in self.slots():
            while waiting < len(present) and present[waiting] <= slot:
                stack.append([present[waiting], int(self.left[present[waiting]])])
                waiting += 1
            while stack and low < high:
                size, count = stack[-1]
                n = min(count, high - low)
                taken.append((low, low + n, size))
                self.placed.append((size, int(self.next_rank[size]), n, low))
                self.next_rank[size] += n
                self.left[size] -= n
                low += n
                if n == count:
                    stack.pop()
                else:
                    stack[-1][1] -= n
        self.rounds += 1
        if taken:
            self.update(np.array(taken, np.int64))
        return bool(taken)

    def update(self, taken: np.ndarray) -> None:
        """Shrink the gaps; neighbouring sequences with equal gaps become one run."""
        edges = np.unique(np.concatenate((self.low, self.high, taken[:, 0], taken[:, 1])))
        change = np.zeros(len(edges), np.int64)
        for start, end, by in ((self.low, self.high, self.gap), (taken[:, 0], taken[:, 1], -taken[:, 2])):
            np.add.at(change, np.searchsorted(edges, start), by)
            np.add.at(change, np.searchsorted(edges, end), -by)
        gap = np.cumsum(change)[:-1]
        new = np.concatenate(([True], gap[1:] != gap[:-1])) if len(gap) else np.zeros(0, bool)
        low, gap = edges[:-1][new], gap[new]
        high = np.append(low[1:], edges[-1])
        keep = gap > 0
        self.low, self.high, self.gap = low[keep], high[keep], gap[keep]


def pack(rows: DataFrame, length_col: str = "length", capacity: int = 2048) -> DataFrame:
    """``rows`` with sequence_id and offset: rows of a sequence lie side by side from offset 0 to ``capacity`` at most.

    Every row has a length from 1 to ``capacity``; anything else, null included,
    ends the job, as dropping the row would lose it. Ties and repeated rows are
    placed each; an empty table gives an empty result. Columns named sequence_id
    or offset in ``rows`` are replaced.
    """
    # Staged first, so that a task never needs two Python workers: one that makes the rows and one that numbers them.
    rows = stage(rows.drop("sequence_id", "offset"), "rows")
    part, rank, before = fresh(rows, "part", "rank", "before")
    place = rows.columns.index(length_col)
    ranked = T.StructType([*rows.schema.fields, T.StructField(part, T.IntegerType()), T.StructField(rank, T.LongType())])

    @tidy
    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, me = np.zeros(capacity + 1, np.int64), TaskContext.get().partitionId()
        for batch in batches:
            length = batch.column(place).to_numpy(zero_copy_only=False)
            if len(length) and not (np.all(length >= 1) and np.all(length <= capacity)):
                raise ValueError(f"a length is not within 1 and {capacity}")
            length = length.astype(np.int64)
            order = np.argsort(length, kind="stable")
            ordered = length[order]
            first = np.searchsorted(ordered, ordered)
            ranks = np.empty(len(length), np.int64)
            ranks[order] = np.arange(len(length)) - first + seen[ordered]
            seen += np.bincount(length, minlength=capacity + 1)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(np.full(len(length), me, np.int32)), pa.array(ranks)], names=ranked.names)

    numbered = stage(rows.mapInArrow(number, ranked), "numbered")
    size = F.col(f"`{length_col}`").cast("long").alias("size")
    counts = stage(numbered.groupBy(F.col(part), size).agg(F.count(F.lit(1)).alias("n")), "classes")
    earlier = Window.partitionBy("size").orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(part, "size", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias(before))
    totals = {r["size"]: r["n"] for r in counts.groupBy("size").agg(F.sum("n").alias("n")).collect()}
    placed = Runs(totals, capacity).run()
    placed = placed[np.lexsort((placed[:, 1], placed[:, 0]))]
    keys, first_rank, first_sequence = placed[:, 0] << RANK_BITS | placed[:, 1], placed[:, 1], placed[:, 3]
    joined = numbered.join(starts, [numbered[part] == starts[part], numbered[length_col].cast("long") == starts["size"]]).select(
        *(numbered[c] for c in rows.columns), (numbered[rank] + starts[before]).alias(rank)
    )
    found = T.StructType([*rows.schema.fields, T.StructField("sequence_id", T.LongType())])

    @tidy
    def look_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length, ranks = (batch.column(i).to_numpy(zero_copy_only=False).astype(np.int64) for i in (place, batch.num_columns - 1))
            at = np.searchsorted(keys, length << RANK_BITS | ranks, "right") - 1
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(first_sequence[at] + ranks - first_rank[at], pa.int64())], names=found.names)

    in_sequence = Window.partitionBy("sequence_id").orderBy(F.desc(length_col), *(F.col(f"`{c}`") for c in rows.columns if not isinstance(rows.schema[c].dataType, (T.MapType, T.BinaryType, T.VariantType))))
    to_here = F.sum(F.col(f"`{length_col}`")).over(in_sequence.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return joined.mapInArrow(look_up, found).withColumn("offset", (to_here - F.col(f"`{length_col}`")).cast("long"))
