"""Removal of repeated passages by longest-previous-factor arrays over suffix order.

A string of ``length`` bytes repeats if it starts anywhere else too. To bring
equal strings together without sorting every suffix of the corpus, each window
of ``length`` bytes is given to its anchor: the place of the smallest hash among
the window's ``GRAM``-byte pieces. Equal windows have equal pieces, so they have
the same anchor hash at the same distance. A run of windows with one anchor is a
segment; a document has a segment for about every ``(length - GRAM) / 2`` bytes.

1. Segments are counted by hash. Equal segments repeat in all their windows.
2. Where an anchor hash has several different segments, one copy of each is cut
   from the texts, and tasks build the suffix order of the segments' bytes by
   doubling ranks. The previous and the next smaller position in that order give
   each window's longest previous factor; seen from the other end they give the
   longest later one. A window repeats if a factor has ``length`` bytes or more.
3. An anchor hash with more than ``HOT`` different segments is not brought into
   one task: its windows are counted by hash, combined on the map side.

Ranges of repeated windows go back to the documents that have the segment.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise.llm.bits import passes
from shelfwise.llm.common import byte_view, cuts, group_starts, keyed, stage, tidy, whole_groups
from shelfwise.llm.shingles import _powers, mixed

GRAM = 64
HOT = 2000
BLOCK = 1 << 20
CHUNK = 1 << 20
PLACE_BITS = 24
_U = np.uint64
_BYTE = mixed(np.arange(1, 257, dtype=np.uint64) * _U(0x9E3779B97F4A7C15))


def _gram_hashes(data: np.ndarray) -> np.ndarray:
    """A hash of the ``GRAM`` bytes from every place on, by doubling."""
    hashes, size, factor = _BYTE[data], 1, 0xD6E8FEB86659FD93
    while size < GRAM:
        hashes = hashes[:-size] * _U(factor) + hashes[size:]
        factor = factor * factor % (1 << 64)
        size *= 2
    return mixed(hashes)


def segments(data: np.ndarray, offsets: np.ndarray, length: int) -> tuple[np.ndarray, ...]:
    """(row, anchor hash, segment hash, first window, last window) of every segment; places are those in ``data``."""
    windows = len(data) - length + 1
    nothing = np.zeros(0, np.int64)
    if windows < 1:
        return nothing, nothing.astype(np.uint64), nothing.astype(np.uint64), nothing, nothing
    grams = _gram_hashes(data)
    place_mask = _U((1 << PLACE_BITS) - 1)
    least = (grams & ~place_mask) | np.arange(len(grams), dtype=np.uint64)
    width, span = length - GRAM + 1, 1
    while span * 2 <= width:
        least = np.minimum(least[:-span], least[span:])
        span *= 2
    if width > span:
        least = np.minimum(least[: windows], least[width - span : width - span + windows])
    anchor = (least[:windows] & place_mask).astype(np.int64)
    starts = np.arange(windows)
    row = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))[:windows]
    valid = starts + length <= offsets[1:][row]
    starts, anchor, row = starts[valid], anchor[valid], row[valid]
    if not len(starts):
        return nothing, nothing.astype(np.uint64), nothing.astype(np.uint64), nothing, nothing
    edge = np.flatnonzero(np.concatenate(([True], anchor[1:] != anchor[:-1])))
    first, last, at = starts[edge], starts[np.append(edge[1:], len(starts)) - 1], anchor[edge]
    up, down = _powers(1 << max(16, int(len(data) - 1).bit_length()))
    sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum((data.astype(np.uint64) + _U(1)) * up[: len(data)])))
    body = (sums[last + length] - sums[first]) * down[first]
    shape = (last - first).astype(np.uint64) << _U(32) | (at - first).astype(np.uint64)
    return row[edge], grams[at], mixed(body + mixed(shape)), first, last


def _cut_segments(length: int, kind: str):
    """For ``mapInArrow`` over (id, key, text): the segments of every row, long texts in overlapping pieces."""

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = byte_view(batch.column(2))
            for low, high in cuts(offsets, BLOCK):
                start, end = int(offsets[low]), int(offsets[high])
                for at in range(start, max(start + 1, end - length + 1), BLOCK):
                    # Only a single long row has more than one piece; its pieces share length - 1 bytes.
                    to = end if high - low > 1 else min(end, at + BLOCK + length - 1)
                    bounds = offsets[low : high + 1] - at if high - low > 1 else np.array([0, to - at])
                    row, anchor, segment, first, last = segments(data[at:to], bounds, length)
                    of = pa.array(row + low, pa.int64())
                    base = bounds[:-1][row] - (at - start if high - low == 1 else 0)
                    yield pa.RecordBatch.from_arrays(
                        [batch.column(0).take(of), batch.column(1).take(of), pa.array(anchor.view(np.int64)), pa.array(segment.view(np.int64)), pa.array(first - base, pa.int64()), pa.array(last - first + 1, pa.int32())],
                        ["id", "key", "anchor", "segment", "first", "windows"],
                    )
                    if high - low > 1:
                        break

    return run, f"id {kind}, key long, anchor long, segment long, first long, windows int"


def _cut_texts(length: int):
    """For ``mapInArrow`` over (text, wanted): the bytes of every wanted segment."""

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low in range(0, len(batch), 64):
                anchor, segment, windows, body = [], [], [], []
                for text, wanted in zip(batch.column(0).slice(low, 64).to_pylist(), batch.column(1).slice(low, 64).to_pylist()):
                    raw = (text or "").encode("utf-8", "surrogatepass")
                    for w in wanted:
                        anchor.append(w["anchor"])
                        segment.append(w["segment"])
                        windows.append(w["windows"])
                        body.append(raw[w["first"] : w["first"] + w["windows"] + length - 1])
                yield pa.RecordBatch.from_arrays([pa.array(anchor, pa.int64()), pa.array(segment, pa.int64()), pa.array(windows, pa.int32()), pa.array(body, pa.binary())], ["anchor", "segment", "windows", "body"])

    return run


def _rank(values: np.ndarray) -> np.ndarray:
    """Dense ranks of ``values``."""
    order = np.argsort(values)
    ordered = values[order]
    rank = np.empty(len(values), np.int64)
    rank[order] = np.cumsum(np.concatenate(([0], ordered[1:] != ordered[:-1])))
    return rank


class SuffixOrder:
    """The order of chosen suffixes of ``data`` by their first ``length`` bytes (at least 8), and common prefixes in it."""

    def __init__(self, data: np.ndarray, chosen: np.ndarray, length: int):
        self.data, self.length = np.concatenate((data, np.zeros(length + 8, np.uint8))), length
        word = np.lib.stride_tricks.sliding_window_view(self.data[: len(data) + 7], 8)
        level = _rank(np.ascontiguousarray(word).view(">u8").reshape(-1).astype(np.uint64))
        self.levels, size = [(8, level.astype(np.int32))], 8
        while size * 2 <= length:
            after = np.concatenate((level[size:], np.zeros(min(size, len(level)), np.int64)))
            level = _rank(level << 32 | after)
            size *= 2
            self.levels.append((size, level.astype(np.int32)))
        rest = np.minimum(chosen + length - size, len(level) - 1)
        self.suffixes = chosen[np.argsort(level[chosen] << 32 | level[rest])]

    def common(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Common prefix of the suffixes at ``a`` and ``b``, at most ``length`` bytes."""
        out = np.zeros(len(a), np.int64)
        top = len(self.levels[0][1]) - 1
        for size, level in [*self.levels[::-1], *self.levels[::-1]]:
            same = (level[np.minimum(a + out, top)] == level[np.minimum(b + out, top)]) & (out + size <= self.length)
            out[same] += size
        for _ in range(8):
            out += (out < self.length) & (self.data[a + out] == self.data[b + out])
        return np.minimum(out, self.length)


def previous_smaller(values: np.ndarray) -> np.ndarray:
    """For every place, the nearest earlier place with a smaller value, or -1; by jumps along the places found so far."""
    found = np.arange(len(values)) - 1
    open_ = np.flatnonzero(found >= 0)
    while len(open_):
        open_ = open_[values[found[open_]] >= values[open_]]
        found[open_] = found[found[open_]]
        open_ = open_[found[open_] >= 0]
    return found


def previous_factors(order: SuffixOrder, position: np.ndarray) -> np.ndarray:
    """Longest previous factor of every suffix in ``order``, where ``position`` says what comes first."""
    out = np.zeros(len(position), np.int64)
    back = previous_smaller(position)
    ahead = len(position) - 1 - previous_smaller(position[::-1])[::-1]
    for other, has in ((back, back >= 0), (ahead, ahead < len(position))):
        at = np.flatnonzero(has)
        out[at] = np.maximum(out[at], order.common(order.suffixes[at], order.suffixes[other[at]]))
    return out


def repeats(bodies: list[bytes], windows: np.ndarray, length: int, keep: str) -> list[tuple[int, int, int]]:
    """(segment, first, last) ranges of windows that repeat in another of the segments, given in order of first occurrence."""
    data = np.frombuffer(b"".join(bodies), np.uint8)
    sizes = np.array([len(b) for b in bodies])
    base = np.concatenate(([0], np.cumsum(sizes)))[:-1]
    of = np.repeat(np.arange(len(bodies)), windows)
    inner = np.arange(len(of)) - np.repeat(np.cumsum(windows) - windows, windows)
    chosen = base[of] + inner
    order = SuffixOrder(data, chosen, length)
    # Places in ``data`` follow the first occurrences, so they serve as text positions.
    hit = previous_factors(order, order.suffixes) >= length
    if keep == "none":
        hit |= previous_factors(order, -order.suffixes) >= length
    flagged = np.zeros(len(data) + 1, bool)
    flagged[order.suffixes[hit]] = True
    marked = flagged[chosen]
    edge = np.concatenate(([True], (of[1:] != of[:-1]) | (marked[1:] != marked[:-1])))
    first = np.flatnonzero(edge)
    last = np.append(first[1:], len(of)) - 1
    return [(int(of[a]), int(inner[a]), int(inner[b])) for a, b in zip(first, last) if marked[a]]


def _compare(length: int, keep: str):
    """For ``mapInArrow`` over (anchor, segment, windows, body), sorted by anchor and first occurrence."""

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in whole_groups(batches, ["anchor"]):
            rows = rows.combine_chunks()
            starts = group_starts(rows, ["anchor"])
            weight = np.cumsum([0, *(len(b.as_buffer()) for b in rows.column("body"))])
            low = 0
            while low < len(starts):
                # Groups up to CHUNK bytes together: windows of different anchors never match, so order is all they share.
                high = low + 1
                while high < len(starts) and weight[starts[high + 1] if high + 1 < len(starts) else rows.num_rows] - weight[starts[low]] <= CHUNK:
                    high += 1
                part = rows.slice(int(starts[low]), int((starts[high] if high < len(starts) else rows.num_rows) - starts[low]))
                anchor, segment = part.column("anchor").to_numpy(), part.column("segment").to_numpy()
                found = repeats(part.column("body").to_pylist(), part.column("windows").to_numpy().astype(np.int64), length, keep)
                at = [f[0] for f in found]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(anchor[at], pa.int64()), pa.array(segment[at], pa.int64()), pa.array([f[1] for f in found], pa.int32()), pa.array([f[2] for f in found], pa.int32())],
                    ["anchor", "segment", "low", "high"],
                )
                low = high

    return run


def _remove(length: int, kind: str):
    """For ``mapInArrow`` over (id, text, ranges): spans and what is left."""

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, len(batch), 64):
                part = batch.slice(at, 64)
                spans, kept, sizes = [], [], []
                for text, ranges in zip(part.column(1).to_pylist(), part.column(2).to_pylist()):
                    raw = (text or "").encode("utf-8", "surrogatepass")
                    cover: list[list[int]] = []
                    for r in sorted((r["low"], r["high"] + length) for r in ranges or ()):
                        if cover and r[0] <= cover[-1][1]:
                            cover[-1][1] = max(cover[-1][1], r[1])
                        else:
                            cover.append(list(r))
                    edges = [0, *(e for c in cover for e in c), len(raw)]
                    kept.append(b"".join(raw[a:b] for a, b in zip(edges[::2], edges[1::2])))
                    spans.append([{"start": a, "end": b} for a, b in cover])
                    sizes.append(len(raw))
                span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(sizes, pa.int64()), pa.array(spans, span), pa.array(kept, pa.binary())], ["id", "n_bytes", "spans", "kept"])

    return run, f"id {kind}, n_bytes long, spans array<struct<start:long,end:long>>, kept binary"


def remove_repeats(docs: DataFrame, length: int = 400, keep: str = "first", id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id_col, n_bytes, spans, kept) for every row of ``docs``: removed byte spans and the bytes that stay.

    A byte goes if a repeated string of ``length`` bytes covers it. With
    ``keep="first"`` the first copy stays, in order of id and place; with
    ``"none"`` no copy does. Strings are judged on the input and never cross
    rows; repeated rows repeat each other, and null counts as empty. Texts
    shorter than ``length`` stay whole. An empty table gives an empty result;
    other columns are not read. ``kept`` is binary, as a span may cut a
    character.
    """
    if keep not in ("first", "none") or length < 2 * GRAM:
        raise ValueError(f"keep is 'first' or 'none', and length at least {2 * GRAM}")
    rows = keyed(docs, id=id_col, text=text_col)
    kind = rows.schema["id"].dataType.simpleString()
    rows = rows.select("id", F.xxhash64("text").alias("key"), "text")
    run, schema = _cut_segments(length, kind)
    found = stage(rows.mapInArrow(run, schema), "segments")
    one = F.min(F.struct("id", "key", "first", "windows")).alias("one")
    kinds = found.groupBy("anchor", "segment").agg(F.count(F.lit(1)).alias("n"), one)
    several = kinds.groupBy("anchor").agg(F.count(F.lit(1)).alias("kinds"), F.sum("n").alias("n")).where("n > 1")
    kinds = stage(kinds.join(several.select("anchor", "kinds"), "anchor"), "kinds")

    differ = kinds.where("kinds > 1").select("anchor", "segment", "kinds", "one.*")
    item = F.struct("anchor", "segment", "first", "windows")
    wanted = differ.groupBy("id", "key").agg(F.collect_list(item).alias("wanted"))
    wanted = stage(wanted, "wanted").select(F.col("id").alias("of"), F.col("key").alias("text_key"), "wanted")
    here = rows.where(passes(wanted.select(F.col("text_key").alias("key")), "key"))
    texts = here.join(wanted, here["id"].eqNullSafe(wanted["of"]) & (here["key"] == wanted["text_key"])).select("text", "wanted")
    bodies = texts.mapInArrow(_cut_texts(length), "anchor long, segment long, windows int, body binary")
    order = differ.select("anchor", "segment", "kinds", F.struct("id", "key", "first").alias("place"))
    bodies = stage(bodies.dropDuplicates(["anchor", "segment"]), "bodies").join(order, ["anchor", "segment"])
    usual = bodies.where(F.col("kinds") <= HOT).repartition("anchor").sortWithinPartitions("anchor", "place", "segment").select("anchor", "segment", "windows", "body")
    ranges = "anchor long, segment long, low int, high int"
    repeated = usual.mapInArrow(_compare(length, keep), ranges)
    each = bodies.where(F.col("kinds") > HOT).select("anchor", "segment", "place", "body", F.explode(F.sequence(F.lit(0), F.col("windows") - 1)).alias("low"))
    window = each.select("anchor", "segment", "place", "low", F.xxhash64(F.substring("body", F.col("low") + 1, F.lit(length))).alias("window"))
    counted = window.groupBy("anchor", "window").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("place", "segment", "low")).alias("head")).where("n > 1")
    hot = window.join(counted, ["anchor", "window"])
    if keep == "first":
        hot = hot.where((F.col("segment") != F.col("head.segment")) | (F.col("low") != F.col("head.low")))
    repeated = repeated.union(hot.select("anchor", "segment", "low", F.col("low").alias("high")))

    copies = kinds.where("n > 1").select("anchor", "segment", F.lit(0).alias("low"), (F.col("one.windows") - 1).alias("high"), F.col("one").alias("spared"))
    none = F.lit(None).cast(copies.schema["spared"].dataType)
    # A kind's first occurrence may be spared as a copy of itself, never as a copy of another kind.
    marks = stage(copies.unionByName(repeated.withColumn("spared", none)), "marks")
    marked = found.join(marks, ["anchor", "segment"])
    if keep == "first":
        here = F.struct("id", "key", "first", "windows")
        marked = marked.where(F.col("spared").isNull() | ~here.eqNullSafe(F.col("spared")))
    span = F.struct((F.col("first") + F.col("low")).alias("low"), (F.col("first") + F.col("high")).alias("high"))
    spans = stage(marked.groupBy("id", "key").agg(F.collect_list(span).alias("ranges")), "ranges").select(F.col("id").alias("of"), F.col("key").alias("text_key"), "ranges")

    touched = passes(spans.select(F.col("text_key").alias("key")), "key")
    hit, whole = rows.where(touched), rows.where(~touched)
    joined = hit.join(spans, hit["id"].eqNullSafe(spans["of"]) & (hit["key"] == spans["text_key"]), "left").select("id", "text", "ranges")
    run, schema = _remove(length, kind)
    empty = F.array().cast("array<struct<start:long,end:long>>")
    raw = F.coalesce("text", F.lit("")).cast("binary")
    rest = whole.select("id", F.octet_length(raw).cast("long").alias("n_bytes"), empty.alias("spans"), raw.alias("kept"))
    return joined.mapInArrow(run, schema).unionByName(rest).withColumnRenamed("id", id_col)
