"""N-gram Jaccard join over a token-group matrix.

Documents are sets of five-word shingles; two link when 100 times the
intersection is at least 80 times the union. Equal sets are one node.

1. *Groups.* Nodes with the same smallest hash (under one of several orders) are
   compared with a leader and join its group if they link; leaders go on to the
   next order. Large buckets are dealt out in parts of ``PART`` nodes, whose
   leaders meet in the next round, so no bucket meets in one task.
   Each leader's task stores the union of its group's tokens as one row.
2. *Matrix.* The matrix of tokens by groups says which queries meet which groups.
   It is kept sparse: a link needs a common token among the rarest fifth of both
   documents' tokens, so only those are listed, by token. Rarity comes from a
   count over all documents in a table of fixed size; any order is correct, a
   good one keeps the lists short. Lists within one class need no work. A long
   list is reduced to one row per group, against which blocks of queries are
   dealt out over tasks.
3. *Bound.* A query and a group that share a listed token (and pass the position
   bound on it) meet: the stored union bounds their overlap. Only a group whose
   bound reaches the query's need is opened: its members are read and compared
   exactly. A group of one is its own union, so the bound's task compares it.
4. *Classes.* Links between classes are joined by label propagation along stars.

Every pair of different nodes that links either shares a class after step 1 or
is found in step 3, so classes are exact up to 64-bit hash collisions.
"""

from __future__ import annotations

import functools
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise.llm.bits import passes
from shelfwise.llm.common import byte_view, cuts, fresh, group_starts, keyed, stage, stage_by, tidy, whole_groups
from shelfwise.llm.shingles import mixed, overlap, shingle_sets

PART = 256
ORDERS = 3
CELL_BITS = 22
CELL_BLOCKS = 64
QUERIES = 2048
PAIRS = 1 << 18
SHORT = 128
LONG = 1024
#: Size of the tables that pick sets by node: 0.5 MB, of use up to some three million nodes.
NODE_BITS = 1 << 22
PLACE_BITS = 32
_U = np.uint64
_ORDER_FACTORS = (_U(1), _U(0xBF58476D1CE4E5B9), _U(0x94D049BB133111EB))


def _signed(x: np.ndarray) -> pa.Array:
    return pa.array(x.view(np.int64), pa.int64())


def _smallest(hashes: np.ndarray, starts: np.ndarray, k: int) -> np.ndarray:
    return np.minimum.reduceat(hashes if k == 0 else mixed(hashes * _ORDER_FACTORS[k]), starts)


def _blocks(batches: Iterator[pa.RecordBatch]):
    """(ids, distinct shingles, number per row) for blocks of rows (id, text)."""
    for batch in batches:
        data, offsets = byte_view(batch.column(1))
        for low, high in cuts(offsets):
            part = slice(int(offsets[low]), int(offsets[high]))
            hashes, counts = shingle_sets(data[part], offsets[low : high + 1] - offsets[low])
            yield batch.column(0).slice(low, high - low), hashes, counts


def _set_ids(hashes: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(rows with a set, where each set starts, its 64-bit name)."""
    filled = np.flatnonzero(counts)
    starts = np.concatenate(([0], np.cumsum(counts)))[filled]
    sums = np.add.reduceat(mixed(hashes + _U(0x632BE59BD9B4E019)), starts) if len(filled) else np.zeros(0, np.uint64)
    return filled, starts, mixed(sums + counts[filled].astype(np.uint64) * _U(0x9E3779B97F4A7C15))


def _read_sets(kind: str):
    """For ``mapInArrow``: the node of every row, and at the end this task's token counts in compressed blocks."""

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells, waiting, kept = np.zeros(1 << CELL_BITS, np.uint32), 0, []
        names = ["id", "n", "node", *(f"order{k}" for k in range(ORDERS)), "block", "counts"]
        for ids, hashes, counts in _blocks(batches):
            filled, starts, names_of = _set_ids(hashes, counts)
            columns = np.zeros((1 + ORDERS, len(counts)), np.uint64)
            columns[0, filled] = names_of
            for k in range(ORDERS):
                if len(filled):
                    columns[1 + k, filled] = _smallest(hashes, starts, k)
            kept.append((hashes >> _U(64 - CELL_BITS)).astype(np.int32))
            waiting += len(hashes)
            if waiting > 4_000_000:
                cells += np.bincount(np.concatenate(kept), minlength=1 << CELL_BITS).astype(np.uint32)
                waiting, kept = 0, []
            none = pa.nulls(len(counts), pa.int32()), pa.nulls(len(counts), pa.binary())
            yield pa.RecordBatch.from_arrays([ids, pa.array(counts, pa.int64()), *map(_signed, columns), *none], names)
        if kept:
            cells += np.bincount(np.concatenate(kept), minlength=1 << CELL_BITS).astype(np.uint32)
        if cells.any():
            packed = [zlib.compress(c.tobytes(), 1) for c in np.split(cells, CELL_BLOCKS)]
            empty = [pa.nulls(CELL_BLOCKS, t) for t in (ids.type, *[pa.int64()] * (2 + ORDERS))]
            yield pa.RecordBatch.from_arrays([*empty, pa.array(range(CELL_BLOCKS), pa.int32()), pa.array(packed, pa.binary())], names)

    return run, f"id {kind}, n long, node long, " + ", ".join(f"order{k} long" for k in range(ORDERS)) + ", block int, counts binary"


@tidy
def _add_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums the compressed blocks of equal number, one at a time."""
    block, total = None, None
    for batch in batches:
        for key, counts in zip(batch.column(0).to_pylist(), batch.column(1)):
            if key != block:
                if block is not None:
                    yield _level(block, total)
                block, total = key, np.zeros((1 << CELL_BITS) // CELL_BLOCKS, np.uint64)
            total += np.frombuffer(zlib.decompress(counts.as_py()), np.uint32)
    if block is not None:
        yield _level(block, total)


def _level(block: int, total: np.ndarray) -> pa.RecordBatch:
    # Sixteen levels for each doubling: enough to rank tokens, in one byte a cell.
    level = np.minimum(np.round(16 * np.log2(total + 1.0)), 255).astype(np.uint8)
    return pa.RecordBatch.from_arrays([pa.array([block], pa.int32()), pa.array([level.tobytes()], pa.binary())], ["block", "levels"])


def _least(n: np.ndarray | int, percent: int) -> np.ndarray | int:
    """The smallest overlap a set of ``n`` needs with any set it links with."""
    return -(-percent * n // 100)


def _rare_tokens(levels: np.ndarray, percent: int):
    """For ``mapInArrow``: (token, node, n, at) of the rarest tokens of each set, once per task and set."""

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for _, hashes, counts in _blocks(batches):
            filled, starts, names = _set_ids(hashes, counts)
            fresh = np.zeros(len(filled), bool)
            for i, name in enumerate(names.tolist()):
                if name not in seen:
                    if len(seen) > 500_000:
                        seen.clear()
                    seen.add(name)
                    fresh[i] = True
            n = counts[filled]
            row = np.repeat(np.arange(len(filled)), n)
            # Shingles come in order of row and hash, so row, level and place make one sortable number.
            level = levels[hashes >> _U(64 - CELL_BITS)].astype(np.int64)
            order = np.sort((row << 8 | level) << PLACE_BITS | np.arange(len(hashes))) & ((1 << PLACE_BITS) - 1)
            at = np.arange(len(hashes)) - np.repeat(starts, n)
            keep = (at < (n - _least(n, percent) + 1)[row]) & fresh[row]
            yield pa.RecordBatch.from_arrays([_signed(hashes[order][keep]), _signed(names[row[keep]]), pa.array(n[row[keep]], pa.int32()), pa.array(at[keep], pa.int32())], ["token", "node", "n", "at"])

    return run


@tidy
def _whole_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for _, hashes, counts in _blocks(batches):
        filled, starts, names = _set_ids(hashes, counts)
        raw = hashes.tobytes()
        sets = [raw[8 * a : 8 * (a + c)] for a, c in zip(starts.tolist(), counts[filled].tolist())]
        yield pa.RecordBatch.from_arrays([_signed(names), pa.array(sets, pa.binary())], ["node", "tokens"])


def _sets(rows: DataFrame, nodes: DataFrame, label: str) -> DataFrame:
    """(node, tokens) of ``nodes`` (id, node), in buckets of the node: only documents that the bit table lets through are read again."""
    found = rows.where(passes(nodes, "id", bits=NODE_BITS)).mapInArrow(_whole_sets, "node long, tokens binary")
    return stage_by(found.join(nodes.select("node"), "node", "left_semi").dropDuplicates(["node"]), "node", label)


def links(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    if percent * max(len(a), len(b)) > 100 * min(len(a), len(b)):
        return False
    common = overlap(a, b)
    return 100 * common >= percent * (len(a) + len(b) - common)


def _leaders(percent: int):
    """For ``mapInArrow`` over (bucket, part, node, tokens), sorted: the leader of every node of a part.

    One more row, without a node, holds the union of the tokens of a leader and those it leads here.
    """

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in whole_groups(batches, ["bucket", "part"]):
            starts = group_starts(rows, ["bucket", "part"])
            nodes = rows.column("node").to_pylist()
            tokens = [np.frombuffer(t.as_buffer(), np.uint64) for t in rows.column("tokens")]
            leader = list(range(len(nodes)))
            for low, high in zip(starts.tolist(), [*starts[1:].tolist(), len(nodes)]):
                heads: list[int] = []
                for i in range(low, high):
                    leader[i] = next((h for h in heads if links(tokens[h], tokens[i], percent)), i)
                    if leader[i] == i:
                        heads.append(i)
            follow = [i for i, h in enumerate(leader) if h != i]
            union: dict[int, np.ndarray] = {}
            for i in follow:
                union[leader[i]] = np.union1d(union.get(leader[i], tokens[leader[i]]), tokens[i])
            columns = [nodes[i] for i in follow], [nodes[leader[i]] for i in follow], [None] * len(follow)
            for column, more in zip(columns, ([None] * len(union), [nodes[h] for h in union], [u.tobytes() for u in union.values()])):
                column.extend(more)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int64(), pa.binary()))], ["node", "leader", "tokens"])

    return run


def _shared(nodes: DataFrame, order: str) -> DataFrame:
    """``nodes`` whose smallest hash in ``order`` another node has too, with the bucket's size.

    The sizes are staged, so that Spark can split the join where a bucket is hot.
    """
    sizes = nodes.groupBy(order).agg(F.count(F.lit(1)).alias("size")).where("size > 1")
    return nodes.join(stage(sizes, "sizes"), order)


def _group(nodes: DataFrame, sets: DataFrame, percent: int) -> tuple[DataFrame, DataFrame]:
    """(node, group, class): the leader that a node joined first, and the last leader above it.

    With it (group, tokens): the unions of groups of several nodes, one row for each turn in which a group grew.
    """
    up, unions, front = [], None, nodes
    for turn, k in enumerate((0, *range(ORDERS))):
        order = f"order{k}"
        part = F.pmod(F.xxhash64(F.lit(turn), "node"), F.ceil(F.col("size") / PART)).cast("int")
        shared = _shared(front, order).select(F.col(order).alias("bucket"), part.alias("part"), "node")
        shared = stage(shared, f"shared{turn}")
        dealt = sets.where(passes(shared, "node", bits=NODE_BITS)).join(shared, "node").select("bucket", "part", "node", "tokens").repartition("bucket", "part").sortWithinPartitions("bucket", "part", "node")
        led = stage(dealt.mapInArrow(_leaders(percent), "node long, leader long, tokens binary"), f"leaders{turn}")
        joined = led.where("node IS NOT NULL").select("node", "leader")
        union = led.where("node IS NULL").select(F.col("leader").alias("group"), "tokens")
        unions = union if unions is None else unions.union(union)
        up.append(joined)
        if turn < ORDERS:
            front = stage(front.join(joined, "node", "left_anti"), f"front{turn}")
    known = nodes.select("node", F.col("node").alias("class"), F.lit(None).cast("long").alias("group"))
    for joined in up:
        step = joined.select(F.col("node").alias("class"), "leader")
        known = known.join(step, "class", "left").select(
            "node", F.coalesce("group", F.when(F.col("leader").isNotNull() & (F.col("node") == F.col("class")), F.col("leader"))).alias("group"), F.coalesce("leader", "class").alias("class")
        )
    return known.select("node", F.coalesce("group", "node").alias("group"), "class"), unions


def _meetings(percent: int):
    """For ``mapInArrow`` over (token, class, group, node, n, at), sorted by token: (query, group) pairs of different classes.

    Of two classes in a list, the one with fewer nodes there asks. The position
    bound on the token must hold for some member; a pair is given once per block.
    Lists have at most ``SHORT`` rows, so all are compared at once: each row with
    the one ``step`` places on.
    """

    def fits(n, at, q, other):
        most = np.minimum(n[q] - at[q], n[other] - at[other])
        near = 100 * np.minimum(n[q], n[other]) >= percent * np.maximum(n[q], n[other])
        return near & ((100 + percent) * most >= percent * (n[q] + n[other]))

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in whole_groups(batches, ["token"]):
            starts = group_starts(rows, ["token"])
            ends = np.append(starts[1:], rows.num_rows)
            of, group, node = (rows.column(c).to_numpy() for c in ("class", "group", "node"))
            n, at = (rows.column(c).to_numpy().astype(np.int64) for c in ("n", "at"))
            classes_at = group_starts(rows, ["token", "class"])
            lengths = np.diff(np.append(classes_at, rows.num_rows))
            size = np.repeat(lengths, lengths)
            end = np.repeat(ends, ends - starts)
            asked, given = [], []
            left = np.arange(rows.num_rows)
            for step in range(1, SHORT):
                left = left[left + step < end[left]]
                if not len(left):
                    break
                i = left[of[left] != of[left + step]]
                i = i[fits(n, at, i, i + step)]
                j = i + step
                asks = (size[i] < size[j]) | ((size[i] == size[j]) & (of[i] < of[j]))
                asked.append(node[np.where(asks, i, j)])
                given.append(group[np.where(asks, j, i)])
            if asked:
                yield _pairs(asked, given)

    return run


def _long_meetings(percent: int):
    """For ``mapInArrow`` over (token, block, asks, class, size, of, least, most, room), groups first: the pairs of ``_meetings``.

    ``of`` is a group or a query; ``size`` counts its class in the list, ``least``
    and ``most`` are the smallest and largest set, and ``room`` is the most tokens
    any of them has from the listed one on. The bounds hold for some member at best.
    """

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in whole_groups(batches, ["token", "block"]):
            starts = group_starts(rows, ["token", "block"])
            asks = rows.column("asks").to_numpy(zero_copy_only=False)
            kind, size, of, least, most, room = (rows.column(c).to_numpy().astype(np.int64) for c in ("class", "size", "of", "least", "most", "room"))
            for low, high in zip(starts.tolist(), [*starts[1:].tolist(), rows.num_rows]):
                first = low + int(np.count_nonzero(~asks[low:high]))
                g = np.arange(low, first)[None, :]
                # As many queries at a time as keep the comparison with the groups small.
                step = max(1, PAIRS // max(1, first - low))
                for at in range(first, high, step):
                    q = np.arange(at, min(high, at + step))[:, None]
                    meet = (size[q] < size[g]) | ((size[q] == size[g]) & (kind[q] < kind[g]))
                    meet &= (100 * most[g] >= percent * most[q]) & (100 * most[q] >= percent * least[g])
                    meet &= (100 + percent) * np.minimum(room[q], room[g]) >= percent * (most[q] + least[g])
                    i, j = np.nonzero(meet)
                    if len(i):
                        yield _pairs([of[at + i]], [of[low + j]])

    return run


def _met(lists: DataFrame, percent: int) -> DataFrame:
    """(node, group): the queries and groups of different classes that share a listed token and pass its bounds.

    Short lists are compared row by row. Of a long list, groups are one row each,
    combined on the map side, and queries are dealt out in blocks of ``LONG``; the
    class that has most nodes in it asks nothing, so a list of one text's near
    copies and a few strangers sends the strangers only.
    """
    sized = lists.groupBy("token").agg(F.min("class").alias("low"), F.max("class").alias("high"), F.count(F.lit(1)).alias("many"))
    lists = stage(lists.join(sized.where("low < high").select("token", "many"), "token"), "bridging")
    pairs = "node long, group long"
    short = lists.where(F.col("many") <= SHORT).select("token", "class", "group", "node", "n", "at")
    short = short.repartition("token").sortWithinPartitions("token", "class", "node").mapInArrow(_meetings(percent), pairs)

    long = lists.where(F.col("many") > SHORT).drop("many")
    sizes = long.groupBy("token", "class").agg(F.count(F.lit(1)).alias("size"))
    last = sizes.groupBy("token").agg(F.max(F.struct("size", "class")).alias("last"), F.sum("size").alias("rows"))
    sizes = sizes.join(last, "token").withColumn("blocks", F.ceil((F.col("rows") - F.col("last.size")) / LONG).cast("int"))
    sizes = stage(sizes.select("token", "class", "size", "blocks", (F.struct("size", "class") < F.col("last")).alias("asking")), "long_sizes")
    width = [F.min("n").alias("least"), F.max("n").alias("most"), F.max(F.col("n") - F.col("at")).alias("room")]
    groups = long.groupBy("token", "class", F.col("group").alias("of")).agg(*width).join(sizes, ["token", "class"])
    groups = groups.withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).withColumn("asks", F.lit(False))
    queries = long.join(sizes.where("asking"), ["token", "class"]).withColumn("block", F.pmod(F.xxhash64("node"), "blocks").cast("int"))
    queries = queries.select("*", F.col("node").alias("of"), F.col("n").alias("least"), F.col("n").alias("most"), (F.col("n") - F.col("at")).alias("room"), F.lit(True).alias("asks"))
    columns = ["token", "block", "asks", "class", "size", "of", "least", "most", "room"]
    dealt = groups.select(*columns).union(queries.select(*columns)).repartition("token", "block").sortWithinPartitions("token", "block", "asks", "of")
    return short.union(dealt.mapInArrow(_long_meetings(percent), pairs)).distinct()


def _pairs(asked: list[np.ndarray], given: list[np.ndarray]) -> pa.RecordBatch:
    """The different pairs, once each."""
    a, b = np.concatenate(asked), np.concatenate(given)
    order = np.lexsort((b, a))
    a, b = a[order], b[order]
    new = np.ones(len(a), bool)
    new[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
    return pa.RecordBatch.from_arrays([pa.array(a[new], pa.int64()), pa.array(b[new], pa.int64())], ["node", "group"])


def _against(kind: str, compare):
    """For ``mapInArrow`` over (group, part, asks, node, tokens), a group's rows first: (query, group) pairs, and one more column.

    ``compare(tokens, node)`` gives the test of a query's tokens, from the tokens of
    a group's rows and the first one's node; what it returns is given unless None.
    """

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in whole_groups(batches, ["group", "part"]):
            starts = group_starts(rows, ["group", "part"])
            asks, nodes, groups = (rows.column(c).to_pylist() for c in ("asks", "node", "group"))
            tokens = [np.frombuffer(t.as_buffer(), np.uint64) for t in rows.column("tokens")]
            found: list[tuple[int, int, bool]] = []
            for low, high in zip(starts.tolist(), [*starts[1:].tolist(), rows.num_rows]):
                first = next((i for i in range(low, high) if asks[i]), high)
                if low == first or first == high:
                    continue
                test = compare(tokens[low:first], nodes[low])
                for q in range(first, high):
                    result = test(tokens[q])
                    if result is not None:
                        found.append((nodes[q], groups[low], result))
            columns = ([f[i] for f in found] for i in range(3))
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int64(), pa.bool_()))], ["node", "group", kind])

    return run, f"node long, group long, {kind} boolean"


def _bound(percent: int):
    """Queries whose need the group's union can fill: true for one that links with a group of one, false for one to open a larger group."""

    def compare(unions: list[np.ndarray], alone: int | None):
        union = functools.reduce(np.union1d, unions) if len(unions) > 1 else unions[0]

        def test(tokens: np.ndarray) -> bool | None:
            if overlap(tokens, union) < _least(len(tokens), percent):
                return None
            return False if alone is None else links(union, tokens, percent) or None

        return test

    return _against("linked", compare)


def _open(percent: int):
    """Queries that link with a member."""
    return _against("linked", lambda members, _: lambda tokens: any(links(m, tokens, percent) for m in members) or None)


def _ask(pairs: DataFrame, there: DataFrame, sets: DataFrame) -> DataFrame:
    """(group, part, asks, node, tokens), sorted: the rows ``there`` (group, node, tokens) and the queries of ``pairs``.

    The queries of a group are dealt out in parts of ``QUERIES``; its own rows go to each part.
    Only groups with more than one part are joined, which are few: the sets move once, to their parts.
    """
    many = stage(pairs.groupBy("group").agg(F.ceil(F.count(F.lit(1)) / QUERIES).cast("int").alias("parts")).where("parts > 1"), "many")
    parts = F.coalesce("parts", F.lit(1))
    part = F.pmod(F.xxhash64("node"), parts).cast("int")
    asking = pairs.join(many, "group", "left").select("group", part.alias("part"), F.lit(True).alias("asks"), "node").join(sets, "node")
    each = F.explode(F.sequence(F.lit(0), parts - 1)).alias("part")
    there = there.join(many, "group", "left").select("group", each, F.lit(False).alias("asks"), "node", "tokens")
    both = there.union(asking.select("group", "part", "asks", "node", "tokens"))
    return both.repartition("group", "part").sortWithinPartitions("group", "part", "asks", "node")


def classes(edges: DataFrame) -> DataFrame:
    """(node, class): the smallest node that the edges (a, b) connect a node with.

    Large-star and small-star in turn until nothing changes; each turn is staged.
    A hub's edges are pre-aggregated to its smallest neighbour, never gathered.
    """
    edges = stage(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct(), "edges")
    while True:
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        # Each larger neighbour hangs on the node's smallest neighbour.
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = stage(large.where("a <> b").distinct(), "edges")
        lower = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(lower, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").union(lower.select("a", F.col("m").alias("b")))
        small = stage(small.distinct(), "edges")
        changed = small.exceptAll(edges).limit(1).count() + edges.exceptAll(small).limit(1).count()
        edges = small
        if not changed:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("class"))


def components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = 80) -> DataFrame:
    """(id_col, n_shingles, component_id) for every row of ``docs``.

    ``component_id`` is the smallest id reachable by links, itself included.
    Texts are lower-cased in A-Z and cut at ASCII white space; fewer than five
    words make one shingle; null, empty and blank texts have no shingle and link
    with nothing. Repeated rows and equal sets share a component; null ids are
    never the smallest unless all are null. An empty table gives an empty
    result; other columns are not read.
    """
    rows = keyed(docs, id=id_col, text=text_col)
    run, schema = _read_sets(rows.schema["id"].dataType.simpleString())
    read = stage(rows.mapInArrow(run, schema), "sets")
    known = read.where("block IS NULL").drop("block", "counts")
    counts = read.where("block IS NOT NULL").select("block", "counts").repartition("block").sortWithinPartitions("block")
    levels = {r["block"]: r["levels"] for r in counts.mapInArrow(_add_counts, "block int, levels binary").collect()}
    empty = bytes((1 << CELL_BITS) // CELL_BLOCKS)
    level = np.frombuffer(b"".join(levels.get(b, empty) for b in range(CELL_BLOCKS)), np.uint8)
    orders = [f"order{k}" for k in range(ORDERS)]
    nodes = stage(known.where("n > 0").groupBy("node").agg(F.min("id").alias("id"), *(F.first(c).alias(c) for c in orders)), "nodes")

    shared = None
    for order in orders:
        some = _shared(nodes, order).select("node", "id")
        shared = some if shared is None else shared.union(some)
    sets = _sets(rows, stage(shared.distinct(), "shared"), "tokens")
    grouped, unions = _group(nodes, sets, percent)
    grouped = stage(grouped, "grouped")

    tokens = stage(rows.mapInArrow(_rare_tokens(level, percent), "token long, node long, n int, at int").repartition("token").sortWithinPartitions("token", "node").mapInArrow(_lists, "token long, node long, n int, at int"), "lists")
    lists = tokens.join(grouped, "node").select("token", "class", "group", "node", "n", "at")
    met = stage(_met(lists, percent), "met")

    # The bound reads stored unions and the sets of queries and of groups of one; members are read where it is reached.
    several = unions.select("group").distinct()
    alone = stage(met.select("group").distinct().join(several, "group", "left_anti"), "alone")
    need = met.select("node").union(alone).distinct()
    asked = _sets(rows, stage(nodes.join(need, "node", "left_semi").select("node", "id"), "needed"), "asked")
    single = alone.withColumn("node", F.col("group")).join(asked, "node").select("group", "node", "tokens")
    there = unions.where(passes(met, "group", bits=NODE_BITS)).select("group", F.lit(None).cast("long").alias("node"), "tokens").union(single)
    run, schema = _bound(percent)
    reached = stage(_ask(met, there, asked).mapInArrow(run, schema), "reached")
    opened = stage(reached.where("NOT linked").select("node", "group"), "opened")
    members = grouped.join(opened.select("group").distinct(), "group", "left_semi").select("group", "node")
    run, schema = _open(percent)
    # Narrow rows pick the sets first, so that sets without a part in this are not moved.
    members, askers = stage(members, "members"), opened.select("node").distinct()
    inside = sets.where(passes(members, "node", bits=NODE_BITS)).join(members, "node").select("group", "node", "tokens")
    exact = stage(_ask(opened, inside, asked.where(passes(askers, "node", bits=NODE_BITS))).mapInArrow(run, schema), "links")
    linked = reached.where("linked").union(exact).select("node", "group")

    of = grouped.select("node", "class")
    edges = linked.join(of, "node").select("group", F.col("class").alias("a")).join(of.select(F.col("node").alias("group"), F.col("class").alias("b")), "group").select("a", "b")
    last = classes(edges).select(F.col("node").alias("class"), F.col("class").alias("last"))
    final = stage(of.join(last, "class", "left").select("node", F.coalesce("last", "class").alias("class")), "classes")
    # Only classes of several nodes need a look at other nodes' ids.
    least = final.join(nodes.select("node", "id"), "node").groupBy("class").agg(F.min("id").alias("least"))
    named = final.join(least, "class").select("node", "least")
    found = known.join(named, "node", "left")
    return found.select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), F.when(F.col("n") > 0, F.col("least")).otherwise(F.col("id")).alias("component_id"))


@tidy
def _lists(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by token and node: those of tokens that two nodes or more have, each once."""
    for rows in whole_groups(batches, ["token"]):
        token, node = rows.column("token").to_numpy(), rows.column("node").to_numpy()
        once = np.ones(len(token), bool)
        once[1:] = (token[1:] != token[:-1]) | (node[1:] != node[:-1])
        starts = group_starts(rows, ["token"])
        many = np.add.reduceat(once, starts, dtype=np.int64) > 1
        keep = once & np.repeat(many, np.diff(np.append(starts, len(token))))
        yield from rows.filter(pa.array(keep)).combine_chunks().to_batches()


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = 80) -> DataFrame:
    """The rows of ``docs``, all columns, of one document per component: the one with the smallest id.

    Documents without words stay. Rows that repeat an id go or stay together.
    """
    found = components(docs, id_col, text_col, percent)
    (name,) = fresh(docs, "gone")
    gone = stage(found.where(F.col("component_id") != F.col(id_col)).select(F.col(id_col).alias(name)).distinct(), "gone")
    # Rows that the bit table lets pass stay where they are; only the others are moved.
    known, columns = docs.withColumn(name, F.col(f"`{id_col}`")), [F.col(f"`{c}`") for c in docs.columns]
    suspect = passes(gone, name, bits=NODE_BITS)
    left = known.where(suspect).join(gone, name, "left_anti")
    return known.where(~suspect).select(*columns).unionByName(left.select(*columns))
