"""A Merkle manifest of a dataset: a tree per source, a tree over the sources, and a proof for every row.

A row's leaf is the sha256 of its fields, each with its length. Within a source,
leaves stand by id; every ``FAN`` neighbours make a node, level by level, until
one node is left, the source's subroot. Subroots, by source, make the root alike.

Leaves get their places from a range-partitioned sort and counts per partition,
so no source, however large, is one task. A leaf partition is a block of
``FAN ** span`` leaves of one source; all interiors of such a block follow from its own leaves.

Proofs are octopus multiproofs: a partition computes the least set of nodes that
all its leaves together miss, fetches each of them once, by one join with the
nodes above the blocks, derives the interiors that its leaves share, and expands
every leaf's own proof from them. Repeated rows are leaves of their own.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfwise.llm.common import group_starts, small_batches, stage, tidy, whole_groups
from shelfwise.session import one_value

FAN = 3
#: Levels of a tree that one block of neighbours spans, by default.
SPAN = 6
#: The number of the tree over the subroots; sources' trees have theirs from 0.
TOP = -1


def _joined(parts: list[bytes]) -> bytes:
    return hashlib.sha256(b"".join(parts)).hexdigest().encode()


def _raised(nodes: list[bytes]) -> list[bytes]:
    """The next level: one node for each run of ``FAN``."""
    return [_joined(nodes[i : i + FAN]) for i in range(0, len(nodes), FAN)]


def widths(leaves: int) -> list[int]:
    """Nodes on each level of a tree, from its leaves to its one top node."""
    out = [leaves]
    while out[-1] > 1:
        out.append(-(-out[-1] // FAN))
    return out


def missing(places: np.ndarray, leaves: int) -> list[np.ndarray]:
    """By level, the places of the nodes that proofs of the leaves at ``places`` need and that don't follow from these leaves."""
    known, out = np.unique(places), []
    for width in widths(leaves)[:-1]:
        parents = np.unique(known // FAN)
        family = (parents[:, None] * FAN + np.arange(FAN)).reshape(-1)
        out.append(np.setdiff1d(family[family < width], known, assume_unique=True))
        known = parents
    return out


def field(value: Column) -> Column:
    """A field as it enters a leaf: ``-`` if null, else its length in bytes, a colon, and the value."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def _placed(rows: DataFrame, tree: list[str], order: list[str], label: str) -> DataFrame:
    """``rows`` with their ``place`` within a tree, by ``order``, and the tree's number of ``leaves``; nulls come first."""
    ordered = rows.repartitionByRange(*tree, *order).sortWithinPartitions(*tree, *order)
    ordered = stage(ordered.withColumn("at", F.monotonically_increasing_id()), label)
    # A number holds the partition in its upper bits and the row in it in the 33 lower ones.
    part = F.shiftrightunsigned("at", 33)
    runs = ordered.groupBy(part.alias("part"), *tree).agg(F.min("at").alias("first"), F.count(F.lit(1)).alias("n"))
    whole = Window.partitionBy(*(tree or [F.lit(0)]))
    before = F.sum("n").over(whole.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    runs = runs.withColumns({"before": F.coalesce(before, F.lit(0)), "leaves": F.sum("n").over(whole)})
    runs = runs.select(F.col("part").alias("run_part"), *(F.col(c).alias(f"run_{c}") for c in tree), "first", "before", "leaves")
    on = part == F.col("run_part")
    for c in tree:
        on = on & F.col(c).eqNullSafe(F.col(f"run_{c}"))
    return ordered.join(runs, on).select(*rows.columns, (F.col("at") - F.col("first") + F.col("before")).alias("place"), "leaves")


def _rise(least: int, span: int):
    """For ``mapInArrow`` over blocks of (tree, place, leaves, hash): the nodes 1 to ``span`` levels up, as (tree, up, place, leaves, hash).

    Of those less than ``least`` up, only the top nodes of trees are given.
    """

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.string())
        for rows in whole_groups(batches, ["tree", "block"]):
            out: list[tuple] = []
            tree, place, leaves = (rows.column(c).to_numpy() for c in ("tree", "place", "leaves"))
            hashes = rows.column("hash").cast(pa.binary()).to_pylist()
            starts = group_starts(rows, ["tree", "block"]).tolist()
            for low, high in zip(starts, [*starts[1:], len(tree)]):
                nodes, first, width = hashes[low:high], int(place[low]), int(leaves[low])
                for up in range(1, span + 1):
                    if width == 1:
                        break
                    nodes, first, width = _raised(nodes), first // FAN, -(-width // FAN)
                    if up >= least or width == 1:
                        out += ((int(tree[low]), up, first + k, width, n.decode()) for k, n in enumerate(nodes))
            columns = zip(*out) if out else [[]] * 5
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], ["tree", "up", "place", "leaves", "hash"])

    return run


def forest(leaves: DataFrame, floor: int = 0, span: int = SPAN) -> DataFrame:
    """(tree, level, place, leaves, hash): the nodes of the trees over ``leaves`` (tree, place, leaves, hash).

    ``leaves`` becomes the number of nodes on the level, 1 for a top node. Below
    level ``floor`` only top nodes are given. A pass makes ``span`` levels, so
    there are as many passes as the largest tree needs.
    """
    block = F.floor(F.col("place") / FAN**span).cast("long")
    level, out = 0, leaves.select("tree", F.lit(0).alias("level"), "place", "leaves", "hash")
    if floor:
        out = out.where("leaves = 1")
    while True:
        dealt = leaves.select("tree", "place", "leaves", "hash", block.alias("block")).repartition("tree", "block").sortWithinPartitions("tree", "block", "place")
        raised = stage(dealt.mapInArrow(_rise(floor - level, span), "tree long, up int, place long, leaves long, hash string"), "nodes")
        out = out.union(raised.select("tree", (F.col("up") + level).alias("level"), "place", "leaves", "hash"))
        leaves, level = raised.where((F.col("up") == span) & (F.col("leaves") > 1)), level + span
        if leaves.isEmpty():
            return out


def _wanted(span: int):
    """For ``mapInArrow`` over (tree, block, leaves, trees): the coordinates that each block misses, its source's tree first."""

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds, size = (pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64()), FAN**span
        for batch in batches:
            out: list[tuple] = []
            for tree, block, leaves, trees in zip(*(c.to_pylist() for c in batch.columns)):
                own = np.arange(block * size, min((block + 1) * size, leaves))
                for of, places, width in ((tree, own, leaves), (TOP, np.array([tree]), trees)):
                    out += ((tree, block, of, level, p) for level, need in enumerate(missing(places, width)) for p in need.tolist())
            columns = zip(*out) if out else [[]] * 5
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], ["tree", "block", "node_tree", "node_level", "node_place"])

    return run


class _Proofs:
    """One block's proofs: the interiors it derives, and the nodes above that it fetched."""

    def __init__(self, first: int, leaves: list[bytes], width: int, trees: int, tree: int, fetched: dict[tuple[int, int, int], bytes], span: int):
        #: The block's own nodes by level, and the place of the first of each.
        self.own, self.widths = [(first, leaves)], widths(width)
        while len(self.own) <= span and len(self.own) < len(self.widths):
            at, nodes = self.own[-1]
            self.own.append((at // FAN, _raised(nodes)))
        # Above the block, all its leaves share the way: (siblings left of it, right of it) up to the root.
        self.above: list[tuple[bytes, bytes]] = []
        at, node = self.own[-1][0], self.own[-1][1][0]
        for of, level, place, sizes in ((tree, len(self.own) - 1, at, self.widths), (TOP, 0, tree, widths(trees))):
            for step in range(level, len(sizes) - 1):
                run = range(place // FAN * FAN, min((place // FAN + 1) * FAN, sizes[step]))
                left, right = (b"".join(fetched[of, step, p] for p in run if (p < place) == side and p != place) for side in (True, False))
                self.above.append((left, right))
                node, place = _joined([left, node, right]), place // FAN
            if of == tree:
                self.subroot = node
        self.shared = b"".join(left + right for left, right in self.above)

    def of(self, place: int, leaf: bytes) -> tuple[str, str]:
        """The hash of the siblings of the leaf at ``place``, and the root that ``leaf`` gives with them."""
        siblings, at = [], place
        for low, nodes in self.own[:-1]:
            k = at - low
            start = k // FAN * FAN
            left, right = b"".join(nodes[start:k]), b"".join(nodes[k + 1 : start + FAN])
            siblings += (left, right)
            leaf, at = _joined([left, leaf, right]), at // FAN
        for left, right in self.above:
            leaf = _joined([left, leaf, right])
        return _joined([*siblings, self.shared]).decode(), leaf.decode()


def _expand(span: int):
    """For ``mapInArrow`` over blocks of fetched nodes and leaves, nodes first: the proofs of all leaves."""

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["id", "leaf", "subroot", "proof_sha256", "folded_root"]
        for rows in whole_groups(batches, ["tree", "block"]):
            starts = group_starts(rows, ["tree", "block"]).tolist()
            is_leaf = rows.column("is_leaf").to_numpy()
            trees, leaves, sources = (rows.column(c).to_numpy() for c in ("trees", "leaves", "tree"))
            place, level, of = (rows.column(c).to_numpy() for c in ("place", "node_level", "node_tree"))
            hashes = rows.column("hash").cast(pa.binary()).to_pylist()
            others = rows.column("other").cast(pa.binary()).to_pylist()
            picked, out = [], []
            for low, high in zip(starts, [*starts[1:], len(place)]):
                first = low + int(np.count_nonzero(~is_leaf[low:high]))
                fetched = {(int(of[k]), int(level[k]), int(place[k])): hashes[k] for k in range(low, first)}
                proofs = _Proofs(int(place[first]), hashes[first:high], int(leaves[first]), int(trees[first]), int(sources[first]), fetched, span)
                subroot = proofs.subroot.decode()
                for k in range(first, high):
                    out.append((hashes[k].decode(), subroot, *proofs.of(int(place[k]), others[k])))
                picked.append(np.arange(first, high))
            ids = pa.concat_arrays(rows.column("id").chunks).take(pa.array(np.concatenate(picked)))
            yield pa.RecordBatch.from_arrays([ids, *(pa.array(c, pa.string()) for c in zip(*out))], names)

    return run


def manifest(docs: DataFrame, fields: list[str], checked: dict[str, Column] | None = None, id_col: str = "doc_id", source_col: str = "source", span: int = SPAN) -> DataFrame:
    """(id_col, leaf, subroot, root, proof_sha256, folded_root, verified) for every row of ``docs``.

    ``fields`` enter a leaf in this order. ``checked`` has other values of some of
    them, as columns of ``docs``: ``folded_root`` is what the row gives with them
    and the original's siblings, ``verified`` whether that is the root. Null ids
    and null sources come first; rows with one id stand by their leaves, and equal
    rows are leaves of their own. Other columns are not read. An empty table gives
    an empty result.
    """
    plain = {c: F.col(f"`{c}`") for c in fields}
    leaf, other = (F.sha2(F.concat(*(field(c) for c in of.values())), 256) for of in (plain, plain | (checked or {})))
    rows = small_batches(docs).select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{source_col}`").cast("string").alias("source"), leaf.alias("hash"), other.alias("other"))
    placed = _placed(rows, ["source"], ["id", "hash"], "leaves")
    trees = _placed(placed.select("source").distinct(), [], ["source"], "sources")
    trees = stage(trees.select(F.col("source").alias("named"), F.col("place").alias("tree"), F.col("leaves").alias("trees")), "trees")
    leaves = placed.join(trees, F.col("source").eqNullSafe(F.col("named"))).drop("source", "named")
    leaves = stage(leaves.withColumn("block", F.floor(F.col("place") / FAN**span).cast("long")), "placed")

    upper = stage(forest(leaves, span, span), "upper")
    top = upper.where("leaves = 1").select(F.lit(TOP).cast("long").alias("tree"), F.col("tree").alias("place"), "hash")
    sizes = trees.select(F.col("tree").alias("place"), F.col("trees").alias("leaves"))
    top = stage(forest(top.join(sizes, "place"), span=span), "top")
    root = one_value(top.where("leaves = 1"), F.max("hash"))

    blocks = leaves.groupBy("tree", "block").agg(F.max("leaves").alias("leaves"), F.max("trees").alias("trees"))
    wanted = blocks.mapInArrow(_wanted(span), "tree long, block long, node_tree long, node_level int, node_place long")
    nodes = upper.union(top).select(F.col("tree").alias("node_tree"), F.col("level").alias("node_level"), F.col("place").alias("node_place"), "hash")
    fetched = wanted.join(nodes, ["node_tree", "node_level", "node_place"]).withColumn("is_leaf", F.lit(False))
    own = leaves.withColumns({"node_tree": F.lit(0).cast("long"), "node_level": F.lit(0), "is_leaf": F.lit(True)})
    both = own.unionByName(fetched.withColumnRenamed("node_place", "place"), allowMissingColumns=True)
    dealt = both.repartition("tree", "block").sortWithinPartitions("tree", "block", "is_leaf", "place")
    kind = rows.schema["id"].dataType.simpleString()
    out = dealt.mapInArrow(_expand(span), f"id {kind}, leaf string, subroot string, proof_sha256 string, folded_root string")
    return out.select(F.col("id").alias(id_col), "leaf", "subroot", root.alias("root"), "proof_sha256", "folded_root", (F.col("folded_root") == root).alias("verified"))
