"""Merkle manifest of a table: one tree per partition, one tree over their roots, and a witness for every row.

Rows append in order, and witnesses grow with them. A *frontier* holds the open subtrees of a stream of appends, each
with its root and the partial witnesses of its leaves. When a subtree gets a sibling of its own height, both become one
subtree, and the witnesses of either side are extended by the root of the other.

1. The leaf digests alone are range-partitioned by (tree, id) and numbered in their tree: rows per partition are
   counted, and prefix sums of these counts give each partition its offset.
2. ``2**BITS`` consecutive leaves make an aligned block, the work of one frontier. The root of each block is a further
   append: blocks of block roots follow in the same way, until each tree has one node.
3. The roots of the trees are the appends of one more tree. Witnesses of blocks are joined to those of their rows.

A last node without a sibling is hashed alone, level by level, as long as its tree has more than one node.
A witness lists one step per level: ``L`` or ``R`` and the digest of the sibling on that side, or an empty string.

Defined cases: a null value counts as ``-``, a null tree is a tree of its own and comes first, null ids come first in
their tree; rows of one id follow by leaf, and repeated rows are leaves of their own. One row is its own root. An empty
table has no root and gives an empty result. Columns that are not named are ignored, whatever they are called.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from narrata.llm.common import stage, tidy

#: Levels of one block: its frontier holds 2**BITS leaves and so many partial witnesses.
BITS = 10


def digest(*parts: str) -> str:
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def encoded(value: Column) -> Column:
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf(*values: Column) -> Column:
    """The digest of a row: each value as its UTF-8 byte count, a colon and the value, or ``-`` for null."""
    return F.sha2(F.concat(*[encoded(v) for v in values]), 256)


class Frontier:
    """The open subtrees of a stream of appends, from the highest and first to the lowest and last."""

    def __init__(self):
        self.open: list[tuple[int, str, list[int]]] = []  # height, root, leaves
        self.witness: list[list[str]] = []

    def append(self, node: str) -> None:
        self.witness.append([])
        self.open.append((0, node, [len(self.witness) - 1]))
        while len(self.open) > 1 and self.open[-1][0] == self.open[-2][0]:
            self.unite()

    def unite(self) -> None:
        """Make the last two subtrees, of one height, one."""
        (height, left, ours), (_, right, theirs) = self.open[-2:]
        for i in ours:
            self.witness[i].append("R" + right)
        for i in theirs:
            self.witness[i].append("L" + left)
        self.open[-2:] = [(height + 1, digest(left, right), ours + theirs)]

    def close(self, height: int | None) -> str:
        """The root of all appends: a last subtree without a sibling is hashed alone, up to ``height`` if given."""
        while len(self.open) > 1 or height is not None and self.open[0][0] < height:
            level, root, leaves = self.open[-1]
            if len(self.open) > 1 and self.open[-2][0] == level:
                self.unite()
                continue
            for i in leaves:
                self.witness[i].append("")
            self.open[-1] = (level + 1, digest(root), leaves)
        return self.open[0][1]


def numbered(rows: DataFrame, tree: str, order: list[str]) -> DataFrame:
    """``rows`` with ``rank`` and ``n``: the place in the order of its tree, from 0, and the size of the tree."""
    place = F.monotonically_increasing_id()
    dealt = rows.repartitionByRange(tree, *order).sortWithinPartitions(tree, *order)
    dealt = stage(dealt.withColumn("place", place)).withColumn("part", F.shiftright("place", 33))
    parts = dealt.groupBy(tree, "part").agg(F.min("place").alias("first"), F.count("*").alias("here"))
    before = Window.partitionBy(tree).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select(tree, "part", "first", F.coalesce(F.sum("here").over(before), F.lit(0)).alias("offset"), F.sum("here").over(Window.partitionBy(tree)).alias("n"))
    joined = dealt.join(parts, [tree, "part"])
    return joined.withColumn("rank", F.col("offset") + F.col("place") - F.col("first")).drop("part", "place", "first", "offset")


def appended(nodes: DataFrame, bits: int, carry: tuple[str, ...] = ()) -> DataFrame:
    """Staged (tree, rank, n, block, steps, root, *carry) of ``nodes`` (tree, rank, n, node): each node's witness within its
    block, and the root of the block."""
    names = ["tree", "rank", "n", "block", *carry]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        frontier = Frontier()

        def closed() -> pa.RecordBatch:
            rows = pa.Table.from_batches(held).combine_chunks()
            root = frontier.close(bits if rows.column("n")[0].as_py() > 1 << bits else None)
            made = [pa.array(frontier.witness, pa.list_(pa.string())), pa.array([root] * rows.num_rows)]
            return pa.Table.from_arrays([*rows.select(names).columns, *made], [*names, "steps", "root"]).combine_chunks().to_batches()[0]

        for batch in batches:
            place = batch.column("rank").to_numpy() & ((1 << bits) - 1)
            starts = [0, *[i for i in np.flatnonzero(place == 0).tolist() if i], batch.num_rows]
            for x, y in zip(starts[:-1], starts[1:], strict=True):
                if x < y and place[x] == 0 and held:
                    yield closed()
                    held, frontier = [], Frontier()
                if x < y:
                    held.append(batch.slice(x, y - x))
                    for node in held[-1].column("node").to_pylist():
                        frontier.append(node)
        if held:
            yield closed()

    dealt = nodes.withColumn("block", F.shiftright("rank", bits)).repartition("tree", "block").sortWithinPartitions("tree", "block", "rank")
    types = {f.name: f.dataType.simpleString() for f in dealt.schema}
    return stage(dealt.mapInArrow(tidy(run), ", ".join([*[f"{c} {types[c]}" for c in names], "steps array<string>", "root string"])))


def climbed(low: DataFrame, bits: int) -> DataFrame:
    """Staged (tree, block, above, top) for the blocks of ``low``: the witness from the root of each block to that of its tree."""
    heads = low.filter(F.col("rank") == F.shiftleft("block", bits))
    nodes = heads.select("tree", F.col("block").alias("rank"), F.shiftright(F.col("n") + ((1 << bits) - 1), bits).alias("n"), F.col("root").alias("node"))
    if (nodes.agg(F.max("n")).first()[0] or 0) <= 1:
        return stage(nodes.select("tree", F.col("rank").alias("block"), F.array().cast("array<string>").alias("above"), F.col("node").alias("top")))
    high = appended(nodes, bits)
    steps = high.join(climbed(high, bits), ["tree", "block"])
    return stage(steps.select("tree", F.col("rank").alias("block"), F.concat("steps", "above").alias("above"), "top"))


def manifest(docs: DataFrame, id: str = "doc_id", tree: str = "lang", fields: tuple[str, ...] = ("doc_id", "source", "lang", "n_chars", "text"),
             changed: dict[str, Column] | None = None, bits: int = BITS) -> DataFrame:
    """(doc_id, leaf, other, subroot, root, steps) per row, ``steps`` being its witness from the leaf to the root.

    Each value of ``tree`` has a subroot, and the subroots, nulls first, have the root. ``other`` is the leaf with the
    columns of ``changed`` in place of the table's own, for checks of what a witness finds.
    """
    named = {c: F.col(f"`{c}`") for c in fields}
    rows = docs.select(
        F.col(f"`{id}`").cast("long").alias("doc_id"), F.coalesce(F.concat(F.lit("="), F.col(f"`{tree}`").cast("string")), F.lit("")).alias("tree"),
        leaf(*named.values()).alias("node"), leaf(*(named | (changed or {})).values()).alias("other"))
    low = appended(numbered(rows, "tree", ["doc_id", "node"]), bits, ("doc_id", "node", "other"))
    up = climbed(low, bits)
    roots = up.filter("block = 0").select(F.lit("").alias("all"), "tree", F.col("top").alias("node"))
    trees = appended(numbered(roots, "all", ["tree"]).withColumnsRenamed({"tree": "name", "all": "tree"}), bits, ("name",))
    whole = trees.join(climbed(trees, bits).withColumnRenamed("top", "whole"), ["tree", "block"])
    whole = whole.select(F.col("name").alias("tree"), F.concat("steps", "above").alias("last"), "whole")
    up = stage(up.join(whole, "tree").select("tree", "block", F.concat("above", "last").alias("above"), "top", "whole"))
    out = low.join(up, ["tree", "block"])
    return out.select("doc_id", F.col("node").alias("leaf"), "other", F.col("top").alias("subroot"), F.col("whole").alias("root"), F.concat("steps", "above").alias("steps"))


def proof(steps: Column) -> Column:
    """The digest of the siblings of a witness, from the leaf's level up."""
    return F.sha2(F.array_join(F.transform(steps, lambda s: F.substring(s, 2, 64)), ""), 256)


def folded(node: Column, steps: Column) -> Column:
    """The root that a leaf and its witness lead to."""
    sibling = lambda s: F.substring(s, 2, 64)
    return F.aggregate(steps, node, lambda at, s: F.sha2(
        F.when(s.startswith("L"), F.concat(sibling(s), at)).when(s.startswith("R"), F.concat(at, sibling(s))).otherwise(at), 256))
