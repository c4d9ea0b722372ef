"""Merkle dataset manifest: a hash tree over the rows of each group, a tree over the groups, and for every row the
authentication path to the one root.

Paths come from a tree traversal: in a block of 3**HEIGHT leaves that stands where the tree has a subtree of its own, each
level has a treehash stack that takes one leaf a step and stays one run ahead, so that a leaf's path is ready when its turn
comes and memory grows with the levels, not with the leaves. Blocks' roots are the leaves of the levels above,
which are walked alike; what lies above a block is found once and appended to the paths of all its leaves.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from .common import materialize

#: Nodes of a run, and levels that a block climbs.
ARITY, HEIGHT = 3, 5
BLOCK = ARITY**HEIGHT


def digest(joined: str) -> str:
    return sha256(joined.encode()).hexdigest()


class Treehash:
    """Nodes of one level, from one leaf at a time; at most ARITY - 1 of each level below wait in it."""

    def __init__(self, level: int):
        self.runs: list[list[str]] = [[] for _ in range(level)]

    def add(self, node: str) -> str | None:
        """The level's next node, if this leaf completes it."""
        for run in self.runs:
            run.append(node)
            if len(run) < ARITY:
                return None
            node = digest("".join(run))
            run.clear()
        return node

    def end(self) -> str | None:
        """The last node, if its runs have fewer nodes than ARITY."""
        node = None
        for run in self.runs:
            if node is not None:
                run.append(node)
            node = digest("".join(run)) if run else None
            run.clear()
        return node


def levels_of(leaves: int) -> int:
    """Levels from that many leaves to a single node."""
    out = 0
    while leaves > 1:
        leaves, out = -(-leaves // ARITY), out + 1
    return out


def climbed(leaves: list[str], levels: int) -> str:
    """The node that all leaves have levels above them."""
    stack, node = Treehash(levels), None
    for x in leaves:
        node = stack.add(x)
    return stack.end() if node is None else node


def traversed(leaves: list[str], levels: int) -> Iterator[list[tuple[list[str], list[str]]]]:
    """Of each leaf in turn its siblings to the left and to the right, level by level.

    The stack of level h makes the nodes of the run that comes next on its level while leaves of the present run are
    visited: a leaf a step, which is as many as there are."""
    width = [ARITY ** (h + 1) for h in range(levels)]
    stacks, now, coming = [Treehash(h) for h in range(levels)], [[] for _ in range(levels)], [[] for _ in range(levels)]

    def take(h: int, place: int, into: list[str]) -> None:
        into += [x for x in (stacks[h].add(leaves[place]), stacks[h].end() if place == len(leaves) - 1 else None) if x is not None]

    for h in range(levels):
        for place in range(min(width[h], len(leaves))):
            take(h, place, now[h])
    for i in range(len(leaves)):
        for h in range(levels):
            if i and i % width[h] == 0:
                now[h], coming[h] = coming[h], []
        own = [i * ARITY // width[h] % ARITY for h in range(levels)]
        yield [(run[:k], run[k + 1 :]) for run, k in zip(now, own, strict=True)]
        for h in range(levels):
            if i + width[h] < len(leaves):
                take(h, i + width[h], coming[h])


def folded(node: str, path: str) -> str:
    """The root that a leaf and its path lead to."""
    for level in path.split("/") if path else ():
        left, right = level.split(":")
        node = digest(left + node + right)
    return node


def row_digest(*fields: Column) -> Column:
    """SHA-256 in hex of a row: of each field its bytes in UTF-8, their number before it, or - where it is null."""
    texts = [f.cast("string") for f in fields]
    return F.sha2(F.concat(*(F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts)).cast("binary"), 256)


def _placed(rows: DataFrame, tree: str, *order: str) -> DataFrame:
    """rows with place (0, 1, ...) in their tree and total, the number of the tree's rows. Ranges are sorted each on
    their own; only their counts are summed."""
    ordered = rows.repartitionByRange(tree, *order).sortWithinPartitions(tree, *order)
    ordered = materialize(ordered.withColumn("part", F.spark_partition_id()).withColumn("line", F.monotonically_increasing_id()), "ordered")
    counts = ordered.groupBy(tree, "part").agg(F.count("*").alias("m"), F.min("line").alias("first"))
    before = F.coalesce(F.sum("m").over(Window.partitionBy(tree).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    counts = counts.select(tree, "part", (before - F.col("first")).alias("shift"), F.sum("m").over(Window.partitionBy(tree)).alias("total"))
    return ordered.join(counts, [tree, "part"]).withColumn("place", F.col("line") + F.col("shift")).drop("part", "line", "shift")


def _blocks(nodes: DataFrame) -> DataFrame:
    return nodes.withColumn("block", F.expr(f"place div {BLOCK}"))


def _levels(total: int) -> int:
    """Levels that blocks of a tree climb: all of them if the tree has more than one block."""
    return HEIGHT if total > BLOCK else levels_of(total)


def _in_order(t: pa.Table) -> pa.Table:
    return t.sort_by("place")


def _climb(nodes: DataFrame) -> tuple[list[DataFrame], DataFrame]:
    """The nodes of every HEIGHT levels of all trees, from (tree, place, total, node), and (tree, root)."""

    def up(t: pa.Table) -> pa.Table:
        total = t.column("total")[0].as_py()
        node = climbed(_in_order(t).column("node").to_pylist(), _levels(total))
        return pa.table({"tree": t.column("tree")[:1], "place": t.column("block")[:1], "total": pa.array([-(-total // BLOCK)], pa.int64()), "node": pa.array([node])})

    steps, roots = [nodes], None
    while True:
        above = _blocks(steps[-1].select("tree", "place", "total", "node")).groupBy("tree", "block").applyInArrow(up, "tree string, place long, total long, node string")
        above = materialize(above, "nodes")
        done = above.where("total = 1").select("tree", F.col("node").alias("root"))
        roots = done if roots is None else roots.union(done)
        above = above.where("total > 1")
        if above.isEmpty():
            return steps, roots
        steps.append(above)


def _walk(kept: str) -> Callable[[pa.Table, pa.Table], pa.Table]:
    names = [x.split()[0] for x in kept.split(", ")]

    def walk(left: pa.Table, right: pa.Table) -> pa.Table:
        """The paths of a block's nodes; right has the one of the block itself."""
        left, above = _in_order(left), right.column("path")[0].as_py()
        found = []
        for levels in traversed(left.column("node").to_pylist(), _levels(left.column("total")[0].as_py())):
            own = "/".join("".join(a) + ":" + "".join(b) for a, b in levels)
            found.append(f"{own}/{above}" if own and above else own or above)
        same = pa.array([right.column("subroot")[0].as_py()] * len(left), pa.string())
        return pa.table([*(left.column(c) for c in names), pa.array(found, pa.string()), same], names=[*names, "path", "subroot"])

    return walk


def _paths(steps: list[DataFrame], tops: DataFrame, keep: str) -> DataFrame:
    """(path, subroot) of each node of the lowest step, with its columns of keep (a schema); tops has tree, path (of the
    tree's root) and subroot."""
    paths = None
    for i in reversed(range(len(steps))):
        kept = "tree string, place long" if i else keep
        top = steps[i].where((F.col("place") == 0) & (F.col("total") <= BLOCK)).select("tree").join(tops, "tree").select("tree", F.lit(0).cast("long").alias("place"), "path", "subroot")
        upper = top if paths is None else paths.union(top)
        upper = upper.select(F.col("tree").alias("of_tree"), F.col("place").alias("of_block"), F.col("path").alias("path"), F.col("subroot").alias("subroot"))
        paths = _blocks(steps[i]).groupBy("tree", "block").cogroup(upper.groupBy("of_tree", "of_block")).applyInArrow(_walk(kept), f"{kept}, path string, subroot string")
        if i:
            paths = materialize(paths, "paths")
    return paths


def merkle_manifest(docs: DataFrame, fields: tuple[str, ...] = ("doc_id", "source", "lang", "n_chars", "text"), group_col: str = "source", id_col: str = "doc_id", also: Column | None = None) -> DataFrame:
    """One leaf for each row of docs: id, leaf, also, path, subroot, root.

    Leaves of a group ascend by id (nulls first, then by leaf); every ARITY consecutive nodes become one, the last
    run may have fewer. Groups ascend by name (null first, by bytes), and their roots form the tree of trees in the same
    way. path lists for each level, from the leaf's to the root's, the siblings before and after the node as left:right,
    levels parted by /; a group or table of one row has an empty path. also is carried along as text. Repeated rows
    are leaves of their own; other columns are not read; an empty table gives an empty result. No group is gathered: a
    group's leaves lie in blocks of 3**HEIGHT."""
    tree = F.coalesce(F.concat(F.lit("+"), F.col(group_col).cast("string")), F.lit(""))
    rows = docs.select(tree.alias("tree"), F.col(id_col).cast("long").alias("id"), row_digest(*(F.col(c) for c in fields)).alias("node"), (F.lit(None) if also is None else also).cast("string").alias("also"))
    steps, roots = _climb(_placed(rows, "tree", "id", "node"))
    roots = materialize(roots, "roots")
    groups = roots.select(F.lit("").alias("tree"), F.col("tree").alias("name"), F.col("root").alias("node"))
    top_steps, top = _climb(_placed(groups, "tree", "name"))
    found = top.first()
    root = found.root if found else None
    of_groups = _paths(top_steps, top.select("tree", F.lit("").alias("path"), F.lit("").alias("subroot")), "name string, node string")
    tops = materialize(of_groups.select(F.col("name").alias("tree"), "path", F.col("node").alias("subroot")), "tops")
    out = _paths(steps, tops, "id long, node string, also string")
    return out.select(F.col("id").alias(id_col), F.col("node").alias("leaf"), "also", "path", "subroot", F.lit(root).cast("string").alias("root"))


def with_folded(rows: DataFrame, leaf_col: str, path_col: str = "path", name: str = "folded_root") -> DataFrame:
    """rows with the root that each leaf leads to along its path; null where either is null. No shuffle."""

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            made = [None if x is None or p is None else folded(x, p) for x, p in zip(b.column(leaf_col).to_pylist(), b.column(path_col).to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(made, pa.string())], [*b.schema.names, name])

    return rows.mapInArrow(fold, StructType([*rows.schema.fields, StructField(name, StringType())]))
