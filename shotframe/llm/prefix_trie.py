"""Conversation prefix trie, built as a Patricia trie.

Conversations are sorted by the hashes of their prefixes; two neighbours part where their common prefix ends. Only there
(branches), where a conversation ends, and at the root are points made; the nodes between two points have the same
members and are one edge. Members, children and sums over subtrees are found on these points, and
nodes within an edge are written out at the end from the points below them and the edge's suffix sums.

All of it is DataFrame code: counts are combined before they are exchanged, and a prefix that a third of all conversations share
is a row a conversation in a sort, never a group in memory.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import materialize


def numbered_turns(conversations: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """(conv, at, role, text): turns from 1 on, by turn (nulls first), then role and text; null role or text
    is empty, and rows without a conversation are left out."""
    empty = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    rows = conversations.where(F.col(conv_col).isNotNull()).select(F.col(conv_col).cast("long").alias("conv"), F.col(turn_col).alias("turn"), empty(role_col).alias("role"), empty(text_col).alias("text"))
    return rows.select("conv", F.row_number().over(Window.partitionBy("conv").orderBy("turn", "role", "text")).cast("long").alias("at"), "role", "text")


def grafted(turns: DataFrame, base: Column, taken: Column) -> tuple[DataFrame, DataFrame]:
    """Conversations that begin with the first `taken` turns of another, `base` (both columns of conv), and go on with
    their own turns after as many. Returns the ids (conv) and the turns (conv, at, role, text)."""
    convs = materialize(turns.select("conv").distinct(), "convs")
    head = convs.select("conv", base.alias("base"), taken.alias("taken")).where("taken > 0")
    most = int(head.agg(F.coalesce(F.max("taken"), F.lit(0))).first()[0])
    lent = turns.where(F.col("at") <= most).select(F.col("conv").alias("base"), "at", "role", "text")
    lent = lent.join(head, "base").where("at <= taken").select("conv", "at", "role", "text")
    had = lent.groupBy("conv").agg(F.count("*").alias("had"))
    own = turns.withColumn("taken", taken).where("at > taken").join(had, "conv", "left")
    return convs, lent.union(own.select("conv", F.col("at") - F.col("taken") + F.coalesce("had", F.lit(0)), "role", "text"))


def _prefixes(turns: DataFrame) -> DataFrame:
    """(conv, depth, x, y, size): 128 bits of hash of each prefix, and the code points of its last text. The hash is the
    exclusive or of the turns' hashes, each with its place, so that it runs along a conversation in a window."""
    before = Window.partitionBy("conv").orderBy("depth").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    hashed = turns.select("conv", F.col("at").cast("long").alias("depth"), F.length("text").cast("long").alias("size"), *(F.xxhash64(F.lit(seed), "at", "role", "text").alias(c) for seed, c in ((1, "x"), (2, "y"))))
    return hashed.select("conv", "depth", "size", *(F.bit_xor(c).over(before).alias(c) for c in ("x", "y")))


def _parting_depths(prefixes: DataFrame) -> DataFrame:
    """(conv, depth): where each conversation leaves the one before it in the order of all, and where it ends."""
    paths = prefixes.groupBy("conv").agg(F.array_sort(F.collect_list(F.struct("depth", "x", "y"))).alias("path"))
    ordered = paths.repartitionByRange("path", "conv").sortWithinPartitions("path", "conv").withColumn("part", F.spark_partition_id())
    ordered = materialize(ordered, "sorted")
    here = Window.partitionBy("part").orderBy("path", "conv")
    # the last conversation of the range before: a row a range
    ends = ordered.groupBy("part").agg(F.max(F.struct("path", "conv")).alias("last")).select("part", F.lag("last.path").over(Window.orderBy("part")).alias("outer"))
    both = ordered.withColumn("inner", F.lag("path").over(here)).join(ends, "part")
    # prefixes' hashes are in a path: what two paths share is their common prefix
    other = F.coalesce("inner", "outer")
    shared = F.when(other.isNull(), 0).otherwise(F.size(F.array_intersect("path", other)))
    return both.select("conv", F.explode(F.array(shared, F.size("path"))).alias("depth")).where("depth > 0").select("conv", F.col("depth").cast("long").alias("depth"))


def _digests_of_ends(ends: DataFrame) -> DataFrame:
    """(x, y, ends_sha256): SHA-256 of the ids of (x, y, conv) in order, joined by commas. A digest takes its input in
    order, so a point's ids pass one task, as a sorted stream and never as a whole."""

    def told(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, h = None, None
        for b in batches:
            done = []
            for x, y, conv in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if (x, y) == now:
                    h.update(f",{conv}".encode())
                    continue
                if h is not None:
                    done.append((*now, h.hexdigest()))
                now, h = (x, y), sha256(str(conv).encode())
            yield batch(done)
        if h is not None:
            yield batch([(*now, h.hexdigest())])

    def batch(rows: list) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate((pa.int64(), pa.int64(), pa.string()))], ["x", "y", "ends_sha256"])

    return ends.repartition("x", "y").sortWithinPartitions("x", "y", "conv").select("x", "y", "conv").mapInArrow(told, "x long, y long, ends_sha256 string")


def prefix_trie(convs: DataFrame, turns: DataFrame) -> DataFrame:
    """Every distinct prefix of the conversations: conv_id (smallest member), depth, parent_conv_id, n_convs (members),
    n_children, n_leaves (childless nodes at or below it), saved_tokens (code points of last texts that members but
    one need not hold, at or below it) and ends_sha256 (of the members that end here).

    convs has conv, each id once, also those without turns; turns has conv, at (1, 2, ...), role and text, no nulls. Two
    prefixes count as one if 128 bits of hash agree. No conversations, no nodes. A conversation's hashes are gathered
    in one row, 24 bytes a turn; its texts are not."""
    prefixes = materialize(_prefixes(turns), "prefixes")
    marks = _parting_depths(prefixes)
    points = prefixes.join(marks, ["conv", "depth"], "left_semi").select("x", "y", "depth").distinct()
    # members: each conversation with the points on its way; every conversation is a member of the root
    way = prefixes.join(points.select("x", "y"), ["x", "y"], "left_semi").select("conv", "depth", "x", "y")
    way = way.union(convs.select("conv", F.lit(0).cast("long"), F.lit(0).cast("long"), F.lit(0).cast("long")))
    way = materialize(way, "members")
    told = way.groupBy("x", "y").agg(F.min("conv").alias("least"), F.count("*").alias("n_convs"))
    along = Window.partitionBy("conv").orderBy("depth")
    both = way.join(told, ["x", "y"])
    up = [F.lag(c).over(along).alias(f"up_{c}") for c in ("depth", "x", "y", "least")]
    # the smallest member of a point has its row: a conversation owns the last points of its way
    owned = materialize(both.select("conv", "depth", "x", "y", "least", "n_convs", *up).where("conv = least"), "owned")
    lengths = prefixes.join(owned.groupBy("conv").agg(F.min("depth").alias("top"), F.min(F.coalesce("up_depth", F.lit(0))).alias("above")), "conv").where("depth > above")
    run = Window.partitionBy("conv").orderBy(F.col("depth").desc()).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    lengths = materialize(lengths.select("conv", "depth", "size", F.sum("size").over(run).alias("below")), "lengths")  # suffix sums of a way
    at_point = lengths.select("conv", "depth", "size", "below")
    at_top = lengths.select(F.col("conv").alias("owner"), F.col("depth").alias("first"), F.col("below").alias("all"))
    children = owned.where("up_x is not null").groupBy(F.col("up_x").alias("x"), F.col("up_y").alias("y")).agg(F.count("*").alias("n_children"))
    full = owned.withColumn("over", F.coalesce("up_depth", F.lit(-1).cast("long"))).join(children, ["x", "y"], "left").join(at_point, ["conv", "depth"], "left")
    full = full.join(at_top, F.expr("conv = owner and over + 1 = first"), "left")
    length = F.coalesce(F.col("all") - F.col("below") + F.col("size"), F.lit(0))  # of the whole edge
    full = full.withColumn("n_children", F.coalesce("n_children", F.lit(0))).withColumn("saved", (F.col("n_convs") - 1) * length)
    full = full.withColumn("leaf", (F.col("n_children") == 0).cast("long"))
    own = Window.partitionBy("conv").orderBy(F.col("depth").desc()).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    full = materialize(full.select("*", F.sum("saved").over(own).alias("saved_below"), F.sum("leaf").over(own).alias("leaves_below")), "points")
    # a subtree: all that its members own, but of the smallest only what lies at or below
    totals = full.groupBy("conv").agg(F.sum("saved").alias("t_saved"), F.sum("leaf").alias("t_leaves"))
    sums = way.join(totals, "conv").groupBy("x", "y").agg(F.sum("t_saved").alias("m_saved"), F.sum("t_leaves").alias("m_leaves"))
    full = full.join(totals, "conv").join(sums, ["x", "y"], "left")
    full = full.select(
        "conv", "depth", "x", "y", "over", "n_convs", "n_children", "size", "below",
        F.col("up_least").alias("parent"),
        (F.coalesce("m_leaves", F.lit(0)) - F.col("t_leaves") + F.col("leaves_below")).alias("n_leaves"),
        # without the edge above the point's own node
        (F.coalesce("m_saved", F.lit(0)) - F.col("t_saved") + F.col("saved_below") - F.col("saved") + (F.col("n_convs") - 1) * F.coalesce("size", F.lit(0))).alias("saved_tokens"),
    )
    last = way.groupBy("conv").agg(F.max(F.struct("depth", "x", "y")).alias("e")).select("e.x", "e.y", "conv")
    full = full.join(_digests_of_ends(last), ["x", "y"], "left").drop("x", "y")
    nothing = F.lit(sha256(b"").hexdigest())
    full = materialize(full.withColumn("ends_sha256", F.coalesce("ends_sha256", nothing)), "sums")
    # nodes within edges: the owner's way has their lengths
    inner = full.select("conv", F.col("depth").alias("point"), "over", "n_convs", "n_leaves", "saved_tokens", "parent", F.col("below").alias("p_below"))
    inner = inner.where("point > over + 1").withColumn("depth", F.explode(F.sequence(F.col("over") + 1, F.col("point") - 1)))
    inner = inner.join(lengths.select("conv", "depth", "below"), ["conv", "depth"], "left")
    parent = F.when(F.col("depth") == F.col("over") + 1, F.col("parent")).otherwise(F.col("conv"))
    more = F.col("saved_tokens") + (F.col("n_convs") - 1) * (F.col("below") - F.col("p_below"))
    inner = inner.select("conv", "depth", parent.alias("parent"), "n_convs", F.lit(1).cast("long").alias("n_children"), "n_leaves", more.alias("saved_tokens"), nothing.alias("ends_sha256"))
    out = full.select("conv", "depth", F.when((F.col("depth") == F.col("over") + 1) | (F.col("depth") == 0), F.col("parent")).otherwise(F.col("conv")).alias("parent"), "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")
    return out.union(inner).withColumnRenamed("conv", "conv_id").withColumnRenamed("parent", "parent_conv_id")
