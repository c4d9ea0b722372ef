"""N-gram Jaccard join, size-aware: small sets meet in their fixed-size subsets, large sets scan the
inverted lists of their rarest shingles, and the boundary between the two is the cheaper one by cost."""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import blake2b
from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize, text_bytes, text_chunks
from .components import components
from .windows import bucket_bits, by_bucket, cuts, mix, packed, packed_hashes, packed_ids, packed_numbers, runs, shingle_sets, unpacked, unpacked_hashes, unpacked_ids, unpacked_numbers

BLOCK = 1_000_000
#: Documents of a block that share a shingle from which on their postings stay with the documents: only counts
#: go to the shingle's bucket.
HOT = 64
#: Sets, and shingles of sets, of one component that meet another block's to count links.
LINK_SETS, LINK_SHINGLES = 1024, 500_000
#: Sets above this size are always large: their subsets are too many.
LARGEST_SMALL = 14


def least_common(s: int, t: int, percent: int) -> int:
    """Shingles that sets of s and t must share: 100 * o >= percent * (s + t - o)."""
    return -(-percent * (s + t) // (100 + percent))


def partners(s: int, percent: int) -> list[int]:
    """Sizes that a set of s shingles can link with."""
    return [t for t in range(max(1, percent * s // 100), 100 * s // percent + 2) if least_common(s, t, percent) <= min(s, t)]


def _group(ids: np.ndarray, bits: int) -> np.ndarray:
    return ((ids.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - bits)).astype(np.int64)


def shared_shingles(docs: DataFrame, words: int, percent: int) -> DataFrame:
    """(id, n, sig, k, rich, codes, tokens) of each document: size and signature of its set, how common its
    shingles are on the whole, and, where k (the number of its shingles that another document has too) is
    enough for a link, those shingles, rarest first."""
    bits, hot_from = bucket_bits(text_bytes(docs)), HOT

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows for a bucket (0 or more): kind 0, hashes of a block with their documents; kind 1, hot hashes with
        the groups that have them and how often. Rows for a group g (bucket -1 - g): kind 2, sizes and
        signatures; kind 3, hot hashes with their documents."""

        def rows(keys, kind, h, ids, more=None):
            n = len(keys)
            more = packed(np.empty(0, np.uint8), np.zeros(n + 1, np.int64)) if more is None else more
            whole = pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array(np.full(n, kind), pa.int32()), h, ids, more], ["bucket", "kind", "h", "ids", "more"])
            step = n // 8 + 1
            for i in range(0, n, step):
                yield whole.slice(i, step)

        def blocks():
            h, ids = (np.concatenate(x) for x in zip(*held, strict=True)) if held else (np.empty(0, np.uint64), np.empty(0, np.int64))
            order = np.argsort(h)
            first = np.flatnonzero(np.concatenate(([True], np.diff(h[order]) != 0))) if len(h) else np.empty(0, int)
            many = np.diff(np.append(first, len(h)))
            hot = np.empty(len(h), bool)
            hot[order] = np.repeat(many >= hot_from, many)
            bucket, order = by_bucket(h[~hot], bits)
            at = cuts(bucket)
            yield from rows(bucket[at[:-1]], 0, packed_hashes(h[~hot][order], at), packed_ids(ids[~hot][order], at))
            if hot.any():
                h, ids = h[hot], ids[hot]
                group = _group(ids, bits)
                order = np.lexsort((h, group))
                at = cuts(group[order])
                yield from rows(-1 - group[order][at[:-1]], 3, packed(h[order], at), packed_ids(ids[order], at))
                order = np.lexsort((group, h))
                h, group = h[order], group[order]
                first = np.flatnonzero(np.concatenate(([True], (h[1:] != h[:-1]) | (group[1:] != group[:-1]))))
                many, h, group = np.diff(np.append(first, len(h))), h[first], group[first]
                bucket, order = by_bucket(h, bits)
                at = cuts(bucket)
                yield from rows(bucket[at[:-1]], 1, packed_hashes(h[order], at), packed_ids(group[order], at), packed_numbers(many[order], at))
            ids = np.array([x[0] for x in sizes], np.int64)
            order = np.argsort(_group(ids, bits), kind="stable")
            ids, own = ids[order], [sizes[i] for i in order.tolist()]
            group = _group(ids, bits)
            at = cuts(group)
            sigs = np.frombuffer(b"".join(x[2] for x in own), np.uint8).reshape(-1, 16)
            yield from rows(-1 - group[at[:-1]], 2, packed_numbers(np.array([x[1] for x in own], np.uint64), at), packed_ids(ids, at), packed(sigs, at))

        held, sizes, seen, n = [], [], set(), 0
        for ids, texts in text_chunks(batches):
            order = sorted((x, i) for i, x in enumerate(ids) if x is not None)
            if not order:
                continue
            h, count = shingle_sets([texts[i] for _, i in order], words)
            ends = np.cumsum(count)
            fresh = np.zeros(len(order), bool)
            for j, (x, _) in enumerate(order):
                sig = blake2b(h[ends[j] - count[j] : ends[j]].tobytes(), digest_size=16).digest()
                fresh[j] = sig not in seen  # copies within a block are sent once
                seen.add(sig)
                sizes.append((x, int(count[j]), sig))
            keep = np.repeat(fresh, count)
            held.append((h[keep], np.repeat(np.array([x for x, _ in order], np.int64), count)[keep]))
            n += int(keep.sum()) + len(order)
            if n >= BLOCK:
                yield from blocks()
                held, sizes, seen, n = [], [], set(), 0
        if sizes:
            yield from blocks()

    def repeated(t: pa.Table) -> pa.Table:
        """Rows for groups: kind 2 and 3 as they came; kind 4, shared hashes with their documents and how common they
        are; kind 5, how common a group's hot hashes are."""
        bucket = t.column("bucket")[0].as_py()
        names = ("g", "kind", "h", "ids", "more")
        if bucket < 0:
            return pa.table([pa.array([-1 - bucket] * len(t), pa.int64()), *(t.column(k) for k in names[1:])], names=names)
        few, many = (t.filter(pc.equal(t.column("kind"), k)) for k in (0, 1))
        h, hot = (unpacked_hashes(x.column("h"), bucket, bits) for x in (few, many))
        ids, hot_group = (unpacked_ids(x.column("ids")) for x in (few, many))
        hot_many = unpacked_numbers(many.column("more")).astype(np.int64)
        order = np.lexsort((ids, h))
        h, ids = h[order], ids[order]
        new = np.ones(len(h), bool)
        new[1:] = (h[1:] != h[:-1]) | (ids[1:] != ids[:-1])
        h, ids = h[new], ids[new]
        distinct, where, df = np.unique(np.concatenate((h, hot)), return_inverse=True, return_counts=True)
        if len(hot):
            df = np.bincount(where, np.concatenate((np.ones(len(h)), hot_many)), len(distinct)).astype(np.int64)
        code = np.minimum(255, np.floor(8 * np.log2(np.maximum(1, df)))).astype(np.uint8)[where]  # a coarse logarithm orders well enough
        hit = df[where[: len(h)]] > 1
        group = _group(ids[hit], bits)
        order = np.lexsort((ids[hit], group))
        h, ids, own, group = h[hit][order], ids[hit][order], code[: len(hit)][hit][order], group[order]
        at = cuts(group)
        parts = [(group[at[:-1]], 4, packed(h, at), packed_ids(ids, at), packed(own, at))]
        if len(hot):
            order = np.lexsort((hot, hot_group))
            hot, hot_group, code = hot[order], hot_group[order], code[len(hit) :][order]
            at = cuts(hot_group)
            parts.append((hot_group[at[:-1]], 5, packed(hot, at), packed(np.empty(0, np.uint8), np.zeros(len(at), np.int64)), packed(code, at)))
        return pa.concat_tables(pa.table([pa.array(g, pa.int64()), pa.array(np.full(len(g), kind), pa.int32()), *x], names=names) for g, kind, *x in parts)

    def gathered(t: pa.Table) -> pa.Table:
        own = {k: t.filter(pc.equal(t.column("kind"), k)) for k in (2, 3, 4, 5)}
        sized, n = unpacked_ids(own[2].column("ids")), unpacked_numbers(own[2].column("h")).astype(np.int64)
        sig = unpacked(own[2].column("more")).reshape(-1, 16)
        sized, at = np.unique(sized, return_index=True)  # an id with several texts may have come twice
        n, sig = n[at], sig[at]
        ids, h = (np.concatenate(x) for x in zip(*((unpacked_ids(x.column("ids")), unpacked(x.column("h"), np.dtype("<u8"))) for x in (own[4], own[3])), strict=True))
        code = unpacked(own[4].column("more"))
        if len(own[3]):
            hot, at = np.unique(unpacked(own[5].column("h"), np.dtype("<u8")), return_index=True)
            code = np.concatenate((code, unpacked(own[5].column("more"))[at][np.searchsorted(hot, h[len(code) :])]))
        order = np.lexsort((h, code, ids))
        ids, h, code = ids[order], h[order], code[order]
        new = np.ones(len(ids), bool)
        new[1:] = (ids[1:] != ids[:-1]) | (h[1:] != h[:-1])
        ids, h, code = ids[new], h[new], code[new]
        a, b = np.searchsorted(ids, sized), np.searchsorted(ids, sized, "right")
        k = b - a
        total = np.append(0, np.cumsum(code, dtype=np.int64))
        enough = (n > 0) & (100 * k >= percent * n)
        kept = enough[np.searchsorted(sized, ids)]
        offsets = pa.array(np.append(0, np.cumsum(np.where(enough, k, 0))), pa.int32())
        lists = lambda x: pa.ListArray.from_arrays(offsets, pa.array(x[kept]), mask=pa.array(~enough))
        at = np.arange(len(sized) + 1)
        columns = (pa.array(sized), pa.array(n), packed(sig, at), pa.array(k), pa.array((total[b] - total[a]) / np.maximum(1, n)), lists(code.astype(np.int16)), lists(h.view(np.int64)))
        return pa.table(columns, names=("id", "n", "sig", "k", "rich", "codes", "tokens"))

    sent = docs.mapInArrow(hashed, "bucket long, kind int, h binary, ids binary, more binary").groupBy("bucket").applyInArrow(repeated, "g long, kind int, h binary, ids binary, more binary")
    return sent.groupBy("g").applyInArrow(gathered, "id long, n long, sig binary, k long, rich double, codes array<short>, tokens array<long>")


def _prefix(n, k, percent: int):
    """Shared shingles in the prefix of a set of n: singletons come first in the order and fill it first."""
    return F.greatest(F.lit(0), n - F.expr(f"({percent} * n + 99) div 100") + 1 - (n - k)).cast("int")


def _boundary(sets: DataFrame, percent: int) -> int:
    """The size up to which enumerating subsets costs less than scanning lists, over all sets: from one
    aggregate of LARGEST_SMALL rows."""
    lists = F.aggregate(F.slice("codes", 1, F.greatest(F.lit(1), _prefix(F.col("n"), F.col("k"), percent))), F.lit(0.0), lambda a, c: a + F.pow(F.lit(2.0), c / 8.0))
    found = {(r.n, r.k): (r.sets, r.lists) for r in sets.where(F.col("n") <= LARGEST_SMALL).groupBy("n", "k").agg(F.count("*").alias("sets"), F.sum(lists).alias("lists")).collect()}
    gain, best, at = 0.0, 0.0, 0
    for size in range(1, LARGEST_SMALL + 1):
        for (n, k), (sets_, lists_) in found.items():
            if n == size:
                gain += lists_ - sets_ * sum(comb(k, c) for c in {least_common(n, t, percent) for t in partners(n, percent)} if c <= k)
        if gain >= best:
            best, at = gain, size
    return at


def _subset_edges(sets: DataFrame, boundary: int, percent: int) -> DataFrame:
    """Edges between small sets that share a subset of the size that a link between their sizes needs: as many as
    join the same components."""

    def subsets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = []
            for i, n, tokens in zip(*(c.to_pylist() for c in b.columns), strict=True):
                for t in partners(n, percent):
                    c = least_common(n, t, percent)
                    if t > boundary or c > len(tokens):
                        continue
                    some = np.array(list(combinations(sorted(tokens), c)), np.int64).reshape(-1, c).view(np.uint64)
                    key = np.full(len(some), np.uint64(min(n, t) * 64 + max(n, t)))
                    for j in range(c):
                        key = mix(key * np.uint64(0xD1342543DE82EF95) + some[:, j])
                    rows += [(x, i, n <= t, n >= t) for x in key.view(np.int64).tolist()]
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], kind) for k, kind in enumerate((pa.int64(), pa.int64(), pa.bool_(), pa.bool_()))], ["key", "id", "is_low", "is_high"])

    hits = sets.where(F.col("n") <= boundary).select("id", "n", "tokens").mapInArrow(subsets, "key long, id long, is_low boolean, is_high boolean")
    hubs = hits.groupBy("key").agg(F.min(F.when(F.col("is_low"), F.col("id"))).alias("low"), F.min(F.when(F.col("is_high"), F.col("id"))).alias("high"), F.count("*").alias("m")).where("m > 1 and low is not null and high is not null")
    both = hits.join(hubs, "key")
    return both.where("is_low").select(F.col("id").alias("a"), F.col("high").alias("b")).union(both.where("is_high").select(F.col("id").alias("a"), F.col("low").alias("b"))).where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose sets do link, by counting what they share."""
    left = sets.select(F.col("id").alias("a"), F.col("n").alias("na"), F.col("tokens").alias("ta"))
    right = sets.select(F.col("id").alias("b"), F.col("n").alias("nb"), F.col("tokens").alias("tb"))
    both = pairs.join(left, "a").join(right, "b").withColumn("o", F.size(F.array_intersect("ta", "tb")))
    return both.where(F.col("o") * 100 >= (F.col("na") + F.col("nb") - F.col("o")) * percent).select("a", "b", F.col("o").cast("long").alias("shared"))


def _list_edges(sets: DataFrame, boundary: int, percent: int, edges: DataFrame, rounds: int = 2) -> DataFrame:
    """Edges of pairs with a large set, besides those given: as many as join the same components.

    The order of all shingles has those of one document first, so of two sets that link, the first shingle in
    common stands no later in either than its size less the overlap that their sizes need: lists are scanned
    with that condition. Every list first checks its members against one pivot, the member richest in common
    shingles, which in a group of near copies is what they were copied from. What then lies in one
    component needs no more checks. After some rounds, every pair of a list that still lies in two
    components is checked, so no link between components is missed."""
    p = _prefix(F.col("n"), F.col("k"), percent)
    need = lambda a, b: F.expr(f"({percent} * ({a} + {b}) + {99 + percent}) div {100 + percent}")
    lists = sets.where((100 * F.col("n") > percent * boundary) & (p > 0)).select("id", "n", "rich", (F.col("n") - F.col("k")).alias("alone"), F.posexplode(F.slice("tokens", 1, p)).alias("at", "tok"))
    lists = lists.select("id", "n", "rich", "tok", (F.col("alone") + F.col("at")).alias("pos"))
    known = lists.groupBy("tok").agg(F.count("*").alias("m"), F.min("n").alias("low")).where("m > 1").select("tok", "low")
    smallest = f"greatest(low, ({percent} * n + 99) div 100)"  # of the partners that a member may have in its list
    lists = lists.join(known, "tok").where(F.col("pos") + need("n", smallest) <= F.col("n")).drop("low")
    lists = materialize(lists, "lists")
    near = F.expr(f"100 * least(n, pn) >= {percent} * greatest(n, pn)") & (F.greatest("n", "pn") > boundary)
    near = near & (F.col("pos") + need("n", "pn") <= F.col("n")) & (F.col("ppos") + need("n", "pn") <= F.col("pn"))
    checked = edges.limit(0).select("a", "b")
    for turn in range(rounds + 1):
        label = components(edges) if turn or boundary else None
        now = lists.withColumn("label", F.col("id")) if label is None else lists.join(label.withColumnRenamed("root", "label"), "id", "left").withColumn("label", F.coalesce("label", "id"))
        by_label = now.groupBy("tok", "label").agg(F.count("*").alias("m"), F.max(F.struct("rich", -F.col("id"), "n", "pos")).alias("top"))
        open_ = by_label.groupBy("tok").agg(F.max_by("label", F.struct("m", "label")).alias("main"), F.max("top").alias("top"), F.min("label").alias("x"), F.max("label").alias("y")).where("x <> y")
        pivot = ((-F.col("top.col2")).alias("pivot"), F.col("top.n").alias("pn"), F.col("top.pos").alias("ppos"))
        open_ = open_.select("tok", "main", *pivot)
        now = now.select("tok", "id", "n", "pos", "label")
        if turn < rounds:
            if turn:  # the list's main component has had its pivot; now the best of the others
                rest = by_label.join(open_.select("tok", "main"), "tok").where("label <> main").groupBy("tok").agg(F.max("top").alias("top"))
                open_ = rest.select("tok", *pivot)
            found = now.join(open_, "tok").where((F.col("id") != F.col("pivot")) & near)
            found = found.groupBy("id", "pivot").agg(F.count("*").alias("m")).groupBy("id").agg(F.max_by("pivot", F.struct("m", -F.col("pivot"))).alias("pivot"))
        else:
            others = now.join(open_.select("tok", "main"), "tok").where("label <> main").select("tok", F.col("id").alias("pivot"), F.col("n").alias("pn"), F.col("pos").alias("ppos"), F.col("label").alias("plabel"))
            found = now.join(others, "tok").where((F.col("label") != F.col("plabel")) & near).select("id", "pivot").distinct()
        pairs = found.select(F.greatest("id", "pivot").alias("a"), F.least("id", "pivot").alias("b")).distinct().join(checked, ["a", "b"], "left_anti")
        pairs = materialize(pairs, "pairs")
        checked = checked.union(pairs)
        edges = materialize(edges.union(_verified(pairs, sets, percent)).distinct(), "links")
    return edges


def _links_of(t: pa.Table, percent: int) -> tuple[list[int], list[int]]:
    """(ids, far) of the sets in t, which has root, i, j, id, side, n, members and tokens: how many documents the
    sets of the same root (and, of two blocks i and j, of the other side) that link with it have."""
    ids, far = [], []
    cross = t.column("i")[0].as_py() != t.column("j")[0].as_py()
    root = np.array(t.column("root").to_pylist(), np.int64)
    order = np.argsort(root, kind="stable")
    for a, b in runs(root[order]):
        own = t.take(pa.array(order[a:b]))
        n, members, side = (np.array(own.column(k).to_pylist(), np.int64) for k in ("n", "members", "side"))
        tokens = own.column("tokens").combine_chunks()
        size, flat = np.diff(tokens.offsets.to_numpy()), tokens.flatten().to_numpy()
        m = len(n)
        _, token, df = np.unique(flat, return_inverse=True, return_counts=True)
        of = np.repeat(np.arange(m), size)
        common = np.zeros(m * m, np.int64)
        order_ = np.argsort(token, kind="stable")
        order_ = order_[(df[token[order_]] > 1) & (df[token[order_]] < 32)]
        rare, who = token[order_], of[order_]
        for step in range(1, 32):  # the pairs of a list of fewer than 32, step places apart
            pair = np.flatnonzero(rare[step:] == rare[:-step])
            if not len(pair):
                break
            x, y = who[pair], who[pair + step]
            common += np.bincount(np.minimum(x, y) * m + np.maximum(x, y), minlength=m * m)
        shared = common.reshape(m, m)
        shared = shared + shared.T
        wide = np.full(len(df), -1)
        wide[df >= 32] = np.arange((df >= 32).sum())
        column = wide[token]
        for c in range(0, int((df >= 32).sum()), 1024):
            at = (column >= c) & (column < c + 1024)
            x = np.zeros((m, 1024), np.float32)
            x[of[at], column[at] - c] = 1
            shared += (x @ x.T).astype(np.int64)
        link = shared * (100 + percent) >= percent * (n[:, None] + n[None, :])
        if cross:  # pairs within a block are counted where it meets itself
            link &= side[:, None] != side[None, :]
        np.fill_diagonal(link, False)
        ids += own.column("id").to_pylist()
        far += (link @ members).tolist()
    return ids, far


def link_counts(sets: DataFrame, roots: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """(rep, far): how many documents with other sets each set links with. Links lie within components, so each
    component's sets meet in blocks of bounded size; counts leave a task, pairs do not. Small components
    share a task."""
    named = sets.select("id", "n", "tokens").join(roots.union(roots.select(F.col("root").alias("id"), "root").distinct()), "id")
    named = named.join(classes.select(F.col("rep").alias("id"), "members"), "id")
    size = named.groupBy("root").agg(F.count("*").alias("m"), F.sum(F.size("tokens")).alias("s"))
    size = size.select("root", F.greatest(F.expr(f"(m + {LINK_SETS - 1}) div {LINK_SETS}"), F.expr(f"(s + {LINK_SHINGLES - 1}) div {LINK_SHINGLES}")).alias("blocks"))
    named = materialize(named.join(size, "root"), "members")
    total = int(named.agg(F.coalesce(F.sum(F.size("tokens")), F.lit(0))).first()[0])
    small = named.where("blocks = 1").select("root", "id", "n", "members", "tokens", F.pmod(F.xxhash64("root"), F.lit(1 + total // LINK_SHINGLES)).alias("task"), F.lit(-1).alias("i"), F.lit(-1).alias("j"), F.lit(0).alias("side"))
    # a set goes to the blocks that its own meets: as many as there are
    wide = named.where("blocks > 1").withColumn("own", F.pmod(F.xxhash64("id", F.lit("block")), F.col("blocks"))).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    wide = wide.select("root", "id", "n", "members", "tokens", F.col("root").alias("task"), F.least("own", "other").cast("int").alias("i"), F.greatest("own", "other").cast("int").alias("j"), (F.col("own") > F.col("other")).cast("int").alias("side"))

    def counted(t: pa.Table) -> pa.Table:
        ids, far = _links_of(t, percent)
        return pa.table({"rep": pa.array(ids, pa.int64()), "far": pa.array(far, pa.int64())})

    return small.union(wide).groupBy("task", "i", "j").applyInArrow(counted, "rep long, far long").groupBy("rep").agg(F.sum("far").alias("far"))


def jaccard_join(docs: DataFrame, words: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text", links: bool = False) -> DataFrame:
    """Groups documents whose sets of word shingles have a Jaccard similarity of percent / 100 or more.

    Returns id, n_shingles, component_id (smallest id reachable by links) and copies_of (smallest id with
    the same set); with links also n_links, the number of other ids that an id links with, of which no
    link is missing. A-Z are lower-cased; a text with fewer words than a shingle has one shingle; null text
    and text without words have none, link with nothing and stand alone. Rows with a null id are left out
    of the join and returned with nulls. An id names one text: repeated rows give one row, and of an id with
    several texts one stands for it. An empty table gives an empty result. Other columns are not read.

    Equal sets fall into classes first, by signature. A shingle of one document alone cannot be shared, so
    sets keep only the others, and those with too few of them are settled. Shingles are compared by
    64-bit hashes; counts of shared ones are exact for every pair that is checked. Candidates are checked as
    long as they can still join components; links are then counted within components.
    """
    source = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    rows = materialize(shared_shingles(source, words, percent), "sets")
    classes = rows.where("n > 0").groupBy("sig").agg(F.min("id").alias("rep"), F.min(F.when(F.col("tokens").isNotNull(), F.col("id"))).alias("carrier"), F.count("*").alias("members"))
    classes = materialize(classes, "classes")
    sets = rows.where(F.col("tokens").isNotNull()).join(classes.where("carrier is not null").select(F.col("carrier").alias("id"), "rep"), "id").select(F.col("rep").alias("id"), "n", "k", "rich", "codes", "tokens")
    sets = materialize(sets, "candidates")
    boundary = _boundary(sets, percent)
    edges = sets.limit(0).select(F.col("id").alias("a"), F.col("id").alias("b"), F.col("n").alias("shared"))
    if boundary:
        edges = _verified(_subset_edges(sets, boundary, percent), sets, percent)
    edges = _list_edges(sets, boundary, percent, materialize(edges, "small"))
    roots = components(edges)
    # the smallest id of a class is its representative, so the smallest representative is the smallest id
    named = rows.drop("codes", "tokens", "k", "rich").join(classes.select("sig", "rep", "members"), "sig", "left").join(roots.withColumnRenamed("id", "rep"), "rep", "left")
    columns = [F.col("id").alias(id_col), F.col("n").alias("n_shingles"), F.coalesce("root", "rep", "id").alias("component_id"), F.coalesce("rep", "id").alias("copies_of")]
    if links:
        named = named.join(link_counts(sets, roots, classes, percent), "rep", "left")
        columns.append((F.coalesce("members", F.lit(1)) - 1 + F.coalesce("far", F.lit(0))).cast("long").alias("n_links"))
    out = named.select(*columns)
    nulls = docs.where(F.col(id_col).isNull()).select(F.col(id_col).cast("long"), *(F.lit(None).cast("long").alias(c) for c in out.columns[1:]))
    return out.unionByName(nulls)
