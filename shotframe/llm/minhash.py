"""MinHash near-dedup by a multi-index Hamming join.

A set of shingles has a signature of minimum hashes. The first SYMBOLS of them, with b = 8 bits each, are indexed: signatures
that differ there in at most DISTANCE symbols are found by pigeonhole: cut into (DISTANCE + 1) / 2 chunks, two such signatures
have a chunk in which they differ in one symbol at most. Every chunk is indexed once for each symbol that may be wrong, with that symbol left out, so that two signatures share a key exactly if a chunk of theirs has at most
one error. Pairs that are found are judged by the whole signature, WHOLE minima of b = 2 bits each, then on their sets.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialize, squeeze_ids, text_chunks, unsqueeze_ids
from .components import components
from .windows import low_bytes, mix, runs, shingle_sets, split_by_bucket, whole_hashes

#: Symbols of a signature, and in how many of them two signatures of a pair may differ. Of two sets with a Jaccard
#: similarity of 0.8 each symbol differs with probability 0.2, so that one pair in 2 million at the very threshold
#: differs in more than 49 of 128; pairs further above it are lost far more rarely still.
SYMBOLS, DISTANCE = 128, 49
#: Symbols of the whole signature and in how many of them a pair may differ: one pair in 1.8 million at the threshold has more.
WHOLE, WHOLE_DISTANCE = 2048, 388
_UNLIKE = np.array([sum(x >> k & 3 > 0 for k in (0, 2, 4, 6)) for x in range(256)], np.uint8)
#: Keys that a document shares with a pivot before its set is read for that; pairs at the threshold share 51 in the mean.
ENOUGH = 24
#: Members of a list that meet another block's, and bytes of signatures that are compared at a time.
MEET, COMPARED = 2048, 1 << 25
#: Keys that a task gathers before it sends them on, and that a bucket is to hold.
BLOCK, BUCKET = 1_000_000, 500_000
#: Shingles whose minima are taken at once: they stay in a core's cache.
AT_ONCE = 1 << 16


def _seeds(symbols: int) -> tuple[np.ndarray, np.ndarray]:
    x = (mix(np.arange(1, 2 * symbols + 1, dtype=np.uint64)) >> np.uint64(32)).astype(np.uint32)
    return x[:symbols], x[symbols:] | np.uint32(1)


def signatures(h: np.ndarray, count: np.ndarray, symbols: int = WHOLE) -> np.ndarray:
    """One row of symbols bytes for each set, of each minimum its top byte, mixed. h has the sets' 64-bit hashes one after the
    other, of which half serves here, count their sizes (one at least)."""
    out = np.empty((len(count), symbols), np.uint8)
    flip, times = _seeds(symbols)
    half, ends = h.astype(np.uint32), np.cumsum(count)
    a = 0
    while a < len(count):
        b = max(a + 1, int(np.searchsorted(ends, ends[a] - count[a] + AT_ONCE, side="right")))
        base = ends[a] - count[a]
        own, starts = half[base : ends[b - 1]], ends[a:b] - count[a:b] - base
        now = np.empty_like(own)
        for k in range(symbols):
            np.bitwise_xor(own, flip[k], out=now)
            np.multiply(now, times[k], out=now)
            out[a:b, k] = mix(np.minimum.reduceat(now, starts).astype(np.uint64)) >> np.uint64(56)
        a = b
    return out


def packed(sig: np.ndarray) -> np.ndarray:
    """The indexed symbols as they are, and all symbols with two bits each, four in a byte."""
    two = sig & 3
    return np.concatenate((sig[:, :SYMBOLS], two[:, ::4] | two[:, 1::4] << 2 | two[:, 2::4] << 4 | two[:, 3::4] << 6), axis=1)


def chunks(symbols: int, distance: int) -> list[range]:
    """(distance + 1) / 2 chunks: if each had two errors or more, there would be more than distance."""
    parts = (distance + 2) // 2
    cuts = [symbols * i // parts for i in range(parts + 1)]
    return [range(a, b) for a, b in zip(cuts, cuts[1:], strict=False)]


def chunk_keys(sig: np.ndarray, distance: int = DISTANCE) -> Iterator[np.ndarray]:
    """The keys of all signatures, for each chunk and each symbol left out of it."""
    for c, part in enumerate(chunks(sig.shape[1], distance)):
        for without in part:
            key = np.full(len(sig), mix(np.array([c << 16 | without], np.uint64))[0])
            for k in part:
                if k != without:
                    key = mix(key ^ (sig[:, k].astype(np.uint64) + np.uint64(1)))
            yield key


def signed_sets(docs: DataFrame, words: int) -> DataFrame:
    """(id, n, same, sig) of each row of (id, text): size of its set, a digest of all of it, and its signature. No
    shuffle; sets themselves do not leave the task."""

    def signed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, texts in text_chunks(batches):
            h, count = shingle_sets(texts, words)
            ends = np.cumsum(count)
            some = np.flatnonzero(count)
            sig = packed(signatures(h, count[some])) if len(some) else ()
            same = [blake2b(h[e - c : e].tobytes(), digest_size=16).digest() if c else None for e, c in zip(ends.tolist(), count.tolist(), strict=True)]
            row = iter(sig)
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(count, pa.int64()), pa.array(same, pa.binary()), pa.array([next(row).tobytes() if c else None for c in count], pa.binary())], ["id", "n", "same", "sig"])

    return docs.mapInArrow(signed, "id long, n long, same binary, sig binary")


def shared_keys(signed: DataFrame, rows: int, distance: int = DISTANCE) -> DataFrame:
    """(key, id) of every key that several of (id, sig) have.

    Of a key that repeats within a block, the block's members are known to be wanted: they go straight out, and one
    of them goes to the key's bucket for the others. A key common to all documents costs a bucket a row a block."""
    bits = 8
    while rows * SYMBOLS >> bits > BUCKET:
        bits += 1

    def sent(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def blocks():
            sig = np.frombuffer(b"".join(s for _, s in held), np.uint8).reshape(len(held), -1)[:, :SYMBOLS]
            ids = np.array([i for i, _ in held], np.int64)
            order = np.argsort(ids)
            sig, ids = sig[order], ids[order]
            keys = np.concatenate(list(chunk_keys(sig, distance)))
            who = np.tile(np.arange(len(ids), dtype=np.int32), len(keys) // len(ids))
            order = np.argsort(keys, kind="stable")
            keys, who = keys[order], who[order]
            new = np.concatenate(([True], keys[1:] != keys[:-1]))
            many = np.repeat(np.diff(np.append(np.flatnonzero(new), len(keys))) > 1, np.diff(np.append(np.flatnonzero(new), len(keys))))
            rest = many & ~new
            rows = [(-1 - part, keys[rest][a : a + 4096].tobytes(), ids[who[rest][a : a + 4096]].tobytes(), b"") for part, a in enumerate(range(0, int(rest.sum()), 4096))]
            keys, who, many = keys[new], who[new], many[new]
            for b, at in split_by_bucket(keys, bits):
                at = at[np.argsort(who[at], kind="stable")]  # ids in order take less room
                rows.append((b, low_bytes(keys[at]), squeeze_ids(ids[who[at]]), np.packbits(many[at]).tobytes()))
            for i in range(0, len(rows), 64):
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows[i : i + 64], strict=True), (pa.int64(), *[pa.binary()] * 3), strict=True)], ["bucket", "keys", "ids", "many"])

        held: list = []
        for batch in batches:
            held += zip(*(c.to_pylist() for c in batch.columns), strict=True)
            while len(held) * SYMBOLS >= BLOCK:
                held, left = held[: BLOCK // SYMBOLS + 1], held[BLOCK // SYMBOLS + 1 :]
                yield from blocks()
                held = left
        if held:
            yield from blocks()

    def repeated(t: pa.Table) -> pa.Table:
        bucket = t.column("bucket")[0].as_py()
        if bucket < 0:
            keys, ids = (b"".join(t.column(c).to_pylist()) for c in ("keys", "ids"))
            return pa.table({"key": pa.array(np.frombuffer(keys, np.int64)), "id": pa.array(np.frombuffer(ids, np.int64))})
        keys = np.concatenate([whole_hashes(x, bucket, bits) for x in t.column("keys").to_pylist()])
        ids = [unsqueeze_ids(x) for x in t.column("ids").to_pylist()]
        many = np.concatenate([np.unpackbits(np.frombuffer(x, np.uint8), count=len(i)) for x, i in zip(t.column("many").to_pylist(), ids, strict=True)]).astype(bool)
        ids = np.concatenate(ids)
        order = np.argsort(keys, kind="stable")
        keys, ids, many = keys[order], ids[order], many[order]
        first = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
        size = np.diff(np.append(first, len(keys)))
        wanted = np.repeat((size > 1) | np.maximum.reduceat(many, first), size)
        return pa.table({"key": pa.array(keys[wanted].view(np.int64)), "id": pa.array(ids[wanted])})

    return signed.mapInArrow(sent, "bucket long, keys binary, ids binary, many binary").groupBy("bucket").applyInArrow(repeated, "key long, id long")


def _sets_of(docs: DataFrame, wanted: DataFrame, words: int) -> DataFrame:
    """(id, tokens) of all (id, same) that are asked for: the shingles of the id's text whose set has that digest."""

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        digests: dict = {}
        for ids, texts in text_chunks(_noted(batches, digests)):
            h, count = shingle_sets(texts, words)
            ends = np.cumsum(count)
            for i, e, c in zip(ids, ends.tolist(), count.tolist(), strict=True):
                own = h[e - c : e]
                if blake2b(own.tobytes(), digest_size=16).digest() == digests[i]:
                    yield pa.RecordBatch.from_arrays([pa.array([i], pa.int64()), pa.array([own.view(np.int64)], pa.list_(pa.int64()))], ["id", "tokens"])

    asked = docs.join(wanted, "id").select("id", "text", "same").dropDuplicates(["id", "text"])
    return asked.mapInArrow(hashed, "id long, tokens array<long>")


def _noted(batches: Iterator[pa.RecordBatch], digests: dict) -> Iterator[pa.RecordBatch]:
    """Notes the third column of the batches by the first."""
    for b in batches:
        digests.update(zip(b.column(0).to_pylist(), b.column(2).to_pylist(), strict=True))
        yield b


def _linked(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose whole sets link."""
    both = pairs.join(sets.select(F.col("id").alias("a"), F.col("tokens").alias("x")), "a").join(sets.select(F.col("id").alias("b"), F.col("tokens").alias("y")), "b")
    shared = F.size(F.array_intersect("x", "y"))
    return both.where(shared * (100 + percent) >= (F.size("x") + F.size("y")) * percent).select("a", "b")


def _near(percent: int, n: str, m: str) -> Column:
    return F.expr(f"100 * least({n}, {m}) >= {percent} * greatest({n}, {m})")


def _first_shared(x: np.ndarray, y: np.ndarray, distance: int) -> np.ndarray:
    """Of pairs of indexed signatures the number (in the order of chunk_keys) of the first key that both have; -1 of none."""
    unlike = x != y
    begin = np.array([c.start for c in chunks(x.shape[1], distance)])
    errors = np.add.reduceat(unlike, begin, axis=1, dtype=np.int64)
    part = (errors <= 1).argmax(1)
    row = np.arange(len(x))
    ahead = np.minimum(begin[part][:, None] + np.arange(x.shape[1] // len(begin) + 1), x.shape[1] - 1)  # a chunk has no more symbols
    where = begin[part] + unlike[row[:, None], ahead].argmax(1)
    return np.where(errors[row, part] == 0, begin[part], np.where(errors[row, part] == 1, where, -1))


def _near_pairs(t: pa.Table, percent: int, distance: int) -> pa.Table:
    """(a, b) of the members of t's lists (key, id, n, label, side, sig) that lie in different components, have sizes that can
    link, and whose whole signatures are near; of two blocks' members only pairs of both sides. Of the lists that a pair is in,
    the one of the first key that it shares tells it, the others do not."""
    key, ids, n, label, side = (t.column(c).to_numpy() for c in ("key", "id", "n", "label", "side"))
    both = np.frombuffer(b"".join(t.column("sig").to_pylist()), np.uint8).reshape(len(ids), -1)
    index, sig = both[:, :SYMBOLS], both[:, SYMBOLS:]
    order = np.argsort(key, kind="stable")
    lists = runs(key[order])
    heads = order[[a for a, _ in lists]]
    number = (np.stack(list(chunk_keys(index[heads], distance))).view(np.int64) == key[heads]).argmax(0)  # which of its members' keys a list is of
    found = [np.empty((0, 2), np.int64)]
    for (a, b), own_key in zip(lists, number.tolist(), strict=True):
        own = order[a:b]
        names, of, many = np.unique(label[own], return_inverse=True, return_counts=True)
        if len(names) < 2:
            continue
        rest = np.flatnonzero(of != many.argmax())  # a pair of two components has a member outside the largest
        step = max(1, COMPARED // (len(own) * sig.shape[1]))
        for k in range(0, len(rest), step):
            u = own[rest[k : k + step]]
            x, y = np.nonzero((label[u][:, None] != label[own]) & (100 * np.minimum(n[u][:, None], n[own]) >= percent * np.maximum(n[u][:, None], n[own])) & ((side[u][:, None] != side[own]) | (side[own] < 0)))
            x, y = u[x], own[y]
            near = _UNLIKE[sig[x] ^ sig[y]].sum(1, dtype=np.int64) <= WHOLE_DISTANCE
            x, y = x[near], y[near]
            told = _first_shared(index[x], index[y], distance) == own_key
            i, j = ids[x[told]], ids[y[told]]
            found.append(np.stack((np.maximum(i, j), np.minimum(i, j)), axis=1))
    pairs = np.unique(np.concatenate(found), axis=0)
    return pa.table({"a": pa.array(pairs[:, 0]), "b": pa.array(pairs[:, 1])})


def _open_pairs(now: DataFrame, signed: DataFrame, percent: int, distance: int) -> DataFrame:
    """(a, b): the near pairs of different components in the lists (key, id, n, label). Lists meet in blocks of bounded size, in
    which signatures are compared where they lie: pairs that are not near never become rows."""
    size = now.groupBy("key").agg(F.count("*").alias("m")).select("key", F.expr(f"(m + {MEET - 1}) div {MEET}").alias("blocks"))
    rows = now.join(size, "key")
    total = int(now.count())
    columns = ["key", "id", "n", "label"]
    small = rows.where("blocks = 1").select(*columns, F.pmod(F.xxhash64("key"), F.lit(1 + total // (2 * MEET))).alias("task"), F.lit(-1).alias("i"), F.lit(-1).alias("j"), F.lit(-1).alias("side"))
    wide = rows.where("blocks > 1").withColumn("own", F.pmod(F.xxhash64("id", F.lit("block")), F.col("blocks"))).withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    side = F.when(F.col("own") == F.col("other"), -1).otherwise((F.col("own") > F.col("other")).cast("int"))
    wide = wide.select(*columns, F.col("key").alias("task"), F.least("own", "other").cast("int").alias("i"), F.greatest("own", "other").cast("int").alias("j"), side.alias("side"))

    def near(t: pa.Table) -> pa.Table:
        return _near_pairs(t, percent, distance)

    met = small.union(wide).join(signed.select("id", "sig"), "id").select(*columns, "side", "sig", "task", "i", "j")
    return met.groupBy("task", "i", "j").applyInArrow(near, "a long, b long").distinct()


def _roots(docs: DataFrame, signed: DataFrame, lists: DataFrame, words: int, percent: int, distance: int) -> DataFrame:
    """(id, root) of the components that all links of pairs in a list make.

    Two turns check each document against the pivot that it shares most keys with, of one and then of eight in each of its lists: most
    groups of copies are whole after these, and pairs within a component need no more checks. Then every pair of a list that
    lies in two components is checked, so that none is given up."""
    rich = lists.groupBy("key").agg((F.count("*") - 1).alias("m")).join(lists, "key").groupBy("id").agg(F.sum("m").alias("rich"))
    lists = materialize(lists.join(rich, "id").join(signed.select("id", "n"), "id").select("key", "id", "n", "rich"), "lists")
    sets = roots = None
    for turn in range(3):
        now = lists.withColumn("label", F.col("id")) if roots is None else lists.join(roots, "id", "left").select("key", "id", "n", "rich", F.coalesce("root", "id").alias("label"))
        still = now.groupBy("key").agg(F.min("label").alias("x"), F.max("label").alias("y")).where("x <> y").select("key")
        now = materialize(now.join(still, "key"), "open")
        if now.isEmpty():
            break
        if turn == 2:
            pairs = _open_pairs(now.drop("rich"), signed, percent, distance)
        else:
            pivots = now.groupBy("key", F.pmod(F.xxhash64("id"), F.lit((1, 8)[turn])).alias("salt")).agg(F.max(F.struct("rich", -F.col("id"), "n", "label")).alias("p"))
            pivots = pivots.select("key", (-F.col("p.col2")).alias("pivot"), F.col("p.n").alias("pn"), F.col("p.label").alias("plabel"))
            met = now.join(pivots, "key").where((F.col("label") != F.col("plabel")) & _near(percent, "n", "pn"))
            met = met.groupBy("id", "pivot").agg(F.count("*").alias("m")).where(F.col("m") >= ENOUGH)
            best = met.groupBy("id").agg(F.max(F.struct("m", -F.col("pivot"))).alias("p")).select("id", (-F.col("p.col2")).alias("pivot"))
            pairs = best.select(F.greatest("id", "pivot").alias("a"), F.least("id", "pivot").alias("b")).distinct()
        pairs = materialize(pairs, "pairs")
        wanted = pairs.select(F.col("a").alias("id")).union(pairs.select(F.col("b").alias("id"))).distinct()
        wanted = wanted if sets is None else wanted.join(sets.select("id"), "id", "left_anti")
        fresh = materialize(_sets_of(docs, wanted.join(signed.select("id", "same"), "id"), words), "sets")
        sets = fresh if sets is None else sets.union(fresh)
        new = materialize(_linked(pairs, sets, percent), "links")
        if not new.isEmpty():
            roots = components(new if roots is None else roots.select(F.col("id").alias("a"), F.col("root").alias("b")).union(new))
        lists = now.select("key", "id", "n", "rich")
    return lists.select("id", F.col("id").alias("root")).limit(0) if roots is None else roots


def minhash_near_dedup(docs: DataFrame, words: int = 2, percent: int = 80, distance: int = DISTANCE, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Groups documents whose sets of word shingles have a Jaccard similarity of percent / 100 or more, found by
    their signatures and confirmed on the full sets.

    Returns id, n_shingles, component_id (smallest id reachable by links) and kept (whether that is the document
    itself). A-Z are lower-cased; a text with fewer words than a shingle has one shingle; null text and text without
    words have none, link with nothing and are kept. Rows with a null id are left out of the join and returned with
    nulls, but kept. An id names one text: repeated rows give one row, and of an id with several texts the one whose set has
    the smallest digest stands for it. An empty table gives an empty result. Other columns are not read.

    All pairs of signatures within distance are found, however common a key is: equal sets fall into classes first, the
    rest meets in lists of keys. distance (and WHOLE_DISTANCE) go with percent: at a similarity of s, a symbol differs with
    probability 1 - s. Comparing signatures grows with the square of a group of different near copies that do not link; rows
    do not."""
    source = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    rows = signed_sets(source.where("id is not null"), words).groupBy("id").agg(F.min(F.struct("same", "n", "sig")).alias("s"))
    rows = materialize(rows.select("id", "s.*"), "signed")
    classes = rows.where("n > 0").groupBy("same").agg(F.min(F.struct("id", "n", "sig")).alias("s")).select("same", "s.*")
    classes = materialize(classes, "classes")
    lists = materialize(shared_keys(classes.select("id", "sig"), classes.count(), distance), "keys")
    roots = _roots(source, classes, lists, words, percent, distance)
    named = rows.select("id", "n", "same").join(classes.select("same", F.col("id").alias("rep")), "same", "left").join(roots.withColumnRenamed("id", "rep"), "rep", "left")
    component = F.coalesce("root", "rep", "id")
    out = named.select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), component.alias("component_id"), (component == F.col("id")).alias("kept"))
    nulls = source.where("id is null").select(F.col("id").alias(id_col), F.lit(None).cast("long").alias("n_shingles"), F.lit(None).cast("long").alias("component_id"), F.lit(True).alias("kept"))
    return out.unionByName(nulls)
