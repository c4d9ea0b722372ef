"""Substring dedup: Rabin-Karp hashes of all word windows, counted across documents; repeated windows
merge into maximal removal intervals."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import as_bytes, materialize, text_bytes, text_chunks
from .windows import bucket_bits, by_bucket, cuts, packed, packed_hashes, packed_ids, packed_numbers, unpacked, unpacked_hashes, unpacked_ids, unpacked_numbers, window_hashes

#: Windows that a task gathers before it sends them on.
BLOCK = 1_000_000


def _group(ids: np.ndarray, bits: int) -> np.ndarray:
    """The group that a document is put together in."""
    return ((ids.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - bits)).astype(np.int64)


def _least(h: np.ndarray, check: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """Of each window, the smallest document that has it."""
    order = np.argsort(h)
    if (np.diff(h[order]) == 0)[np.diff(check[order].astype(np.int64)) != 0].any():  # different windows of equal first hash
        order = np.lexsort((check, h))
    a, c = h[order], check[order]
    first = np.flatnonzero(np.concatenate(([True], (a[1:] != a[:-1]) | (c[1:] != c[:-1])))) if len(h) else np.empty(0, int)
    out = np.empty_like(ids)
    if len(h):
        out[order] = np.repeat(np.minimum.reduceat(ids[order], first), np.diff(np.append(first, len(h))))
    return out


def _by_group(ids: np.ndarray, pos: np.ndarray, bits: int) -> tuple[np.ndarray, pa.Array, pa.Array]:
    """Groups, ids and window starts of windows to remove: a row a group."""
    group = _group(ids, bits)
    order = np.lexsort((pos, ids, group))
    ids, pos, group = ids[order], pos[order], group[order]
    at = cuts(group)
    return group[at[:-1]], packed_ids(ids, at), packed_numbers(pos, at)


def substring_dedup(docs: DataFrame, window: int = 13, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Removes each word covered by a window whose word sequence also starts in a document with a smaller id.

    Returns id, n_words, n_removed, kept_text (kept words joined by one space) and removed (intervals of
    word numbers, end exclusive, maximal). Windows are judged on the input. Null text has no words; a row
    with a null id is returned whole and removes nothing. An id names one text: rows that repeat an id
    get the same result, once a row. Other columns are not read. Texts of fewer words than a window
    lose nothing; an empty table gives an empty result.

    Each task counts the windows of a block first: of windows that repeat in it only those of the smallest
    document are sent on, the others are known to go. A bucket finds for each hash the smallest document
    of all blocks and answers with the window starts to remove, so that a passage common to all documents
    costs a row a block. Two windows count as equal if their hashes, 96 bits in all, are.
    """
    source = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    bits = bucket_bits(text_bytes(source))

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def blocks():
            h, check, ids, pos = (np.concatenate(x) for x in zip(*held, strict=True))
            least = _least(h, check, ids)
            known = ids > least  # a smaller document of this block has the window
            bucket, order = by_bucket(h[~known], bits)
            at = cuts(bucket)
            group, *gone = _by_group(ids[known], pos[known], bits)
            none = packed(np.empty(0, np.uint8), np.zeros(len(group) + 1, np.int64))
            sent_on = [packed_hashes(h[~known][order], at), packed(check[~known][order], at), packed_ids(ids[~known][order], at), packed_numbers(pos[~known][order], at)]
            for keys, columns in ((bucket[at[:-1]], sent_on), (-1 - group, [none, none, *gone])):
                whole = pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), *columns], ["bucket", "h", "check", "ids", "pos"])
                step = len(keys) // 8 + 1
                for i in range(0, len(keys), step):
                    yield whole.slice(i, step)

        held, n = [], 0
        for ids, texts in text_chunks(batches):
            order = sorted((x, i) for i, x in enumerate(ids) if x is not None)
            if not order:
                continue
            w, check, doc, pos = window_hashes([texts[i] for _, i in order], window)
            if len(w):
                held.append((w, check, np.array([x for x, _ in order], np.int64)[doc], pos.astype(np.uint32)))
                n += len(w)
            if n >= BLOCK:
                yield from blocks()
                held, n = [], 0
        if held:
            yield from blocks()

    def repeated(t: pa.Table) -> pa.Table:
        bucket = t.column("bucket")[0].as_py()
        if bucket < 0:
            return pa.table({"g": pa.array([-1 - bucket] * len(t), pa.int64()), "ids": t.column("ids"), "pos": t.column("pos")})
        h, check, ids, pos = unpacked_hashes(t.column("h"), bucket, bits), unpacked(t.column("check"), np.uint32), unpacked_ids(t.column("ids")), unpacked_numbers(t.column("pos"))
        hit = ids > _least(h, check, ids)
        group, *gone = _by_group(ids[hit], pos[hit], bits)
        return pa.table([pa.array(group, pa.int64()), *gone], names=["g", "ids", "pos"])

    def sent(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        press = zstandard.ZstdCompressor(level=1).compress
        for b in batches:
            ids = b.column(0)
            texts = as_bytes(b.column(1))
            known = np.array([zlib.crc32(t) if x is None else x for x, t in zip(ids.to_pylist(), texts, strict=True)], np.int64)  # rows without an id are dealt out by their texts
            yield pa.RecordBatch.from_arrays([pa.array(_group(known, bits)), ids, pa.array([press(x) for x in texts], pa.binary())], ["g", "id", "z"])

    def cut(left: pa.Table, right: pa.Table) -> pa.Table:
        ids, pos = unpacked_ids(right.column("ids")), unpacked_numbers(right.column("pos")).astype(np.int64)
        order = np.lexsort((pos, ids))
        ids, pos = ids[order], pos[order]
        out = {"id": [], "n_words": [], "n_removed": [], "kept_text": [], "removed": []}
        inflate = zstandard.ZstdDecompressor().decompress
        for i, z in zip(left.column("id").to_pylist(), left.column("z").to_pylist(), strict=True):
            words = inflate(z).split()  # of bytes: at 0x20 and 0x09-0x0D alone
            a, b = (0, 0) if i is None else np.searchsorted(ids, [i, i + 1])
            spans, kept, n = [], words, 0
            if b > a:
                at = pos[a:b]
                new = np.flatnonzero(np.concatenate(([True], at[1:] > at[:-1] + window)))
                starts, ends = at[new], at[np.append(new[1:] - 1, len(at) - 1)] + window
                spans = [{"start": int(s), "end": int(e)} for s, e in zip(starts, ends, strict=True)]
                kept, last = [], 0
                for s in spans:
                    kept += words[last : s["start"]]
                    last = s["end"]
                kept += words[last:]
                n = len(words) - len(kept)
            for k, v in zip(out, (i, len(words), n, b" ".join(kept).decode("utf-8", "replace"), spans), strict=True):
                out[k].append(v)
        return pa.table({"id": pa.array(out["id"], pa.int64()), "n_words": pa.array(out["n_words"], pa.int64()), "n_removed": pa.array(out["n_removed"], pa.int64()), "kept_text": pa.array(out["kept_text"], pa.string()), "removed": pa.array(out["removed"], pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])))})

    found = source.mapInArrow(hashed, "bucket long, h binary, check binary, ids binary, pos binary").groupBy("bucket").applyInArrow(repeated, "g long, ids binary, pos binary")
    found = materialize(found, "repeats")
    texts = source.mapInArrow(sent, "g long, id long, z binary")
    return texts.groupBy("g").cogroup(found.groupBy("g")).applyInArrow(cut, "id long, n_words long, n_removed long, kept_text string, removed array<struct<start: long, end: long>>").withColumnRenamed("id", id_col)
