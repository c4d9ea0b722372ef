"""Packing by shortest-pack-first over the length histogram: lengths are placed longest first into the pack
with the most room, as counts of packing patterns; documents then take the patterns' places by rank."""

from __future__ import annotations

import zlib
from bisect import insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import as_texts, materialize, text_chunks
from .tokens import alphabet, encoder


def shortest_pack_first(histogram: dict[int, int], capacity: int) -> list[tuple[int, list[tuple[int, int]]]]:
    """Patterns (how many packs, [(length, times), ...]) that place every length of the histogram.

    As if the pieces came longest first, each going to the pack with the most room, or to a new one if it
    fits in none; packs with equal contents are handled together as one count."""
    room: list[int] = []  # sorted, of the open patterns
    open_: dict[int, list[tuple[int, list[tuple[int, int]]]]] = {}

    def put(space: int, count: int, pattern: list[tuple[int, int]]) -> None:
        if space not in open_:
            insort(room, space)
            open_[space] = []
        open_[space].append((count, pattern))

    for length in sorted(histogram, reverse=True):
        left = histogram[length]
        while left and room and room[-1] >= length:
            space = room[-1]
            count, pattern = open_[space].pop()
            if not open_[space]:
                del open_[space]
                room.pop()
            took = min(left, count)
            grown = [*pattern[:-1], (length, pattern[-1][1] + 1)] if pattern[-1][0] == length else [*pattern, (length, 1)]
            put(space - length, took, grown)
            if count > took:
                put(space, count - took, pattern)
            left -= took
        each = capacity // length
        if left >= each:
            put(capacity - each * length, left // each, [(length, each)])
        if left % each:
            put(capacity - left % each * length, 1, [(length, left % each)])
    return [x for space in room for x in open_[space]]


def slots(patterns: list[tuple[int, list[tuple[int, int]]]]) -> dict[str, np.ndarray]:
    """Runs of places: the pieces of a length with ranks from rank on take sequence, sequence + 1, ... at offset."""
    rows, taken, sequence = [], {}, 0
    for count, pattern in patterns:
        offset = 0
        for length, times in pattern:
            for _ in range(times):
                rows.append((length, taken.get(length, 0), sequence, offset))
                taken[length] = taken.get(length, 0) + count
                offset += length
        sequence += count
    rows.sort()
    return {k: np.array([r[i] for r in rows], np.int64) for i, k in enumerate(("length", "rank", "sequence", "offset"))}


def encoded_pieces(docs: DataFrame, path: str, capacity: int, end_id: int, id_col: str, text_col: str) -> DataFrame:
    """(id, start, length, ids_crc32, doc_tokens) of each document's pieces of at most capacity ids."""

    letters = docs.sparkSession.sparkContext.broadcast(alphabet(path))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, end = encoder(path, letters.value), np.array([end_id], "<u4").tobytes()
        for ids, texts in text_chunks(batches):
            rows = []
            for i, x in zip(ids, enc.encode(as_texts(texts)), strict=True):
                x = x.astype("<u4").tobytes() + end
                for a in range(0, len(x), 4 * capacity):
                    part = x[a : a + 4 * capacity]
                    rows.append((i, a // 4, len(part) // 4, zlib.crc32(part), len(x) // 4))
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows, strict=True)], ["id", "start", "length", "ids_crc32", "doc_tokens"])

    return docs.select(F.col(id_col).cast("long"), F.col(text_col)).mapInArrow(cut, "id long, start long, length long, ids_crc32 long, doc_tokens long")


def pack_documents(docs: DataFrame, path: str, capacity: int = 4096, end_id: int = 2, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Places every document's ids, end_id after them, into sequences of at most capacity.

    Returns a row per piece: id, start, length, ids_crc32, doc_tokens, sequence_id and offset. Only texts
    longer than a sequence are cut, into whole sequences and a rest. Null text is empty (one id); null
    ids are kept and come first; repeated rows are packed each. Other columns are not read; an empty
    table gives an empty result.

    The histogram has at most capacity rows, so it and its patterns fit the driver at any size of input.
    Ranks are counted within salted groups of a length, so that one very common length is no hot key."""
    spark = docs.sparkSession
    pieces = materialize(encoded_pieces(docs, path, capacity, end_id, id_col, text_col), "pieces")
    histogram = {r.length: r["count"] for r in pieces.groupBy("length").count().collect()}
    at = spark.sparkContext.broadcast(slots(shortest_pack_first(histogram, capacity)))
    salts = max(16, int(spark.conf.get("spark.sql.shuffle.partitions")))
    salted = pieces.withColumn("salt", F.pmod(F.xxhash64("id", "start"), F.lit(salts)))
    before = salted.groupBy("length", "salt").count().select("length", "salt", (F.sum("count").over(W.partitionBy("length").orderBy("salt")) - F.col("count")).alias("before"))
    order = W.partitionBy("length", "salt").orderBy("id", "start", "ids_crc32", "doc_tokens")
    ranked = salted.withColumn("own", F.row_number().over(order) - 1).join(before, ["length", "salt"])

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        s = at.value
        key = s["length"] << np.int64(48) | s["rank"]
        for b in batches:
            length, rank = (b.column(b.schema.get_field_index(k)).to_numpy(zero_copy_only=False) for k in ("length", "rank"))
            i = np.searchsorted(key, length << np.int64(48) | rank, side="right") - 1
            yield pa.RecordBatch.from_arrays([*b.columns[:5], pa.array(s["sequence"][i] + rank - s["rank"][i]), pa.array(s["offset"][i])], [*b.schema.names[:5], "sequence_id", "offset"])

    ranked = ranked.select("id", "start", "length", "ids_crc32", "doc_tokens", (F.col("before") + F.col("own")).cast("long").alias("rank"))
    return ranked.mapInArrow(placed, "id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long").withColumnRenamed("id", id_col)
