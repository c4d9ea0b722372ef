"""Token ids in seekable Zstandard files: independent frames, a directory of documents, and a trailing seek
table with a checksum for each frame, so that readers decompress only the frames of requested documents.

A file is frames of ids (little-endian unsigned 32-bit), a skippable frame with the directory, and the
skippable frame of the public seekable format: for each frame its compressed size, its size and the low 32
bits of its XXH64; then the number of frames, a descriptor byte and the magic number.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import as_texts, materialize, squeeze, squeeze_ids, text_bytes, text_chunks, unsqueeze, unsqueeze_ids
from .tokens import alphabet, encoder

# Fixed values of the public Zstandard formats.
SKIPPABLE_DIRECTORY, SKIPPABLE_SEEK_TABLE, SEEKABLE_MAGIC, CHECKSUM_FLAG = 0x184D2A50, 0x184D2A5E, 0x8F92EAB1, 0x80
#: Uncompressed bytes from which a frame is closed; a document lies in one frame.
FRAME_BYTES = 1 << 18
#: A null id is written as this and read as null.
NO_ID = -(1 << 63)


class Writer:
    """Writes one file in a single pass."""

    def __init__(self, sink, level: int = 1):
        self.sink, self.press = sink, zstandard.ZstdCompressor(level=level, write_checksum=True)
        self.frames: list[tuple[int, int, int]] = []
        self.ids: list[int] = []
        self.sizes: list[int] = []
        self.frame_of: list[int] = []
        self.open: list[bytes] = []
        self.held = 0

    def add(self, doc_id: int, ids: bytes) -> None:
        self.ids.append(doc_id)
        self.sizes.append(len(ids) // 4)
        self.frame_of.append(len(self.frames))
        self.open.append(ids)
        self.held += len(ids)
        if self.held >= FRAME_BYTES:
            self._close_frame()

    def _close_frame(self) -> None:
        if self.open:
            raw = b"".join(self.open)
            frame = self.press.compress(raw)
            self.sink.write(frame)
            self.frames.append((len(frame), len(raw), xxhash.xxh64_intdigest(raw) & 0xFFFFFFFF))
            self.open, self.held = [], 0

    def close(self) -> None:
        self._close_frame()
        parts = [squeeze_ids(np.array(self.ids, np.int64)), squeeze(np.array(self.sizes, np.uint32)), squeeze(np.array(self.frame_of, np.uint32))]
        directory = struct.pack("<3I", *map(len, parts)) + b"".join(parts)
        self.sink.write(struct.pack("<2I", SKIPPABLE_DIRECTORY, len(directory)) + directory)
        table = b"".join(struct.pack("<3I", *x) for x in self.frames) + struct.pack("<IBI", len(self.frames), CHECKSUM_FLAG, SEEKABLE_MAGIC)
        self.sink.write(struct.pack("<2I", SKIPPABLE_SEEK_TABLE, len(table)) + table)


class Reader:
    """Reads the tail of a file, then only the frames that are asked for. Raises ValueError on damage."""

    def __init__(self, source):
        self.source, size = source, source.size()
        n, flag, magic = struct.unpack("<IBI", self._at(size - 9, 9))
        if magic != SEEKABLE_MAGIC or flag != CHECKSUM_FLAG:
            raise ValueError("no seek table with checksums")
        self.frames = np.frombuffer(self._at(size - 9 - 12 * n, 12 * n), "<u4").reshape(-1, 3)
        self.begins = np.concatenate(([0], np.cumsum(self.frames[:, 0], dtype=np.int64)))
        magic, length = struct.unpack("<2I", self._at(int(self.begins[-1]), 8))
        if magic != SKIPPABLE_DIRECTORY:
            raise ValueError("no directory")
        d = self._at(int(self.begins[-1]) + 8, length)
        a, b, c = struct.unpack("<3I", d[:12])
        self.ids, self.sizes, self.frame_of = unsqueeze_ids(d[12 : 12 + a]), unsqueeze(d[12 + a : 12 + a + b]), unsqueeze(d[12 + a + b : 12 + a + b + c])

    def _at(self, start: int, n: int) -> bytes:
        self.source.seek(start)
        return self.source.read(n)

    def frame(self, k: int) -> bytes:
        size, raw_size, check = map(int, self.frames[k])
        raw = zstandard.ZstdDecompressor().decompress(self._at(int(self.begins[k]), size))
        if len(raw) != raw_size or xxhash.xxh64_intdigest(raw) & 0xFFFFFFFF != check:
            raise ValueError(f"frame {k} is damaged")
        return raw

    def documents(self, wanted: Iterable[int] | None = None) -> Iterator[tuple[int, int, bytes]]:
        """(id, ids before it in the file, its ids) of all documents, or of those wanted."""
        before = np.concatenate(([0], np.cumsum(self.sizes, dtype=np.int64)))
        at = np.arange(len(self.ids)) if wanted is None else np.flatnonzero(np.isin(self.ids, np.array(list(wanted), np.int64)))
        last, raw, begin = -1, b"", 0
        for i in at.tolist():
            k = int(self.frame_of[i])
            if k != last:
                last, raw = k, self.frame(k)
                begin = int(before[np.searchsorted(self.frame_of, k)])
            a = 4 * (int(before[i]) - begin)
            yield int(self.ids[i]), int(before[i]), raw[a : a + 4 * int(self.sizes[i])]


def write_token_ids(docs: DataFrame, path: str, folder: str, end_id: int = 2, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Writes the ids of every text, each with end_id after it, to files under folder in ascending id order.

    Returns one row per file in that order: file, n_docs, n_ids, and start (ids in the files before). Ids are
    dealt by range, so each task writes one file, under another name until it is whole: a task that
    runs twice does no harm. Null text is empty; null ids come first; rows that repeat an id lie side
    by side, in an order that their texts decide. An empty table gives no files. Other columns are not read."""
    spark = docs.sparkSession
    source = docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(NO_ID)).alias("id"), F.col(text_col).alias("text"))
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), text_bytes(source) // (64 << 20))

    letters = spark.sparkContext.broadcast(alphabet(path))

    def written(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, top = fs.FileSystem.from_uri(folder)
        enc, end, file, to = encoder(path, letters.value), np.array([end_id], "<u4").tobytes(), TaskContext.get().partitionId(), None
        name, draft = f"{top}/ids-{file:06d}.zst", f"{top}/.ids-{file:06d}-{TaskContext.get().taskAttemptId()}"
        for ids, texts in text_chunks(batches):
            if to is None:
                store.create_dir(top, recursive=True)
                sink = store.open_output_stream(draft)
                to = Writer(sink)
            for i, x in zip(ids, enc.encode(as_texts(texts)), strict=True):
                to.add(i, x.astype("<u4").tobytes() + end)
        if to is not None:
            to.close()
            sink.close()
            store.move(draft, name)
            yield pa.RecordBatch.from_arrays([pa.array([x]) for x in (file, len(to.ids), int(np.sum(to.sizes, dtype=np.int64)))], ["file", "n_docs", "n_ids"])

    # the hash deals out the rows of a null or very common id
    dealt = source.withColumn("own", F.xxhash64("text")).repartitionByRange(parts, "id", "own").sortWithinPartitions("id", "own", "text").select("id", "text")
    files = materialize(dealt.mapInArrow(written, "file long, n_docs long, n_ids long"), "files")
    before = F.coalesce(F.sum("n_ids").over(W.orderBy("file").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    return files.select("file", "n_docs", "n_ids", before.alias("start"))  # a row for each file, no more


def read_token_ids(files: DataFrame, folder: str, id_col: str = "doc_id", wanted: Iterable[int] | None = None) -> DataFrame:
    """Documents of the files that write_token_ids gave: id, start (ids of all documents before), n_tokens,
    ids_crc32 and ids. wanted: read only the frames of these ids."""
    chosen = None if wanted is None else sorted(wanted)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, top = fs.FileSystem.from_uri(folder)
        for batch in batches:
            for file, start in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                with store.open_input_file(f"{top}/ids-{file:06d}.zst") as f:
                    rows, held = [], 0
                    for i, before, ids in Reader(f).documents(chosen):
                        rows.append((None if i == NO_ID else i, start + before, len(ids) // 4, zlib.crc32(ids), ids))
                        held += len(ids)
                        if held > 8 << 20:
                            yield _rows(rows)
                            rows, held = [], 0
                    if rows:
                        yield _rows(rows)

    def _rows(rows: list) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary()), strict=True)], ["id", "start", "n_tokens", "ids_crc32", "ids"])

    n = max(1, int(files.sparkSession.conf.get("spark.sql.shuffle.partitions")), files.count())
    return files.select("file", "start").repartition(n, "file").mapInArrow(read, "id long, start long, n_tokens long, ids_crc32 long, ids binary").withColumnRenamed("id", id_col)
