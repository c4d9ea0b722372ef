"""Helpers that the operators share: the shared folder, written cuts of lineage, small codecs."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_OWN: dict[str, str] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """A fresh folder under spark.checkpoint.dir. Where that is unset, a temporary one in local mode; on a cluster,
    whose machines would not see it, an error."""
    top = spark.conf.get("spark.checkpoint.dir", "")
    if not top:
        if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        if "dir" not in _OWN:
            _OWN["dir"] = tempfile.mkdtemp(prefix="spark-shotframe-")
        top = _OWN["dir"]
    return f"{top.rstrip('/')}/shotframe-{uuid.uuid4().hex}"


def materialize(df: DataFrame, tag: str = "cut") -> DataFrame:
    """Writes df to the shared folder and reads it back: lineage ends there, and lost executors
    cost nothing that was written. Shuffle files of the write are released when it ends."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{tag}"
    before = spark.conf.get(_CLEANUP, "false")
    try:
        spark.conf.set(_CLEANUP, "true")
        df.write.parquet(path)
    finally:
        spark.conf.set(_CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)


def text_bytes(docs: DataFrame, text: str = "text") -> int:
    """UTF-8 bytes of all texts: one aggregate, used to size partitions."""
    return int(docs.agg(F.coalesce(F.sum(F.octet_length(text)), F.lit(0))).first()[0])


def squeeze(a: np.ndarray) -> bytes:
    """An integer array as byte planes under zstandard; the first byte is its item size."""
    a = np.ascontiguousarray(a)
    planes = a.view(np.uint8).reshape(-1, a.itemsize).T.tobytes() if len(a) else b""
    return bytes([a.itemsize]) + zstandard.ZstdCompressor(level=1).compress(planes)


def unsqueeze(b: bytes) -> np.ndarray:
    size, planes = b[0], zstandard.ZstdDecompressor().decompress(b[1:])
    return np.frombuffer(planes, np.uint8).reshape(size, -1).T.copy().view(f"<u{size}").ravel()


def squeeze_ids(ids: np.ndarray) -> bytes:
    """Signed 64-bit ids by their differences."""
    return squeeze(np.diff(ids, prepend=np.int64(0)).view(np.uint64))


def unsqueeze_ids(b: bytes) -> np.ndarray:
    return np.cumsum(unsqueeze(b).view(np.int64))


def as_bytes(column: pa.Array) -> list[bytes]:
    """Texts as UTF-8; null is the empty text."""
    kind = pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()
    return [x or b"" for x in column.cast(kind).to_pylist()]


def as_texts(texts: list[bytes]) -> list[str]:
    return [t.decode("utf-8", "replace") for t in texts]


def text_chunks(batches: Iterator[pa.RecordBatch], limit: int = 1 << 20) -> Iterator[tuple[list, list[bytes]]]:
    """(ids, texts) of some documents at a time, about limit bytes; a longer text comes alone.

    Expects the columns id, text in this order."""
    ids, texts, size = [], [], 0
    for batch in (b.slice(a, 128) for b in batches for a in range(0, b.num_rows, 128)):  # copies few rows at a time
        for i, t in zip(batch.column(0).to_pylist(), as_bytes(batch.column(1)), strict=True):
            if texts and size + len(t) > limit:
                yield ids, texts
                ids, texts, size = [], [], 0
            ids.append(i)
            texts.append(t)
            size += len(t) + 1
    if texts:
        yield ids, texts
