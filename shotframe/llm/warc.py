"""WARC with a Merkle fixity audit: records and their ordered offset ranges are hashed into trees; replicas are
compared from the root, and only mismatching branches are descended, down to the damaged records."""

from __future__ import annotations

import re
import zlib
from collections.abc import Callable, Iterator
from hashlib import sha256

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialize, text_bytes

#: Children of a node.
FANOUT = 16
#: The length of what lies behind a file's last record, whatever it is.
TO_END = -1
NAME = "part-{:06d}.warc.gz"
#: Bytes of text in a file.
FILE_BYTES = 256 << 20


def record(url: Column, body: Column, named: Column, date: str = "2024-01-01T00:00:00Z") -> Column:
    """A WARC/1.0 resource record of a page, as UTF-8 text; null url or body is empty, and white space and control
    characters of a url are left out. named goes into the record's id beside url and body."""
    url, body = F.regexp_replace(F.coalesce(url, F.lit("")), r"[\x00-\x20\x7f]", ""), F.coalesce(body, F.lit(""))  # a header holds no line break
    own = F.md5(F.concat_ws("\n", named, url, body).cast("binary"))
    uuid = F.concat_ws("-", *[F.substring(own, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))])
    head = [F.lit("WARC/1.0"), F.lit("WARC-Type: resource"), F.concat(F.lit("WARC-Target-URI: "), url), F.lit(f"WARC-Date: {date}"), F.concat(F.lit("WARC-Record-ID: <urn:uuid:"), uuid, F.lit(">")), F.lit("Content-Type: text/html"), F.concat(F.lit("Content-Length: "), F.octet_length(body).cast("string")), F.lit("")]
    return F.concat(F.concat_ws("\r\n", *head), F.lit("\r\n"), body, F.lit("\r\n\r\n"))


def write_warc(pages: DataFrame, folder: str, id_col: str = "page_id", url_col: str = "url", body_col: str = "html") -> DataFrame:
    """Writes a gzip member for each page, in id order, to files under folder, and returns the manifest: file, seq
    (its number in the file), id, offset and length. A file is moved into place when whole, so a task
    that runs twice does no harm. Null ids come first; repeated rows are written each, in an order that their content
    decides. A file has some 256 MB of text, so their number grows with the table. An empty table gives no files. Other columns are not read."""
    rows = pages.select(F.col(id_col).cast("long").alias("id"), record(F.col(url_col), F.col(body_col), F.coalesce(F.col(id_col).cast("string"), F.lit(""))).alias("record"))
    parts = max(int(pages.sparkSession.conf.get("spark.sql.shuffle.partitions")), text_bytes(pages, body_col) // FILE_BYTES)

    def written(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, top = fs.FileSystem.from_uri(folder)
        task = TaskContext.get()
        file, sink, at, seq = task.partitionId(), None, 0, 0
        draft = f"{top}/.{NAME.format(file)}-{task.taskAttemptId()}"
        for b in batches:
            out = []
            for i, text in zip(b.column(0).to_pylist(), b.column(1), strict=True):
                if sink is None:
                    store.create_dir(top, recursive=True)
                    sink = store.open_output_stream(draft)
                z = zlib.compressobj(6, zlib.DEFLATED, 31)
                member = z.compress(text.as_py().encode()) + z.flush()
                sink.write(member)
                out.append((file, seq, i, at, len(member)))
                at, seq = at + len(member), seq + 1
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out, strict=True)], ["file", "seq", "id", "offset", "length"])
        if sink is not None:
            sink.close()
            store.move(draft, f"{top}/{NAME.format(file)}")

    # the hash deals out the rows of a null or very common id; ranges of texts themselves would sample them
    rows = rows.withColumn("own", F.xxhash64("record")).repartitionByRange(parts, "id", "own").sortWithinPartitions("id", "own", "record").select("id", "record")
    return materialize(rows.mapInArrow(written, "file long, seq long, id long, offset long, length long"), "manifest")


def _parts(manifest: DataFrame, column: str) -> int:
    """Partitions for the records or files of a manifest: by stored bytes, or one a file."""
    found = manifest.agg(F.coalesce(F.sum("length"), F.lit(0)).alias("length"), F.coalesce(F.max("file") + 1, F.lit(0)).alias("file")).first()
    return max(int(manifest.sparkSession.conf.get("spark.sql.shuffle.partitions")), found.file if column == "file" else found.length // (FILE_BYTES // 4))


def _by_file(manifest: DataFrame) -> DataFrame:
    parts = _parts(manifest, "length")
    return manifest.repartition(parts, "file", F.expr("seq div 4096")).sortWithinPartitions("file", "seq")


def copy_warc(manifest: DataFrame, source: str, target: str, changed: Callable[[int | None, bytes], bytes] = lambda _, x: x) -> DataFrame:
    """Copies every file to a further replica, record by record; changed (of id and bytes) can hand on other bytes
    of the same length, as failing storage does. Returns the files copied."""

    def copied(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a, top = fs.FileSystem.from_uri(source)
        b, to = fs.FileSystem.from_uri(target)
        b.create_dir(to, recursive=True)
        name = src = sink = draft = None

        def close() -> None:
            if sink is not None:
                src.close()
                sink.close()
                b.move(draft, f"{to}/{name}")

        for batch in batches:
            done = []
            for file, i, offset, length in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if name != NAME.format(file):
                    close()
                    name = NAME.format(file)
                    draft = f"{to}/.{name}-{TaskContext.get().taskAttemptId()}"
                    src, sink = a.open_input_file(f"{top}/{name}"), b.open_output_stream(draft)
                    done.append(file)
                src.seek(offset)
                sink.write(changed(i, src.read(length)))
            if done:
                yield pa.RecordBatch.from_arrays([pa.array(done, pa.int64())], ["file"])
        close()

    rows = manifest.repartition(_parts(manifest, "file"), "file").sortWithinPartitions("file", "seq").select("file", "id", "offset", "length")
    return materialize(rows.mapInArrow(copied, "file long"), "copied")


def leaves(manifest: DataFrame, folder: str) -> DataFrame:
    """(file, node, start, end, hash) of each record of a replica, read at the manifest's offsets; a missing or
    short file gives the hash of what can be read."""

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, top = fs.FileSystem.from_uri(folder)
        name = f = None
        for b in batches:
            out = []
            for file, seq, offset, length in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if name != file:
                    if f is not None:
                        f.close()
                    name = file
                    try:
                        f = store.open_input_file(f"{top}/{NAME.format(file)}")
                    except FileNotFoundError:
                        f = None
                own, end = sha256(b"\0"), offset + length
                if f is not None and offset < f.size():
                    f.seek(offset)
                    if length == TO_END:
                        while data := f.read(1 << 20):
                            own.update(data)
                        end = f.size()
                    else:
                        own.update(f.read(length))
                out.append((file, seq, offset, end, own.hexdigest()))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.string() if k == 4 else pa.int64()) for k, c in enumerate(zip(*out, strict=True))], ["file", "node", "start", "end", "hash"])
        if f is not None:
            f.close()

    rows = _by_file(manifest).select("file", "seq", "offset", "length")
    return rows.mapInArrow(hashed, "file long, node long, start long, end long, hash string")


def merkle_levels(leaf: DataFrame, depth: int) -> list[DataFrame]:
    """Levels from the leaves to one root per file. A node covers FANOUT neighbours; its hash is that of their
    ordered offset ranges and hashes. Groups have FANOUT rows at most."""
    levels = [materialize(leaf, "level0")]
    for k in range(depth):
        child = F.struct("node", F.concat_ws(":", "start", "end", "hash").alias("part"))
        up = levels[-1].groupBy("file", F.expr(f"node div {FANOUT}").alias("parent")).agg(F.min("start").alias("start"), F.max("end").alias("end"), F.array_sort(F.collect_list(child)).alias("parts"))
        up = up.select("file", F.col("parent").alias("node"), "start", "end", F.sha2(F.concat(F.lit("1|"), F.array_join(F.col("parts.part"), "|")).cast("binary"), 256).alias("hash"))
        levels.append(materialize(up, f"level{k + 1}"))
    return levels


def merkle_root(roots: DataFrame) -> str:
    """The replica's hash: of its files' roots in order, in groups of FANOUT until one is left."""
    rows = roots.select(F.col("file").alias("node"), "hash")
    while True:
        rows = materialize(rows.groupBy(F.expr(f"node div {FANOUT}").alias("node")).agg(F.array_sort(F.collect_list(F.struct(F.col("node").alias("n"), "hash"))).alias("p")).select("node", F.sha2(F.array_join(F.col("p.hash"), "|").cast("binary"), 256).alias("hash")), "root")
        some = rows.take(2)
        if len(some) < 2 and (not some or some[0].node == 0):
            return some[0].hash if some else sha256(b"").hexdigest()


def _with_tails(manifest: DataFrame, folders: tuple[str, ...]) -> DataFrame:
    """The manifest, for each file a row of what lies behind its last record, and a row for each file of the folders
    that the manifest does not name. Names of files, no more, are listed on the driver."""
    found = set()
    for folder in folders:
        store, top = fs.FileSystem.from_uri(folder)
        names = (x.base_name for x in store.get_file_info(fs.FileSelector(top, allow_not_found=True)))
        found |= {int(m[1]) for m in map(re.compile(r"part-(\d+)\.warc\.gz").fullmatch, names) if m}
    spark = manifest.sparkSession
    tails = manifest.groupBy("file").agg((F.max("seq") + 1).alias("seq"), F.max(F.col("offset") + F.col("length")).alias("offset"))
    present = spark.createDataFrame([(x,) for x in sorted(found)], "file long")
    more = present.join(tails, "file", "left_anti").select("file", F.lit(0).cast("long").alias("seq"), F.lit(0).cast("long").alias("offset"))
    rows = tails.select("file", "seq", "offset").union(more).select("file", "seq", F.lit(None).cast("long").alias("id"), "offset", F.lit(TO_END).cast("long").alias("length"))
    return materialize(manifest.select("file", "seq", "id", "offset", "length").union(rows), "places")


def audit(manifest: DataFrame, folder: str, replica: str) -> DataFrame:
    """Compares a replica with the folder: one row per record of the manifest with its hash in either, and damaged;
    and a row with null id and length for each file that has other bytes behind its last record, or that the
    manifest does not name and that differs.

    Null and repeated ids keep a row per record, since places name them; an empty manifest and empty folders give
    no rows. Equal roots end the audit; else each level's nodes are compared only under parents that differ."""
    manifest = _with_tails(manifest, (folder, replica))
    top = manifest.agg(F.max("seq")).first()[0] or 0
    depth = 1
    while FANOUT**depth <= top:
        depth += 1
    left, right = (merkle_levels(leaves(manifest, x), depth) for x in (folder, replica))
    differ = None
    if merkle_root(left[-1]) != merkle_root(right[-1]):
        for level in range(depth, -1, -1):
            a, b = left[level], right[level]
            if differ is not None:
                under = differ.select("file", F.col("node").alias("parent"))
                a, b = (x.withColumn("parent", F.expr(f"node div {FANOUT}")).join(under, ["file", "parent"], "left_semi") for x in (a, b))
            differ = a.select("file", "node", "hash").join(b.select("file", "node", F.col("hash").alias("other")), ["file", "node"]).where("hash <> other").select("file", "node", "other")
    out = manifest.join(left[0].select("file", F.col("node").alias("seq"), "hash"), ["file", "seq"])
    if differ is None:
        return out.where(F.col("length") != TO_END).withColumn("replica_hash", F.col("hash")).withColumn("damaged", F.lit(False))
    found = differ.select("file", F.col("node").alias("seq"), "other")
    return out.join(found, ["file", "seq"], "left").withColumn("replica_hash", F.coalesce("other", "hash")).withColumn("damaged", F.col("other").isNotNull()).drop("other").where((F.col("length") != TO_END) | F.col("damaged")).withColumn("length", F.when(F.col("length") != TO_END, F.col("length")))
