"""Stacks: shot tables kept as array files, a file a column, whose first axis is the shot; read by ranges of shots.

A stack is a folder of parts, each a folder of .npy files, or .h5 files (where h5py is installed) whose datasets of the length of
the first axis are columns; or one such part or .npy file. Shots are numbered over all parts in the order of
their names. Headers alone are read to plan: a task gets (part, start, stop) and reads these bytes of the columns that are asked
for, so a range of shots costs what it holds.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, Filter, GreaterThan, GreaterThanOrEqual, InputPartition, LessThan, LessThanOrEqual
from pyspark.sql.types import ArrayType, BooleanType, ByteType, DataType, DoubleType, FloatType, IntegerType, LongType, ShortType, StructField, StructType

SHOT = "shot"
HDF5 = (".h5", ".hdf5", ".cxi")
#: Bytes of a task's range, and of a batch within it.
RANGE, BATCH = 64 << 20, 4 << 20
_KINDS: dict[str, DataType] = {"b1": BooleanType(), "i1": ByteType(), "u1": ShortType(), "i2": ShortType(), "u2": IntegerType(), "i4": IntegerType(), "u4": LongType(), "i8": LongType(), "f4": FloatType(), "f8": DoubleType()}
_NUMPY = {"boolean": "?", "tinyint": "i1", "smallint": "<i2", "int": "<i4", "bigint": "<i8", "float": "<f4", "double": "<f8"}


@dataclass(frozen=True)
class Array:
    """A column in a part: where it lies, its element type and the shape of one shot's value."""

    file: str
    name: str
    dtype: str
    shape: tuple[int, ...]
    offset: int = 0

    @property
    def width(self) -> int:
        return np.dtype(self.dtype).itemsize * int(np.prod(self.shape, dtype=np.int64))

    @property
    def kind(self) -> DataType:
        out = _KINDS[np.dtype(self.dtype).str[1:]]
        for _ in self.shape:
            out = ArrayType(out, False)
        return out


@dataclass
class Part:
    rows: int
    columns: dict[str, Array] = field(default_factory=dict)


def store_of(path: str):
    """A file system and the path in it, of a URI or a local path."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(path) if "://" in path else (fs.LocalFileSystem(), path)


def _npy(store, path: str, name: str) -> tuple[int, Array]:
    with store.open_input_file(path) as f:
        version = np.lib.format.read_magic(f)
        shape, fortran, dtype = np.lib.format.read_array_header_1_0(f) if version == (1, 0) else np.lib.format.read_array_header_2_0(f)
        at = f.tell()
    if not shape or fortran and len(shape) > 1 or dtype.str[1:] not in _KINDS:
        raise ValueError(f"{path} is no array of numbers by shots")
    return shape[0], Array(path, name, dtype.str, tuple(shape[1:]), at)


def _hdf5(path: str) -> Part:
    import h5py

    with h5py.File(path) as f:
        found: dict[str, tuple] = {}
        f.visititems(lambda n, d: found.__setitem__(n, (d.shape, d.dtype)) if getattr(d, "shape", None) else None)
    rows = found["event_time"][0][0] if "event_time" in found else max((s[0] for s, _ in found.values()), default=0)
    return Part(rows, {n: Array(path, n, t.str, tuple(s[1:])) for n, (s, t) in found.items() if s[0] == rows and t.str[1:] in _KINDS})


def parts_of(path: str) -> list[Part]:
    """The parts of a stack by their names, from headers alone."""
    from pyarrow import fs

    if path.endswith(HDF5):
        return [_hdf5(path)]
    store, top = store_of(path)
    if top.endswith(".npy"):
        rows, array = _npy(store, top, top.rsplit("/", 1)[-1].removesuffix(".npy"))
        return [Part(rows, {array.name: array})]
    out, own = [], Part(-1)
    for info in sorted(store.get_file_info(fs.FileSelector(top)), key=lambda i: i.path):
        base = info.path.rsplit("/", 1)[-1]
        if base.startswith(("_", ".")):
            continue
        if info.type == fs.FileType.Directory:
            out += parts_of(f"{path.rstrip('/')}/{base}")
        elif base.endswith(HDF5):
            out.append(_hdf5(info.path))
        elif base.endswith(".npy"):
            rows, array = _npy(store, info.path, base.removesuffix(".npy").replace("%2F", "/"))
            if own.rows not in (-1, rows):
                raise ValueError(f"columns of {path} differ in their number of shots")
            own.rows, own.columns[array.name] = rows, array
    return out if own.rows < 0 else [*out, own]


@dataclass
class ShotRange(InputPartition):
    part: int
    first: int
    start: int
    stop: int


def _nested(a: np.ndarray) -> pa.Array:
    """An array of shots as Arrow lists in lists."""
    out = pa.array(a.reshape(-1))
    for size in reversed(a.shape[1:]):
        out = pa.ListArray.from_arrays(pa.array(np.arange(len(out) // size + 1, dtype=np.int32) * size), out) if size else pa.array([[]] * len(a), pa.list_(out.type))
    return out


class StackReader(DataSourceReader):
    def __init__(self, path: str, schema: StructType, parts: list[Part], range_bytes: int):
        self.path, self.schema, self.parts, self.range_bytes = path, schema, parts, range_bytes
        self.low, self.high = 0, sum(p.rows for p in parts)

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        """Bounds of the shot number become the range that is planned; other filters are left to Spark."""
        for f in filters:
            if getattr(f, "attribute", None) != (SHOT,) or not isinstance(getattr(f, "value", None), int):
                yield f
            elif isinstance(f, EqualTo):
                self.low, self.high = max(self.low, f.value), min(self.high, f.value + 1)
            elif isinstance(f, GreaterThanOrEqual):
                self.low = max(self.low, f.value)
            elif isinstance(f, GreaterThan):
                self.low = max(self.low, f.value + 1)
            elif isinstance(f, LessThan):
                self.high = min(self.high, f.value)
            elif isinstance(f, LessThanOrEqual):
                self.high = min(self.high, f.value + 1)
            else:
                yield f

    def _wanted(self, part: Part) -> list[Array]:
        missing = [n for n in self.schema.names if n != SHOT and n not in part.columns]
        if missing:
            raise KeyError(f"{self.path} has no {', '.join(missing)}")
        return [part.columns[n] for n in self.schema.names if n != SHOT]

    def partitions(self) -> list[InputPartition]:
        out, first = [], 0
        for k, part in enumerate(self.parts):
            a, b = max(0, self.low - first), min(part.rows, self.high - first)
            step = max(1, self.range_bytes // max(1, 8 + sum(c.width for c in self._wanted(part))))
            out += [ShotRange(k, first, i, min(b, i + step)) for i in range(a, b, step)]
            first += part.rows
        return out or [ShotRange(0, 0, 0, 0)]

    def read(self, partition: ShotRange) -> Iterator[pa.RecordBatch]:
        """A range in batches: of each column the bytes from its first shot to its last."""
        if partition.start == partition.stop:
            return
        columns = {c.name: c for c in self._wanted(self.parts[partition.part])}
        step = max(1, BATCH // max(1, 8 + sum(c.width for c in columns.values())))
        arrow = pa.schema([(f.name, _arrow(f.dataType)) for f in self.schema])
        opened = {n: _Opened(c) for n, c in columns.items()}
        try:
            for a in range(partition.start, partition.stop, step):
                b = min(partition.stop, a + step)
                values = [pa.array(np.arange(partition.first + a, partition.first + b)) if f.name == SHOT else _nested(opened[f.name].rows(a, b)) for f in self.schema]
                yield pa.RecordBatch.from_arrays([v.cast(t.type) for v, t in zip(values, arrow, strict=True)], schema=arrow)
        finally:
            for o in opened.values():
                o.close()


class _Opened:
    """A column's file while its range is read."""

    def __init__(self, column: Array):
        self.column = column
        if column.file.endswith(HDF5):
            import h5py

            self.file = h5py.File(column.file)
        else:
            store, path = store_of(column.file)
            self.file = store.open_input_file(path)

    def rows(self, a: int, b: int) -> np.ndarray:
        c = self.column
        if c.file.endswith(HDF5):
            return np.asarray(self.file[c.name][a:b])
        self.file.seek(c.offset + a * c.width)
        return np.frombuffer(self.file.read((b - a) * c.width), c.dtype).astype(np.dtype(c.dtype).newbyteorder("="), copy=False).reshape(b - a, *c.shape)

    def close(self) -> None:
        self.file.close()


def _arrow(kind: DataType) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type

    return to_arrow_type(kind)


class StackSource(DataSource):
    """spark.read.format("shot_stack").load(path). A schema given to the reader names the columns to read; all without
    one. Option rangeBytes: of a task."""

    @classmethod
    def name(cls) -> str:
        return "shot_stack"

    def _parts(self) -> list[Part]:
        return parts_of(self.options["path"])

    def schema(self) -> StructType:
        parts = self._parts()
        columns = parts[0].columns if parts else {}
        return StructType([StructField(SHOT, LongType(), False), *(StructField(n, c.kind, False) for n, c in sorted(columns.items()))])

    def reader(self, schema: StructType) -> StackReader:
        return StackReader(self.options["path"], schema, self._parts(), int(self.options.get("rangeBytes", RANGE)))


def read_stack(spark: SparkSession, path: str, columns: list[str] | None = None, range_bytes: int = RANGE) -> DataFrame:
    """(shot, columns) of a stack; only the files of these columns (default: all) are read. Filters on shot bound the ranges."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(StackSource)
    reader = spark.read.format("shot_stack").option("rangeBytes", range_bytes)
    if columns is not None:
        parts = parts_of(path)
        known = parts[0].columns if parts else {}
        missing = [c for c in columns if c not in known]
        if missing:
            raise KeyError(f"{path} has no {', '.join(missing)}")
        reader = reader.schema(StructType([StructField(SHOT, LongType()), *(StructField(c, known[c].kind) for c in columns)]))
    return reader.load(path)


def write_stack(df: DataFrame, folder: str, rows_per_part: int = 65_536) -> int:
    """df as a stack: a part for every rows_per_part rows of a partition, a .npy file for each column. Rows keep the order of
    the partitions; values of a column have one shape in a part and no nulls. Returns the number of shots. A part is written under another name first, so that a task that is run again leaves no half part and no second one."""
    kinds = {f.name: f.dataType.simpleString() for f in df.schema}
    dtypes = {n: _NUMPY[k.replace("array<", "").replace(">", "")] for n, k in kinds.items()}

    def save(store, top: str, name: str, columns: dict[str, list]) -> None:
        from pyarrow import fs

        made = f"{top}/.{name}-{uuid.uuid4().hex}"
        store.create_dir(made, recursive=True)
        for n, values in columns.items():
            a = np.ascontiguousarray(np.array(values, dtype=dtypes[n]))
            with store.open_output_stream(f"{made}/{n.replace('/', '%2F')}.npy") as f:
                np.lib.format.write_array_header_1_0(f, {"descr": a.dtype.str, "fortran_order": False, "shape": a.shape})
                f.write(a.tobytes())
        if store.get_file_info(f"{top}/{name}").type != fs.FileType.NotFound:
            store.delete_dir(f"{top}/{name}")  # of an attempt that was lost
        store.move(made, f"{top}/{name}")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, top = store_of(folder)
        held, number = {n: [] for n in kinds}, 0
        names, sizes = [], []

        def flush() -> None:
            names.append(f"part-{TaskContext.get().partitionId():06d}-{number:06d}")
            sizes.append(len(next(iter(held.values()))))
            save(store, top, names[-1], held)

        for b in batches:
            for k in range(0, b.num_rows, 1024):
                some = b.slice(k, 1024)
                for n in held:
                    held[n] += some.column(some.schema.get_field_index(n)).to_pylist()
                if len(next(iter(held.values()))) >= rows_per_part:
                    flush()
                    held, number = {n: [] for n in kinds}, number + 1
        if next(iter(held.values())):
            flush()
        yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array(sizes, pa.int64())], ["part", "rows"])

    parts = df.mapInArrow(write, "part string, rows long")
    return int(parts.agg(F.coalesce(F.sum("rows"), F.lit(0))).first()[0])


def read_stacked_image(spark: SparkSession, path: str, range_bytes: int = RANGE) -> DataFrame:
    """(row, col, value) of a two-dimensional .npy file, by ranges of rows."""
    (part,) = parts_of(path)
    (array,) = part.columns.values()
    if len(array.shape) != 1:
        raise ValueError("an image has two dimensions")
    rows = read_stack(spark, path, [array.name], range_bytes)
    return rows.select(F.col(SHOT).alias("row"), F.posexplode(F.col(f"`{array.name}`")).alias("col", "value")).select("row", F.col("col").cast("long").alias("col"), F.col("value").cast("double").alias("value"))
