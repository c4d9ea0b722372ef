"""Running largest values of a detector's pixels, kept as one array for each block of pixels, and reports of progress.

A micro-batch is first combined into blocks where it is read; a block's state takes the larger values and is handed on only
if it changed, so that what leaves a batch is what the batch did, not the whole detector."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.listener import StreamingQueryListener
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import BinaryType, StructField, StructType

ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
PARTIAL = "kind string, block_row long, block_col long, side int, values binary"
CHANGED = "kind string, block_row long, block_col long, side int, values array<double>"
#: Blocks that a task combines before it sends them on.
HELD = 4096


def combined_blocks(pixels: DataFrame, n_peaks: Column, min_peaks: int = 2, side: int = 64) -> DataFrame:
    """Pixels (row, col, value) of hits and misses as blocks of side x side largest values, one for each block that
    a task meets; pixels that it does not meet, and values that are no number, are not a number in it."""
    rows = pixels.select(F.when(n_peaks >= min_peaks, "hit").otherwise("miss").alias("kind"), F.col("row").cast("long").alias("row"), F.col("col").cast("long").alias("col"), F.col("value").cast("double").alias("value")).where("row is not null and col is not null")

    def combine(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple, np.ndarray] = {}

        def out() -> pa.RecordBatch:
            keys = list(held)
            columns = [pa.array([k[0] for k in keys], pa.string()), *(pa.array([k[i] for k in keys], pa.int64()) for i in (1, 2)), pa.array([side] * len(keys), pa.int32()), pa.array([held[k].tobytes() for k in keys], pa.binary())]
            return pa.RecordBatch.from_arrays(columns, ["kind", "block_row", "block_col", "side", "values"])

        for b in batches:
            if not b.num_rows:
                continue
            kind = np.array(b.column(0).to_pylist(), object)
            row, col = (b.column(i).to_numpy(zero_copy_only=False) for i in (1, 2))
            value = b.column(3).to_numpy(zero_copy_only=False)
            at = pd.MultiIndex.from_arrays([kind, row // side, col // side])
            code, keys = pd.factorize(at)
            for k, key in enumerate(keys):
                mine = code == k
                block = held.setdefault((key[0], int(key[1]), int(key[2])), np.full(side * side, np.nan))
                np.fmax.at(block, (row[mine] % side) * side + col[mine] % side, value[mine])
            if len(held) >= HELD:
                yield out()
                held.clear()
        if held:
            yield out()

    return rows.mapInArrow(combine, PARTIAL)


class LargestBlocks(StatefulProcessor):
    """Keeps the block of a key; hands it on when a value in it grew or appeared."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.block = handle.getValueState("block", StructType([StructField("values", BinaryType())]))

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        old = np.frombuffer(self.block.get()[0]) if self.block.exists() else None
        new, side = old, 0
        for part in rows:
            side = int(part["side"].iloc[0]) if len(part) else side
            for values in part["values"]:
                own = np.frombuffer(values)
                new = own if new is None else np.fmax(new, own)
        if new is not None and (old is None or not np.array_equal(old, new, equal_nan=True)):
            self.block.update((new.tobytes(),))
            yield pd.DataFrame({"kind": [key[0]], "block_row": [key[1]], "block_col": [key[2]], "side": [side], "values": [new.tolist()]})

    def close(self) -> None:
        pass


def stream_powder_blocks(pixels: DataFrame, n_peaks: Column, min_peaks: int = 2, side: int = 64) -> DataFrame:
    """The blocks that each micro-batch changes; update mode. State needs the RocksDB provider, which is set here."""
    pixels.sparkSession.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKS)
    by = combined_blocks(pixels, n_peaks, min_peaks, side).groupBy("kind", "block_row", "block_col")
    return by.transformWithStateInPandas(LargestBlocks(), CHANGED, "Update", "None")


def run_to_batches(changed: DataFrame, folder: str, checkpoint: str) -> StreamingQuery:
    """All data that is there now; what a batch changed goes to a folder of its number, which a repeated batch overwrites."""

    def save(batch: DataFrame, number: int) -> None:
        batch.withColumn("batch", F.lit(number).cast("long")).write.mode("overwrite").parquet(f"{folder}/batch-{number:09d}")

    query = changed.writeStream.outputMode("update").option("checkpointLocation", checkpoint).trigger(availableNow=True).foreachBatch(save).start()
    query.awaitTermination()
    return query


def powder_of_batches(spark: SparkSession, folder: str) -> DataFrame:
    """(kind, row, col, value) as it stands: each block as the last batch left it, 0 at least, without pixels never seen."""
    blocks = spark.read.schema(f"{CHANGED}, batch long").parquet(f"{folder}/batch-*")
    last = blocks.groupBy("kind", "block_row", "block_col").agg(F.max_by(F.struct("side", "values"), "batch").alias("b"))
    cells = last.select("kind", "block_row", "block_col", F.col("b.side").alias("side"), F.posexplode("b.values").alias("at", "value")).where(F.col("value").isNotNull() & ~F.isnan("value"))
    place = lambda block, within: (F.col(block) * F.col("side") + within).cast("long")
    return cells.select("kind", place("block_row", F.expr("at div side")).alias("row"), place("block_col", F.col("at") % F.col("side")).alias("col"), F.greatest(F.lit(0.0), "value").alias("value"))


def steps_passed(before: int, now: int) -> list[int]:
    """Counts to report in (before, now]: of each tenth of the first hundred, hundredth of the first thousand and thousandth
    from then on the last that was passed, with 100 and 1000 themselves."""
    out = []
    for low, high, step in ((0, 100, 10), (100, 1000, 100), (1000, None, 1000)):
        top = now if high is None else min(now, high)
        last = top // step * step
        if last > max(before, low):
            out.append(last)
    return out


class ProgressReporter(StreamingQueryListener):
    """Hands (events, hits) to report whenever a query's observed counts (see reductions.counted) pass a step. Counts
    are those since the listener was added; a batch that is reported twice counts once."""

    def __init__(self, name: str, report: Callable[[int, int, int], None]):
        self.name, self.report = name, report
        self.events = self.hits = 0
        self.seen: set[tuple[str, int]] = set()

    def onQueryStarted(self, event) -> None:  # noqa: N802
        pass

    def onQueryIdle(self, event) -> None:  # noqa: N802
        pass

    def onQueryTerminated(self, event) -> None:  # noqa: N802
        pass

    def onQueryProgress(self, event) -> None:  # noqa: N802
        p = event.progress
        row = (p.observedMetrics or {}).get(self.name)
        batch = (str(p.id), p.batchId)
        if row is None or batch in self.seen:
            return
        self.seen = {b for b in self.seen if b[0] != batch[0] or b[1] >= p.batchId - 2} | {batch}
        before = self.events
        self.events, self.hits = before + row.events, self.hits + row.hits
        for step in steps_passed(before, self.events):
            self.report(step, self.events, self.hits)
