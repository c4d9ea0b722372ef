"""Streaming forms of the stateful reductions. Aggregations keep their state in the checkpoint, so replays do no harm."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from shotframe.operators.images import powder_max, run_sums


def live_shots(spark: SparkSession, folder: str, schema, files_per_batch: int = 25) -> DataFrame:
    """Shots from Parquet files as they arrive."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(folder)


def stream_powder_max(pixels: DataFrame, n_peaks: Column, min_peaks: int = 2) -> DataFrame:
    """Running largest value of each pixel, over hits and over misses; complete or update mode."""
    return powder_max(pixels, n_peaks, min_peaks)


def stream_run_sums(pixels: DataFrame, dropped: Column, keys: tuple[str, ...] = ("row", "col")) -> DataFrame:
    return run_sums(pixels, dropped, keys)


def stream_hit_counts(shots: DataFrame, hit: Column, time: str = "ts", window: str = "1 hour", late: str = "10 minutes") -> DataFrame:
    """(start, events, hits) by window of event time. In append and update mode shots later than the watermark are left
    out and windows leave the state; complete mode keeps all windows and takes late shots too."""
    timed = shots.withColumn(time, F.col(time).cast("timestamp"))  # watermarks need an instant
    by = timed.withWatermark(time, late).groupBy(F.window(time, window))
    return by.agg(F.count("*").alias("events"), F.count_if(hit).alias("hits")).select(F.col("window.start").alias("start"), "events", "hits")


def run_to_memory(df: DataFrame, name: str, mode: str = "complete", checkpoint: str | None = None) -> StreamingQuery:
    """All data that is there now, into a table in memory."""
    writer = df.writeStream.format("memory").queryName(name).outputMode(mode).trigger(availableNow=True)
    query = (writer.option("checkpointLocation", checkpoint) if checkpoint else writer).start()
    query.awaitTermination()
    return query


def run_to_files(df: DataFrame, folder: str, checkpoint: str) -> StreamingQuery:
    """All data that is there now, as Parquet files: windows once the watermark has passed their end. The last ones follow
    with later data, from the checkpoint."""
    query = df.writeStream.format("parquet").outputMode("append").option("checkpointLocation", checkpoint).trigger(availableNow=True).start(folder)
    query.awaitTermination()
    return query


def progress_step(number: Column) -> Column:
    """Whether a running count is one to report: each tenth of the first hundred, hundredth of the first thousand,
    thousandth from then on."""
    each = lambda n: number % n == 0
    return ((number < 100) & each(10)) | ((number < 1000) & each(100)) | each(1000)


def counted(df: DataFrame, name: str, hit: Column) -> DataFrame:
    """df with its counts of events and hits observed under a name, for listeners: no pass of its own."""
    return df.observe(name, F.count(F.lit(1)).alias("events"), F.count_if(hit).alias("hits"))


def once_first(save, each):
    """A foreachBatch function: save sees the first batch, each sees every one."""

    def batch(df: DataFrame, number: int) -> None:
        if number == 0:
            save(df)
        each(df, number)

    return batch
