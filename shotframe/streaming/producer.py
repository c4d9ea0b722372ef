"""A producer's output as a run goes on: reduced data of every event, the configuration once, and sums over the run.

Each micro-batch writes its events and its part of the sums under its own number, so that a batch that is repeated after a
failure replaces what it wrote before; the run's sums are the parts added up when they are read."""

from __future__ import annotations

import json
from collections.abc import Callable
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from shotframe.operators.images import run_sums
from shotframe.operators.kernels import stacked
from shotframe.streaming.reductions import counted, once_first


def image_pixels(shots: DataFrame, image: str = "image", keep: tuple[str, ...] = ()) -> DataFrame:
    """(keep, row, col, value) of the images (row, column); null and empty ones have none."""
    rows = shots.select(*keep, F.posexplode(image).alias("row", "_r"))
    return rows.select(*keep, "row", F.posexplode("_r").alias("col", "value"))


def run_producer(shots: DataFrame, steps: list[Callable[[DataFrame], DataFrame]], folder: str, checkpoint: str, config: dict[str, Any], dropped: Column, image: str = "image", hit: Column | None = None) -> StreamingQuery:
    """All data that is there now. steps: reductions of a shot, each seeing the columns of those before it; the image itself is
    not kept. dropped: shots without x-rays, of which sums are kept apart. Counts of events and hits are observed as "producer" for
    reporters of progress."""

    def configured(batch: DataFrame) -> None:
        batch.sparkSession.createDataFrame([(json.dumps(config, sort_keys=True, default=str),)], "value string").coalesce(1).write.mode("overwrite").text(f"{folder}/config")

    def reduced(batch: DataFrame, number: int) -> None:
        batch = batch.persist()
        try:
            stacked(batch, *steps).drop(image).write.mode("overwrite").parquet(f"{folder}/events/batch-{number:09d}")
            pixels = image_pixels(batch.withColumn("_dropped", dropped), image, ("_dropped",))
            run_sums(pixels, F.col("_dropped")).write.mode("overwrite").parquet(f"{folder}/sums/batch-{number:09d}")
        finally:
            batch.unpersist()

    told = counted(shots, "producer", F.lit(True) if hit is None else hit)
    query = told.writeStream.option("checkpointLocation", checkpoint).trigger(availableNow=True).foreachBatch(once_first(configured, reduced)).start()
    query.awaitTermination()
    return query


def events_of(spark: SparkSession, folder: str) -> DataFrame:
    """The reduced data of all events so far."""
    return spark.read.option("mergeSchema", "true").parquet(f"{folder}/events/batch-*")


def sums_of(spark: SparkSession, folder: str) -> DataFrame:
    """(row, col, calib, calib_dropped, calib_dropped_square) of the run so far."""
    parts = spark.read.parquet(f"{folder}/sums/batch-*")
    return parts.groupBy("row", "col").agg(*(F.sum(c).alias(c) for c in ("calib", "calib_dropped", "calib_dropped_square")))


def config_of(spark: SparkSession, folder: str) -> dict[str, Any]:
    return json.loads(spark.read.text(f"{folder}/config").first()[0])
