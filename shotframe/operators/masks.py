"""Pixel masks as (row, col, value) tables: 1 keeps a pixel, 0 takes it out."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def combined(a: DataFrame, b: DataFrame | None) -> DataFrame:
    """Product of two masks by pixel; a pixel that one of them lacks has the other's value."""
    if b is None:
        return a
    both = a.withColumnRenamed("value", "_a").join(b.withColumnRenamed("value", "_b"), ["row", "col"], "full")
    return both.select("row", "col", (F.coalesce("_a", F.lit(1)) * F.coalesce("_b", F.lit(1))).alias("value"))


def inverted(mask: DataFrame) -> DataFrame:
    """1 where a pixel is out, 0 where it is kept: what indexing programs read."""
    return mask.withColumn("value", 1 - F.col("value"))


def applied(pixels: DataFrame, mask: DataFrame | None) -> DataFrame:
    """Pixels with the value 0 where the mask is 0; pixels that the mask lacks are kept."""
    if mask is None:
        return pixels
    m = mask.select("row", "col", F.col("value").alias("_m"))
    return pixels.join(m, ["row", "col"], "left").withColumn("value", F.col("value") * F.coalesce("_m", F.lit(1))).drop("_m")
