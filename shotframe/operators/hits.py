"""Records of hits for indexing programs, what is stored beside them, and a run's parts put together."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shotframe.operators.peaks import peak_radius, peak_table

#: Fixed names of a hit's peak lists, and the field or column of a peak that fills each.
PEAK_LISTS = {
    "peakXPosRaw": "col",
    "peakYPosRaw": "image_row",
    "rcent": "rcent",
    "ccent": "ccent",
    "rmin": "rmin",
    "rmax": "rmax",
    "cmin": "cmin",
    "cmax": "cmax",
    "peakTotalIntensity": "atot",
    "peakMaxIntensity": "amax",
    "peakRadius": "radius",
}


def hit_records(found: DataFrame, pixel_map: DataFrame, panel_rows: int, cx: float, cy: float, key: str = "shot") -> DataFrame:
    """A row a hit: the columns of found without its peaks, nPeaks, and a list of each property in the order of the
    peaks. A peak whose pixel the map lacks has a null radius. Hits without peaks have empty lists."""
    flat = peak_radius(peak_table(found, [key], panel_rows), pixel_map, cx, cy)
    order = F.array_sort(F.collect_list(F.struct("peak", *[F.col(c).alias(n) for n, c in PEAK_LISTS.items()])))
    lists = flat.groupBy(key).agg(order.alias("_l"))  # a shot's peaks: some thousand at most
    whole = found.withColumn("nPeaks", F.size("peaks")).drop("peaks").join(lists, key, "left")
    return whole.select("*", *[F.coalesce(F.col(f"_l.{n}"), F.array()).alias(n) for n in PEAK_LISTS]).drop("_l")


def machine_time(ts):
    """(seconds, nanoseconds) columns of a timestamp."""
    micros = F.unix_micros(ts.cast("timestamp"))
    return F.floor(micros / 1_000_000).cast("long").alias("machineTime"), (F.pmod(micros, F.lit(1_000_000)) * 1000).cast("long").alias("machineTimeNanoSeconds")


def write_part(hits: DataFrame, powders: DataFrame, mask: DataFrame | None, folder: str) -> None:
    """One part of a run: hits, powders (kind, row, col, value) and the inverted mask, each a table in the folder."""
    from shotframe.operators.masks import inverted

    hits.write.mode("overwrite").parquet(f"{folder}/hits")
    powders.write.mode("overwrite").parquet(f"{folder}/powders")
    if mask is not None:
        inverted(mask).write.mode("overwrite").parquet(f"{folder}/mask")


def merged_powders(parts: list[DataFrame]) -> DataFrame:
    """The largest value of each pixel among the parts of a run."""
    return reduce(DataFrame.unionByName, parts).groupBy("kind", "row", "col").agg(F.max("value").alias("value"))


def read_run(spark: SparkSession, folders: list[str]) -> tuple[DataFrame, DataFrame]:
    """(hits, powders) of all parts of a run; ValueError if no part has a hit."""
    found = spark.read.parquet(*[f"{f}/hits" for f in folders])
    if found.isEmpty():
        raise ValueError("no hits found in any part of the run")
    return found, merged_powders([spark.read.parquet(f"{f}/powders") for f in folders])
