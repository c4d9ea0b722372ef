"""What a run says about its instrument: beam and geometry numbers, detectors by name, values that change slowly."""

from __future__ import annotations

import time

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

#: Fixed names: recorded by the producer itself, whatever the instrument.
ALWAYS_RECORDED = ("FEEGasDetEnergy", "PhaseCavity", "EBeam", "ControlData")
#: Fixed names: recorded by default at the instrument whose code stands in the experiment's name.
INSTRUMENT_RECORDED = {
    "xpp": ("HX2-SB1-BMMON", "XPP-SB2-BMMON", "XPP-SB3-BMMON", "XPP-USB-ENCODER-02"),
    "xcs": ("XCS-SB1-BMMON", "XCS-SB2-BMMON"),
    "cxi": ("CXI-DG2-BMMON", "CXI-DG3-BMMON"),
    "mec": ("MEC-XT2-BMMON-02", "MEC-XT2-BMMON-03"),
}
#: Fixed parts of the names of detectors with a geometry.
AREA = ("cs", "Cs", "epix", "Epix", "jungfrau", "Jungfrau")


def pixel_size_mm(micrometres: Column) -> Column:
    return micrometres / 1e3


def wavelength_angstrom(nanometres: Column) -> Column:
    return nanometres * 10


def distance_mm(pixel_map: DataFrame, guess: float | None = None, z: str = "z") -> DataFrame:
    """(distance): the guess, or the mean depth of the pixels (in micrometres, along the beam) with its sign turned."""
    return pixel_map.agg((F.lit(float(guess)) if guess is not None else -F.avg(z) / 1e3).alias("distance"))


def detector_kind(name: Column) -> Column:
    """The kind of reader that a detector's name calls for; the first that fits."""
    holds = lambda *parts: F.greatest(*[name.contains(p) for p in parts], F.lit(False))
    inside = lambda part: F.instr(name, part) > 1  # noqa: E731  not at the start
    kind = F.when(holds("BMMON"), "beam monitor").when(holds("IPM") | inside("Ipm"), "intensity and position").when(holds("DIO") | inside("Imb"), "intensity")
    return kind.when(holds("USB"), "encoder").when(holds("adc"), "adc").when(holds(*AREA), "image").otherwise("area")


def to_discover(names: DataFrame, experiment: str, name: str = "name", own: tuple[str, ...] = ()) -> DataFrame:
    """(name, kind) of the detectors that nothing records by default; event receivers are left out."""
    known = {*own, *ALWAYS_RECORDED, *(n for code, ns in INSTRUMENT_RECORDED.items() if code in experiment for n in ns)}
    left = names.where(~F.col(name).isin(*known) & ~F.col(name).contains("evr")).select(F.col(name).alias("name")).distinct()
    return left.withColumn("kind", detector_kind(F.col("name")))


def slow_values(shots: DataFrame, changes: DataFrame, key: str = "pv", ts: str = "ts", value: str = "value", span: int = 3600) -> DataFrame:
    """Shots with the value that was last set under their key at or before their time; null before the first change.

    changes: (key, ts, value), of changes at one time the largest value counts. Shots and changes are sorted together
    within a key and a span of some seconds, and a shot takes what stands before it; what holds when a span begins comes from the
    last changes of the spans before, a row a span. No shot meets a change but its own, and no task gets a whole key."""
    span_of = F.floor(F.unix_seconds(F.col(ts).cast("timestamp")) / span).alias("_s")
    none = F.lit(None).cast(f"struct<v:{changes.schema[value].dataType.simpleString()}>")
    rows = shots.select(F.col(key).alias("_k"), span_of, F.col(ts).alias("_t"), F.lit(1).alias("_shot"), none.alias("_v"), F.struct(*[F.col(f"`{c}`") for c in shots.columns]).alias("_row"))
    one = changes.groupBy(key, ts).agg(F.max(value).alias("_m"))
    set_ = one.select(F.col(key).alias("_k"), span_of, F.col(ts).alias("_t"), F.lit(0).alias("_shot"), F.struct(F.col("_m").alias("v")).alias("_v"), F.lit(None).cast(rows.schema["_row"].dataType).alias("_row"))
    both = rows.union(set_)
    ends = both.groupBy("_k", "_s").agg(F.max_by("_v", F.when(F.col("_shot") == 0, F.col("_t"))).alias("_e"))  # a row a span
    begun = ends.select(F.col("_k").alias("_bk"), F.col("_s").alias("_bs"), F.last("_e", True).over(W.partitionBy("_k").orderBy("_s").rowsBetween(W.unboundedPreceding, -1)).alias("_b"))
    held = both.withColumn("_h", F.last("_v", True).over(W.partitionBy("_k", "_s").orderBy("_t", "_shot").rowsBetween(W.unboundedPreceding, W.currentRow)))
    held = held.where("_shot = 1").join(begun, F.col("_k").eqNullSafe(F.col("_bk")) & F.col("_s").eqNullSafe(F.col("_bs")), "left")
    return held.select("_row.*", F.coalesce("_h", "_b")["v"].alias(value))


def wait_for_files(spark: SparkSession, pattern: str, every: float = 10.0, most: int | None = 20) -> list[str]:
    """The files of a pattern, once there are any; TimeoutError after the most looks (None: never)."""
    path = spark._jvm.org.apache.hadoop.fs.Path(pattern)
    store = path.getFileSystem(spark._jsc.hadoopConfiguration())
    looks = 0
    while True:
        found = store.globStatus(path)
        if found:
            return sorted(s.getPath().toString() for s in found)
        looks += 1
        if most is not None and looks >= most:
            raise TimeoutError(f"no files at {pattern}")
        time.sleep(every)
