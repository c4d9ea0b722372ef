"""Images as pixel tables (ix, iy, v): assembly, radial profiles, regions of interest, powders, run sums."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shotframe.functions import nansafe as N
from shotframe.functions.splines import rotated_images, smoothed
from shotframe.operators.droplets import image_batches


def assemble(pixels: DataFrame, ix: str = "ix", iy: str = "iy", v: str = "v") -> DataFrame:
    """(row, col, value): coordinates shifted to begin at 0, values of one pixel summed."""
    least = pixels.agg(F.min(ix).alias("x0"), F.min(iy).alias("y0"))  # one row
    summed = pixels.groupBy(ix, iy).agg(F.sum(v).alias("value"))
    return summed.crossJoin(F.broadcast(least)).select((F.col(iy) - F.col("y0")).alias("row"), (F.col(ix) - F.col("x0")).alias("col"), "value")


def assemble_last(pixels: DataFrame, order: str, ix: str = "ix", iy: str = "iy", v: str = "v") -> DataFrame:
    """(row, col, value): of the values written to one pixel, the last by order stays."""
    return pixels.groupBy(F.col(iy).alias("row"), F.col(ix).alias("col")).agg(F.max_by(v, order).alias("value"))


def coordinates_joined(values: DataFrame, geometry: DataFrame, index: str = "pix_idx") -> DataFrame:
    """Values with their pixel coordinates by flat index; raises at run time if the two differ in number."""
    n = geometry.agg(F.count("*").alias("n")).crossJoin(values.agg(F.count("*").alias("m")))
    checked = n.select(F.assert_true(F.col("n") == F.col("m"), F.lit("values and coordinates differ in number")).alias("ok"))
    return values.join(geometry, index).crossJoin(F.broadcast(checked)).where("ok is null").drop("ok")  # checked: one row


def radius(x: Column, y: Column, cx: float, cy: float) -> Column:
    return F.sqrt(F.pow(x - cx, 2) + F.pow(y - cy, 2))


def radial_profile(image: DataFrame, cx: float, cy: float, mask: Column | None = None, floor: float = 10.0) -> DataFrame:
    """(r, value): mean by whole radius, from 0 to the largest one; 0 where no pixel lies or the mean is below
    floor. Masked pixels (mask not 1) count at radius 0."""
    r = F.floor(radius(F.col("col"), F.col("row"), cx, cy)).cast("int")
    if mask is not None:
        r = F.when(mask == 1, r).otherwise(0)
    rings = image.groupBy(r.alias("r")).agg(F.sum("value").alias("s"), F.count("*").alias("n"))
    top = rings.agg(F.max("r").alias("m")).where("m is not null").select(F.explode(F.sequence(F.lit(0), F.col("m"))).alias("r"))
    mean = F.coalesce(F.col("s") / F.col("n"), F.lit(0.0))
    return top.join(rings, "r", "left").select("r", F.when(mean < floor, 0.0).otherwise(mean).alias("value"))


def clip_hot(image: DataFrame, threshold: float = 1e6) -> DataFrame:
    return image.withColumn("value", F.when(F.col("value") > threshold, 0.0).otherwise(F.col("value")))


def normalise(image: DataFrame) -> DataFrame:
    """Values less their mean over their population deviation."""
    known = image.agg(F.avg("value").alias("m"), F.stddev_pop("value").alias("s"))  # one row
    return image.crossJoin(F.broadcast(known)).select("row", "col", N.divide(F.col("value") - F.col("m"), F.col("s")).alias("value"))


def percentile_range(image: DataFrame, low: float = 0.01, high: float = 0.99) -> DataFrame:
    """(low, high): interpolated percentiles without NaN, for colour ranges."""
    v = N.strip(F.col("value"))
    return image.agg(F.percentile(v, F.lit(low)).alias("low"), F.percentile(v, F.lit(high)).alias("high"))


def region(image: DataFrame, rows: tuple[int, int], cols: tuple[int, int], threshold: float | None = None) -> DataFrame:
    """Pixels of a region (ends exclusive), values not above the threshold as 0."""
    out = image.where((F.col("row") >= rows[0]) & (F.col("row") < rows[1]) & (F.col("col") >= cols[0]) & (F.col("col") < cols[1]))
    return out if threshold is None else out.withColumn("value", F.when(N.above(F.col("value"), threshold), F.col("value")).otherwise(0.0))


def projection(image: DataFrame, axis: str, keys: tuple[str, ...] = ()) -> DataFrame:
    """Sum along the other axis."""
    return image.groupBy(*keys, axis).agg(N.total(F.col("value")).alias("value"))


def brightest_window(image: DataFrame, half: int = 5, axis: str = "col") -> tuple[int, int]:
    """[g - half, g + half) around the axis position with the largest sum over everything else; cut at 0."""
    g = projection(image, axis).agg(F.max_by(axis, F.struct(F.col("value"), -F.col(axis)))).first()[0]
    return max(0, g - half), g + half


def window_spectrum(image: DataFrame, half: int = 5, axis: str = "col", keys: tuple[str, ...] = ("shot",)) -> DataFrame:
    """Spectrum of each shot: values within the brightest window, summed across it."""
    low, high = brightest_window(image, half, axis)
    other = "row" if axis == "col" else "col"
    return projection(image.where((F.col(axis) >= low) & (F.col(axis) < high)), other, keys)


def azimuthal(image: DataFrame, cx: float, cy: float, r_bins: int, r_max: float, phi_bins: int, keys: tuple[str, ...] = ()) -> DataFrame:
    """(phi_bin, r_bin, value): mean of the pixels in each sector of each ring."""
    r = F.floor(radius(F.col("col"), F.col("row"), cx, cy) * r_bins / r_max).cast("int")
    turn = (F.atan2(F.col("row") - cy, F.col("col") - cx) + np.pi) / (2 * np.pi)
    phi = F.least(F.lit(phi_bins - 1), F.floor(turn * phi_bins).cast("int"))
    return image.withColumns({"r_bin": r, "phi_bin": phi}).where(F.col("r_bin") < r_bins).groupBy(*keys, "phi_bin", "r_bin").agg(N.mean(F.col("value")).alias("value"))


def photons(value: Column, per_photon: float = 9.5, threshold: float = 0.8) -> Column:
    """Whole photons of an intensity: a rest of threshold or more counts as one."""
    n = F.floor(value / per_photon)
    return F.greatest(F.lit(0), (n + F.when(value / per_photon - n >= threshold, 1).otherwise(0))).cast("int")


def powder_max(pixels: DataFrame, n_peaks: Column, min_peaks: int = 2, max_peaks: int | None = None) -> DataFrame:
    """(kind, row, col, value): largest value of each pixel over hit and over miss shots, 0 at least. A shot with
    min_peaks or more is a hit; give max_peaks to bound it above too."""
    hit = n_peaks >= min_peaks if max_peaks is None else n_peaks.between(min_peaks, max_peaks)
    kind = F.when(hit, "hit").otherwise("miss").alias("kind")
    return pixels.groupBy(kind, "row", "col").agg(F.greatest(F.lit(0.0), F.coalesce(N.largest(F.col("value")), F.lit(0.0))).alias("value"))


def run_sums(pixels: DataFrame, dropped: Column, keys: tuple[str, ...] = ("row", "col")) -> DataFrame:
    """Sums of a run: all shots, shots without x-rays, and squares of these."""
    v = F.col("value")
    return pixels.groupBy(*keys).agg(F.sum(v).alias("calib"), F.coalesce(F.sum(F.when(dropped, v)), F.lit(0.0)).alias("calib_dropped"), F.coalesce(F.sum(F.when(dropped, v * v)), F.lit(0.0)).alias("calib_dropped_square"))


def rotated(images: DataFrame, angle: float, image: str = "image", whole: bool = True) -> DataFrame:
    """Every image turned by degrees counter-clockwise about its middle by cubic splines, in a frame that holds all of it (whole) or
    in its own; outside, and values that are none, count as 0. Null and empty images stay."""

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            at = b.schema.get_field_index(image)
            out = b.column(at).to_pylist()
            for places, some in image_batches(b.column(at)):
                for k, turned in zip(places.tolist(), rotated_images(np.nan_to_num(some), angle, whole), strict=True):
                    out[k] = turned.tolist()
            yield b.set_column(at, b.schema.field(at), pa.array(out, b.schema.field(at).type))

    return images.mapInArrow(apply, images.schema)


def smoothed_profile(profile: DataFrame, keys: list[str], order: int = 2, cutoff: float = 0.25, floor: float = 10.0, elem: str = "r", value: str = "value") -> DataFrame:
    """(keys, elem, value): profiles (a row an element, as radial_profile gives) through a Butterworth filter forward and backward;
    then values below floor are 0. One profile, a detector's radius long, is one array."""
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in profile.schema if f.name in keys), f"places array<{profile.schema[elem].dataType.simpleString()}>, smooth array<double>"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            smooth = [smoothed(np.array([v], float), order, cutoff)[0] for v in b.column("v").to_pylist()]
            yield pa.RecordBatch.from_arrays([*(b.column(k) for k in keys), b.column("places"), pa.array([np.where(x < floor, 0.0, x).tolist() for x in smooth], pa.list_(pa.float64()))], [*keys, "places", "smooth"])

    one = profile.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct(elem, F.col(value).cast("double").alias("v")))).alias("p"))
    rows = one.select(*keys, F.col(f"p.{elem}").alias("places"), F.col("p.v").alias("v")).mapInArrow(run, schema)
    return rows.select(*keys, F.explode(F.arrays_zip("places", "smooth")).alias("p")).select(*keys, F.col("p.places").alias(elem), F.col("p.smooth").alias(value))


def quantised(shots: DataFrame, abs_error: float, image: str = "image") -> DataFrame:
    """What a lossy codec with this absolute error leaves of the images: values at steps of twice the error. Panels of
    rows of values; null values stay."""
    step = lambda v: F.round(v / (2 * abs_error)) * (2 * abs_error)
    return shots.withColumn(image, F.transform(image, lambda p: F.transform(p, lambda r: F.transform(r, step))))


def _residual_bytes(steps: np.ndarray) -> int:
    """Bytes that whole numbers take as differences of neighbours under deflate."""
    import zlib

    low = np.diff(steps.ravel(), prepend=0)
    return len(zlib.compress(low.astype("<i4").tobytes(), 1)) if len(low) else 0


def lossy_round_trip(shots: DataFrame, image: str = "image", peaks_col: str = "peaks", abs_error: float = 10.0, window: int = 9, bin_size: int = 2, mask: list[list[list[int]]] | None = None) -> DataFrame:
    """What is left of images (panel, row, column) that keep regions of window x window pixels around peaks (seg, row, col) and
    everything else in bins: inside, values at steps of twice the error; outside, the mean of the bin's pixels outside
    (masked ones, mask 0, left out and 0 after) at such steps. No pixel inside is off by more than abs_error; pixels
    that are no number stay. Adds bytes_raw (as 32-bit numbers) and bytes_kept, the size of both parts as differences under deflate."""
    kept = [f for f in shots.schema.fields if f.name != image]
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in kept), f"`{image}` array<array<array<double>>>", "bytes_raw long, bytes_kept long"])
    step = 2 * abs_error

    def one(panels: np.ndarray, peaks: list, good: np.ndarray) -> tuple[np.ndarray, int]:
        n, h, w = panels.shape
        inside = np.zeros(panels.shape, bool)
        half = window // 2
        for p in peaks or []:
            inside[p["seg"], max(0, p["row"] - half) : p["row"] - half + window, max(0, p["col"] - half) : p["col"] - half + window] = True
        number = np.isfinite(panels)
        exact = np.round(np.where(number, panels, 0.0) / step)
        use = number & good & ~inside
        hb, wb = -(-h // bin_size), -(-w // bin_size)
        binned = lambda a: np.pad(a, ((0, 0), (0, hb * bin_size - h), (0, wb * bin_size - w))).reshape(n, hb, bin_size, wb, bin_size).sum((2, 4))
        coarse = np.round(binned(np.where(use, panels, 0.0)) / np.maximum(1, binned(use.astype(float))) / step)
        wide = np.repeat(np.repeat(coarse, bin_size, 1), bin_size, 2)[:, :h, :w]
        out = np.where(inside, exact, np.where(good, wide, 0.0)) * step
        return np.where(number, out, panels), _residual_bytes(exact[inside & number].astype(np.int64)) + _residual_bytes(coarse.astype(np.int64))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out, raw, small = [], [], []
            for m, p in zip(b.column(b.schema.get_field_index(image)), b.column(b.schema.get_field_index(peaks_col)).to_pylist(), strict=True):
                if not m.is_valid or not len(m):
                    out.append(m.as_py())
                    raw.append(0)
                    small.append(0)
                    continue
                panels = np.array(m.as_py(), float)
                good = np.ones(panels.shape, bool) if mask is None else np.broadcast_to(np.array(mask) == 1, panels.shape)
                left, size = one(panels, p, good)
                out.append(left.tolist())
                raw.append(4 * panels.size)
                small.append(size)
            cols = [*(b.column(b.schema.get_field_index(f.name)) for f in kept), pa.array(out, pa.list_(pa.list_(pa.list_(pa.float64())))), pa.array(raw, pa.int64()), pa.array(small, pa.int64())]
            yield pa.RecordBatch.from_arrays(cols, [*(f.name for f in kept), image, "bytes_raw", "bytes_kept"])

    return shots.mapInArrow(run, schema)
