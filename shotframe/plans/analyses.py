"""The analyses as registered tasks over shot tables: what a configuration names and a graph runs."""

from __future__ import annotations

from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shotframe.functions import nansafe as N
from shotframe.operators import binning, differences, filters, fits, geometry, images, peaks, profiles, textscan
from shotframe.operators.sinks import write_list
from shotframe.plans.parameters import Absorption, Concatenate, Emission, GeometrySearch, Peaks, Scattering, build
from shotframe.plans.pipeline import Task, register
from shotframe.sources.shots import detector, read_shots, scan_variable, standard_columns
from shotframe.sources.stacks import read_stacked_image


def _shots(spark: SparkSession, p: Scattering) -> tuple[DataFrame, Column, Column, str | None]:
    """Shots with ipm, iscat and scan, the filters of laser-on and laser-off shots, and the scan's name."""
    raw = standard_columns(read_shots(spark, p.path), p.detector, getattr(p, "absorption_detector", None), getattr(p, "emission_detector", None))
    scan, name = scan_variable(raw, p.scan)
    s = raw.withColumn("scan", scan.cast("double"))
    if p.ipm in raw.columns:
        s = s.withColumn("ipm", F.col(f"`{p.ipm}`").cast("double"))
    if "azav" in s.columns:
        s = s.withColumn("iscat", N.array_total(F.flatten("azav")))
    f = filters.standard_filters(s, p.thresholds.min_iscat, p.thresholds.min_ipm)
    return s, filters.combine(f, filters.DEFAULT), filters.combine(f, filters.LASER_OFF), name


def _binned(s: DataFrame, name: str | None, bins: int, lower: bool = False) -> tuple[DataFrame, DataFrame]:
    """Shots with the scan value that names their bin, and all bins: set points as they are; of fast delays equal-width
    bins by their centres (lower: by their lower edges, with the last edge as a bin that nothing falls into); of a
    table without a scan one bin of all shots."""
    if name is None:
        s = s.withColumn("scan", F.lit(1.0))
    if name is None or "lxt_fast" not in name:
        return s, s
    edges = binning.equal_width_edges(s, "scan", bins)
    names = binning.bin_names(edges, lower)
    at = binning.assign_bin(F.col("scan"), edges)
    s = s.withColumn("scan", F.get(F.array(*map(F.lit, names)), at)) if names else s
    return s, s.sparkSession.createDataFrame([(float(x),) for x in names], "scan double")


def _axis(spark: SparkSession, p: Scattering) -> list[float]:
    """The patterns' axis: of one integrator the first shot's column, of the other a table beside the shots."""
    raw = read_shots(spark, p.path)
    det = p.detector or detector(raw)
    own = f"{det}/pyfai_q"
    if own in raw.columns and f"{det}/azav_azav" not in raw.columns and "azav" not in raw.columns:
        return [float(x) for x in raw.orderBy("shot").select(F.col(f"`{own}`").alias("q")).first().q]  # one number a q bin
    return spark.read.parquet(f"{p.path}.q").orderBy("idx").toPandas()["q"].tolist()  # one number a q bin


def scattering(spark: SparkSession, values: dict[str, Any]) -> DataFrame:
    """(scan, q_idx, on, off, diff): profiles less the dark mean over the patterns' mean in the q range, for every bin."""
    p = build(Scattering, values)
    s, on, off, name = _shots(spark, p)
    s, bins = _binned(s.withColumn("on_", on).withColumn("off_", off), name, p.bins, lower=True)
    return profiles.scattering_difference(s, "azav", _axis(spark, p), "scan", F.col("on_"), F.col("off_"), F.col("xray") == 0, *p.q_range, bins=bins)


def absorption(spark: SparkSession, values: dict[str, Any]) -> DataFrame:
    """(bin, lo, hi, center, on, off, diff): signal by photon energy, over the water ring's mean scattering, or over the
    monitor if that is negative in any shot or there are no patterns."""
    p = build(Absorption, values)
    s, on, off, _ = _shots(spark, p)
    norm = F.col("ipm")
    if "azav" in s.columns:
        s = s.withColumn("water", profiles.pattern_norm(F.col("azav"), _axis(spark, p), *p.water_range))
        norm = differences.normaliser(s, F.col("water"), F.col("ipm"))
    return differences.absorption_by_energy(s, p.energy, binning.ccm_edges(s, p.energy, p.set_point), N.divide(F.col("xas_raw"), norm), on, off)


def absorption_scan(spark: SparkSession, values: dict[str, Any]) -> DataFrame:
    """(scan, on, off, diff): signal over the monitor for every bin of the scan; NaN where a side has no shots. Two bins
    or fewer give no rows."""
    p = build(Absorption, values)
    s, on, off, name = _shots(spark, p)
    s, bins = _binned(s.withColumn("on_", on).withColumn("off_", off), name, p.bins)
    out = differences.by_scan(bins, s, N.divide(F.col("xas_raw"), F.col("ipm")), F.col("on_"), F.col("off_"), skip_nan=False, sides=False)
    out = out.withColumns({c: F.coalesce(c, F.lit(N.NAN)) for c in ("on", "off", "diff")})
    return out if out.select("scan").distinct().count() > 2 else out.limit(0)


def emission(spark: SparkSession, values: dict[str, Any]) -> DataFrame:
    """(scan, pixel, on, off, diff): spectra from the brightest window, over the monitor, for every bin."""
    p = build(Emission, values)
    s, on, off, name = _shots(spark, p)
    if p.rotation:
        s = images.rotated(s, p.rotation, "roi_area")
    s, bins = _binned(s.withColumn("on_", on).withColumn("off_", off), name, p.bins)
    wide = s.select("shot", "scan", "ipm", "on_", "off_", F.posexplode("roi_area").alias("row", "r")).select("*", F.posexplode("r").alias("col", "value")).drop("r")
    keys = ("shot", "scan", "ipm", "on_", "off_")
    axis, pixel = ("row", "col") if p.transpose else ("col", "row")
    spectra = images.window_spectrum(wide, p.half_width, axis, keys).withColumnRenamed(pixel, "pixel")
    pixels = s.select(F.explode(F.sequence(F.lit(0), (F.size(F.get("roi_area", F.lit(0))) if p.transpose else F.size("roi_area")) - 1)).alias("pixel")).distinct()
    return differences.by_scan(bins, spectra, N.divide(F.col("value"), F.col("ipm")), F.col("on_"), F.col("off_"), pixels, skip_nan=False)


def overlap(spark: SparkSession, values: dict[str, Any]) -> DataFrame:
    """One row, the overlap of the pulses along the scan: scan_name, q_idx, position, fwhm, and the curve it is found on (bins,
    curve, trace). The curve is the scattering difference ten elements beyond the solvent maximum. Timing scans (lxt in the
    name) give the place where the curve's convolution with a step is largest, and its width in bins; others the
    centre and width of a gaussian, without a trace. Without scattering there is no row."""
    p = build(Scattering, values)
    s, on, off, name = _shots(spark, p)
    axis = _axis(spark, p)
    s, bins = _binned(s.withColumn("on_", on).withColumn("off_", off), name, p.bins, lower=True)
    rows = profiles.corrected(s, "azav", axis, F.col("xray") == 0, ("on_",), *p.q_range)
    mean = differences.global_profile(rows, "q_idx", F.col("v"), F.col("on_")).where(~F.isnan("value"))
    top = fits.solvent_maximum(mean, "q_idx", "value")
    out = profiles.scattering_difference(s, "azav", axis, "scan", F.col("on_"), F.col("off_"), F.col("xray") == 0, *p.q_range, bins=bins)
    at = -1 if top is None else min(top + 10, len(axis) - 1)
    step = "lxt" in (name or "")
    curve = out.where(F.col("q_idx") == at).select("q_idx", "scan", (N.nan_to_num(F.col("diff")) if step else F.col("diff")).alias("diff"))
    found = fits.overlap(curve, ["q_idx"], "scan", "diff", name or "")
    whole = curve.groupBy("q_idx").agg(F.array_sort(F.collect_list(F.struct("scan", "diff"))).alias("c"))  # a row a bin
    position, trace = (F.col("t0"), F.col("trace")) if step else (F.col("center"), F.lit(None).cast("array<double>"))
    return found.join(whole, "q_idx").select(F.lit(name).alias("scan_name"), "q_idx", position.alias("position"), "fwhm", F.col("c.scan").alias("bins"), F.col("c.diff").alias("curve"), trace.alias("trace"))


def find_peaks(spark: SparkSession, values: dict[str, Any]) -> DataFrame:
    """Hits with their peaks; where out is given also written, with a list file that names them."""
    p = build(Peaks, values)
    s = filters.with_event_code(spark.read.parquet(p.path), p.event_code, active=p.event_logic)
    s = s.orderBy("shot").limit(p.n_events) if p.n_events else s
    if p.abs_error:
        s = images.quantised(s, p.abs_error)
    found = peaks.hits(peaks.find_peaks(s, **p.finder()), p.min_peaks, p.max_peaks)
    if p.out:
        found.write.mode("overwrite").parquet(f"{p.out}/{p.tag or 'hits'}")
        write_list(spark, [f"{p.out}/{p.tag or 'hits'}"], f"{p.out}/{p.tag or 'hits'}.list")
        found = spark.read.parquet(f"{p.out}/{p.tag or 'hits'}")
    return found


def geometry_search(spark: SparkSession, values: dict[str, Any]) -> DataFrame:
    """The best candidate of the grid around the centre (the image's middle by default)."""
    p = build(GeometrySearch, values)
    pixels = (read_stacked_image(spark, p.powder) if p.powder.endswith(".npy") else spark.read.parquet(p.powder)).select("row", "col", "value")
    size = pixels.agg(F.max("row").alias("h"), F.max("col").alias("w")).first()
    center = p.center or ((size.w + 1) / 2, (size.h + 1) / 2)
    grid = geometry.center_grid(spark, center, [p.distance], p.dx, p.dy)
    smooth = (p.filter_order, p.filter_threshold) if p.filter_profile else None
    return geometry.best_candidate(geometry.search(grid, pixels, p.wavelength, p.pixel_size, p.n_iterations, p.n_peaks, p.threshold, smooth))


def concatenate(spark: SparkSession, values: dict[str, Any]) -> str:
    p = build(Concatenate, values)
    textscan.concat_files(spark, f"{p.in_dir}/*_{p.tag}.stream", p.out)
    return p.out


for _name, _run in (("scattering", scattering), ("overlap", overlap), ("absorption", absorption), ("absorption_scan", absorption_scan), ("emission", emission), ("find_peaks", find_peaks), ("geometry", geometry_search), ("concatenate", concatenate)):
    register(Task(_name, _run))
