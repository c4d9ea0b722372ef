"""Kernels on one detector image at a time, for a producer's per-shot reductions: images are dealt to tasks and
each is an array of rows."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shotframe.functions.splines import smoothed
from shotframe.operators.droplets import droplets, placed_photons  # noqa: F401  kernels of the same stack


def _per_image(shots: DataFrame, image: str, name: str, kind: str, arrow: pa.DataType, kernel: Callable[[np.ndarray], object]) -> DataFrame:
    """shots with a column of the kernel's results; null of null or empty images."""
    fields = shots.schema.fields
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in fields), f"`{name}` {kind}"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = [kernel(np.array(m, float)) if (m := x.as_py()) else None for x in b.column(b.schema.get_field_index(image))]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(out, arrow)], [*b.schema.names, name])

    return shots.mapInArrow(run, schema)


def stacked(shots: DataFrame, *steps: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Shots through several reductions, each seeing the columns that the ones before it made."""
    for step in steps:
        shots = shots.transform(step)
    return shots


def droplet_photons(shots: DataFrame, per_photon: float = 162.0, droplets_col: str = "droplets") -> DataFrame:
    """shots with photons: the droplets' intensities as whole photons, in sum."""
    return shots.withColumn("photons", F.aggregate(droplets_col, F.lit(0).cast("long"), lambda a, d: a + F.round(d["adu"] / per_photon).cast("long")))


def autocorrelation(shots: DataFrame, image: str = "image", low: float = -1e6, high: float = 1e6) -> DataFrame:
    """shots with the circular autocorrelation of each image, values outside [low, high] as 0, no shift in the middle."""

    def correlate(m: np.ndarray) -> list[list[float]]:
        m = np.where((m >= low) & (m <= high), m, 0.0)
        return np.fft.fftshift(np.fft.ifft2(np.abs(np.fft.fft2(m)) ** 2).real).tolist()

    return _per_image(shots, image, "correlation", "array<array<double>>", pa.list_(pa.list_(pa.float64())), correlate)


def reconstructed(shots: DataFrame, image: str = "image", components: int = 2) -> DataFrame:
    """shots with each image from its largest singular values."""

    def fit(m: np.ndarray) -> list[list[float]]:
        u, s, v = np.linalg.svd(m, full_matrices=False)
        return ((u[:, :components] * s[:components]) @ v[:components]).tolist()

    return _per_image(shots, image, "fitted", "array<array<double>>", pa.list_(pa.list_(pa.float64())), fit)


def sparsified(shots: DataFrame, keys: list[str], image: str = "image", threshold: float = 0.0) -> DataFrame:
    """(keys, row, col, value) of the pixels above a threshold."""
    rows = shots.select(*keys, F.posexplode(image).alias("row", "_r"))
    return rows.select(*keys, "row", F.posexplode("_r").alias("col", "value")).where((F.col("value") > threshold) & ~F.isnan("value"))


def lowpass(y: np.ndarray, order: int = 2, cutoff: float = 0.25) -> np.ndarray:
    """One profile without its fast parts; cutoff is a share of the highest frequency."""
    return smoothed(np.asarray(y, float)[None, :], order, cutoff)[0]
