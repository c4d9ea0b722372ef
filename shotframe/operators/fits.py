"""Fits of binned signals, one group at a time: a group is one curve of a few dozen bins."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shotframe.functions import numeric as K


def _per_curve(curves: DataFrame, keys: list[str], x: str, y: str, schema: str, fit: Callable[[np.ndarray, np.ndarray], dict]) -> DataFrame:
    kinds = {f.name: f.dataType.simpleString() for f in curves.schema.fields}

    def one(key: tuple, p: pd.DataFrame) -> pd.DataFrame:
        p = p.sort_values(x)
        return pd.DataFrame([dict(zip(keys, key, strict=True)) | fit(p[x].to_numpy(float), p[y].to_numpy(float))])

    return curves.select(*keys, x, y).groupBy(*keys).applyInPandas(one, ", ".join([*(f"`{k}` {kinds[k]}" for k in keys), schema]))


def gaussian_fits(curves: DataFrame, keys: list[str], x: str, y: str) -> DataFrame:
    """Overlap of the pulses: keys, amp, center, sigma, base and fwhm of each curve."""
    out = _per_curve(curves, keys, x, y, "amp double, center double, sigma double, base double", K.fit_gaussian)
    return out.withColumn("fwhm", F.col("sigma") * float(np.sqrt(8 * np.log(2))))


def step_times(curves: DataFrame, keys: list[str], x: str, y: str) -> DataFrame:
    """Time zero of a step: keys and t0 of each curve."""
    return _per_curve(curves, keys, x, y, "t0 double", lambda a, b: {"t0": K.step_time(a, b)})


def step_traces(curves: DataFrame, keys: list[str], x: str, y: str) -> DataFrame:
    """Keys, trace (the curve convolved with a step), center (place of its maximum), t0 and fwhm, the width counted in
    bins between the two places where the spline through the trace crosses half its maximum."""

    def fit(a: np.ndarray, b: np.ndarray) -> dict:
        trace = K.step_response(b)
        return {"trace": trace.tolist(), "center": int(trace.argmax()), "t0": K.step_time(a, b), "fwhm": K.fwhm(a, trace, np.arange(len(a), dtype=float))}

    return _per_curve(curves, keys, x, y, "trace array<double>, center int, t0 double, fwhm double", fit)


def overlap(curves: DataFrame, keys: list[str], x: str, y: str, scan_name: str) -> DataFrame:
    """A step for laser timing scans (lxt in the name), a gaussian for others."""
    return step_traces(curves, keys, x, y) if "lxt" in scan_name else gaussian_fits(curves, keys, x, y)


def solvent_maximum(profile: DataFrame, elem: str, value: str, height: float = 1.0) -> int:
    """Position of the highest local maximum of at least height; of the largest value if there is none."""
    from pyspark.sql import Window as W

    w = W.orderBy(elem)  # one profile: a few hundred rows
    p = profile.withColumns({"_a": F.lag(value).over(w), "_b": F.lead(value).over(w)})
    peak = (F.col(value) > F.col("_a")) & (F.col(value) > F.col("_b")) & (F.col(value) >= height)
    return p.agg(F.max_by(elem, F.struct(peak, F.col(value), -F.col(elem)))).first()[0]
