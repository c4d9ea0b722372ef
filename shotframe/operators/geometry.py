"""Detector geometry from powder rings: a grid of centres and distances, whose profiles are one aggregation, refined by turns."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shotframe.functions.numeric import bilinear, least_squares
from shotframe.functions.splines import smoothed
from shotframe.operators.images import radius
from shotframe.operators.peaks import profile_peaks

#: Ring spacings that are tried (inverse Angstrom), orders that count, and the first ring of silver behenate.
SPACINGS = (0.01, 0.03, 0.00005)
ORDERS, FIRST_RING = 13, 0.1076


def offsets(limits: tuple[float, float, int]) -> list[float]:
    return [float(x) for x in np.linspace(*limits)]


def center_grid(spark: SparkSession, center: tuple[float, float], distances: list[float], dx=(-6, 6, 5), dy=(-6, 6, 5)) -> DataFrame:
    """(candidate, cx, cy, distance) of every offset in x, offset in y and distance: a small product of parameters, in one
    partition."""
    rows = spark.range(0, 1, 1, 1)
    for k, values in (("x", offsets(dx)), ("y", offsets(dy)), ("d", distances)):
        rows = rows.select("*", F.posexplode(F.array(*[F.lit(float(v)) for v in values])).alias(f"{k}_i", k))
    ny, nd = len(offsets(dy)), len(distances)
    at = (F.col("x_i") * ny + F.col("y_i")) * nd + F.col("d_i")
    return rows.select(at.alias("candidate"), (center[0] + F.col("x")).alias("cx"), (center[1] + F.col("y")).alias("cy"), F.col("d").alias("distance"))


def spacing_table(spark: SparkSession) -> DataFrame:
    low, high, step = SPACINGS
    n = int(np.ceil((high - low) / step - 1e-9))
    return spark.range(n).select((F.lit(low) + F.col("id") * step).alias("dq"))


def ring_scores(peaks: DataFrame, q: str = "q", keys: tuple[str, ...] = ()) -> DataFrame:
    """keys, dq, score: how far the peaks lie from multiples of each spacing, relative to it; spacings are a fixed
    table of 400 numbers, peaks a handful to a key."""
    rounded = F.round(F.col(q), 5)
    rest = rounded - F.floor(rounded / F.col("dq")) * F.col("dq")
    rows = peaks.crossJoin(F.broadcast(spacing_table(peaks.sparkSession)))
    near = F.least(rest, F.abs(F.col("dq") - rest))
    return rows.where(rounded / F.col("dq") < ORDERS).groupBy(*keys, "dq").agg((F.avg(near) / F.first("dq")).alias("score"))


def best_spacing(scores: DataFrame, keys: tuple[str, ...] = ()) -> DataFrame:
    """keys, dq with the least score, final_score = (mean - least) / deviation of the scores, 0 if that is no number."""
    final = (F.avg("score") - F.min("score")) / F.nullif(F.stddev_pop("score"), F.lit(0.0))
    return scores.groupBy(*keys).agg(F.min_by("dq", F.struct("score", "dq")).alias("dq"), F.coalesce(F.nanvl(final, F.lit(0.0)), F.lit(0.0)).alias("final_score"))


def score_rings(q_peaks: np.ndarray) -> tuple[float, float]:
    """Spacing and score as ring_scores and best_spacing give them, for use inside a task."""
    dqs = np.arange(*SPACINGS)
    q = np.round(q_peaks, 5)
    scores = np.full(len(dqs), np.nan)
    for i, dq in enumerate(dqs):
        own = q[q / dq < ORDERS]
        if len(own):
            rest = own % dq
            scores[i] = np.minimum(rest, np.abs(dq - rest)).mean() / dq
    if np.isnan(scores).all():
        return float(dqs[0]), 0.0
    dev = np.nanstd(scores)
    score = 0.0 if np.isnan(np.min(scores)) or dev == 0 else float((scores.mean() - scores.min()) / dev)
    return float(dqs[np.nanargmin(scores)]), score


def profile_of(image: np.ndarray, cx: float, cy: float, floor: float = 10.0) -> np.ndarray:
    y, x = np.indices(image.shape)
    r = np.hypot(x - cx, y - cy).astype(int).ravel()
    n = np.bincount(r)
    out = np.bincount(r, image.ravel()) / np.maximum(n, 1)
    out[out < floor] = 0
    return out


def candidate_profiles(pixels: DataFrame, candidates: DataFrame, floor: float = 10.0, smooth: tuple[int, float] | None = None) -> DataFrame:
    """(candidate, profile): of every centre (candidate, cx, cy) the mean by whole radius of the pixels (row, col, value), from 0
    to the largest radius; 0 where no pixel lies or the mean is below floor. One aggregation for all centres: a pixel
    is added to each one's ring where it is read. smooth: order and cutoff of a Butterworth filter, before the floor."""
    centres = [F.struct(F.lit(int(c.candidate)).alias("candidate"), F.lit(float(c.cx)).alias("cx"), F.lit(float(c.cy)).alias("cy")) for c in candidates.select("candidate", "cx", "cy").collect()]  # a grid of parameters
    if not centres:
        return candidates.select(F.col("candidate").cast("int"), F.array().cast("array<double>").alias("profile"))
    rows = pixels.select("row", "col", F.col("value").cast("double").alias("value"), F.explode(F.array(*centres)).alias("c"))
    r = F.floor(radius(F.col("col"), F.col("row"), F.col("c.cx"), F.col("c.cy"))).cast("int")
    rings = rows.groupBy(F.col("c.candidate").alias("candidate"), r.alias("r")).agg((F.sum("value") / F.count("*")).alias("m"))
    one = rings.groupBy("candidate").agg(F.map_from_entries(F.collect_list(F.struct("r", "m"))).alias("m"), F.max("r").alias("top"))  # a detector's radius long
    whole = one.select("candidate", F.transform(F.sequence(F.lit(0), "top"), lambda i: F.coalesce(F.try_element_at("m", i), F.lit(0.0))).alias("profile"))
    if smooth:

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                out = [smoothed(np.array([p], float), *smooth)[0].tolist() for p in b.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays([b.column(0), pa.array(out, pa.list_(pa.float64()))], ["candidate", "profile"])

        whole = whole.mapInArrow(run, "candidate int, profile array<double>")
    return whole.select("candidate", F.transform("profile", lambda v: F.when(v < floor, 0.0).otherwise(v)).alias("profile"))


def ring_peaks(profiles: DataFrame) -> DataFrame:
    """(candidate, place, value, prominence): the peaks of the profiles."""
    return profile_peaks(profiles, ["candidate"], "profile", 1.0, 10)


def inferred_distances(peaks: DataFrame, candidates: DataFrame, wavelength: float, pixel: float) -> DataFrame:
    """candidates with distance, the one that puts the first ring in its place, score (of the rings) and n_rings. Ring positions are
    2 sin(theta / 2) / wavelength without a factor of two pi, and the known ring is divided by it."""
    at = peaks.select("candidate", "place").join(candidates.select("candidate", "distance"), "candidate")
    q = at.select("candidate", (2 * F.sin(F.atan(F.col("place") * pixel / F.col("distance")) / 2) / wavelength).alias("q"))
    best = best_spacing(ring_scores(q, keys=("candidate",)), ("candidate",))
    rings = peaks.groupBy("candidate").agg(F.count("*").cast("int").alias("n_rings"))
    out = candidates.join(best, "candidate", "left").join(rings, "candidate", "left")
    first = 2 * F.col("distance") * F.asin(F.coalesce("dq", F.lit(SPACINGS[0])) * wavelength / 2) / pixel
    known = float(np.tan(2 * np.arcsin(wavelength * FIRST_RING / (2 * np.pi) / 2)))
    return out.select("candidate", "cx", "cy", (first * pixel / known).alias("distance"), F.coalesce("final_score", F.lit(0.0)).alias("score"), F.coalesce("n_rings", F.lit(0)).alias("n_rings"))


def refine_center(image: np.ndarray, radii: np.ndarray, cx: float, cy: float, points: int = 200) -> tuple[float, float]:
    """Centre and ring radii that put the rings on the brightest pixels, by least squares."""
    flat = (image - image.mean()) / max(image.std(), 1e-12)
    turn = np.linspace(0, 2 * np.pi, points, endpoint=False)

    def residual(p: np.ndarray) -> np.ndarray:
        return np.concatenate([flat.max() - bilinear(flat, p[1] + r * np.sin(turn), p[0] + r * np.cos(turn)) for r in p[2:]])

    if not len(radii):
        return cx, cy
    p = least_squares(residual, np.array([cx, cy, *radii], float), steps=20)
    return float(p[0]), float(p[1])


def search(candidates: DataFrame, pixels: DataFrame, wavelength: float, pixel: float, iterations: int = 5, n_peaks: int = 4, threshold: float = 1e6, smooth: tuple[int, float] | None = None) -> DataFrame:
    """Refines every candidate and returns its iterations: candidate, iteration, cx, cy, distance, score, n_rings.

    Profiles of all candidates are one aggregation over the pixels (row, col, value; values above threshold count as 0), their peaks
    and ring scores are joins of a few rows a candidate; only the fit of a centre to the image, of which a task needs
    the pixels around the rings, runs in a task for each candidate. The assembled image is broadcast to these: a fixed size for a
    detector. Each iteration ends in a row a candidate on the driver."""
    spark = candidates.sparkSession
    clean = pixels.select("row", "col", F.when(F.col("value") > threshold, 0.0).otherwise(F.col("value")).alias("value"))
    rows = clean.toPandas()  # one assembled image
    image = np.zeros((int(rows["row"].max()) + 1, int(rows["col"].max()) + 1)) if len(rows) else np.zeros((1, 1))
    image[rows["row"], rows["col"]] = rows["value"]
    shared = spark.sparkContext.broadcast(image)

    def refine(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for p in parts:
            found = [refine_center(shared.value, np.array(sorted(c.radii), float), c.cx, c.cy) for c in p.itertuples(index=False)]
            yield pd.DataFrame({"candidate": p["candidate"], "cx": [f[0] for f in found], "cy": [f[1] for f in found], "distance": p["distance"]})

    schema = "candidate int, cx double, cy double, distance double"
    now = candidates.select(F.col("candidate").cast("int"), "cx", "cy", "distance")
    out, count = [], max(1, candidates.count())
    for k in range(iterations):
        peaks = ring_peaks(candidate_profiles(clean, now, smooth=smooth))
        of = Window.partitionBy("candidate")
        first = peaks.withColumn("k", F.row_number().over(of.orderBy("place"))).where("k <= 8")
        chosen = first.withColumn("k", F.row_number().over(of.orderBy(F.desc("value"), "place"))).where(F.col("k") <= n_peaks)
        radii = chosen.groupBy("candidate").agg(F.collect_list(F.col("place").cast("double")).alias("radii"))
        fits = now.join(radii, "candidate", "left").withColumn("radii", F.coalesce("radii", F.array().cast("array<double>")))
        moved = spark.createDataFrame(fits.repartition(count, "candidate").mapInPandas(refine, schema).collect(), schema)  # a row a candidate
        scored = inferred_distances(ring_peaks(candidate_profiles(clean, moved, smooth=smooth)), moved, wavelength, pixel).collect()
        out += [(r.candidate, k, r.cx, r.cy, r.distance, r.score, r.n_rings) for r in scored]
        now = spark.createDataFrame([(r.candidate, r.cx, r.cy, r.distance) for r in scored], schema)
    return spark.createDataFrame(out, "candidate int, iteration int, cx double, cy double, distance double, score double, n_rings int")


def best_candidate(found: DataFrame) -> DataFrame:
    """The row with the highest score; of equal ones the first."""
    return found.orderBy(F.desc("score"), "candidate", "iteration").limit(1)


def edge_resolution(half_width: float, distance: float, wavelength: float) -> float:
    """1 / q at half_width (mm) from the beam."""
    return float(wavelength / (2 * np.sin(np.arctan(half_width / distance) / 2)))
