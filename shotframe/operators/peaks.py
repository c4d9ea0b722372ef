"""Peak finding per shot, hit selection, peak coordinates and summaries."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from shotframe.functions.nansafe import divide
from shotframe.functions.numeric import prominent_peaks
from shotframe.operators.droplets import image_batches

PEAK = "seg: int, row: int, col: int, npix: int, amax: double, atot: double, rcent: double, ccent: double, rmin: int, rmax: int, cmin: int, cmax: int, son: double"

#: Pixels of images that are searched at once.
PIXELS = 1 << 22


def _shifted(a: np.ndarray, dy: int, dx: int, fill: float) -> np.ndarray:
    """(panel, row, column) with the value that stands dy rows and dx columns on."""
    h, w = a.shape[1:]
    out = np.full_like(a, fill)
    if abs(dy) < h and abs(dx) < w:
        out[:, max(0, -dy) : h - max(0, dy), max(0, -dx) : w - max(0, dx)] = a[:, max(0, dy) : h + min(0, dy), max(0, dx) : w + min(0, dx)]
    return out


def _around(panels: np.ndarray, at: tuple[np.ndarray, ...], dy: np.ndarray, dx: np.ndarray) -> np.ndarray:
    """Of each place the values at offsets; not a number outside the panel."""
    k, r, c = at
    h, w = panels.shape[1:]
    y, x = r[:, None] + dy, c[:, None] + dx
    ok = (y >= 0) & (y < h) & (x >= 0) & (x < w)
    return np.where(ok, panels[k[:, None], np.clip(y, 0, h - 1), np.clip(x, 0, w - 1)], np.nan)


def peaks_of(panels: np.ndarray, npix_min: int, npix_max: int, amax_thr: float, atot_thr: float, son_min: float, rank: int, r0: float, dr: float, nsigm: float) -> dict[str, np.ndarray]:
    """Columns of the peaks of panels (panel, row, column), by panel, row and column; no loop over pixels or peaks.

    Pixels above amax_thr that are the largest within rank of them (the first of equal ones) are seeds; a peak is the
    pixels around its seed that exceed the background of a ring (radius r0, width dr) by nsigm deviations and touch
    each other."""
    seed = panels > amax_thr
    for dy in range(-rank, rank + 1):
        for dx in range(-rank, rank + 1):
            if (dy, dx) != (0, 0) and seed.any():
                other = _shifted(panels, dy, dx, -np.inf)
                seed &= panels > other if (dy, dx) < (0, 0) else panels >= other
    at = k, r, c = np.nonzero(seed)
    reach = int(np.ceil(max(rank, r0 + dr)))
    y, x = (v.ravel() for v in np.mgrid[-reach : reach + 1, -reach : reach + 1])
    far = np.hypot(y, x)
    in_ring = (far >= r0) & (far <= r0 + dr)
    ring = _around(panels, at, y[in_ring], x[in_ring])
    n = np.maximum(1, (~np.isnan(ring)).sum(1))
    base = np.nansum(ring, 1) / n
    noise = np.sqrt(np.nansum((ring - base[:, None]) ** 2, 1) / n)
    side = 2 * rank + 1
    y, x = (v.ravel() for v in np.mgrid[-rank : rank + 1, -rank : rank + 1])
    near = (_around(panels, at, y, x) - base[:, None]).reshape(-1, side, side)
    bright = near > nsigm * noise[:, None, None]  # never outside the panel
    member = np.zeros_like(bright)
    member[:, rank, rank] = True
    while len(member):  # as often as the longest way through a window
        grown = member.copy()
        grown[:, 1:] |= member[:, :-1]
        grown[:, :-1] |= member[:, 1:]
        grown[:, :, 1:] |= member[:, :, :-1]
        grown[:, :, :-1] |= member[:, :, 1:]
        grown = grown & bright | member
        if np.array_equal(grown, member):
            break
        member = grown
    flat, own = member.reshape(-1, side * side), np.where(member, near, 0.0).reshape(-1, side * side)
    npix, total, top = flat.sum(1), own.sum(1), near[:, rank, rank]
    with np.errstate(divide="ignore", invalid="ignore"):
        son = np.where(noise > 0, total / (noise * np.sqrt(np.maximum(1, npix))), np.inf)
        rcent, ccent = r + own @ y / total, c + own @ x / total
    least = lambda v: np.where(flat, v, side).min(1, initial=side)
    most = lambda v: np.where(flat, v, -side).max(1, initial=-side)
    keep = (npix >= npix_min) & (npix <= npix_max) & (top >= amax_thr) & (total >= atot_thr) & (son >= son_min)
    columns = {"panel": k, "row": r, "col": c, "npix": npix, "amax": top, "atot": total, "rcent": rcent, "ccent": ccent, "rmin": r + least(y), "rmax": r + most(y), "cmin": c + least(x), "cmax": c + most(x), "son": son}
    return {name: v[keep] for name, v in columns.items()}


def find_peaks(shots: DataFrame, image: str = "image", npix_min: int = 2, npix_max: int = 30, amax_thr: float = 80.0, atot_thr: float = 120.0, son_min: float = 7.0, rank: int = 3, r0: float = 3.0, dr: float = 2.0, nsigm: float = 7.0) -> DataFrame:
    """shots with peaks (array) and n_peaks; image is (panel, row, column), null or empty images have none.

    The kernel that such parameters are known from is native code that cannot be read; this one follows what the
    parameters are described to mean and is not equal to it bit for bit."""
    kept = [f for f in shots.schema.fields if f.name != image]
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in kept), f"peaks array<struct<{PEAK}>>"])
    whole = {"seg", "row", "col", "npix", "rmin", "rmax", "cmin", "cmax"}
    kind = pa.list_(pa.struct([(k, pa.int32() if k in whole else pa.float64()) for k in (x.split(":")[0] for x in PEAK.split(", "))]))

    names = [f.name for f in kind.value_type]

    def of_images(column: pa.Array) -> list[list[dict]]:
        """Panels of one shape together, whatever shots they are of."""
        shot = [i for i, m in enumerate(column) for _ in (m if m.is_valid else ())]
        seg = [s for m in column for s in range(len(m) if m.is_valid else 0)]
        out: list[list[dict]] = [[] for _ in range(len(column))]
        for places, panels in image_batches(column.flatten()):
            p = peaks_of(panels, npix_min, npix_max, amax_thr, atot_thr, son_min, rank, r0, dr, nsigm)
            place = places[p.pop("panel")]
            p["seg"] = np.array(seg, np.int64)[place]
            structs = pa.StructArray.from_arrays([pa.array(p[f.name]).cast(f.type) for f in kind.value_type], fields=list(kind.value_type)).to_pylist()
            for i, x in zip(place.tolist(), structs, strict=True):
                out[shot[i]].append({n: x[n] for n in names})
        return [sorted(x, key=lambda d: (d["seg"], d["row"], d["col"])) for x in out]

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            at = whole.schema.get_field_index(image)
            one = next((len(m) * len(m[0]) * len(m[0][0]) for m in whole.column(at) if m.is_valid and len(m) and len(m[0])), 1)
            for a in range(0, whole.num_rows, step := max(1, PIXELS // max(1, one))):
                b = whole.slice(a, step)
                yield pa.RecordBatch.from_arrays([*(b.column(b.schema.get_field_index(f.name)) for f in kept), pa.array(of_images(b.column(at)), kind)], [*(f.name for f in kept), "peaks"])

    return shots.mapInArrow(found, schema).withColumn("n_peaks", F.size("peaks"))


def image_counts(shots: DataFrame, image: str = "image") -> DataFrame:
    """One row: events, and those without an image, which the finder passes over."""
    return shots.agg(F.count("*").alias("events"), F.count_if(F.col(image).isNull()).alias("no_image"))


def hits(shots: DataFrame, min_peaks: int = 2, max_peaks: int = 2048, n_peaks: str = "n_peaks") -> DataFrame:
    return shots.where(F.col(n_peaks).between(min_peaks, max_peaks))


def peak_table(hit: DataFrame, keys: list[str], panel_rows: int) -> DataFrame:
    """A row per peak, with its row in the image of panels under each other."""
    return hit.select(*keys, F.posexplode("peaks").alias("peak", "p")).select(*keys, "peak", "p.*").withColumn("image_row", F.col("seg") * panel_rows + F.col("row"))


def peak_radius(peaks: DataFrame, pixel_map: DataFrame, cx: float, cy: float) -> DataFrame:
    """Peaks with the coordinates of their pixel (map: seg, row, col, ix, iy) and the distance of its middle from the
    beam; a pixel that the map lacks has none."""
    r = F.sqrt(F.pow(F.col("ix") + 0.5 - cx, 2) + F.pow(F.col("iy") + 0.5 - cy, 2))
    return peaks.join(pixel_map, ["seg", "row", "col"], "left").withColumn("radius", r)


def hit_summary(shots: DataFrame, hit: Column, rank: Column | None = None) -> DataFrame:
    """One row: events, hits, rate with two decimals (0.00 without events), and hits of each rank."""
    own = F.lit(0) if rank is None else rank
    ranks = shots.groupBy(own.alias("rank")).agg(F.count("*").alias("n"), F.count_if(hit).alias("h"))
    out = ranks.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("events"), F.coalesce(F.sum("h"), F.lit(0)).alias("hits"), F.array_sort(F.collect_list(F.struct("rank", "h"))).alias("r"))
    rate = F.when(F.col("events") > 0, F.col("hits") / F.col("events")).otherwise(0.0)
    return out.select("events", "hits", F.format_string("%.2f", rate).alias("rate"), F.transform("r", lambda x: x["h"]).alias("hits_per_rank"))


def local_maxima(profile: DataFrame, elem: str, value: str, height: float, keys: list[str] | None = None) -> DataFrame:
    """Rows greater than both neighbours and at least height, within each key."""
    w = W.partitionBy(*(keys or [F.lit(0)])).orderBy(elem)
    p = profile.withColumns({"_a": F.lag(value).over(w), "_b": F.lead(value).over(w)})
    return p.where((F.col(value) > F.col("_a")) & (F.col(value) > F.col("_b")) & (F.col(value) >= height)).drop("_a", "_b")


def profile_peaks(shots: DataFrame, keys: list[str], profile: str, prominence: float = 1.0, distance: int = 10, height: float = -np.inf) -> DataFrame:
    """(keys, place, value, prominence): the peaks of every shot's profile that are distance apart and stand out by prominence. A
    profile is one row's array and batches of profiles are searched at once; null and empty ones have no peaks."""
    kinds = {f.name: f.dataType.simpleString() for f in shots.schema.fields}
    schema = ", ".join([*(f"`{k}` {kinds[k]}" for k in keys), "place int, value double, prominence double"])

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            column = b.column(len(keys))
            sizes = np.array([len(x) if x.is_valid else 0 for x in column])
            for size in np.unique(sizes[sizes > 0]):
                rows = np.flatnonzero(sizes == size)
                y = column.take(pa.array(rows)).flatten().to_numpy(zero_copy_only=False).astype(float).reshape(len(rows), size)
                owner, place, rise = prominent_peaks(y, prominence, distance, height)
                own = pa.array(rows[owner])
                yield pa.RecordBatch.from_arrays([*(b.column(k).take(own) for k in range(len(keys))), pa.array(place, pa.int32()), pa.array(y[owner, place]), pa.array(rise)], [*keys, "place", "value", "prominence"])

    return shots.select(*keys, F.col(profile).cast("array<double>")).mapInArrow(find, schema)


def strongest(peaks: DataFrame, elem: str, value: str, first: int = 8, n: int = 4) -> DataFrame:
    """Of the first peaks by position the n highest; equal ones by position."""
    return peaks.orderBy(elem).limit(first).orderBy(F.desc(value), elem).limit(n)


def hit_rate(shots: DataFrame, hit: Column) -> Column:
    return divide(F.count_if(hit).cast("double"), F.count("*").cast("double"))
