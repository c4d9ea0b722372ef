"""Droplets of detector images and the photons in them, for whole batches of images at once.

Bright pixels of a row that touch are one run; runs of neighbouring rows that touch are joined by a union-find over runs,
in array steps. Nothing loops over pixels or images."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

DROPLETS = "array<struct<npix: int, adu: double, row: double, col: double>>"
_DROPLETS = pa.list_(pa.struct([("npix", pa.int32()), ("adu", pa.float64()), ("row", pa.float64()), ("col", pa.float64())]))
PLACES = "array<struct<row: int, col: int, photons: int>>"
_PLACES = pa.list_(pa.struct([("row", pa.int32()), ("col", pa.int32()), ("photons", pa.int32())]))


@dataclass
class Runs:
    """Runs of set pixels in (image, row, column) order: first pixel, length and group (numbered from 0 on by first pixel)
    of each."""

    start: np.ndarray
    size: np.ndarray
    group: np.ndarray
    groups: int


def labelled_runs(mask: np.ndarray) -> Runs:
    """The runs of masks (image, row, column) and the groups of those that touch by a side; start counts pixels of all images."""
    n, h, w = mask.shape
    wide = np.zeros((n, h + 1, w + 1), bool)  # a free pixel ends each row, a free row each image
    wide[:, :h, :w] = mask
    step = np.diff(wide.ravel().view(np.int8), prepend=np.int8(0))
    start, end = np.flatnonzero(step == 1), np.flatnonzero(step == -1)
    # of each run the runs of the next row that reach under it: neighbours in the order of all
    low, high = np.searchsorted(end, start + w + 1, side="right"), np.searchsorted(start, end + w + 1, side="left")
    many = np.maximum(0, high - low)
    above = np.repeat(np.arange(len(start)), many)
    below = np.arange(int(many.sum())) - np.repeat(np.cumsum(many) - many, many) + np.repeat(low, many)
    label = np.arange(len(start))
    while True:
        a, b = label[above], label[below]
        apart = a != b
        if not apart.any():
            break
        above, below, a, b = above[apart], below[apart], a[apart], b[apart]
        np.minimum.at(label, np.maximum(a, b), np.minimum(a, b))
        while True:  # every run to the least of its group so far
            shorter = label[label]
            if np.array_equal(shorter, label):
                break
            label = shorter
    roots, group = np.unique(label, return_inverse=True)
    image, within = np.divmod(start, (h + 1) * (w + 1))
    return Runs(image * h * w + within // (w + 1) * w + within % (w + 1), end - start, group, len(roots))


def _pixels(runs: Runs) -> tuple[np.ndarray, np.ndarray]:
    """Every pixel of the runs and its group."""
    offset = np.cumsum(runs.size) - runs.size
    return np.arange(int(runs.size.sum())) + np.repeat(runs.start - offset, runs.size), np.repeat(runs.group, runs.size)


@dataclass
class Found:
    """Droplets by image and first pixel: image, pixels, sum and weighted place of each; with pixels' own arrays."""

    image: np.ndarray
    npix: np.ndarray
    adu: np.ndarray
    row: np.ndarray
    col: np.ndarray
    at: np.ndarray
    droplet: np.ndarray


def droplets_of(images: np.ndarray, threshold: float, low: float, min_adu: float) -> Found:
    """Of (image, row, column): touching pixels above low, of which one is above threshold, with min_adu in all."""
    n, h, w = images.shape
    flat = images.reshape(-1)
    at, group = _pixels(runs := labelled_runs(images > low))
    value = flat[at]
    total, top = np.bincount(group, value, runs.groups), np.full(runs.groups, -np.inf)
    np.maximum.at(top, group, value)
    keep = (top > threshold) & (total >= min_adu)
    number = np.cumsum(keep) - 1
    mine = keep[group]
    at, droplet, value = at[mine], number[group[mine]], value[mine]
    m = int(keep.sum())
    image = np.zeros(m, np.int64)
    image[droplet] = at // (h * w)
    adu = total[keep]
    row, col = (np.bincount(droplet, x * value, m) / adu for x in (at % (h * w) // w, at % w))
    return Found(image, np.bincount(droplet, minlength=m), adu, row, col, at, droplet)


def photon_places(images: np.ndarray, found: Found, per_photon: float) -> tuple[np.ndarray, np.ndarray]:
    """(pixel, photons): every droplet's intensity as whole photons, put on its pixels. A pixel first takes the whole
    photons that it holds; each of the rest goes where most is left, of equals to the first pixel."""
    left = images.reshape(-1)[found.at] / per_photon
    whole = np.floor(left)
    left -= whole
    want = np.round(found.adu / per_photon)
    rest = (want - np.bincount(found.droplet, whole, len(want))).astype(np.int64)  # no more than pixels: each has less than one left
    order = np.lexsort((found.at, -left, found.droplet))
    first = np.cumsum(np.bincount(found.droplet, minlength=len(want))) - np.bincount(found.droplet, minlength=len(want))
    rank = np.empty(len(order), np.int64)
    rank[order] = np.arange(len(order)) - first[found.droplet[order]]
    photons = whole.astype(np.int64) + (rank < rest[found.droplet])
    some = photons > 0
    return found.at[some], photons[some]


def image_batches(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(places, images) of the images of one shape; null and empty images are left out. Null pixels are not a number."""
    by_shape: dict[tuple[int, int], list[int]] = {}
    for i, m in enumerate(column):
        if m.is_valid and len(m) and m[0].is_valid and len(m[0]):
            by_shape.setdefault((len(m), len(m[0])), []).append(i)
    for shape, places in by_shape.items():
        some = column.take(pa.array(places))
        flat = some.flatten().flatten()
        if len(flat) != len(places) * shape[0] * shape[1]:
            raise ValueError("rows of an image differ in length")
        yield np.array(places), flat.to_numpy(zero_copy_only=False).astype(float).reshape(len(places), *shape)


def with_lists(shots: DataFrame, image: str, name: str, kind: str, arrow: pa.DataType, kernel: Callable[[np.ndarray], tuple[np.ndarray, dict[str, np.ndarray]]], pixels: int = 1 << 22) -> DataFrame:
    """shots with a column of lists of structs: the kernel gives of a batch of images the image that each struct is of, in
    order, and the structs' fields. Null and empty images have null. A batch has some million pixels, not a batch of Arrow's."""
    fields = shots.schema.fields
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in fields), f"`{name}` {kind}"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            column = whole.column(whole.schema.get_field_index(image))
            one = next((len(m) * len(m[0]) for m in column if m.is_valid and len(m) and m[0].is_valid), 1)
            for a in range(0, whole.num_rows, step := max(1, pixels // max(1, one))):
                b = whole.slice(a, step)
                out: list = [None] * b.num_rows
                for places, images in image_batches(b.column(b.schema.get_field_index(image))):
                    owner, columns = kernel(images)
                    cuts = np.searchsorted(owner, np.arange(len(places) + 1))
                    structs = pa.StructArray.from_arrays([pa.array(columns[f.name]).cast(f.type) for f in arrow.value_type], fields=list(arrow.value_type)).to_pylist()
                    for k, place in enumerate(places.tolist()):
                        out[place] = structs[cuts[k] : cuts[k + 1]]
                yield pa.RecordBatch.from_arrays([*b.columns, pa.array(out, arrow)], [*b.schema.names, name])

    return shots.mapInArrow(run, schema)


def droplets(shots: DataFrame, image: str = "image", threshold: float = 5.0, low: float = 5.0, min_adu: float = 60.0) -> DataFrame:
    """shots with droplets (npix, adu, row, col): pixels above low that touch by a side, of which one is above threshold, with
    min_adu in all; row and col are weighted means. Ordered by first pixel."""

    def find(images: np.ndarray) -> tuple[np.ndarray, dict]:
        d = droplets_of(images, threshold, low, min_adu)
        return d.image, {"npix": d.npix, "adu": d.adu, "row": d.row, "col": d.col}

    return with_lists(shots, image, "droplets", DROPLETS, _DROPLETS, find)


def placed_photons(shots: DataFrame, image: str = "image", per_photon: float = 162.0, threshold: float = 5.0, low: float = 5.0, min_adu: float = 60.0) -> DataFrame:
    """shots with photon_places (row, col, photons): the droplets' photons on the pixels they are counted in, by pixel."""

    def find(images: np.ndarray) -> tuple[np.ndarray, dict]:
        h, w = images.shape[1:]
        at, photons = photon_places(images, droplets_of(images, threshold, low, min_adu), per_photon)
        order = np.argsort(at)
        at, photons = at[order], photons[order]
        return at // (h * w), {"row": at % (h * w) // w, "col": at % w, "photons": photons}

    return with_lists(shots, image, "photon_places", PLACES, _PLACES, find)
