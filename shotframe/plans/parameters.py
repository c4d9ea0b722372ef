"""Parameters of the analyses, with defaults and checks; ranges that make no sense raise ValueError."""

from __future__ import annotations

import os
from dataclasses import dataclass, field, fields
from typing import Any


def _check(ok: bool, what: str) -> None:
    if not ok:
        raise ValueError(what)


@dataclass
class Header:
    title: str = "Task configuration"
    experiment: str = ""
    run: int | str = ""
    date: str = "1970/01/01"
    version: str | float = 0.1
    task_timeout: int = 600
    work_dir: str = ""

    def __post_init__(self) -> None:
        self.experiment = self.experiment or os.environ.get("EXPERIMENT", "EXPX00000")
        if self.run == "":
            first = os.environ.get("RUN_NUM", "").split("_")[0]
            self.run = int(first) if first.isdigit() else ""
        _check(self.task_timeout > 0, "task_timeout is above 0")

    @property
    def hutch(self) -> str:
        return self.experiment[:3]


@dataclass
class Thresholds:
    min_iscat: float = 10.0
    min_ipm: float = 1000.0


@dataclass
class Scattering:
    """Columns of the shot table by name. path: where the table lies; plans.pipeline.last_result finds the last one that a
    task has recorded in the ledger."""

    ipm: str
    path: str = ""
    detector: str | None = None
    scan: str | list[str] | None = None
    thresholds: Thresholds = field(default_factory=Thresholds)
    bins: int = 51
    q_range: tuple[float, float] = (0.9, 3.5)


@dataclass
class Absorption(Scattering):
    energy: str = "ccm"
    set_point: str | None = None
    water_range: tuple[float, float] = (1.5, 3.5)
    absorption_detector: str | None = None


@dataclass
class Emission(Scattering):
    transpose: bool = False
    rotation: float | None = None
    half_width: int = 5
    emission_detector: str | None = None


@dataclass
class Peaks:
    detector: str = ""
    path: str = ""
    out: str = ""
    n_events: int = 0
    tag: str = ""
    event_logic: bool = False
    event_code: int = 0
    min_peaks: int = 2
    max_peaks: int = 2048
    npix_min: int = 2
    npix_max: int = 30
    amax_thr: float = 80.0
    atot_thr: float = 120.0
    son_min: float = 7.0
    rank: int = 3
    r0: float = 3.0
    dr: float = 2.0
    nsigm: float = 7.0
    abs_error: float | None = None

    def __post_init__(self) -> None:
        _check(0 <= self.min_peaks <= self.max_peaks, "min_peaks is not above max_peaks")
        _check(0 < self.npix_min <= self.npix_max and self.rank > 0, "npix_min, npix_max and rank are above 0")

    def finder(self) -> dict[str, Any]:
        return {k: getattr(self, k) for k in ("npix_min", "npix_max", "amax_thr", "atot_thr", "son_min", "rank", "r0", "dr", "nsigm")}


@dataclass
class GeometrySearch:
    detector: str = ""
    powder: str = ""
    wavelength: float = 1.0
    pixel_size: float = 0.1
    n_peaks: int = 4
    n_iterations: int = 5
    threshold: float = 1e6
    dx: tuple[float, float, int] = (-6, 6, 5)
    dy: tuple[float, float, int] = (-6, 6, 5)
    center: tuple[float, float] | None = None
    distance: float = 100.0
    filter_profile: bool = False
    filter_order: int = 2
    filter_threshold: float = 0.25

    def __post_init__(self) -> None:
        _check(self.wavelength > 0 and self.pixel_size > 0 and self.distance > 0, "lengths are above 0")


@dataclass
class Concatenate:
    in_dir: str
    tag: str
    out: str = ""

    def __post_init__(self) -> None:
        self.out = self.out or f"{self.in_dir.rstrip('/')}/{self.tag}.stream"


def build(model: type, values: dict[str, Any]) -> Any:
    """A model from a configuration's dictionary; nested thresholds too. Unknown names raise TypeError."""
    known = {f.name for f in fields(model)}
    unknown = set(values) - known
    if unknown:
        raise TypeError(f"{model.__name__} has no {', '.join(sorted(unknown))}")
    v = dict(values)
    if isinstance(v.get("thresholds"), dict):
        v["thresholds"] = Thresholds(**v["thresholds"])
    return model(**v)


def describe(model: type) -> list[tuple[str, str, Any]]:
    """(name, type, default) of each parameter."""
    from dataclasses import MISSING

    return [(f.name, str(f.type), "required" if f.default is MISSING and f.default_factory is MISSING else f.default if f.default is not MISSING else f.default_factory()) for f in fields(model)]
