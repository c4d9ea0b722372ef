"""Named shot filters: boolean columns under names, combined by a comma-separated list."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shotframe.functions.nansafe import above

DEFAULT = "xray on, laser on, total scattering, ipm"
LASER_OFF = "xray on, laser off, ipm, total scattering"


def standard_filters(shots: DataFrame, min_iscat: float = 10.0, min_ipm: float = 1000.0) -> dict[str, Column]:
    """xray and laser flags, and thresholds on integrated scattering (iscat) and the intensity monitor (ipm);
    a monitor that the table lacks passes every shot."""
    out = {}
    for light in ("xray", "laser"):
        if light in shots.columns:
            out[f"{light} on"] = F.coalesce(F.col(light).cast("int") == 1, F.lit(False))
            out[f"{light} off"] = F.coalesce(F.col(light).cast("int") == 0, F.lit(False))
    if "iscat" in shots.columns:
        out["total scattering"] = above(F.col("iscat"), min_iscat)
    out["ipm"] = above(F.col("ipm"), min_ipm) if "ipm" in shots.columns else F.lit(True)
    return out


def combine(filters: dict[str, Column], names: str = DEFAULT) -> Column:
    """All filters of the list at once; names that are not registered are passed over."""
    chosen = [filters[n.strip()] for n in names.split(",") if n.strip() in filters]
    return reduce(lambda a, b: a & b, chosen, F.lit(True))


def filter_counts(shots: DataFrame, filters: dict[str, Column]) -> DataFrame:
    """(filter, n_pass, n_total): one pass over the shots."""
    counts = shots.agg(F.count("*").alias("n_total"), *[F.count_if(c).alias(n) for n, c in filters.items()])
    rows = F.explode(F.array(*[F.struct(F.lit(n).alias("filter"), F.col(f"`{n}`").alias("n_pass")) for n in filters])).alias("r")
    return counts.select("n_total", rows).select("r.filter", "r.n_pass", "n_total")


def with_event_code(shots: DataFrame, code: int, column: str = "event_codes", active: bool = True) -> DataFrame:
    """Shots that carry the event code; all of them if the logic is not active."""
    return shots.where(F.array_contains(column, code)) if active else shots


def shot_ranges(total: int, ranks: int) -> list[tuple[int, int, int]]:
    """(rank, start, stop) of contiguous ranges; the first of them take the remainder."""
    each, more = divmod(total, ranks)
    sizes = [each + (r < more) for r in range(ranks)]
    return [(r, sum(sizes[:r]), sum(sizes[: r + 1])) for r in range(ranks)]
