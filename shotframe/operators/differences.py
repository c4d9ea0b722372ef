"""Pump-probe difference signals: means of laser-on and laser-off shots by bin, and their difference."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shotframe.functions import nansafe as N
from shotframe.operators.binning import assign_bin, bin_table


def on_off_means(df: DataFrame, keys: list[str], value: Column, on: Column, off: Column, skip_nan: bool = True, clean: bool = False) -> DataFrame:
    """keys, on, off, diff, n_on, n_off: one aggregation with a partial step on the map side.

    skip_nan: means without NaN, else NaN poisons them. clean: NaN, null and infinities of the results become
    finite numbers. A side without shots is null unless cleaned."""
    fix = N.nan_to_num if clean else (lambda c: c)
    out = df.groupBy(*keys).agg(N.mean(F.when(on, value), skip_nan).alias("_on"), N.mean(F.when(off, value), skip_nan).alias("_off"), F.count_if(on).alias("n_on"), F.count_if(off).alias("n_off"))
    return out.select(*keys, fix(F.col("_on")).alias("on"), fix(F.col("_off")).alias("off"), fix(F.col("_on") - F.col("_off")).alias("diff"), "n_on", "n_off")


def by_edges(df: DataFrame, scan: Column, edges: list[float], value: Column, on: Column, off: Column, closed_last: bool = False, clean: bool = False, skip_nan: bool = True) -> DataFrame:
    """on_off_means by bin, with a row for every bin, also an empty one: (bin, lo, hi, center, on, off, diff, n_on, n_off)."""
    binned = df.withColumn("bin", assign_bin(scan, edges, closed_last)).where("bin is not null")
    found = on_off_means(binned, ["bin"], value, on, off, skip_nan, clean)
    bins = bin_table(df.sparkSession, edges)
    zero = F.lit(0.0) if clean else F.lit(None).cast("double")
    return bins.join(found, "bin", "left").select("bin", "lo", "hi", "center", *[F.coalesce(c, zero).alias(c) for c in ("on", "off", "diff")], *[F.coalesce(c, F.lit(0)).alias(c) for c in ("n_on", "n_off")])


def by_scan(shots: DataFrame, rows: DataFrame, value: Column, on: Column, off: Column, elements: DataFrame | None = None, skip_nan: bool = True, scan: str = "scan", sides: bool = True) -> DataFrame:
    """on_off_means of rows by scan value, with a row for every scan value of shots (a NaN there counts as 0) and
    every one of elements (a small table, such as the numbers of a profile's elements). sides: the difference
    counts a side without shots, or with a NaN mean, as 0; else it is null or NaN there."""
    found = on_off_means(rows.where(F.col(scan).isNotNull() & ~F.isnan(scan)), [scan, *(elements.columns if elements is not None else ())], value, on, off, skip_nan)
    grid = shots.select(N.nan_to_num(F.col(scan).cast("double")).alias(scan)).distinct()
    if elements is not None:
        grid = grid.crossJoin(elements)  # set points times elements
    out = grid.join(found, grid.columns, "left").withColumns({c: F.coalesce(c, F.lit(0)) for c in ("n_on", "n_off")})
    return out.withColumn("diff", N.nan_to_num(F.col("on")) - N.nan_to_num(F.col("off"))) if sides else out


def absorption_by_energy(df: DataFrame, energy: str, edges: list[float], value: Column, on: Column, off: Column) -> DataFrame:
    """Absorption over energy bins whose last one is closed; two bins or fewer give no spectrum."""
    out = by_edges(df, F.col(energy), edges, value, on, off, closed_last=True, clean=True)
    return out if len(edges) - 1 > 2 else out.limit(0)


def normaliser(df: DataFrame, norm: Column, monitor: Column) -> Column:
    """norm, or the monitor for all shots if norm is below 0 in any of them (one aggregate decides)."""
    negative = df.agg(F.bool_or(N.strip(norm) < 0)).first()[0]
    return monitor if negative else norm


def global_profile(df: DataFrame, elem: str, value: Column, on: Column) -> DataFrame:
    """(elem, value): the sum over laser-on shots divided by the number of all shots."""
    return df.groupBy(elem).agg(N.divide(N.total(F.when(on, value)), F.count("*").cast("double")).alias("value"))
