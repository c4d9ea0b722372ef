"""Array-valued shot columns: (phi, q) patterns and q profiles, kept as arrays inside a shot and exploded only
where shots are averaged."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shotframe.functions import nansafe as N


def exploded(df: DataFrame, profile: str, elem: str = "q_idx", value: str = "v") -> DataFrame:
    """A row per element; the other columns stay. Averages over it combine on the map side."""
    return df.select("*", F.posexplode(profile).alias(elem, value)).drop(profile)


def in_range(axis: list[float], low: float, high: float) -> list[int]:
    """Positions strictly inside a range of the axis."""
    return [i for i, x in enumerate(axis) if low < x < high]


def range_mean(profile: Column, axis: list[float], low: float, high: float) -> Column:
    """Mean without NaN over the axis range; NaN if nothing lies in it."""
    return N.array_mean(F.array(*[F.get(profile, F.lit(i)) for i in in_range(axis, low, high)]).cast("array<double>"))


def dark_mean(df: DataFrame, profile: str, off: Column) -> DataFrame:
    """(q_idx, dark): mean profile of shots without x-rays, NaN left out; 0 for every element where that mean is
    one and the same number throughout, as it then says nothing."""
    dark = exploded(df.where(off).select(profile), profile).groupBy("q_idx").agg(N.mean(F.col("v")).alias("dark"))
    known = dark.agg(F.count_distinct("dark").alias("n"))
    return dark.crossJoin(F.broadcast(known)).select("q_idx", F.when(F.col("n") > 1, F.col("dark")).otherwise(0.0).alias("dark"))  # known: one row


def dark_array(dark: DataFrame) -> list[float]:
    """The dark profile as a literal: one number per element of a profile."""
    return [r.dark for r in dark.orderBy("q_idx").collect()]


def pattern_norm(patterns: Column, axis: list[float], low: float, high: float) -> Column:
    """Norm of a (phi, q) pattern: the mean over the axis range of each phi row, then the mean over phi, both without
    NaN. Of the raw pattern, whatever is subtracted from its profile."""
    at = in_range(axis, low, high)
    if not at:
        return F.lit(N.NAN)
    rows = F.transform(patterns, lambda row: N.array_mean(F.slice(row, at[0] + 1, len(at)) if at == list(range(at[0], at[-1] + 1)) else F.transform(F.array(*map(F.lit, at)), lambda i: F.get(row, i))))
    return N.array_mean(rows)


def normalised(df: DataFrame, patterns: str, axis: list[float], dark: list[float], keep: tuple[str, ...], low: float = 0.9, high: float = 3.5) -> DataFrame:
    """(keep, q_idx, v): a row per shot and element, the profile (sum over phi) less the dark one, over the pattern's
    norm. The norm is found once a shot, before elements part: a select of its own, below the one that explodes."""
    once = df.select(*keep, pattern_norm(F.col(patterns), axis, low, high).alias("_n"), N.row_totals(F.col(patterns)).alias("_t"))
    wide = once.select(*keep, "_n", F.posexplode("_t").alias("q_idx", "_p"))
    less = F.get(F.array(*[F.lit(float(x)) for x in dark]), F.col("q_idx")) if dark else F.lit(0.0)
    return wide.select(*keep, "q_idx", N.divide(F.col("_p") - less, F.col("_n")).alias("v"))


def corrected(df: DataFrame, patterns: str, axis: list[float], xray_off: Column, keep: tuple[str, ...], low: float = 0.9, high: float = 3.5) -> DataFrame:
    """(keep, q_idx, v): profiles less the dark mean over the patterns' norm, a row per shot and element."""
    dark = dark_array(dark_mean(df.where(xray_off).select(N.row_totals(F.col(patterns)).alias("_profile")), "_profile", F.lit(True)))
    return normalised(df, patterns, axis, dark, keep, low, high)


def scattering_difference(df: DataFrame, patterns: str, axis: list[float], scan: str, on: Column, off: Column, xray_off: Column, low: float = 0.9, high: float = 3.5, bins: DataFrame | None = None) -> DataFrame:
    """(scan, q_idx, on, off, diff, n_on, n_off): normalised profiles averaged without NaN by scan value and
    element, for every scan value of df (or of bins) and every element. on and off are null where a side has no shots; the
    difference counts such a side as 0. A NaN scan belongs to no bin."""
    from shotframe.operators.differences import by_scan

    s = df.select(F.col(scan).cast("double").alias("scan"), on.alias("_on_shot"), off.alias("_off_shot"), xray_off.alias("_dark_shot"), F.col(patterns).alias("_patterns"))
    rows = corrected(s, "_patterns", axis, F.col("_dark_shot"), ("scan", "_on_shot", "_off_shot"), low, high)
    elements = df.sparkSession.range(len(axis)).select(F.col("id").cast("int").alias("q_idx"))
    return by_scan(bins if bins is not None else s, rows, F.col("v"), F.col("_on_shot"), F.col("_off_shot"), elements)
