"""Bins of scan variables. Edges are a few numbers that the driver computes once from an aggregate, so that
engine and checks see the same doubles; shots get their bin by arithmetic, without a join."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from shotframe.functions.nansafe import nan_to_num, strip


def equal_width_edges(df: DataFrame, column: str, bins: int) -> list[float]:
    """bins + 1 edges from the least to the largest value (NaN left out); a single value is widened by 0.5."""
    lo, hi = df.agg(F.min(strip(F.col(column).cast("double"))), F.max(strip(F.col(column).cast("double")))).first()
    if lo is None:
        return []
    if lo == hi:
        lo, hi = lo - 0.5, hi + 0.5
    step = (hi - lo) / bins
    return [lo + i * step for i in range(bins)] + [hi]


def midpoint_edges(df: DataFrame, column: str) -> list[float]:
    """Edges between neighbouring distinct values; the outer ones are the extreme values themselves."""
    v = [r[0] for r in df.where(F.col(column).isNotNull() & ~F.isnan(F.col(column).cast("double"))).select(F.col(column).cast("double").alias("v")).distinct().orderBy("v").collect()]
    return [v[0], *[(a + b) / 2 for a, b in zip(v, v[1:], strict=False)], v[-1]] if v else []


def unique_edges(df: DataFrame, column: str, most: int = 50) -> list[float]:
    """Equal widths, as many as there are distinct values, most at most."""
    n = df.select(strip(F.col(column).cast("double")).alias("v")).agg(F.count_distinct("v")).first()[0]
    return equal_width_edges(df, column, min(most, n)) if n else []


def ccm_edges(df: DataFrame, readback: str, set_point: str | None) -> list[float]:
    """From the set points where the table has them, else from the readback's distinct values."""
    return midpoint_edges(df, set_point) if set_point and set_point in df.columns else unique_edges(df, readback)


def bin_names(edges: list[float], lower: bool = False) -> list[float]:
    """What bins are called: their centres, or (lower) their lower edges with the last edge as one bin more, which
    nothing falls into."""
    return list(edges) if lower else [(a + b) / 2 for a, b in zip(edges, edges[1:], strict=False)]


def distinct_values(df: DataFrame, column: str, fill_nan: bool = True) -> DataFrame:
    """(bin, value) of the distinct values in order; a NaN counts as 0, as it does where scans are cleaned first."""
    c = F.col(column).cast("double")
    values = df.select((nan_to_num(c) if fill_nan else strip(c)).alias("value")).where("value is not null").distinct()
    return values.select((F.row_number().over(W.orderBy("value")) - 1).alias("bin"), "value")


def bin_table(spark: SparkSession, edges: list[float], closed_last: bool = False) -> DataFrame:
    """(bin, lo, hi, center) of neighbouring edges."""
    rows = [(i, a, b, (a + b) / 2) for i, (a, b) in enumerate(zip(edges, edges[1:], strict=False))]
    return spark.createDataFrame(rows, "bin int, lo double, hi double, center double")


def _halved(c: Column, edges: list[float], low: int, high: int) -> Column:
    """The bin from low to high (exclusive) that c, which lies in one of them, is in: edges are compared by halves."""
    if high - low == 1:
        return F.lit(low)
    middle = (low + high) // 2
    return F.when(c < edges[middle], _halved(c, edges, low, middle)).otherwise(_halved(c, edges, middle, high))


def assign_bin(c: Column, edges: list[float], closed_last: bool = False) -> Column:
    """Number of the half-open bin [lo, hi) that holds c; null outside, for null and for NaN. closed_last: the
    last bin holds its upper edge too."""
    if len(edges) < 2:
        return F.lit(None).cast("int")
    c, n = c.cast("double"), len(edges) - 1
    width = (edges[-1] - edges[0]) / n
    even = width > 0 and all(abs(edges[i] - (edges[0] + i * width)) <= width * 1e-6 for i in range(n + 1))
    at = F.array(*[F.lit(float(e)) for e in edges])
    if even:
        guess = F.greatest(F.lit(0), F.least(F.lit(n - 1), F.floor((c - edges[0]) / width).cast("int")))
        found = F.when(c < F.get(at, guess), guess - 1).when((c >= F.get(at, guess + 1)) & (guess < n - 1), guess + 1).otherwise(guess)
    else:
        found = _halved(c, edges, 0, n)
    inside = (c >= edges[0]) & ((c <= edges[-1]) if closed_last else (c < edges[-1])) & ~F.isnan(c)
    return F.when(inside, found)
