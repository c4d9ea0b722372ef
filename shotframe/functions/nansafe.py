"""Column functions with the NaN, infinity and division rules of array libraries.

Spark ranks NaN above all numbers, treats it as equal to itself and lets it poison means; ANSI mode raises on
a division by zero. Array code skips NaN in nan-reductions, finds it in no comparison, and divides to infinity.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

INF, NAN, HUGE = float("inf"), float("nan"), 1.7976931348623157e308


def strip(c: Column) -> Column:
    """NaN as null, so that aggregates skip it."""
    return F.when(~F.isnan(c), c)


def mean(c: Column, skip_nan: bool = True) -> Column:
    return F.avg(strip(c)) if skip_nan else F.avg(c)


def total(c: Column) -> Column:
    """Sum that skips NaN and is 0 of nothing."""
    return F.coalesce(F.sum(strip(c)), F.lit(0.0))


def largest(c: Column) -> Column:
    return F.max(strip(c))


def above(c: Column, limit: float) -> Column:
    """c > limit, which NaN and null never are."""
    return F.coalesce((c > limit) & ~F.isnan(c), F.lit(False))


def same(a: Column, b: Column) -> Column:
    """a == b, which NaN never is."""
    return (a == b) & ~F.isnan(a)


def divide(a: Column, b: Column) -> Column:
    """a / b with infinities and NaN where b is 0; null stays null."""
    by_zero = F.when(F.isnan(a) | (a == 0), F.lit(NAN)).when(a > 0, F.lit(INF)).when(a < 0, F.lit(-INF))
    return F.when(b == 0, by_zero).otherwise(a / F.when(b != 0, b))


def nan_to_num(c: Column) -> Column:
    """NaN and null to 0, infinities to the largest finite numbers."""
    return F.when(c.isNull() | F.isnan(c), 0.0).when(c == INF, HUGE).when(c == -INF, -HUGE).otherwise(c)


def array_total(a: Column) -> Column:
    """Sum of an array of doubles without NaN and null."""
    return F.aggregate(a, F.lit(0.0), lambda s, x: s + F.when(x.isNull() | F.isnan(x), 0.0).otherwise(x))


def array_mean(a: Column) -> Column:
    """Mean of an array of doubles without NaN and null; NaN of nothing."""
    kept = F.filter(a, lambda x: x.isNotNull() & ~F.isnan(x))
    return F.when(F.size(kept) > 0, F.aggregate(kept, F.lit(0.0), lambda s, x: s + x) / F.size(kept)).otherwise(F.lit(NAN))


def array_largest(a: Column) -> Column:
    return F.array_max(F.filter(a, lambda x: ~F.isnan(x)))


def array_divide(a: Column, n: Column) -> Column:
    return F.transform(a, lambda x: divide(x, n))


def array_subtract(a: Column, b: Column) -> Column:
    return F.zip_with(a, b, lambda x, y: x - y)


def row_totals(image: Column) -> Column:
    """Per column of an array of rows, the sum over rows without NaN: a (phi, q) pattern to its q profile."""
    zero = F.transform(F.get(image, F.lit(0)), lambda _: F.lit(0.0))
    return F.aggregate(image, zero, lambda s, row: F.zip_with(s, row, lambda x, y: x + F.when(y.isNull() | F.isnan(y), 0.0).otherwise(y)))


def gaussian(x: Column, amp: float, center: float, sigma: float, base: float) -> Column:
    return F.lit(amp) * F.exp(-F.pow(x - center, 2) / (2 * sigma * sigma)) + F.lit(base)


def sigma_to_fwhm(sigma: Column) -> Column:
    return sigma * F.sqrt(8 * F.log(F.lit(2.0)))


def photon_energy(measured: Column, wavelength: Column) -> Column:
    """The measured energy in eV, or the one of the wavelength (Angstrom) where that is missing or infinite."""
    usable = measured.isNotNull() & ~F.isnan(measured) & (F.abs(measured) != INF)
    return F.when(usable, measured).otherwise(divide(F.lit(12398.4197386209), wavelength))
