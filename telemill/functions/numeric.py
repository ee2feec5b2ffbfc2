"""Rounding and averaging that give the same bits at any partitioning."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F

# Sums of readings are kept as whole numbers of 2^-60: the doubles themselves are
# added, not their decimal notation, and the sum is the same in whatever order rows
# arrive. Readings beyond 2^42 count in units of 1; the total may reach 8e19.
EXACT = "decimal(38, 0)"
_HALF, _LOW = float(2**20), float(2**40)
_LARGE = float(2**42)


def _col(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x


def rnd(x: Column | str, digits: int = 0) -> Column:
    """Round half away from zero."""
    if digits == 0:
        return F.round(_col(x))
    scale = F.lit(float(10**digits))
    return F.round(_col(x) * scale) / scale


def rnd_even(x: Column | str, digits: int = 0) -> Column:
    """Round half to even, as data frames in Python do."""
    if digits == 0:
        return F.bround(_col(x))
    scale = F.lit(float(10**digits))
    return F.bround(_col(x) * scale) / scale


def known(x: Column | str) -> Column:
    """The value, or null where it is NaN or infinite: one rule for missing numbers."""
    return F.when(F.abs(_col(x).cast("double")) < F.lit(float("inf")), _col(x))


def known_numbers(df: DataFrame, columns: list[str]) -> DataFrame:
    """``known`` on those of the columns that are floating point."""
    kinds = dict(df.dtypes)
    floating = [c for c in columns if kinds.get(c) in ("double", "float")]
    return df.withColumns({c: known(c) for c in floating}) if floating else df


def units(x: Column) -> Column:
    """A double in units of 2^-60: two whole parts, neither of which rounds."""
    scaled = x * F.lit(_HALF)
    high = F.floor(scaled)
    low = F.floor((scaled - high.cast("double")) * F.lit(_LOW))
    fine = high.cast("decimal(20, 0)") * F.lit(2**40).cast("decimal(13, 0)") + low.cast("decimal(13, 0)")
    coarse = x.cast("decimal(20, 0)").cast(EXACT) * F.lit(2**60).cast("decimal(19, 0)")
    return F.when(F.abs(x) < F.lit(_LARGE), fine.cast(EXACT)).otherwise(coarse.cast(EXACT))


def exact_total(values: np.ndarray) -> int:
    """Sum of finite doubles in units of 2^-60, each cut there as in ``units`` and added without rounding."""
    near = np.abs(values) < _LARGE
    scaled = values[near] * _HALF
    high = np.floor(scaled)
    low = np.floor((scaled - high) * _LOW).astype(np.int64)
    high = high.astype(np.int64)
    whole = (int((high >> 32).sum()) << 32) + int((high & 0xFFFFFFFF).sum())
    return (whole << 40) + (int((low >> 32).sum()) << 32) + int((low & 0xFFFFFFFF).sum()) + sum(
        round(v) << 60 for v in values[~near].tolist())


def exact_sum(x: Column | str) -> Column:
    """Exact partial sum in units of 2^-60, to be combined with ``mean_of``; NaN counts as missing."""
    return F.sum(units(known(x).cast("double")))


def mean_of(total: Column | str, n: Column | str) -> Column:
    """Mean from an exact sum and a non-null count, rounded like a DOUBLE sum without error; null on an empty group."""
    return _col(total).cast("double") * F.lit(2.0**-60) / F.nullif(_col(n), F.lit(0)).cast("double")


def mean(x: Column | str) -> Column:
    return mean_of(exact_sum(x), F.count(known(x)))


def pct(part: Column | str, whole: Column | str) -> Column:
    """100 * part / whole in DOUBLE; null when whole is 0."""
    return _col(part).cast("double") * F.lit(100.0) / F.nullif(_col(whole), F.lit(0)).cast("double")


def count_true(condition: Column | str) -> Column:
    """Number of true rows as BIGINT, 0 on none."""
    return F.count_if(_col(condition))


def non_null_count(x: Column | str) -> Column:
    return F.count(_col(x))
