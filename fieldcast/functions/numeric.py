"""Numeric column helpers. All stay inside generated JVM code."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql import types as T


def round_even(value: Column, digits: int = 0) -> Column:
    """Round a double half to even, as the numpy and PostgreSQL double rounding do."""
    if digits == 0:
        return F.rint(value)
    scale = F.lit(float(10 ** digits))
    return F.rint(value * scale) / scale


def safe_ratio(top: Column, bottom: Column) -> Column:
    """``top / bottom``, NULL where the bottom is zero."""
    return top / F.nullif(bottom, F.lit(0.0))


def percent_change(new: Column, old: Column) -> Column:
    return safe_ratio(new - old, old) * F.lit(100.0)


def weighted_mean(value: Column, weight: Column) -> Column:
    """Aggregate: area-weighted mean, NULL where no weight adds up."""
    return safe_ratio(F.sum(value * weight), F.sum(weight))


def clip(value: Column, low: float, high: float) -> Column:
    """Clip to [low, high]; NULL stays NULL (least and greatest alone would skip it)."""
    return F.when(
        value.isNotNull(), F.greatest(F.least(value, F.lit(high)), F.lit(low))
    )


def is_true(flag: Column) -> Column:
    """Three-valued flag to plain boolean: NULL counts as false."""
    return F.coalesce(flag, F.lit(False))


def coerce_double(value: Column) -> Column:
    """Numeric coercion: whatever is no number becomes NULL, NaN included."""
    number = value.try_cast("double")
    return F.when(~F.isnan(number), number)


def nan_to_null(df: DataFrame) -> DataFrame:
    """NaN means NULL in files written from pandas frames; undo that on read."""
    floats = [
        f.name for f in df.schema.fields if isinstance(f.dataType, (T.DoubleType, T.FloatType))
    ]
    return df.withColumns({c: F.when(~F.isnan(c), F.col(c)) for c in floats}) if floats else df
