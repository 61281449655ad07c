"""Calendar helpers."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def days_in_month(year: Column, month: Column) -> Column:
    first = F.make_date(year.cast("int"), month.cast("int"), F.lit(1))
    return F.dayofmonth(F.last_day(first))


def mean_flux_to_kwh(flux: Column, year: Column, month: Column) -> Column:
    """Mean W/m2 over a month to kWh/m2 received in it."""
    return flux * F.lit(24) * days_in_month(year, month) / F.lit(1000.0)
