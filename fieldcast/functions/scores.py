"""Suitability scores, all on a scale of 0 to 100."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from fieldcast.functions.numeric import clip, round_even
from fieldcast.functions.text import strip_space
from fieldcast.settings import SCORE_WEIGHTS

TINY = 0.0001  # smallest width of a range and smallest reference yield


def _ramp(distance: Column, width: Column) -> Column:
    """Share of ``width`` covered by ``distance`` in percent; nothing over a width <= 0."""
    share = F.lit(100.0) * distance / F.when(width > 0, width)
    return F.greatest(F.least(F.coalesce(share, F.lit(0.0)), F.lit(100.0)), F.lit(0.0))


def tolerance_score(
    value: Column, low: Column, high: Column,
    abs_low: Column | None = None, abs_high: Column | None = None,
) -> Column:
    """100 inside [low, high], falling in a straight line to 0 at the absolute limits.

    A missing limit lies one range width outside the range (the lower one not below 0).
    A missing value or range scores 0.
    """
    value, low, high = (c.cast("double") for c in (value, low, high))
    width = F.greatest(high - low, F.lit(TINY))
    floor = F.greatest(F.lit(0.0), low - width)
    ceiling = high + width
    if abs_low is not None:
        floor = F.coalesce(abs_low.cast("double"), floor)
    if abs_high is not None:
        ceiling = F.coalesce(abs_high.cast("double"), ceiling)
    return (
        F.when(value.isNull() | low.isNull() | high.isNull(), 0.0)
        .when(value.between(low, high), 100.0)
        .when(value < low, _ramp(value - floor, low - floor))
        .otherwise(_ramp(ceiling - value, ceiling - high))
    )


def soil_score(family: Column, preferred: list[Column]) -> Column:
    """100 for a preferred soil family, 0 for any other and for none."""
    name = F.lower(strip_space(family))
    hit = F.lit(False)
    for soil in preferred:
        hit = hit | F.coalesce(name == F.lower(strip_space(soil)), F.lit(False))
    return F.when(hit, 100.0).otherwise(0.0)


def yield_score(amount: Column, high_yield: Column) -> Column:
    return clip(amount / F.greatest(high_yield, F.lit(TINY)) * F.lit(100.0), 0.0, 100.0)


def composite_score(parts: dict[str, Column]) -> Column:
    """Weighted sum of the five part scores, one decimal."""
    total = None
    for name, weight in SCORE_WEIGHTS.items():
        term = parts[name] * F.lit(weight)
        total = term if total is None else total + term
    return round_even(clip(total, 0.0, 100.0), 1)
