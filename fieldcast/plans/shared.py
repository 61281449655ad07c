"""Inputs that several parts of a run need, computed once."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

from fieldcast.operators.climate import tagged_seasons
from fieldcast.operators.footprint import plot_footprint
from fieldcast.operators.staging import stage
from fieldcast.operators.together import run_together
from fieldcast.settings import Settings


@dataclass(frozen=True)
class SharedInputs:
    """``seasons`` by cell, year and ``ahead``; ``grown`` by crop and cell: both staged tables."""

    seasons: DataFrame
    grown: DataFrame

    def past(self, years) -> DataFrame:
        """Past seasons of a (first, last) range or a list of years."""
        year = F.col("year")
        inside = year.between(*years) if isinstance(years, tuple) else year.isin(*years)
        return self.seasons.where(~F.col("ahead") & inside).drop("ahead")

    def future(self, horizons) -> DataFrame:
        return self.seasons.where(F.col("ahead") & F.col("year").isin(*horizons)).drop("ahead")


def grown_cells(tables, settings: Settings) -> DataFrame:
    return plot_footprint(tables.plots).where(F.col("crop_id").isin(*settings.crops))


def shared_inputs(tables, settings: Settings) -> SharedInputs:
    """One pass over both climates gives the base season, the history and all horizons; one over
    the plots gives the footprint. Neither table is read again by the run."""
    first, last = settings.history_years
    years = settings.history_years
    if not first <= settings.base_year <= last:
        years = [*range(first, last + 1), settings.base_year]
    return SharedInputs(*run_together(
        tables.plots.sparkSession,
        lambda: stage(tagged_seasons(
            tables.climate_past, tables.climate_future, years, list(settings.horizons), tables.by_cell),
            "seasons"),
        lambda: stage(grown_cells(tables, settings), "footprint"),
    ))
