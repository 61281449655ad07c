"""Temperature series: the country, one cell, and both side by side."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from fieldcast.operators.climate import season_rows
from fieldcast.settings import Settings


def _years(tables, settings: Settings) -> tuple[DataFrame, DataFrame]:
    wanted = [F.col("cell_id").cast("long").alias("cell_id"),
              F.col("year").cast("int").alias("year"), "temp"]
    return (
        season_rows(tables.climate_past, [settings.base_year]).select(*wanted),
        season_rows(tables.climate_future, list(settings.horizons)).select(*wanted),
    )


def temperature_series(tables, settings: Settings) -> DataFrame:
    """Mean over cells of their season mean: the base year, then each horizon with data.

    The base year always shows, with NULL where nothing was measured.
    """
    base, ahead = (
        rows.where("temp IS NOT NULL").groupBy("year", "cell_id").agg(F.avg("temp").alias("temp"))
        for rows in _years(tables, settings)
    )
    first = base.agg(F.avg("temp").alias("temperature")).select(
        F.lit(settings.base_year).alias("year"), "temperature"
    )
    rest = ahead.groupBy("year").agg(F.avg("temp").alias("temperature"))
    return first.unionByName(rest).orderBy("year")


def cell_temperature_series(tables, settings: Settings, cell_id: int | None = None) -> DataFrame:
    """Season mean temperature by year, for one cell or for all.

    For one cell the base year always shows, with NULL where nothing was measured.
    """
    base, ahead = _years(tables, settings)
    if cell_id is None:
        return (
            base.unionByName(ahead).groupBy("cell_id", "year")
            .agg(F.avg("temp").alias("temperature"))
        )
    here = F.col("cell_id") == int(cell_id)
    first = base.where(here).agg(F.avg("temp").alias("temperature")).select(
        F.lit(settings.base_year).alias("year"), "temperature"
    )
    rest = ahead.where(here).groupBy("year").agg(F.avg("temp").alias("temperature"))
    return first.unionByName(rest).orderBy("year")


def compare_series(tables, settings: Settings, cell_id: int) -> DataFrame:
    """One cell against the country, over all years that either has."""
    country = temperature_series(tables, settings).withColumnRenamed("temperature", "national")
    local = cell_temperature_series(tables, settings, cell_id).withColumnRenamed(
        "temperature", "cell"
    )
    return country.join(local, "year", "full").orderBy("year")


def compare_all_cells(tables, settings: Settings) -> DataFrame:
    """The comparison for every cell with a reading in any of the years.

    A cell unfolds into the closed list of years, so the outer merge needs no pairing of
    cells with the national rows beyond one look-up by year.
    """
    years = [settings.base_year, *settings.horizons]
    local = cell_temperature_series(tables, settings)
    folded = local.groupBy("cell_id").agg(
        F.map_from_entries(F.collect_list(F.struct("year", "temperature"))).alias("_t")
    )
    grid = folded.withColumn("year", F.explode(F.array(*[F.lit(y) for y in years])))
    country = temperature_series(tables, settings).select(
        "year", F.col("temperature").alias("national"), F.lit(True).alias("_known")
    )
    return (
        grid.join(F.broadcast(country), "year", "left")
        .where(F.col("_known") | F.map_contains_key("_t", F.col("year")))
        .select("cell_id", "year", "national",
                F.try_element_at("_t", F.col("year")).alias("cell"))
    )
