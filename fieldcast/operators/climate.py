"""Monthly and seasonal climate of grid cells."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from fieldcast.functions import mean_flux_to_kwh, round_even
from fieldcast.settings import SEASON_MONTHS


def season_rows(climate: DataFrame, years=None) -> DataFrame:
    """Growing-season rows of some years: a ``(first, last)`` tuple or a list.

    Both filters reach the Parquet scan, as partition filters where the table is
    partitioned by year.
    """
    rows = climate.where(F.col("month").between(SEASON_MONTHS[0], SEASON_MONTHS[-1]))
    if years is None:
        return rows
    if isinstance(years, tuple):
        return rows.where(F.col("year").between(*years))
    return rows.where(F.col("year").isin(*[int(y) for y in years]))


def monthly_climate(climate: DataFrame, years=None, tags=()) -> DataFrame:
    """Mean temperature, rain and sun per cell and month of the season. Columns ``tags`` keep
    several climates in one table apart."""
    return (
        season_rows(climate, years)
        .groupBy(
            *tags,
            F.col("cell_id").cast("long").alias("cell_id"),
            F.col("year").cast("int").alias("year"),
            F.col("month").cast("int").alias("month"),
        )
        .agg(
            F.avg("temp").alias("temp"), F.avg("rain").alias("rain"), F.avg("sun").alias("sun")
        )
        .withColumn("sun_kwh", mean_flux_to_kwh(F.col("sun"), F.col("year"), F.col("month")))
    )


def seasonal_climate(
    climate: DataFrame, years=None, by_cell: bool = True, tags=(), dealt: bool = False,
) -> DataFrame:
    """Season figures per cell and year.

    With ``by_cell`` the months are spread by cell alone, so that this grouping and any
    later join or grouping by cell need no further shuffle; without, the result suits a
    join by cell and year. Where the climate is ``dealt`` out by cell already (a bucketed table),
    nothing moves at all. By then a cell has at most five rows a year, whatever its share
    of the raw table.

    Figures are kept to nine decimals: a mean that is exactly on a bound stays there,
    whatever the order of summation, and a repeated run gives the same flags.
    """
    figures = {
        "temp_avg": F.avg("temp"),
        "temp_peak": F.max("temp"),
        "rain": F.sum("rain"),
        "sun_mean": F.avg("sun"),
        "sun": F.sum("sun_kwh"),
    }
    months = monthly_climate(climate, years, tags)
    return (
        (months.repartition("cell_id") if by_cell and not dealt else months)
        .groupBy(*tags, "cell_id", "year")
        .agg(
            *[round_even(figure, 9).alias(name) for name, figure in figures.items()],
            F.count("*").cast("int").alias("n_months"),
        )
    )


def tagged_seasons(
    past: DataFrame, future: DataFrame, past_years, horizons, dealt: bool = False,
) -> DataFrame:
    """Seasons of past and future years from one pass: as ``seasonal_climate``, with a column
    ``ahead`` that is true for the rows of ``future``."""
    columns = ["cell_id", "year", "month", "temp", "rain", "sun"]
    both = season_rows(past, past_years).select(F.lit(False).alias("ahead"), *columns).unionByName(
        season_rows(future, horizons).select(F.lit(True).alias("ahead"), *columns))
    return seasonal_climate(both, tags=("ahead",), dealt=dealt)


def complete_seasons(seasons: DataFrame) -> DataFrame:
    return seasons.where(F.col("n_months") == len(SEASON_MONTHS))


def bias_correct(climate: DataFrame, offset: float = 0.0, column: str = "temp") -> DataFrame:
    """Shift a climate column by a constant; no change by default."""
    return climate.withColumn(column, F.col(column) + F.lit(float(offset))) if offset else climate
