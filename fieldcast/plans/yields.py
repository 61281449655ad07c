"""Historical yields: training rows, trimming, reference figures per cell and crop."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

from fieldcast.functions import coerce_double, soil_score
from fieldcast.operators.climate import complete_seasons, seasonal_climate
from fieldcast.operators.footprint import per_cell_map
from fieldcast.operators.joins import closed_domain
from fieldcast.operators.quantiles import exact_quantiles, quantile_table
from fieldcast.operators.staging import stage
from fieldcast.schemas import require_columns
from fieldcast.settings import UNKNOWN_SOIL, Settings

FEATURES = ["temp_avg", "temp_peak", "rain", "sun_mean"]
MEASURES = ["yield_q_ha", "temp_avg", "temp_peak", "rain", "sun_mean", "sun"]
TRAINING_COLUMNS = ["cell_id", "crop_id", "year", "soil_family", *MEASURES]
TRIM = (0.01, 0.99)
HIGH_YIELD = 0.90


def _soil_families(tables) -> DataFrame:
    return tables.soils.groupBy(F.col("cell_id").cast("long").alias("cell_id")).agg(
        F.min("soil_family").alias("soil_family")
    )


def yield_training_set(tables, settings: Settings, seasons: DataFrame | None = None) -> DataFrame:
    """Yields above zero on a grown area, with the complete season of their year.

    The yields are joined as they are to one row per cell and year; a cell with very many
    yields is split by adaptive execution. ``seasons`` of the history years are computed here
    unless given.
    """
    if seasons is None:
        seasons = seasonal_climate(tables.climate_past, settings.history_years, by_cell=False)
    seasons = complete_seasons(seasons)
    grown = tables.yields.where(
        F.col("crop_id").isin(*settings.crops)
        & (F.col("yield_q_ha") > 0)
        & (F.coalesce("area_ha", F.lit(0.0)) > 0)
        & F.col("year").between(*settings.history_years)
    ).select(
        F.col("cell_id").cast("long").alias("cell_id"),
        F.col("crop_id").cast("int").alias("crop_id"),
        F.col("year").cast("int").alias("year"),
        "yield_q_ha", "area_ha",
    )
    return (
        grown.join(seasons, ["cell_id", "year"])
        .join(_soil_families(tables), "cell_id", "left")
        .withColumn("soil_family", F.coalesce("soil_family", F.lit(UNKNOWN_SOIL)))
        .select("cell_id", "crop_id", "year", "yield_q_ha", "area_ha",
                "temp_avg", "temp_peak", "rain", "sun_mean", "sun", "soil_family")
    )


def horizon_features(tables, settings: Settings) -> DataFrame:
    """Model inputs of each cell and horizon: complete seasons of located cells."""
    seasons = complete_seasons(seasonal_climate(tables.climate_future, list(settings.horizons)))
    return (
        seasons.join(tables.coordinates, "cell_id")
        .join(_soil_families(tables), "cell_id", "left")
        .select(
            "cell_id", "year", "lat", "lon", "temp_avg", "temp_peak", "rain", "sun_mean", "sun",
            F.coalesce("soil_family", F.lit(UNKNOWN_SOIL)).alias("soil_family"),
        )
    )


def with_soil_score(training: DataFrame, constraints: DataFrame, settings: Settings) -> DataFrame:
    """Match of a row's soil with the preferred soils of its crop, as a further model input."""
    preferred = [f"soil_pref_{i}" for i in (1, 2, 3)]
    soils = closed_domain(
        constraints.select(F.col("crop_id").cast("int").alias("crop_id"), *preferred),
        "crop_id", settings.crops,
    )
    return training.join(F.broadcast(soils), "crop_id", "left").withColumn(
        "soil_score", soil_score(F.col("soil_family"), [F.col(c) for c in preferred])
    ).drop(*preferred)


def valid_rows(training: DataFrame) -> DataFrame:
    """Rows with a usable target."""
    require_columns(training, TRAINING_COLUMNS, "training set")
    return training.withColumn("yield_q_ha", coerce_double(F.col("yield_q_ha"))).where(
        F.col("yield_q_ha").isNotNull()
    )


def yield_bounds(training: DataFrame) -> DataFrame:
    """Trimming bounds of each crop."""
    return quantile_table(
        training, ["crop_id"],
        {"low_yield": ("yield_q_ha", TRIM[0]), "high_yield": ("yield_q_ha", TRIM[1])},
        small_domain=True,
    )


def trimmed_yields(training: DataFrame, bounds: DataFrame) -> DataFrame:
    """Rows inside the trimming bounds of their crop, both ends included."""
    return (
        training.join(F.broadcast(bounds), "crop_id")
        .where(F.col("yield_q_ha").between(F.col("low_yield"), F.col("high_yield")))
        .drop("low_yield", "high_yield")
    )


def reference_by_cell(trimmed: DataFrame) -> DataFrame:
    """Mean yield and season of each cell and crop."""
    return trimmed.groupBy("crop_id", "cell_id").agg(
        *[F.avg(c).alias(f"ref_{c}") for c in MEASURES]
    )


def reference_defaults(trimmed: DataFrame) -> DataFrame:
    """Medians per crop, used where a cell has no history, and the high reference yield."""
    wanted = {f"default_{c}": (c, 0.5) for c in MEASURES}
    wanted["yield_p90"] = ("yield_q_ha", HIGH_YIELD)
    return quantile_table(trimmed, ["crop_id"], wanted, small_domain=True)


def yield_quantiles(training: DataFrame, probs) -> DataFrame:
    return exact_quantiles(training, ["crop_id"], "yield_q_ha", list(probs), small_domain=True)


@dataclass(frozen=True)
class YieldHistory:
    """What the fact build needs of the past, as staged tables.

    ``training`` holds all usable rows, ``trimmed`` those inside the bounds of their crop,
    ``cells`` one map of reference figures per cell, ``defaults`` one row per crop.
    """

    training: DataFrame
    trimmed: DataFrame
    cells: DataFrame
    defaults: DataFrame


def yield_history(tables, settings: Settings, seasons: DataFrame | None = None) -> YieldHistory:
    """Read the climate history once; everything after works on staged rows.

    Both tables keyed by crop come from crops of the run, a closed list, so they may be
    broadcast.
    """
    training = stage(valid_rows(yield_training_set(tables, settings, seasons)), "training")
    bounds = stage(yield_bounds(training), "yield-bounds")
    trimmed = trimmed_yields(training, bounds)
    cells = per_cell_map(
        reference_by_cell(trimmed), "crop_id", [f"ref_{c}" for c in MEASURES], "reference"
    )
    return YieldHistory(training, trimmed, cells, stage(reference_defaults(trimmed), "crop-defaults"))
