"""Suitability of every grid cell for every crop and horizon."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from fieldcast.functions import is_true
from fieldcast.operators.climate import seasonal_climate
from fieldcast.operators.dedupe import keep_first
from fieldcast.operators.footprint import per_cell_map
from fieldcast.operators.joins import checked_join, closed_domain
from fieldcast.plans.shared import SharedInputs, grown_cells
from fieldcast.settings import SEASON_MONTHS, Settings

DIMENSIONS = ["dept_code", "dept_name", "region_code", "region_name", "lat", "lon",
              "soil_family", "soil_texture"]

# Fixed values.
REASONS = {
    "climate": "incomplete climate",
    "temp": "temperature",
    "rain": "rain",
    "sun": "sun",
    "soil": "soil",
}


def cell_dimensions(tables, checked: bool = False) -> DataFrame:
    """One row per cell that has both coordinates and a soil; others drop out.

    Of several rows for a cell the smallest counts, or, where ``checked``, the plan fails.
    """
    place = tables.coordinates.select(F.col("cell_id").cast("long").alias("cell_id"), "lat", "lon")
    soil = tables.soils.withColumn("cell_id", F.col("cell_id").cast("long"))
    if checked:
        return checked_join(place, soil, ["cell_id"], "inner", "one_to_one").select("cell_id", *DIMENSIONS)
    place = keep_first(place, ["cell_id"], ["lat", "lon"])
    soil = keep_first(soil, ["cell_id"], ["soil_family", "soil_texture", "dept_code", "dept_name"])
    return place.join(soil, "cell_id").select("cell_id", *DIMENSIONS)


def cells_without_soil(tables) -> DataFrame:
    """Cells the fact table cannot show because no soil row names them."""
    return tables.coordinates.select("cell_id").join(
        tables.soils.select("cell_id"), "cell_id", "left_anti"
    )


def crop_constraints(constraints: DataFrame, settings: Settings) -> DataFrame:
    """One row of bounds per crop of the run, sun bounds in the unit of the climate."""
    typed = constraints.withColumn("crop_id", F.col("crop_id").cast("int"))
    return closed_domain(typed, "crop_id", settings.crops).withColumns({
        c: F.col(c) / F.lit(settings.sun_divisor) for c in ("sun_season_min", "sun_season_max")
    })


def cell_crop_horizons(
    tables, settings: Settings, extra: DataFrame | None = None, shared: SharedInputs | None = None,
) -> DataFrame:
    """Cells with everything known about them, spread over crops and horizons.

    Seasons and footprints are folded into one row per cell first, so that all joins are
    joins of one row per cell on the same partitioning. Only then does a cell unfold into
    its crops and horizons, which needs no shuffle. ``extra`` is a further per-cell table
    with a map column ``reference`` by crop. With ``shared`` inputs, as in the fact build, neither
    climate nor plots are read, and a cell that repeats in a dimension or in ``extra`` fails the plan.
    """
    measures = ["temp_avg", "temp_peak", "rain", "sun", "sun_mean", "n_months"]
    base = (
        shared.past([settings.base_year]) if shared
        else seasonal_climate(tables.climate_past, [settings.base_year], dealt=tables.by_cell)
    ).select(
        "cell_id",
        F.col("temp_avg").alias("base_temp_avg"), F.col("temp_peak").alias("base_temp_peak"),
        F.col("rain").alias("base_rain"), F.col("sun").alias("base_sun"),
    )
    ahead = per_cell_map(
        shared.future(settings.horizons) if shared
        else seasonal_climate(tables.climate_future, list(settings.horizons), dealt=tables.by_cell),
        "year", measures, "ahead",
    )
    grown = per_cell_map(
        shared.grown if shared else grown_cells(tables, settings), "crop_id", ["area", "plot_count"], "grown")
    cells = (
        cell_dimensions(tables, checked=shared is not None)
        .join(ahead, "cell_id", "left")
        .join(grown, "cell_id", "left")
        .join(base, "cell_id", "left")
    )
    kept = ["cell_id", *DIMENSIONS, "base_temp_avg", "base_temp_peak", "base_rain", "base_sun"]
    if extra is not None:
        cells = (
            checked_join(cells, extra, ["cell_id"]) if shared else cells.join(extra, "cell_id", "left"))
        reference = [F.try_element_at("reference", F.col("crop_id")).alias("reference")]
    else:
        reference = []
    spread = cells.withColumn(
        "crop_id", F.explode(F.array(*[F.lit(c) for c in settings.crops]))
    ).withColumn("horizon_year", F.explode(F.array(*[F.lit(h) for h in settings.horizons])))
    found = spread.select(
        *kept, "crop_id", "horizon_year", *reference,
        F.try_element_at("grown", F.col("crop_id")).alias("_grown"),
        F.try_element_at("ahead", F.col("horizon_year")).alias("_ahead"),
    )
    return found.select(
        *kept, "crop_id", "horizon_year", *(["reference"] if reference else []),
        F.col("_grown").isNotNull().alias("is_grown"),
        F.coalesce("_grown.area", F.lit(0.0)).alias("grown_area"),
        F.coalesce("_grown.plot_count", F.lit(0).cast("long")).alias("plot_count"),
        *[
            F.col(f"_ahead.{m}").alias("n_months" if m == "n_months" else f"fut_{m}")
            for m in measures
        ],
    )


def suitability_flags(rows: DataFrame) -> DataFrame:
    """The four criteria and the completeness mark, all three-valued."""
    complete = F.col("n_months") == len(SEASON_MONTHS)
    family = F.lower(F.trim("soil_family"))
    preferred = [F.lower(F.trim(f"soil_pref_{i}")) for i in (1, 2, 3)]
    return rows.withColumns({
        "temp_ok": complete
        & F.col("fut_temp_avg").between(F.col("temp_opt_min"), F.col("temp_opt_max"))
        & (F.col("fut_temp_peak") <= F.col("temp_opt_max")),
        "rain_ok": complete
        & F.col("fut_rain").between(F.col("rain_season_min"), F.col("rain_season_max")),
        "sun_ok": complete
        & F.col("fut_sun").between(F.col("sun_season_min"), F.col("sun_season_max")),
        "soil_ok": family.isin(*preferred),
        "climate_complete": complete,
    })


def fail_reasons() -> Column:
    """Failed criteria in fixed order; an incomplete climate hides the climatic ones."""
    complete = is_true(F.col("climate_complete"))
    return F.concat_ws(
        " + ",
        F.when(~complete, REASONS["climate"]),
        *[
            F.when(complete & ~is_true(F.col(f"{name}_ok")), REASONS[name])
            for name in ("temp", "rain", "sun")
        ],
        F.when(~is_true(F.col("soil_ok")), REASONS["soil"]),
    )


def cell_status() -> Column:
    grown, suitable = F.col("is_grown"), F.col("suitable")
    return (
        F.when(grown & suitable, "kept")
        .when(grown & ~suitable, "lost")
        .when(~grown & suitable, "new")
        .otherwise("hidden")
    )


def judged(rows: DataFrame) -> DataFrame:
    """Add suitability, reasons and status to rows with flags."""
    suitable = (
        is_true(F.col("temp_ok")) & is_true(F.col("rain_ok"))
        & is_true(F.col("sun_ok")) & is_true(F.col("soil_ok"))
    )
    return (
        rows.withColumn("suitable", suitable)
        .withColumn("fail_reasons", fail_reasons())
        .withColumn("status", cell_status())
    )


def suitability(
    tables, settings: Settings, keep_hidden: bool = False, extra: DataFrame | None = None,
    shared: SharedInputs | None = None,
) -> DataFrame:
    """Flags, reasons and status per cell, crop and horizon.

    Constraint columns stay in the result for the scoring. Cells neither grown nor suitable
    are left out unless ``keep_hidden``.
    """
    rows = cell_crop_horizons(tables, settings, extra, shared)
    bounds = crop_constraints(tables.constraints, settings)
    result = judged(suitability_flags(rows.join(F.broadcast(bounds), "crop_id")))
    return result if keep_hidden else result.where("is_grown OR suitable")


def status_summary(rows: DataFrame, area: str = "grown_area") -> DataFrame:
    """Number of cells by status and grown area per crop and horizon."""
    return rows.groupBy("crop_id", "horizon_year").agg(
        F.count("*").alias("n_cells"),
        *[F.count_if(F.col("status") == s).alias(f"n_{s}") for s in ("kept", "lost", "new")],
        F.sum(area).alias("grown_area"),
    )
