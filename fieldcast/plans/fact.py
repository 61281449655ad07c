"""The projection fact table: suitability, scores, yields and areas in one plan."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from fieldcast.functions import (
    composite_score, is_true, round_even, soil_score, strip_space, tolerance_score, yield_score,
)
from fieldcast.functions.numeric import percent_change
from fieldcast.operators.areas import future_area, median_area_by_crop, median_area_by_dept
from fieldcast.operators.joins import spread_join, unique_by
from fieldcast.operators.staging import stage
from fieldcast.operators.together import run_together
from fieldcast.plans.shared import SharedInputs, grown_cells, shared_inputs
from fieldcast.plans.suitability import cell_dimensions, suitability
from fieldcast.plans.yields import FEATURES, MEASURES, YieldHistory, yield_history
from fieldcast.schemas import FACT, require_columns
from fieldcast.settings import Settings

PARTS = ("yield", "temp", "rain", "sun")


def median_areas(
    tables, settings: Settings, shared: SharedInputs | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Median grown area by department and by crop, over cells the fact table shows."""
    grown = stage(
        (shared.grown if shared else grown_cells(tables, settings)).join(
            cell_dimensions(tables, checked=shared is not None).select("cell_id", "dept_code", "dept_name"), "cell_id"
        ),
        "grown-cells",
    )
    return tuple(run_together(
        grown.sparkSession,
        lambda: stage(median_area_by_dept(grown), "dept-medians"),
        lambda: stage(median_area_by_crop(grown), "crop-medians"),
    ))


def with_references(rows: DataFrame, defaults: DataFrame) -> DataFrame:
    """Reference yield and season of a cell, with the crop's medians where it has none."""
    joined = rows.join(F.broadcast(defaults), "crop_id", "left")
    return joined.withColumns({
        f"ref_{c}": F.coalesce(F.col(f"reference.ref_{c}"), F.col(f"default_{c}"))
        for c in MEASURES
    })


def with_features(rows: DataFrame) -> DataFrame:
    """Future season as model input: missing where the season is not complete."""
    complete = is_true(F.col("climate_complete"))
    return rows.withColumn("climate_complete", complete).withColumns({
        f"x_{name}": F.when(complete, F.col(f"fut_{name}"))
        for name in ("temp_avg", "temp_peak", "rain", "sun_mean", "sun")
    })


def prediction_mask() -> Column:
    """Rows a yield is predicted for: complete climate, all inputs, a known soil."""
    mask = F.col("climate_complete") & F.col("soil_family").isNotNull()
    for name in FEATURES:
        mask = mask & F.col(f"x_{name}").isNotNull()
    return mask


def scores_at(when: str, amount: Column, temp: Column, rain: Column, sun: Column) -> dict:
    """The four changing part scores for the base or the future."""
    col = F.col
    return {
        f"yield_score_{when}": yield_score(amount, col("yield_p90")),
        f"temp_score_{when}": tolerance_score(
            temp,
            F.coalesce("temp_season_min", "temp_opt_min"),
            F.coalesce("temp_season_max", "temp_opt_max"),
            col("temp_abs_min"), col("temp_abs_max"),
        ),
        f"rain_score_{when}": tolerance_score(
            rain, col("rain_season_min"), col("rain_season_max"), F.lit(0.0)
        ),
        f"sun_score_{when}": tolerance_score(sun, col("sun_season_min"), col("sun_season_max")),
    }


def scored(rows: DataFrame) -> DataFrame:
    """Part scores, fit scores and their change. Needs ``fut_yield`` and references."""
    preferred = [F.col(f"soil_pref_{i}") for i in (1, 2, 3)]
    rows = rows.withColumns({
        "soil_score": soil_score(F.col("soil_family"), preferred),
        **scores_at("base", F.col("ref_yield_q_ha"), F.col("ref_temp_avg"), F.col("ref_rain"),
                    F.col("ref_sun")),
        **scores_at("fut", F.col("fut_yield"), F.col("x_temp_avg"), F.col("x_rain"),
                    F.col("x_sun")),
    })
    rows = rows.withColumns({
        f"fit_score_{when}": composite_score(
            {**{p: F.col(f"{p}_score_{when}") for p in PARTS}, "soil": F.col("soil_score")}
        )
        for when in ("base", "fut")
    })
    # Without a complete future season no future score counts.
    rows = rows.withColumns({
        c: F.when(F.col("climate_complete"), F.col(c)).otherwise(0.0)
        for c in [*[f"{p}_score_fut" for p in PARTS], "fit_score_fut"]
    })
    return rows.withColumns({
        "score_delta": round_even(F.col("fit_score_fut") - F.col("fit_score_base"), 1),
        "yield_delta_pct": round_even(
            percent_change(F.col("fut_yield"), F.col("ref_yield_q_ha")), 1
        ),
    })


def with_areas(
    rows: DataFrame, dept_medians: DataFrame, crop_medians: DataFrame, factor: float
) -> DataFrame:
    """Base, future and new area. A department may hold very many cells, so the look-up of
    its median is spread over the cells; the medians by crop are at most one row a crop."""
    rows = rows.withColumns({
        c: strip_space(F.col(c)) for c in ("dept_code", "dept_name")
    })
    by_dept = ["crop_id", "dept_code", "dept_name"]
    medians = unique_by(dept_medians.drop("n_cells"), by_dept, "medians by department")
    rows = spread_join(rows, medians, by_dept, ["cell_id"]).join(F.broadcast(crop_medians), "crop_id", "left")
    rows = rows.withColumn(
        "median_grown_area", F.coalesce("dept_median", "crop_median", F.lit(0.0))
    )
    rows = rows.withColumns({
        "base_area": F.when(F.col("is_grown"), F.col("grown_area")).otherwise(0.0),
        "fut_area": future_area(
            F.col("status"), F.col("grown_area"), F.col("median_grown_area"), factor
        ),
    })
    return rows.withColumn(
        "new_area", F.when(F.col("status") == "new", F.col("fut_area")).otherwise(0.0)
    )


def stamped(rows: DataFrame, settings: Settings) -> DataFrame:
    """Run constants, final column names and types."""
    rows = rows.withColumns({
        "base_yield": F.col("ref_yield_q_ha"),
        "model_version": F.lit(settings.model_version),
        "new_area_factor": F.lit(settings.new_area_factor),
        "computed_at": F.current_timestamp(),
    })
    require_columns(rows, FACT.fieldNames(), "fact rows")
    return rows.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in FACT.fields])


def projection_fact(
    tables, settings: Settings, history: YieldHistory | None = None, predict=None, medians=None,
    shared: SharedInputs | None = None,
) -> DataFrame:
    """Fact rows of all crops and horizons of the run.

    ``predict`` maps rows with the columns ``x_*``, ``soil_family`` and ``crop_id`` to rows
    with a ``predicted`` yield (see :mod:`fieldcast.plans.model`). Without one, the
    reference yield of the cell stands for the prediction. ``history``, ``medians`` and the
    ``shared`` inputs are built here unless given. Climate, plots and yields are read once each.
    A repeated row of coordinates, soils, references or medians fails the build.
    """
    shared = shared or shared_inputs(tables, settings)
    history, (dept_medians, crop_medians) = run_together(
        tables.soils.sparkSession,
        lambda: history or yield_history(tables, settings, shared.past(settings.history_years)),
        lambda: medians or median_areas(tables, settings, shared),
    )
    rows = suitability(tables, settings, extra=history.cells, shared=shared)
    rows = with_features(with_references(rows, history.defaults))
    rows = (
        predict(rows) if predict else rows.withColumn("predicted", F.col("ref_yield_q_ha"))
    )
    rows = rows.withColumn(
        "fut_yield",
        F.greatest(
            F.coalesce(F.when(prediction_mask(), F.col("predicted")), F.lit(0.0)), F.lit(0.0)
        ),
    )
    return stamped(
        with_areas(scored(rows), dept_medians, crop_medians, settings.new_area_factor), settings
    )
