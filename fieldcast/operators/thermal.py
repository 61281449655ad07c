"""Heat exposure of grown cells, month by month."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from fieldcast.functions import lookup
from fieldcast.operators.climate import season_rows
from fieldcast.operators.dedupe import keep_largest
from fieldcast.operators.footprint import plot_footprint
from fieldcast.operators.joins import closed_domain
from fieldcast.settings import DEFAULT_HEAT_THRESHOLD, HEAT_MARGIN, Settings

# Fixed values.
SEVERITY = {"missing": 0, "viable": 1, "critical": 2, "fatal": 3}
MONTH_NAMES = {4: "April", 5: "May", 6: "June", 7: "July", 8: "August"}
MAX_DELTA = 20.0
DELTA_STEP = 0.5


def thermal_months(tables, settings: Settings, horizons=None) -> DataFrame:
    """Grown cells with their base and future temperature, one row per horizon and month.

    Base and all future years share one grouping by (cell, month); a month shows for each
    horizon that has it, with the base temperature where there is one.
    """
    years = list(settings.horizons if horizons is None else horizons)
    base = season_rows(tables.climate_past, [settings.base_year])
    future = season_rows(tables.climate_future, years)
    tagged = base.select("cell_id", "month", "temp", F.lit(None).cast("int").alias("ahead")).unionByName(
        future.select("cell_id", "month", "temp", F.col("year").cast("int").alias("ahead"))
    )
    months = (
        tagged.groupBy(
            F.col("cell_id").cast("long").alias("cell_id"),
            F.col("month").cast("int").alias("month"),
        )
        .agg(
            F.avg(F.when(F.col("ahead").isNull(), F.col("temp"))).alias("base_temp"),
            F.array(*[
                F.struct(
                    F.lit(y).alias("horizon_year"),
                    F.avg(F.when(F.col("ahead") == y, F.col("temp"))).alias("fut_temp"),
                    F.count_if(F.col("ahead") == y).alias("n"),
                )
                for y in years
            ]).alias("_years"),
        )
        .select("cell_id", "month", "base_temp", F.inline("_years"))
        .where("n > 0")
        .drop("n")
    )
    grown = plot_footprint(tables.plots, positive_only=False).where(
        F.col("crop_id").isin(*settings.crops)
    )
    return (
        grown.join(tables.coordinates, "cell_id")
        .join(months, "cell_id")
        .select(
            "crop_id", "cell_id", "horizon_year", "lat", "lon", "month",
            "base_temp", "fut_temp", "plot_count", "area",
        )
    )


def thermal_class(temp: Column, threshold: Column, margin: float = HEAT_MARGIN) -> Column:
    return (
        F.when(temp.isNull(), "missing")
        .when(temp <= threshold, "viable")
        .when(temp <= threshold + F.lit(margin), "critical")
        .otherwise("fatal")
    )


def check_delta(delta: float) -> float:
    delta = float(delta)
    if not 0.0 <= delta <= MAX_DELTA or (delta / DELTA_STEP) != int(delta / DELTA_STEP):
        raise ValueError(f"delta must lie in 0..{MAX_DELTA:g} in steps of {DELTA_STEP:g}")
    return delta


def thermal_exposure(
    months: DataFrame, constraints: DataFrame, settings: Settings,
    deltas=(0.0,), scenarios=("observed", "projected", "warming"),
) -> DataFrame:
    """Classed temperature per crop, cell, month and scenario.

    ``observed`` is the base year, ``projected`` the horizon, ``warming`` the horizon plus
    each of ``deltas``. The horizon is a key of all of them.
    """
    options = []
    for scenario in scenarios:
        if scenario == "observed":
            options.append((scenario, 0.0, F.col("base_temp")))
        elif scenario == "projected":
            options.append((scenario, 0.0, F.col("fut_temp")))
        elif scenario == "warming":
            options += [
                (scenario, check_delta(d), F.col("fut_temp") + F.lit(float(d))) for d in deltas
            ]
        else:
            raise ValueError(f"unknown scenario: {scenario}")
    thresholds = closed_domain(
        constraints.select(
            F.col("crop_id").cast("int").alias("crop_id"),
            F.col("temp_opt_max").cast("double").alias("threshold"),
        ),
        "crop_id", settings.crops,
    )
    classed = (
        months.join(F.broadcast(thresholds), "crop_id", "left")
        .withColumn("threshold", F.coalesce("threshold", F.lit(DEFAULT_HEAT_THRESHOLD)))
        .withColumn("_s", F.explode(F.array(*[
            F.struct(
                F.lit(s).alias("scenario"), F.lit(d).alias("delta"),
                t.cast("double").alias("temp"),
            )
            for s, d, t in options
        ])))
        .select(
            "crop_id", "cell_id", "horizon_year", "lat", "lon", "month", "plot_count", "area",
            "threshold",
            "_s.scenario", "_s.delta", "_s.temp",
        )
        .withColumn("thermal_class", thermal_class(F.col("temp"), F.col("threshold")))
    )
    return classed.withColumns({
        "severity": lookup(F.col("thermal_class"), SEVERITY),
        "month_name": lookup(F.col("month"), MONTH_NAMES),
    })


def worst_month(exposure: DataFrame) -> DataFrame:
    """The worst month of each cell: highest class, then hottest, then earliest."""
    return keep_largest(
        exposure,
        ["crop_id", "cell_id", "horizon_year", "scenario", "delta"],
        [F.col("severity"), F.col("temp"), -F.col("month")],
    )


def thermal_area_share(worst: DataFrame) -> DataFrame:
    """Area and share of each class per crop, horizon and scenario; absent classes show 0."""
    area = {
        c: F.coalesce(F.sum(F.when(F.col("thermal_class") == c, F.col("area"))), F.lit(0.0))
        for c in SEVERITY
    }
    keys = ["crop_id", "horizon_year", "scenario", "delta"]
    wide = worst.groupBy(*keys).agg(
        F.coalesce(F.sum("area"), F.lit(0.0)).alias("total_area"),
        *[a.alias(c) for c, a in area.items()],
    )
    share = F.col("area") / F.nullif(F.col("total_area"), F.lit(0.0)) * 100.0
    return (
        wide.unpivot(
            [*keys, "total_area"], list(SEVERITY), "thermal_class", "area"
        )
        .withColumn("share_pct", F.coalesce(share, F.lit(0.0)))
    )
