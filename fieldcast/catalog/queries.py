"""One query per operator, over the order-system tables of a folder.

Queries that read the stored fact table share one copy per session and folder, built by
the first of them, as users of the stored table would.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import replace
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

from fieldcast import functions as X
from fieldcast.operators import climate as C
from fieldcast.operators import footprint as P
from fieldcast.operators import thermal as H
from fieldcast.operators import areas as A
from fieldcast.operators.dedupe import keep_first
from fieldcast.operators.joins import key_counts
from fieldcast.operators.mesh import assign_cell
from fieldcast.operators.quantiles import exact_quantiles
from fieldcast.operators.scans import scan_metrics
from fieldcast.operators.staging import stage, staged_path
from fieldcast.plans import department_models as D
from fieldcast.plans import department_ridge as G
from fieldcast.plans import marts as M
from fieldcast.plans import quality as Q
from fieldcast.plans import series as E
from fieldcast.plans import suitability as S
from fieldcast.plans import yields as Y
from fieldcast.plans.fact import (
    PARTS, prediction_mask, projection_fact, scores_at, with_features,
)
from fieldcast.plans.job import error_class, refresh_partitions, run_projection, train_models
from fieldcast.plans.martstore import stored_mart
from fieldcast.plans.model import fill_values, metrics_table, predict_by_crop
from fieldcast.plans.shared import SharedInputs, shared_inputs
from fieldcast.schemas import SOIL_TEXTURES
from fieldcast.settings import MIN_MODEL_ROWS, MIN_VALIDATION_ROWS, Settings
from fieldcast.sources import driver_tables
from fieldcast.sources.driver_tables import SETTINGS
from fieldcast.sources.factstore import read_fact, replace_partitions
from fieldcast.sources.grid import (
    bbox_filter, clean_grid, kelvin_to_celsius, land_csv, requested, write_grid,
)
from fieldcast.sources.tables import (
    missing_crops, ordered_constraints, read_cell_tables, read_query, write_cell_tables,
)
from fieldcast.sources.zones import write_csv, zone_path

REGISTRY: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
_FACTS: dict[tuple[str, str], DataFrame] = {}
_HISTORIES: dict[tuple[str, str], Y.YieldHistory] = {}
_MODELS: dict[tuple[str, str], list] = {}
_SHARED: dict[tuple[str, str], SharedInputs] = {}
BIG = 2  # digits kept of totals that run into the millions


def query(fn):
    REGISTRY[fn.__name__] = fn
    return fn


def tidy(df: DataFrame, digits: int = 5, **special: int) -> DataFrame:
    """Round the doubles of a result, so that the order of summation does not show. The
    extra 0.001 keeps ties clear of that noise too. Large values and NaN stay what they are."""
    out = []
    for f in df.schema.fields:
        col = F.col(f.name)
        if isinstance(f.dataType, T.DoubleType):
            scale = F.lit(float(10 ** special.get(f.name, digits)))
            col = F.rint(col * scale + F.lit(0.001)) / scale + F.lit(0.0)
        out.append(col.alias(f.name))
    return df.select(*out)


def tables(spark: SparkSession, folder: str):
    return driver_tables.load(spark, folder)


def _once(cache: dict, spark: SparkSession, folder: str, build):
    key = (spark.sparkContext.applicationId, folder)
    if key not in cache:
        cache[key] = build()
    return cache[key]


def history(spark, folder, shared: SharedInputs | None = None) -> Y.YieldHistory:
    seasons = shared.past(SETTINGS.history_years) if shared else None
    return _once(
        _HISTORIES, spark, folder, lambda: Y.yield_history(tables(spark, folder), SETTINGS, seasons)
    )


def shared(spark, folder) -> SharedInputs:
    """Seasons and footprint of a fact build, which its history reads too."""
    return _once(_SHARED, spark, folder, lambda: shared_inputs(tables(spark, folder), SETTINGS))


def fact(spark, folder) -> DataFrame:
    """The fact table with the reference yield as the prediction."""
    def build():
        inputs = shared(spark, folder)
        past = history(spark, folder, inputs)
        return stage(projection_fact(tables(spark, folder), SETTINGS, past, shared=inputs), "fact")
    return _once(_FACTS, spark, folder, build)


def models(spark, folder) -> list:
    def train():
        found, failed = train_models(history(spark, folder), SETTINGS)
        if failed:
            raise ValueError(f"no model for crops: {failed}")
        return found
    return _once(_MODELS, spark, folder, train)


def with_crop(rows: DataFrame, t) -> DataFrame:
    """Rows repeated for each crop, with the bounds of the crop."""
    each = rows.withColumn("crop_id", F.explode(F.array(*[F.lit(c) for c in SETTINGS.crops])))
    return each.join(F.broadcast(S.crop_constraints(t.constraints, SETTINGS)), "crop_id")


# --- climate and footprint ---------------------------------------------------------------

@query
def monthly_climate(spark, folder):
    return tidy(C.monthly_climate(tables(spark, folder).climate_past, SETTINGS.history_years))


@query
def seasonal_climate(spark, folder):
    return tidy(C.seasonal_climate(tables(spark, folder).climate_past, SETTINGS.history_years))


@query
def complete_seasons(spark, folder):
    return tidy(C.complete_seasons(
        C.seasonal_climate(tables(spark, folder).climate_future, list(SETTINGS.horizons))
    ))


@query
def plot_footprint(spark, folder):
    return tidy(P.plot_footprint(tables(spark, folder).plots))


@query
def plot_stats(spark, folder):
    return tidy(P.plot_stats(tables(spark, folder).plots))


@query
def distinct_counts(spark, folder):
    return tidy(P.distinct_counts(tables(spark, folder).plots))


@query
def bias_correct(spark, folder):
    shifted = C.bias_correct(tables(spark, folder).climate_future, -0.9)
    return tidy(C.seasonal_climate(shifted, list(SETTINGS.horizons)))


# --- heat ----------------------------------------------------------------------------------

def _exposure(t, **options):
    return H.thermal_exposure(H.thermal_months(t, SETTINGS), t.constraints, SETTINGS, **options)


@query
def thermal_months(spark, folder):
    return tidy(H.thermal_months(tables(spark, folder), SETTINGS))


@query
def worst_month(spark, folder):
    return tidy(H.worst_month(_exposure(tables(spark, folder), deltas=(2.5,))).select(
        "crop_id", "cell_id", "horizon_year", "scenario", "delta", "month", "month_name", "temp",
        "thermal_class", "severity", "area",
    ))


@query
def thermal_area_share(spark, folder):
    return tidy(H.thermal_area_share(H.worst_month(
        _exposure(tables(spark, folder), scenarios=("observed", "projected"))
    )))


@query
def warming_scenarios(spark, folder):
    return tidy(H.thermal_area_share(H.worst_month(_exposure(
        tables(spark, folder), scenarios=("warming",), deltas=(0.0, 0.5, 5.0, 10.0, 20.0)
    ))))


# --- suitability ---------------------------------------------------------------------------

KEY = ["cell_id", "crop_id", "horizon_year"]


@query
def suitability_flags(spark, folder):
    rows = S.suitability(tables(spark, folder), SETTINGS, keep_hidden=True)
    return rows.select(
        *KEY, "n_months", "temp_ok", "rain_ok", "sun_ok", "soil_ok", "climate_complete", "suitable"
    )


@query
def failure_reasons(spark, folder):
    return S.suitability(tables(spark, folder), SETTINGS).select(*KEY, "fail_reasons")


@query
def cell_status(spark, folder):
    return tidy(S.suitability(tables(spark, folder), SETTINGS, keep_hidden=True).select(
        *KEY, "is_grown", "suitable", "status", "grown_area", "plot_count"
    ))


@query
def cell_layout_status(spark, folder):
    """The status of every cell from tables bucketed by cell: seasons, footprints and all joins by
    cell run where the rows lie. The database and its tables go with the application."""
    name = f"cells_{uuid.uuid4().hex}"
    spark.sql(f"CREATE DATABASE {name} LOCATION '{staged_path(spark, 'cell-tables')}'")
    write_cell_tables(tables(spark, folder), name, int(spark.conf.get("spark.sql.shuffle.partitions")))
    rows = S.suitability(read_cell_tables(spark, name), SETTINGS, keep_hidden=True)
    return tidy(rows.select(*KEY, "status", "n_months", "fut_temp_avg", "base_temp_avg", "grown_area"))


@query
def status_summary(spark, folder):
    return tidy(S.status_summary(S.suitability(tables(spark, folder), SETTINGS)))


@query
def missing_horizon_status(spark, folder):
    """A horizon without any climate row: all flags on climate are NULL there."""
    rows = S.suitability(
        tables(spark, folder), replace(SETTINGS, horizons=(2001, 2054)), keep_hidden=True
    )
    return rows.select(
        *KEY, "n_months", "temp_ok", "soil_ok", "climate_complete", "suitable", "status",
        "fail_reasons",
    )


@query
def cells_without_soil(spark, folder):
    """Located cells without a soil: customers are cells too here, soils know suppliers only."""
    t = tables(spark, folder)
    more = spark.read.parquet(f"{folder}/customer.parquet").select(
        F.col("c_custkey").alias("cell_id"), F.lit(0.0).alias("lat"), F.lit(0.0).alias("lon"))
    cells = t.coordinates.join(more, "cell_id", "left_anti").unionByName(more)
    return S.cells_without_soil(replace(t, coordinates=cells))


# --- scores --------------------------------------------------------------------------------

@query
def tolerance_scores(spark, folder):
    t = tables(spark, folder)
    seasons = C.seasonal_climate(t.climate_past, SETTINGS.history_years)
    rows = with_crop(seasons, t).withColumn("yield_p90", F.lit(1.0))
    scores = scores_at("x", F.lit(0.0), F.col("temp_avg"), F.col("rain"), F.col("sun"))
    return tidy(rows.select(
        "cell_id", "year", "crop_id",
        *[scores[f"{p}_score_x"].alias(f"{p}_score") for p in ("temp", "rain", "sun")],
    ))


@query
def soil_score(spark, folder):
    t = tables(spark, folder)
    preferred = [F.col(f"soil_pref_{i}") for i in (1, 2, 3)]
    return tidy(with_crop(t.soils, t).select(
        "cell_id", "crop_id", "soil_family",
        X.lookup(F.col("soil_texture").cast("int"), SOIL_TEXTURES).alias("texture_label"),
        X.soil_score(F.col("soil_family"), preferred).alias("soil_score"),
    ))


@query
def yield_score(spark, folder):
    past = history(spark, folder)
    return tidy(past.trimmed.join(F.broadcast(past.defaults), "crop_id").select(
        "cell_id", "crop_id", "year",
        X.yield_score(F.col("yield_q_ha"), F.col("yield_p90")).alias("yield_score"),
    ))


@query
def fit_score(spark, folder):
    return tidy(fact(spark, folder).select(
        *KEY, *[f"{p}_score_{w}" for p in PARTS for w in ("base", "fut")], "soil_score",
        "fit_score_base", "fit_score_fut",
    ))


@query
def score_change(spark, folder):
    return tidy(fact(spark, folder).select(*KEY, "score_delta", "yield_delta_pct"))


# --- yields --------------------------------------------------------------------------------

@query
def yield_training_set(spark, folder):
    return tidy(Y.yield_training_set(tables(spark, folder), SETTINGS))


@query
def horizon_features(spark, folder):
    return tidy(Y.horizon_features(tables(spark, folder), SETTINGS))


@query
def yield_quantiles(spark, folder):
    training = Y.valid_rows(Y.yield_training_set(tables(spark, folder), SETTINGS))
    return tidy(Y.yield_quantiles(training, [0.01, 0.5, 0.9, 0.99]))


@query
def price_quantiles(spark, folder):
    """Exact quantiles of groups with many rows and of a key of open size."""
    lines = spark.read.parquet(f"{folder}/lineitem.parquet")
    return tidy(exact_quantiles(
        lines, ["l_suppkey"], "l_extendedprice", [0.05, 0.5, 0.95],
        spread_on=["l_orderkey", "l_linenumber"],
    ))


@query
def trimmed_yields(spark, folder):
    return tidy(history(spark, folder).trimmed.select(
        "cell_id", "crop_id", "year", "yield_q_ha"
    ))


@query
def reference_by_cell(spark, folder):
    return tidy(Y.reference_by_cell(history(spark, folder).trimmed))


@query
def reference_defaults(spark, folder):
    return tidy(history(spark, folder).defaults)


# --- fact ----------------------------------------------------------------------------------

@query
def median_area_by_dept(spark, folder):
    t = tables(spark, folder)
    grown = S.grown_cells(t, SETTINGS).join(
        S.cell_dimensions(t).select("cell_id", "dept_code", "dept_name"), "cell_id"
    )
    return tidy(A.median_area_by_dept(grown))


@query
def future_areas(spark, folder):
    return tidy(fact(spark, folder).select(
        *KEY, "base_area", "median_grown_area", "fut_area", "new_area", "new_area_factor"
    ))


@query
def projection_fact_table(spark, folder):
    """The whole build, from the given tables to fact rows."""
    t = tables(spark, folder)
    return tidy(projection_fact(t, SETTINGS).drop("computed_at"))


@query
def partition_overwrite(spark, folder):
    """Store the fact, replace one partition by changed rows, read all back."""
    rows = fact(spark, folder)
    path = staged_path(spark, "store")
    replace_partitions(rows, path)
    changed = rows.where(
        (F.col("crop_id") == SETTINGS.crops[0]) & (F.col("horizon_year") == SETTINGS.horizons[0])
    ).withColumn("base_area", F.col("base_area") * 2.0)
    replace_partitions(changed, path)
    return tidy(read_fact(spark, path).select(*KEY, "status", "base_area"))


@query
def mart_freshness(spark, folder):
    """A stored mart read twice, and once more after a partition of its facts was replaced."""
    rows, path = fact(spark, folder), staged_path(spark, "mart-store")
    replace_partitions(rows, path)

    def read(when: str) -> DataFrame:
        mart = stored_mart(spark, path, "status_metrics", M.status_metrics)
        return mart.select(F.lit(when).alias("read"), "crop_id", "horizon_year", "grown_cells", "base_area", "fut_area")

    first, again = read("first"), read("again")
    changed = rows.where(
        (F.col("crop_id") == SETTINGS.crops[0]) & (F.col("horizon_year") == SETTINGS.horizons[0])
    ).withColumn("base_area", F.col("base_area") * 2.0)
    replace_partitions(changed, path)
    return tidy(first.unionByName(again).unionByName(read("fresh")))


@query
def failure_isolation(spark, folder):
    """A refresh in which one partition cannot be built and the rows of another break a rule: both
    keep their stored rows, all others are replaced."""
    rows, path = fact(spark, folder), staged_path(spark, "isolation")
    replace_partitions(rows.withColumn("model_version", F.lit("first")), path)
    crop, horizon = F.col("crop_id"), F.col("horizon_year")

    def build(part: Settings) -> DataFrame:
        here = rows.where(crop.isin(*part.crops) & horizon.isin(*part.horizons))
        return here.withColumns({
            "model_version": F.lit("second"),
            "fut_area": F.when((crop == 1) & (horizon == 1999), F.raise_error(F.lit("no season")).cast("double"))
            .when((crop == 2) & (horizon == 2000), -1.0).otherwise(F.col("fut_area")),
        })

    results = refresh_partitions(spark, build, path, SETTINGS).withColumn("error_class", error_class(F.col("error")))
    stored = read_fact(spark, path).groupBy("crop_id", "horizon_year", F.col("model_version").alias("stored_by")).agg(
        F.count("*").alias("n_stored"))
    return results.drop("error").join(stored, ["crop_id", "horizon_year"], "full")


# --- marts ---------------------------------------------------------------------------------

@query
def projection_extract(spark, folder):
    t = tables(spark, folder)
    return tidy(M.plain_flags(
        M.projection_extract(fact(spark, folder), t.constraints, SETTINGS)
    ).drop("computed_at"))


@query
def status_metrics(spark, folder):
    return tidy(M.status_metrics(fact(spark, folder)))


@query
def marker_size(spark, folder):
    return tidy(M.marker_size(fact(spark, folder), SETTINGS).select(*KEY, "marker_size"))


@query
def cell_label(spark, folder):
    shown = M.projection_extract(fact(spark, folder), tables(spark, folder).constraints, SETTINGS)
    return tidy(shown, 6).select(*KEY, M.cell_label().alias("cell_label"))


@query
def national_kpis(spark, folder):
    return tidy(
        M.national_kpis(fact(spark, folder)).drop("computed_at"),
        base_production=BIG, fut_production=BIG,
    )


@query
def department_kpis(spark, folder):
    return tidy(M.department_kpis(fact(spark, folder)))


@query
def department_index(spark, folder):
    return M.department_kpis(fact(spark, folder)).select(
        "crop_id", "horizon_year", "dept_code", "dept_name", "dept_index", "band", "rating"
    )


@query
def department_ranking(spark, folder):
    return tidy(M.department_ranking(M.department_kpis(fact(spark, folder))))


@query
def best_crop(spark, folder):
    return tidy(M.best_crop(fact(spark, folder)))


# --- series --------------------------------------------------------------------------------

@query
def temperature_series(spark, folder):
    return tidy(E.temperature_series(tables(spark, folder), SETTINGS))


@query
def cell_temperature_series(spark, folder):
    return tidy(E.cell_temperature_series(tables(spark, folder), SETTINGS))


@query
def compare_series(spark, folder):
    return tidy(E.compare_all_cells(tables(spark, folder), SETTINGS))


# --- cleaning ------------------------------------------------------------------------------

def _grid(spark, folder):
    """Order lines as gridded readings in Kelvin, some missing, some repeated."""
    cell = F.col("l_suppkey")
    return spark.read.parquet(f"{folder}/lineitem.parquet").select(
        F.col("l_shipdate").alias("time"),
        (F.lit(41.0) + (cell % 100) / F.lit(10.0)).alias("lat"),
        (F.lit(-5.0) + (cell % 140) / F.lit(10.0)).alias("lon"),
        F.when(F.col("l_discount") > 0, F.col("l_quantity") + F.col("l_tax") + F.lit(260.0))
        .alias("tas"),
    )


@query
def grid_clean(spark, folder):
    return tidy(clean_grid(_grid(spark, folder)))


LANDED = T.StructType([
    T.StructField("time", T.TimestampNTZType()), T.StructField("lat", T.DoubleType()),
    T.StructField("lon", T.DoubleType()), T.StructField("tas", T.DoubleType())])


@query
def landing_round_trip(spark, folder):
    """Order lines landed as a CSV, some with an unreadable number or time: cleaned, written as
    Parquet and CSV, both read back by type, with the number of lines that did not fit."""
    lines = _grid(spark, folder).select(
        F.when(F.col("lon") > 8.5, F.concat(F.lit("on "), F.col("time").cast("string")))
        .otherwise(F.col("time").cast("string")).alias("time"),
        "lat", "lon", F.coalesce(F.col("tas").cast("string"), F.lit("n/a")).alias("tas"))
    root = staged_path(spark, "zones")
    write_csv(lines, zone_path(root, "bronze", "lines"))
    silver, rejected = land_csv(spark, root, "lines", "lines", LANDED)
    by_year = silver.groupBy(F.year("time").alias("year")).agg(
        F.count("*").alias("n_rows"), F.sum("temp_celsius").alias("temp_sum"))
    refused = rejected.agg(F.count("*").alias("n_rejected"))
    return tidy(by_year.crossJoin(F.broadcast(refused)))  # one row


@query
def source_request(spark, folder):
    """Years, months and a box asked of a landed grid: what comes back, the folders that the scan
    opened, and whether it decoded fewer rows than they hold."""
    path = staged_path(spark, "landed")
    write_grid(_grid(spark, folder), path, page_rows=50)
    landed = spark.read.parquet(path)
    years, months = [1996, 1998], [5, 6, 7]
    rows = requested(landed, years, months, north=46.05, west=-3.05, south=44.95, east=5.05)
    (scan,) = scan_metrics(rows.select("time", "lat", "lon", "tas"))
    there = landed.where(F.col("year").isin(*years) & F.col("month").isin(*months)).count()
    return tidy(rows.groupBy(F.year("time").alias("year"), F.month("time").alias("month")).agg(
        F.count("*").alias("n_rows"), F.count("tas").alias("n_values"), F.sum("tas").alias("tas_sum"),
    ).withColumns({
        "n_folders": F.lit(int(scan["folders"])), "skipped_rows": F.lit(scan["rows"] < there)}))


@query
def dedupe_first(spark, folder):
    lines = spark.read.parquet(f"{folder}/lineitem.parquet")
    order = ["l_shipdate", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice"]
    return tidy(keep_first(
        lines.select("l_orderkey", "l_linenumber", *order), ["l_orderkey", "l_linenumber"], order
    ))


@query
def celsius(spark, folder):
    parts = spark.read.parquet(f"{folder}/part.parquet")
    return tidy(parts.select(
        "p_partkey", kelvin_to_celsius(F.col("p_retailprice")).alias("temp_celsius")
    ))


@query
def box_filter(spark, folder):
    return tidy(bbox_filter(
        driver_tables.coordinates(spark, folder), north=48.05, west=-3.05, south=42.95, east=5.05
    ))


@query
def coerce_numeric(spark, folder):
    parts = spark.read.parquet(f"{folder}/part.parquet")
    raw = F.replace(F.col("p_brand"), F.lit("Brand#1"), F.lit(""))
    return tidy(parts.select("p_partkey", X.coerce_double(raw).alias("number")))


@query
def dept_code_normalise(spark, folder):
    customers = spark.read.parquet(f"{folder}/customer.parquet")
    raw = F.concat(F.lit(" "), F.col("c_nationkey").cast("double").cast("string"), F.lit(" "))
    return customers.groupBy(X.dept_code_normalise(raw).alias("dept_code")).agg(
        F.count("*").alias("n_rows")
    )


def _located_customers(spark, folder):
    """Customers as plots at a place of their own, each with the mesh cell nearest to it."""
    key = F.col("c_custkey")
    points = spark.read.parquet(f"{folder}/customer.parquet").select(
        key.alias("point_id"),
        (F.lit(41.0) + (key % 1050) / F.lit(100.0)).alias("lat"),
        (F.lit(-5.5) + (key % 1530) / F.lit(100.0)).alias("lon"),
        "c_mktsegment", "c_acctbal",
    )
    return assign_cell(points, driver_tables.coordinates(spark, folder), 60.0)


@query
def nearest_cell(spark, folder):
    return tidy(_located_customers(spark, folder).select("point_id", "cell_id", "distance"))


@query
def regridded_footprint(spark, folder):
    """Area and plots per mesh cell of plots that came with coordinates only."""
    plots = _located_customers(spark, folder).where("cell_id IS NOT NULL").select(
        F.col("point_id").alias("plot_id"), "cell_id",
        F.when(F.col("c_mktsegment") == "MACHINERY", 1).otherwise(2).alias("crop_id"),
        F.col("c_acctbal").alias("area_ha"),
    )
    return tidy(P.plot_footprint(plots))


# --- checks --------------------------------------------------------------------------------

@query
def crop_coverage_anti(spark, folder):
    grown = tables(spark, folder).plots.select("crop_id").distinct()
    return missing_crops(grown, range(1, 10))


@query
def join_cardinality(spark, folder):
    """Rows and keys that would break the declared cardinality of the fact build's merges, and of a
    table whose key does repeat."""
    t = tables(spark, folder)
    lines = spark.read.parquet(f"{folder}/lineitem.parquet")
    sides = {
        "coordinates by cell": (t.coordinates, ["cell_id"]),
        "soils by cell": (t.soils, ["cell_id"]),
        "references by cell": (history(spark, folder).cells, ["cell_id"]),
        "yields by cell, crop and year": (t.yields, ["cell_id", "crop_id", "year"]),
        "lines by order and number": (lines, ["l_orderkey", "l_linenumber"]),
        "lines by order": (lines, ["l_orderkey"]),
    }
    counted = [key_counts(df, keys).select(F.lit(name).alias("side"), "*") for name, (df, keys) in sides.items()]
    return reduce(DataFrame.unionByName, counted)


@query
def key_uniqueness(spark, folder):
    lines = spark.read.parquet(f"{folder}/lineitem.parquet")
    return Q.duplicate_keys(lines, ["l_orderkey", "l_linenumber"])


@query
def fact_violations(spark, folder):
    """Violations of a fact table spoilt on purpose: repeated keys, a status of no meaning,
    negative areas and scores above 100."""
    rows = fact(spark, folder)
    spoilt = rows.unionByName(rows.where("status = 'new'")).withColumns({
        "status": F.when(F.col("soil_family") == "F4", "odd").otherwise(F.col("status")),
        "base_area": F.when(F.col("suitable"), -F.col("base_area")).otherwise(F.col("base_area")),
        "fit_score_fut": F.col("fit_score_fut") * F.lit(1.05),
    })
    return Q.fact_violations(spoilt)


@query
def first_repeated_keys(spark, folder):
    """The first ten repeated keys of a table, as an error message names them."""
    lines = spark.read.parquet(f"{folder}/lineitem.parquet")
    return Q.first_duplicates(lines, ["l_orderkey", "l_linenumber"])


@query
def empty_inputs(spark, folder):
    """Which inputs of a run hold no row; the climate of a year to come holds none."""
    t = tables(spark, folder)
    return Q.emptiness({
        "coordinates": t.coordinates, "soils": t.soils, "plots": t.plots, "yields": t.yields,
        "past": t.climate_past, "future": t.climate_future, "future 2054": t.climate_future.where("year = 2054")})


@query
def constraints_in_order(spark, folder):
    """The constraints by crop, with the plots and cells that each crop has."""
    t = tables(spark, folder)
    stats = P.plot_stats(t.plots).select("crop_id", "n_plots", "n_cells")
    return ordered_constraints(t.constraints.join(stats, "crop_id", "left").select(
        F.col("crop_id").cast("int").alias("crop_id"), "crop_name", "temp_opt_min", "temp_opt_max", "n_plots", "n_cells"))


@query
def bound_parameters(spark, folder):
    """A SQL text with named values, bound and not pasted in: a value that looks like SQL stays a value."""
    text = f"""SELECT l_returnflag AS flag, count(*) AS n_lines, min(l_shipdate) AS first_day
        FROM parquet.`{folder}/lineitem.parquet`
        WHERE l_quantity BETWEEN :low AND :high AND l_returnflag <> :flag GROUP BY l_returnflag"""
    return read_query(spark, text, {"low": 10, "high": 20.5, "flag": "A' OR 'a' = 'a"})


@query
def divisor_checks(spark, folder):
    """Which of the discounts and brands of the tables a run takes as its divisor of the sun bounds:
    numbers above zero only. Both columns have a few distinct values."""
    discounts = spark.read.parquet(f"{folder}/lineitem.parquet").select(
        (F.col("l_discount") + F.lit(0.0)).cast("string").alias("divisor"))
    brands = spark.read.parquet(f"{folder}/part.parquet").select(F.col("p_brand").alias("divisor"))
    checked = []
    for value in sorted(r[0] for r in discounts.union(brands).distinct().collect()):
        try:
            checked.append((value, True, Settings(sun_divisor=value).sun_divisor))
        except ValueError:
            checked.append((value, False, None))
    return spark.createDataFrame(checked, "divisor string, accepted boolean, used double")


@query
def partition_summary(spark, folder):
    return tidy(Q.partition_summary(fact(spark, folder)))


@query
def status_domain(spark, folder):
    return Q.status_domain(fact(spark, folder))


# --- models --------------------------------------------------------------------------------

@query
def yield_model_metrics(spark, folder):
    return metrics_table(spark, models(spark, folder))


@query
def yield_predictions(spark, folder):
    rows = with_features(S.suitability(tables(spark, folder), SETTINGS))
    predicted = predict_by_crop(models(spark, folder), prediction_mask())(rows)
    return predicted.select(
        *KEY, F.when(prediction_mask(), F.greatest("predicted", F.lit(0.0))).otherwise(0.0)
        .alias("fut_yield"),
    )


@query
def projection_fact_model(spark, folder):
    inputs = shared(spark, folder)
    past = history(spark, folder, inputs)
    predict = predict_by_crop(models(spark, folder), prediction_mask())
    return projection_fact(tables(spark, folder), SETTINGS, past, predict, shared=inputs).drop("computed_at")


@query
def model_fills(spark, folder):
    """What a missing input of each crop's model is replaced by."""
    trimmed = history(spark, folder).trimmed
    rows = [
        (crop, *[fills[c] for c in (*Y.FEATURES, "soil_family")])
        for crop in SETTINGS.crops
        for fills in [fill_values(trimmed.where(F.col("crop_id") == crop))]
    ]
    kinds = ", ".join(f"{c} double" for c in Y.FEATURES)
    return tidy(spark.createDataFrame(rows, f"crop_id int, {kinds}, soil_family string"))


@query
def holdout_split(spark, folder):
    """Rows before and after the last training year, and whether they allow a model and its test."""
    past, year = history(spark, folder), F.col("year") <= SETTINGS.last_training_year
    usable = past.training.groupBy("crop_id").agg(F.count("*").alias("n_usable"))
    split = past.trimmed.groupBy("crop_id").agg(
        F.count("*").alias("n_rows"), F.count_if(year).alias("n_train"), F.count_if(~year).alias("n_test"))
    return usable.join(split, "crop_id").select(
        "crop_id", "n_usable", "n_rows", "n_train", "n_test",
        (F.col("n_usable") >= MIN_MODEL_ROWS).alias("is_trained"),
        ((F.col("n_train") >= MIN_MODEL_ROWS) & (F.col("n_test") >= MIN_VALIDATION_ROWS)).alias("is_tested"))


@query
def prediction_checks(spark, folder):
    """Counts over the models' own predictions: masked rows are 0, no row is negative."""
    rows = with_features(S.suitability(tables(spark, folder), SETTINGS))
    mask = F.coalesce(prediction_mask(), F.lit(False))
    predicted = predict_by_crop(models(spark, folder), prediction_mask())(rows).select(
        "crop_id", "horizon_year", mask.alias("mask"), "predicted",
        F.when(mask, F.greatest("predicted", F.lit(0.0))).otherwise(0.0).alias("fut_yield"))
    return predicted.groupBy("crop_id", "horizon_year").agg(
        F.count("*").alias("n_rows"), F.count_if("mask").alias("n_predicted"),
        F.count_if(F.col("mask") & F.col("predicted").isNull()).alias("n_missing"),
        F.count_if(~F.col("mask") & (F.col("fut_yield") != 0)).alias("n_masked_not_zero"),
        F.count_if(F.col("fut_yield") < 0).alias("n_negative"))


@query
def models_per_crop(spark, folder):
    """One model per crop, trained on all its trimmed rows and used for every horizon."""
    found = models(spark, folder)
    trained = spark.createDataFrame(
        [(m.crop_id, len([x for x in found if x.crop_id == m.crop_id]), m.metrics["n_rows"]) for m in found],
        "crop_id int, n_models int, n_rows long")
    rows = with_features(S.suitability(tables(spark, folder), SETTINGS))
    used = predict_by_crop(found, prediction_mask())(rows).where("predicted IS NOT NULL").groupBy("crop_id").agg(
        F.count_distinct("horizon_year").alias("n_horizons"), F.count("*").alias("n_predicted"))
    return trained.join(used, "crop_id", "left")


@query
def soil_feature(spark, folder):
    """The soil match as a model input, by crop and soil family."""
    rows = Y.with_soil_score(
        history(spark, folder).trimmed, tables(spark, folder).constraints, SETTINGS)
    return rows.groupBy("crop_id", "soil_family", "soil_score").agg(F.count("*").alias("n_rows"))


@query
def score_parts(spark, folder):
    """The points that each part score adds to the future fit score."""
    parts = F.array(*[
        F.struct(F.lit(p).alias("part"), F.col("soil_score" if p == "soil" else f"{p}_score_fut").alias("score"))
        for p in (*PARTS, "soil")])
    rows = fact(spark, folder).select(*KEY, F.inline(parts))
    weighted = rows.join(F.broadcast(M.score_weights(spark)), "part")  # one row per part
    return tidy(weighted.select(
        *KEY, "part", "points", (F.col("score") * F.col("points") / 100.0).alias("added")))


@query
def projection_dry_run(spark, folder):
    """The job for one crop and two horizons, checked but not written."""
    return run_projection(
        spark, tables(spark, folder), None, SETTINGS, crops=[2], horizons=[1999, 2001], dry_run=True)


def _dept_yields(spark, folder):
    t = tables(spark, folder)
    return D.department_yields(Y.yield_training_set(t, SETTINGS), t.soils)


@query
def department_baseline(spark, folder):
    return tidy(D.department_baseline(_dept_yields(spark, folder)))


@query
def department_baseline_errors(spark, folder):
    return tidy(D.baseline_errors(D.department_baseline(_dept_yields(spark, folder)), SETTINGS))


def gram_digits() -> dict[str, int]:
    """Digits kept of the sums: those with rain run into the billions."""
    columns = [*G.INPUTS, G.TARGET]
    names = [G.product_name(a, b) for i, a in enumerate(columns) for b in columns[i:]]
    return {n: -3 if "rain" in n else 3 for n in names} | {f"sum_{c}": 1 if c == "rain" else 3 for c in columns}


@query
def department_gram(spark, folder):
    """Sums of values and products over the department rows of the training years."""
    train, _ = G.split(G.department_inputs(_dept_yields(spark, folder)), SETTINGS)
    return tidy(G.gram_sums(train), **gram_digits())


@query
def department_ridge(spark, folder):
    """Errors of the historical mean and of the ridge solved from those sums."""
    return tidy(G.ridge_and_baseline(G.department_inputs(_dept_yields(spark, folder)), SETTINGS), 4)


@query
def department_regressors(spark, folder):
    """The same with boosted trees beside them, which SQL cannot train."""
    return tidy(G.department_models(G.department_inputs(_dept_yields(spark, folder)), SETTINGS), 4)


@query
def model_comparison(spark, folder):
    """Regressors side by side, with the soil match as a further input."""
    rows = Y.with_soil_score(
        history(spark, folder).trimmed, tables(spark, folder).constraints, SETTINGS
    )
    return D.compare_models(rows, SETTINGS, features=[*Y.FEATURES, "soil_score"])


@query
def comparison_rows(spark, folder):
    """The rows behind each regressor of the comparison."""
    return D.comparison_sizes(history(spark, folder).trimmed, SETTINGS)


@query
def department_folds(spark, folder):
    """The departments and rows that each fold of the test on unseen departments leaves out."""
    return D.fold_sizes(_dept_yields(spark, folder))


@query
def unknown_department(spark, folder):
    return D.unknown_departments(stage(_dept_yields(spark, folder), "dept-yields"), settings=SETTINGS)
