"""Schemas of the input tables and of the projection fact table."""

from __future__ import annotations

from pyspark.sql import types as T


_TYPES = {
    "int": T.IntegerType(), "long": T.LongType(), "short": T.ShortType(),
    "float": T.FloatType(), "double": T.DoubleType(), "string": T.StringType(),
    "boolean": T.BooleanType(), "date": T.DateType(), "timestamp": T.TimestampType(),
    "timestamp_ntz": T.TimestampNTZType(),
}


def _schema(spec: str) -> T.StructType:
    """Schema of "name type, name type"; needs no session, unlike a DDL string."""
    return T.StructType([
        T.StructField(name, _TYPES[kind])
        for name, kind in (field.split() for field in spec.split(","))
    ])


CONSTRAINTS = _schema(
    "crop_id long, crop_name string, "
    "temp_opt_min long, temp_opt_max long, temp_abs_min long, temp_abs_max long, "
    "temp_season_min double, temp_season_max double, "
    "rain_season_min double, rain_season_max double, "
    "sun_season_min double, sun_season_max double, "
    "soil_pref_1 string, soil_pref_2 string, soil_pref_3 string"
)
COORDINATES = _schema("cell_id long, lat double, lon double")
SOILS = _schema(
    "cell_id long, soil_family string, soil_texture string, "
    "dept_code string, dept_name string, region_code string, region_name string"
)
CLIMATE_FUTURE = _schema(
    "cell_id int, date date, year short, month short, temp float, rain float, sun float"
)
CLIMATE_PAST = _schema(
    "cell_id int, date timestamp_ntz, year short, month short, temp float, rain float, sun float"
)
PLOTS = _schema("plot_id string, cell_id long, crop_id long, area_ha double")
YIELDS = _schema("cell_id long, crop_id long, year int, yield_q_ha double, area_ha double")

INPUT_SCHEMAS = {
    "constraints": CONSTRAINTS,
    "coordinates": COORDINATES,
    "soils": SOILS,
    "climate_past": CLIMATE_PAST,
    "climate_future": CLIMATE_FUTURE,
    "plots": PLOTS,
    "yields": YIELDS,
}

FACT = _schema(
    "cell_id long, crop_id int, horizon_year int, "
    "dept_code string, dept_name string, region_code string, region_name string, "
    "lat double, lon double, soil_family string, soil_texture string, "
    "is_grown boolean, plot_count long, base_area double, "
    "base_temp_avg double, base_temp_peak double, base_rain double, base_sun double, "
    "fut_temp_avg double, fut_temp_peak double, fut_rain double, fut_sun double, "
    "temp_ok boolean, rain_ok boolean, sun_ok boolean, soil_ok boolean, "
    "climate_complete boolean, suitable boolean, status string, fail_reasons string, "
    "base_yield double, fut_yield double, "
    "yield_score_base double, yield_score_fut double, "
    "temp_score_base double, temp_score_fut double, "
    "rain_score_base double, rain_score_fut double, "
    "sun_score_base double, sun_score_fut double, soil_score double, "
    "fit_score_base double, fit_score_fut double, score_delta double, yield_delta_pct double, "
    "median_grown_area double, fut_area double, new_area double, "
    "model_version string, new_area_factor double, computed_at timestamp"
)
FACT_KEY = ("cell_id", "crop_id", "horizon_year")
FACT_PARTITIONS = ("crop_id", "horizon_year")

# Texture codes of the soil map.
SOIL_TEXTURES = {
    1: "Sandy",
    2: "Loamy",
    3: "Clayey",
    4: "Heavy clay",
    5: "Organic",
}


def require_columns(df, wanted, what="table"):
    """Return ``df`` if it has all ``wanted`` columns, else name the missing ones."""
    missing = sorted(set(wanted) - set(df.columns))
    if missing:
        raise ValueError(f"{what} lacks columns: {missing}")
    return df
