"""Order-system tables presented as the input tables of this package.

Suppliers stand for grid cells, nations for departments, order lines for climate readings
(delivered lines are the past, open ones the future), for plots and for yields.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from fieldcast.schemas import CONSTRAINTS
from fieldcast.settings import Settings
from fieldcast.sources.tables import Tables

SETTINGS = Settings(
    base_year=1998,
    horizons=(1999, 2000, 2001),
    history_years=(1995, 2001),
    last_training_year=1999,
)

# Crop, name, optimum and absolute temperature, season bounds of temperature,
# rain and sun, preferred soil families.
CONSTRAINT_ROWS = [
    (1, "wine grape", 20, 42, 10, 50, 22.0, 30.0, 210000.0, 330000.0, 0.40, 0.64, "F0", "F1", "F2"),
    (2, "chickpea", 18, 38, 10, 50, 20.0, 28.0, 200000.0, 300000.0, 0.40, 0.64, "F1", "F2", "F3"),
    (3, "potato", 22, 40, 10, 50, None, None, 240000.0, 330000.0, 0.40, 0.64, "F2", "F3", "F4"),
]


def _read(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def _crop(flag) -> "F.Column":
    return F.when(flag == "A", 1).when(flag == "N", 2).when(flag == "R", 3)


def _grown_crop(flag, cell) -> "F.Column":
    """Crops 1 to 7, of which a cell grows three; 4 to 7 are outside the run."""
    return ((cell + 2 * _crop(flag)) % 7 + 1).cast("int")


def climate(
    spark: SparkSession, folder: str, line_status: str, years: tuple[int, int] | None = None,
) -> DataFrame:
    """``years`` (first, last) is pushed to the scan as a range of dates."""
    lines = _read(spark, folder, "lineitem").where(F.col("l_linestatus") == line_status)
    if years:
        first, after = (F.lit(f"{y}-01-01").cast("timestamp_ntz") for y in (years[0], years[1] + 1))
        lines = lines.where((F.col("l_shipdate") >= first) & (F.col("l_shipdate") < after))
    return lines.select(
        F.col("l_suppkey").alias("cell_id"),
        F.col("l_shipdate").alias("date"),
        F.year("l_shipdate").alias("year"),
        F.month("l_shipdate").alias("month"),
        F.col("l_quantity").alias("temp"),
        F.col("l_extendedprice").alias("rain"),
        (F.col("l_tax") + F.lit(0.0)).alias("sun"),
    )


def coordinates(spark: SparkSession, folder: str) -> DataFrame:
    cell = F.col("s_suppkey")
    return _read(spark, folder, "supplier").select(
        cell.alias("cell_id"),
        (F.lit(41.0) + (cell % 100) / F.lit(10.0)).alias("lat"),
        (F.lit(-5.0) + (cell % 140) / F.lit(10.0)).alias("lon"),
    )


def soils(spark: SparkSession, folder: str) -> DataFrame:
    supplier, nation, region = (_read(spark, folder, t) for t in ("supplier", "nation", "region"))
    return (
        supplier.join(nation, supplier.s_nationkey == nation.n_nationkey)
        .join(region, nation.n_regionkey == region.r_regionkey)
        .select(
            F.col("s_suppkey").alias("cell_id"),
            F.concat(F.lit("F"), F.col("n_regionkey").cast("string")).alias("soil_family"),
            F.col("n_regionkey").cast("string").alias("soil_texture"),
            F.col("n_nationkey").cast("string").alias("dept_code"),
            F.col("n_name").alias("dept_name"),
            F.col("r_regionkey").cast("string").alias("region_code"),
            F.col("r_name").alias("region_name"),
        )
    )


def plots(spark: SparkSession, folder: str) -> DataFrame:
    """Every order line is (part of) a plot."""
    return _read(spark, folder, "lineitem").select(
        F.col("l_orderkey").cast("string").alias("plot_id"),
        F.col("l_suppkey").alias("cell_id"),
        _grown_crop(F.col("l_returnflag"), F.col("l_suppkey")).alias("crop_id"),
        F.col("l_quantity").alias("area_ha"),
    )


def yields(spark: SparkSession, folder: str) -> DataFrame:
    lines = _read(spark, folder, "lineitem")
    price = F.col("l_extendedprice") * (F.lit(1.0) - F.col("l_discount"))
    return (
        lines.groupBy(
            F.col("l_suppkey").alias("cell_id"),
            _crop(F.col("l_returnflag")).alias("crop_id"),
            F.year("l_shipdate").alias("year"),
        )
        .agg(F.sum(price).alias("_value"), F.sum("l_quantity").alias("area_ha"))
        .select(
            "cell_id", "crop_id", "year",
            (F.col("_value") / F.nullif("area_ha", F.lit(0.0))).alias("yield_q_ha"),
            "area_ha",
        )
    )


def load(spark: SparkSession, folder: str) -> Tables:
    return Tables(
        constraints=spark.createDataFrame(CONSTRAINT_ROWS, CONSTRAINTS),
        coordinates=coordinates(spark, folder),
        soils=soils(spark, folder),
        climate_past=climate(spark, folder, "F", SETTINGS.history_years),
        climate_future=climate(
            spark, folder, "O", (min(SETTINGS.horizons), max(SETTINGS.horizons))),
        plots=plots(spark, folder),
        yields=yields(spark, folder),
    )
