"""Areas: medians of grown cells and the area a cell may have in future."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from fieldcast.functions import strip_space
from fieldcast.operators.quantiles import exact_quantiles


def median_area_by_dept(grown: DataFrame) -> DataFrame:
    """Median grown area of a crop's cells by department.

    ``grown`` holds crop, cell, area and department. Grown cells stay in the fact table at
    every horizon, so one median serves all horizons.
    """
    rows = grown.where(F.col("area") > 0).select(
        "crop_id", "cell_id",
        strip_space(F.col("dept_code")).alias("dept_code"),
        strip_space(F.col("dept_name")).alias("dept_name"),
        "area",
    )
    return exact_quantiles(
        rows, ["crop_id", "dept_code", "dept_name"], "area", [0.5], spread_on=["cell_id"]
    ).select(
        "crop_id", "dept_code", "dept_name",
        F.col("n").alias("n_cells"), F.col("quantile").alias("dept_median"),
    )


def median_area_by_crop(grown: DataFrame) -> DataFrame:
    """Median over all departments, for departments where a crop is not grown."""
    return exact_quantiles(
        grown.where(F.col("area") > 0), ["crop_id"], "area", [0.5], small_domain=True
    ).select("crop_id", F.col("quantile").alias("crop_median"))


def future_area(
    status: Column, grown_area: Column, median_area: Column, factor: float
) -> Column:
    """Kept cells keep their area; new ones get part of the median; all others nothing."""
    return (
        F.when(status == "kept", grown_area)
        .when(status == "new", median_area * F.lit(factor))
        .otherwise(0.0)
    )
