"""Where each crop is grown: plots per cell."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from fieldcast.operators.distinct import bit_counts, merged_bitmaps, number_bitmaps


def plot_footprint(plots: DataFrame, positive_only: bool = True) -> DataFrame:
    """Grown area and number of plots per crop and cell.

    The fact build counts plots with an area only, the thermal map counts all.
    """
    rows = plots.where(F.col("area_ha") > 0) if positive_only else plots
    return rows.groupBy(
        F.col("crop_id").cast("int").alias("crop_id"),
        F.col("cell_id").cast("long").alias("cell_id"),
    ).agg(
        F.sum("area_ha").alias("area"),
        F.count_distinct("plot_id").alias("plot_count"),
    )


def cell_bitmaps(plots: DataFrame) -> DataFrame:
    """The cells of each crop as bitmaps, which also give those of several crops together."""
    return number_bitmaps(plots.withColumn("crop_id", F.col("crop_id").cast("int")), ["crop_id"], "cell_id")


def plot_stats(plots: DataFrame) -> DataFrame:
    """Distinct plots, distinct cells and area of each crop.

    Plots are named by text and counted by value, cells by bitmaps: one distinct count at a time
    needs no copy of the rows.
    """
    counted = plots.groupBy(F.col("crop_id").cast("int").alias("crop_id")).agg(
        F.count_distinct("plot_id").alias("n_plots"), F.sum("area_ha").alias("total_area"))
    cells = bit_counts(cell_bitmaps(plots), ["crop_id"], "n_cells")
    both = counted.unionByName(cells, allowMissingColumns=True).groupBy("crop_id")  # a NULL crop counts too
    return both.agg(
        F.max("n_plots").alias("n_plots"), F.coalesce(F.max("n_cells"), F.lit(0)).alias("n_cells"),
        F.max("total_area").alias("total_area"))


def distinct_counts(plots: DataFrame) -> DataFrame:
    """Distinct plots, distinct cells and area of all crops; the cells from the crops' bitmaps."""
    counted = plots.agg(F.count_distinct("plot_id").alias("n_plots"), F.sum("area_ha").alias("total_area"))
    cells = bit_counts(merged_bitmaps(cell_bitmaps(plots), []), [], "n_cells")
    return counted.unionByName(cells, allowMissingColumns=True).agg(
        F.max("n_plots").alias("n_plots"), F.coalesce(F.max("n_cells"), F.lit(0)).alias("n_cells"),
        F.max("total_area").alias("total_area"))


def per_cell_map(df: DataFrame, key: str, values: list[str], name: str) -> DataFrame:
    """Fold rows unique by (cell, key) into one map ``key -> struct(values)`` per cell.

    ``key`` is a crop or a horizon, so a map has a handful of entries. Tables folded this
    way join on the cell alone and share one partitioning.
    """
    entry = F.struct(F.col(key).cast("int").alias("k"), F.struct(*values).alias("v"))
    return df.groupBy("cell_id").agg(
        F.map_from_entries(F.collect_list(entry)).alias(name)
    )
