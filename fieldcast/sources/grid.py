"""Cleaning of gridded variables: bronze to silver."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from fieldcast.functions import coerce_double, round_even
from fieldcast.operators.dedupe import keep_first
from fieldcast.settings import SOURCE_BOX
from fieldcast.sources.zones import (
    read_grid, read_typed_csv, sound_lines, write_csv, write_parquet, zone_path,
)

# Fixed values.
TEMP_COLUMNS = ("t2m", "tas", "2m_air_temperature", "tasmax")
PLACE_COLUMNS = ("time", "lat", "lon", "latitude", "longitude")
ZERO_CELSIUS = 273.15


def first_present(df: DataFrame, candidates) -> str:
    """The first column of the frame that is among the candidates."""
    for name in df.columns:
        if name in candidates:
            return name
    raise ValueError(f"none of {list(candidates)} among the columns {df.columns}")


def kelvin_to_celsius(kelvin: Column) -> Column:
    return round_even(kelvin - F.lit(ZERO_CELSIUS), 2)


def bbox_filter(
    df: DataFrame, north: float = SOURCE_BOX["north"], west: float = SOURCE_BOX["west"],
    south: float = SOURCE_BOX["south"], east: float = SOURCE_BOX["east"],
) -> DataFrame:
    return df.where(F.col("lat").between(south, north) & F.col("lon").between(west, east))


def select_period(df: DataFrame, years=None, months=None) -> DataFrame:
    """Years and months of a gridded table.

    The years become ranges of ``time``, which prune row groups and files; columns ``year`` and
    ``month``, where the table is laid out by them, prune folders.
    """
    time = F.col("time")
    if years is not None:
        runs = []
        for y in sorted(set(years)):
            runs = [*runs[:-1], (runs[-1][0], y)] if runs and runs[-1][1] == y - 1 else [*runs, (y, y)]
        kind = df.schema["time"].dataType.simpleString()
        inside = F.lit(False)
        for first, last in runs:
            start, end = (F.lit(f"{y:04d}-01-01").cast(kind) for y in (first, last + 1))
            inside = inside | ((time >= start) & (time < end))
        df = df.where(inside if runs else F.lit(False))
        if "year" in df.columns:
            df = df.where(F.col("year").isin(*years))
    if months is not None:
        df = df.where(F.month(time).isin(*months))
        if "month" in df.columns:
            df = df.where(F.col("month").isin(*months))
    return df


def clean_grid(
    df: DataFrame, value_col: str | None = None, out_col: str = "temp_celsius",
    convert=kelvin_to_celsius, keys=("time", "lat", "lon"),
) -> DataFrame:
    """Convert the value, drop rows without one, keep one row per time and place.

    ``value_col`` defaults to the first known temperature column; other variables pass
    their own column and conversion. Of several rows for a key the one with the smallest
    raw value stays, which makes the choice repeatable.
    """
    source = value_col or first_present(df, TEMP_COLUMNS)
    places = [c for c in PLACE_COLUMNS if c in df.columns]
    raw = df.select(*places, coerce_double(F.col(source)).alias("_raw")).where("_raw IS NOT NULL")
    single = keep_first(raw, list(keys), ["_raw"])
    return single.select(*places, convert(F.col("_raw")).alias(out_col))


def bronze_to_silver(
    spark: SparkSession, root: str, source: str, target: str, fmt: str = "parquet", **options
) -> DataFrame:
    """Read a landed grid, keep a CSV copy for audit, write the cleaned one twice."""
    raw = read_grid(spark, zone_path(root, "bronze", source), fmt)
    write_csv(raw, zone_path(root, "bronze", f"{target}_raw_csv"))
    silver = zone_path(root, "silver", f"{target}_clean")
    write_parquet(clean_grid(raw, **options), silver)
    cleaned = spark.read.parquet(silver)
    write_csv(cleaned, zone_path(root, "silver", f"{target}_clean_csv"))
    return cleaned


def land_csv(
    spark: SparkSession, root: str, source: str, target: str, schema, **options
) -> tuple[DataFrame, DataFrame]:
    """Read a landed CSV by its declared types, keep the lines that do not fit beside it, write the
    cleaned rows to silver as Parquet and as CSV, and read both of those back.

    Returns (silver rows, rejected lines). The silver CSV is read by the types of the Parquet copy
    and must hold the same rows; a line of it that does not fit fails the landing.
    """
    typed = read_typed_csv(spark, zone_path(root, "bronze", source), schema)
    sound, rejected = sound_lines(typed)
    refused = zone_path(root, "bronze", f"{target}_rejected")
    write_parquet(rejected, refused)
    silver = zone_path(root, "silver", f"{target}_clean")
    write_parquet(clean_grid(sound, **options), silver)
    cleaned = spark.read.parquet(silver)
    write_csv(cleaned, zone_path(root, "silver", f"{target}_clean_csv"))
    again, broken = sound_lines(read_typed_csv(spark, zone_path(root, "silver", f"{target}_clean_csv"), cleaned.schema))
    n = again.count()
    if not broken.isEmpty() or n != cleaned.count():
        raise ValueError(f"{target}: the silver CSV does not hold the rows of the Parquet copy")
    return again, spark.read.parquet(refused)


#: Layout of a landed grid that is asked for by period and box: folders by year and month, rows by
#: latitude in small pages, so that whole folders, row groups and pages can be left out.
PAGE_ROWS = 500


def write_grid(df: DataFrame, path: str, page_rows: int = PAGE_ROWS) -> None:
    rows = df.withColumns({"year": F.year("time"), "month": F.month("time")})
    (
        rows.hint("rebalance", "year", "month").sortWithinPartitions("year", "month", "lat", "lon")
        .write.mode("overwrite").option("parquet.page.row.count.limit", page_rows)
        .partitionBy("year", "month").parquet(path)
    )


def requested(df: DataFrame, years=None, months=None, **box) -> DataFrame:
    """Rows of a landed grid by years, months and box (north, west, south, east) together."""
    rows = select_period(df, years, months)
    return bbox_filter(rows, **box) if box else rows
