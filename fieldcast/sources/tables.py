"""The input tables of a run."""

from __future__ import annotations

from dataclasses import dataclass, fields

from pyspark.sql import DataFrame, SparkSession, functions as F

from fieldcast.functions import nan_to_null
from fieldcast.schemas import INPUT_SCHEMAS, require_columns


@dataclass(frozen=True)
class Tables:
    constraints: DataFrame
    coordinates: DataFrame
    soils: DataFrame
    climate_past: DataFrame
    climate_future: DataFrame
    plots: DataFrame
    yields: DataFrame

    by_cell = False  # whether rows lie by cell already, see write_cell_tables

    def checked(self) -> "Tables":
        for field in fields(self):
            require_columns(
                getattr(self, field.name), INPUT_SCHEMAS[field.name].fieldNames(), field.name
            )
        return self


def read_table(spark: SparkSession, root: str, name: str) -> DataFrame:
    """One input table with its declared schema; NaN reads as NULL."""
    return nan_to_null(
        spark.read.schema(INPUT_SCHEMAS[name]).parquet(f"{root.rstrip('/')}/{name}")
    )


def read_tables(spark: SparkSession, root: str) -> Tables:
    """All input tables below a folder (any file system Spark can reach)."""
    return Tables(**{name: read_table(spark, root, name) for name in INPUT_SCHEMAS})


def read_catalog_tables(spark: SparkSession, database: str) -> Tables:
    """All input tables from a catalog database."""
    return Tables(
        **{n: nan_to_null(spark.table(f"{database}.{n}")) for n in INPUT_SCHEMAS}
    ).checked()


def read_query(spark: SparkSession, sql: str, params: dict | None = None) -> DataFrame:
    """A SQL text with ``:name`` markers; values are bound, never pasted in."""
    return spark.sql(sql, args=params or {})


def ordered_constraints(constraints: DataFrame) -> DataFrame:
    return constraints.orderBy("crop_id")


def write_climate(df: DataFrame, path: str) -> None:
    """Climate table laid out for the season scans: a folder per year, pruned as a whole,
    and rows sorted by month, so that row groups of other months are skipped.

    The rebalance hint splits a year too large for one file and merges small ones.
    """
    (
        df.hint("rebalance", "year")
        .sortWithinPartitions("year", "month", "cell_id")
        .write.mode("overwrite").partitionBy("year").parquet(path)
    )


def write_tables(tables: Tables, root: str) -> None:
    for field in fields(tables):
        df, path = getattr(tables, field.name), f"{root.rstrip('/')}/{field.name}"
        if field.name.startswith("climate"):
            write_climate(df, path)
        else:
            df.write.mode("overwrite").parquet(path)


class CellTables(Tables):
    """Tables whose scans come partitioned by cell."""

    by_cell = True


CELL_ORDER = {"climate_past": ["cell_id", "year", "month"], "climate_future": ["cell_id", "year", "month"]}


def write_cell_tables(tables: Tables, database: str, buckets: int) -> None:
    """Catalog tables bucketed and sorted by cell, constraints aside.

    A season or footprint of a cell then needs no exchange, nor does any join by cell. The number
    of buckets should be that of the shuffle partitions of the runs to come: fewer would be dealt
    out anew. Rows are first dealt out by the same key, so that a bucket is one file.
    """
    for field in fields(tables):
        df = getattr(tables, field.name)
        if field.name == "constraints":
            df.write.mode("overwrite").saveAsTable(f"{database}.{field.name}")
            continue
        rows = df.withColumn("cell_id", F.col("cell_id").cast("long")).repartition(buckets, "cell_id")
        order = CELL_ORDER.get(field.name, ["cell_id"])
        rows.write.mode("overwrite").bucketBy(buckets, "cell_id").sortBy(*order).saveAsTable(
            f"{database}.{field.name}")


def read_cell_tables(spark: SparkSession, database: str) -> CellTables:
    return CellTables(**{
        field.name: nan_to_null(spark.table(f"{database}.{field.name}")) for field in fields(CellTables)})


def missing_crops(constraints: DataFrame, crops) -> DataFrame:
    """Requested crops that have no constraint row."""
    wanted = constraints.sparkSession.createDataFrame(
        [(int(c),) for c in crops], "crop_id int"
    )
    known = constraints.select(F.expr("try_cast(crop_id AS int)").alias("crop_id"))
    return wanted.join(known, "crop_id", "left_anti")
