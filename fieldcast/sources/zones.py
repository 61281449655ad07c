"""Landing zones and their file sinks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

from fieldcast.operators.staging import stage

ZONES = ("bronze", "silver", "gold")


def zone_path(root: str, zone: str, name: str) -> str:
    """Path of a data set in a zone; ``root`` may be any URI Spark can reach."""
    if zone not in ZONES:
        raise ValueError(f"unknown zone: {zone}")
    return f"{root.rstrip('/')}/{zone}/{name}"


def read_grid(spark: SparkSession, path: str, fmt: str = "parquet", schema=None) -> DataFrame:
    """A gridded variable already in long form: one row per time, lat and lon."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    if fmt == "csv":
        return reader.option("header", True).csv(path)
    return reader.format(fmt).load(path)


REJECTED = "_rejected_line"


def read_typed_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A CSV with its declared types. A line that does not fit them, in the number of fields or in
    any value, has all of its text in ``_rejected_line``; that of a sound line is NULL."""
    typed = T.StructType([*schema.fields, T.StructField(REJECTED, T.StringType())])
    return (
        spark.read.schema(typed).option("header", True).option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", REJECTED).csv(path)
    )


def sound_lines(typed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows that fit, text of the lines that do not), of a frame from ``read_typed_csv``.

    The parser looks only at the columns that a query needs, so the lines are parsed once with all
    of them into a staged table; both results come from there.
    """
    whole = stage(typed, "typed-lines")
    return (
        whole.where(F.col(REJECTED).isNull()).drop(REJECTED),
        whole.where(F.col(REJECTED).isNotNull()).select(REJECTED),
    )


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)


def write_parquet(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)
