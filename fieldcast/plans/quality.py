"""Checks of fact rows before they replace stored ones."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from fieldcast.functions import is_true
from fieldcast.schemas import FACT_KEY
from fieldcast.settings import STATUSES

PARTITION = ["crop_id", "horizon_year"]
RULES = (
    "duplicate_key", "unknown_status", "negative_base_area", "negative_fut_area",
    "negative_new_area", "score_out_of_range", "incomplete_not_lost",
)


def duplicate_keys(fact: DataFrame, key=FACT_KEY) -> DataFrame:
    """Business keys that occur more than once."""
    return fact.groupBy(*key).agg(F.count("*").alias("n_rows")).where("n_rows > 1")


def first_duplicates(fact: DataFrame, key=FACT_KEY, n: int = 10) -> DataFrame:
    """The first ``n`` repeated keys in order, with their number of rows."""
    return duplicate_keys(fact, key).orderBy(*key).limit(n)


def emptiness(frames: dict[str, DataFrame]) -> DataFrame:
    """``(name, is_empty)``: whether a frame has any row at all, by one row of each."""
    parts = [
        df.limit(1).agg((F.count(F.lit(1)) == 0).alias("is_empty")).select(F.lit(name).alias("name"), "is_empty")
        for name, df in frames.items()]
    return reduce(DataFrame.unionByName, parts)


def duplicate_examples(fact: DataFrame, key=FACT_KEY, n: int = 10) -> list[tuple]:
    """A few duplicate keys for an error message."""
    return [tuple(r)[:-1] for r in first_duplicates(fact, key, n).collect()]


def fact_violations(fact: DataFrame) -> DataFrame:
    """``(crop_id, horizon_year, n_rows, rule, violations)`` for all rules in one pass.

    Rows are first counted per key, which finds duplicates and sums the other rules on the
    way; the second grouping adds up those sums per crop and horizon.
    """
    broken = {
        "unknown_status": ~F.col("status").isin(*STATUSES),
        "negative_base_area": F.col("base_area") < 0,
        "negative_fut_area": F.col("fut_area") < 0,
        "negative_new_area": F.col("new_area") < 0,
        "score_out_of_range": ~F.col("fit_score_fut").between(0.0, 100.0),
        "incomplete_not_lost": F.col("is_grown")
        & ~is_true(F.col("climate_complete"))
        & ~is_true(F.col("status") == "lost"),
    }
    per_key = fact.groupBy(*FACT_KEY).agg(
        F.count("*").alias("n_rows"),
        *[F.count_if(rule).alias(name) for name, rule in broken.items()],
    ).withColumn("duplicate_key", F.when(F.col("n_rows") > 1, F.col("n_rows")).otherwise(0))
    sums = per_key.groupBy(*PARTITION).agg(
        F.sum("n_rows").alias("n_rows"), *[F.sum(r).alias(r) for r in RULES]
    )
    return sums.unpivot([*PARTITION, "n_rows"], list(RULES), "rule", "violations")


def partition_summary(fact: DataFrame) -> DataFrame:
    """Cells by status and areas per crop and horizon."""
    return fact.groupBy(*PARTITION).agg(
        F.count("*").alias("n_cells"),
        *[F.count_if(F.col("status") == s).alias(f"n_{s}") for s in ("kept", "lost", "new")],
        F.coalesce(F.sum("base_area"), F.lit(0.0)).alias("base_area"),
        F.coalesce(F.sum("fut_area"), F.lit(0.0)).alias("fut_area"),
    )


def status_domain(fact: DataFrame) -> DataFrame:
    return fact.select("status").distinct()
