"""Joins that hold up when one key carries a large share of the rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

SALTS = 16


def closed_domain(df: DataFrame, key: str, values) -> DataFrame:
    """One row per value of a closed list at most: the proof a broadcast needs.

    Rows outside the list go; several rows for one value are an error.
    """
    rest = [c for c in df.columns if c != key]
    repeated = F.raise_error(F.concat(F.lit(f"repeated {key}: "), F.col(key).cast("string")))
    return (
        df.where(F.col(key).isin(*values))
        .groupBy(key)
        .agg(F.min(F.struct(*rest)).alias("_row"), F.count("*").alias("_n"))
        .withColumn("_row", F.when(F.col("_n") == 1, F.col("_row")).otherwise(repeated))
        .select(key, *[F.col(f"_row.{c}").alias(c) for c in rest])
    )


CARDINALITIES = ("one_to_one", "one_to_many", "many_to_one")


def unique_by(df: DataFrame, keys: list[str], what: str = "rows") -> DataFrame:
    """The same rows; the plan fails, naming a key, as soon as a key occurs twice.

    A row with a NULL in its key matches nothing in a join and is not counted. The count needs
    the rows of a key together and sorted, as a join by that key does anyway.
    """
    together = Window.partitionBy(*keys)
    named = F.concat(F.lit(f"repeated key in {what}: "), F.to_json(F.struct(*keys)))
    known = F.lit(True)
    for key in keys:
        known = known & F.col(key).isNotNull()
    single = F.when(~known | (F.col("_times") == 1), True).otherwise(F.raise_error(named).cast("boolean"))
    return df.withColumn("_times", F.count(F.lit(1)).over(together)).where(single).drop("_times")


def checked_join(
    left: DataFrame, right: DataFrame, on: list[str], how: str = "left", validate: str = "many_to_one",
) -> DataFrame:
    """Equi-join with a declared cardinality, checked inside the plan: a key that repeats on a side
    declared ``one`` fails the job instead of multiplying rows."""
    if validate not in CARDINALITIES:
        raise ValueError(f"validate must be one of {CARDINALITIES}, got {validate!r}")
    if validate.startswith("one"):
        left = unique_by(left, on, "the left table")
    if validate.endswith("one"):
        right = unique_by(right, on, "the right table")
    return left.join(right, on, how)


def key_counts(df: DataFrame, keys: list[str]) -> DataFrame:
    """One row: ``n_rows``, ``n_keys``, ``n_repeated`` keys and the ``n_offending`` rows they hold."""
    per_key = df.groupBy(*keys).agg(F.count("*").alias("_n"))
    repeated = F.col("_n") > 1
    for key in keys:
        repeated = repeated & F.col(key).isNotNull()
    return per_key.agg(
        F.coalesce(F.sum("_n"), F.lit(0)).alias("n_rows"), F.count("*").alias("n_keys"),
        F.count_if(repeated).alias("n_repeated"),
        F.coalesce(F.sum(F.when(repeated, F.col("_n"))), F.lit(0)).alias("n_offending"))


def spread_join(
    big: DataFrame, small: DataFrame, keys: list[str], spread_on: list[str],
    how: str = "left", salts: int = SALTS,
) -> DataFrame:
    """Equi-join of a table with hot keys to a look-up table of unproven size.

    Each key of ``big`` is split over ``salts`` buckets by a hash of ``spread_on`` and
    ``small`` is repeated once per bucket, so no task gets a whole hot key. The hash
    depends on the row alone, hence a repeated task puts it in the same bucket.
    Adaptive execution still turns this into a broadcast where ``small`` proves small.
    """
    salted = big.withColumn("_salt", F.pmod(F.xxhash64(*spread_on), F.lit(salts)))
    copies = small.withColumn(
        "_salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(salts - 1).cast("long")))
    )
    return salted.join(copies, [*keys, "_salt"], how).drop("_salt")
