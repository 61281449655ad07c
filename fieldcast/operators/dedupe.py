"""Keep one row per key, chosen by a total order.

Both are aggregations of a struct, not sorted windows: every task first reduces its
own rows, so a key with very many copies costs no more than any other.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def keep_first(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The row with the smallest ``order`` columns (NULL first) per key; the remaining
    columns break ties, so the result does not depend on the input order."""
    rest = [c for c in df.columns if c not in keys and c not in order]
    ranked = [c for c in order if c not in keys] + rest
    if not ranked:
        return df.select(*keys).distinct().select(df.columns)
    if len(ranked) == 1:  # a plain minimum aggregates by hash, a struct needs a sort
        one = ranked[0]
        smallest = F.when(F.count("*") == F.count(one), F.min(one))
        return df.groupBy(*keys).agg(smallest.alias(one)).select(df.columns)
    best = df.groupBy(*keys).agg(F.min(F.struct(*ranked)).alias("_row"))
    return best.select(
        *[F.col(c) if c in keys else F.col(f"_row.{c}").alias(c) for c in df.columns]
    )


def keep_largest(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """The row with the largest ``order`` expressions (NULL last) per key. The order must
    be total within a key."""
    rest = [c for c in df.columns if c not in keys]
    best = df.groupBy(*keys).agg(
        F.max_by(F.struct(*rest), F.struct(*order)).alias("_row")
    )
    return best.select(
        *[F.col(c) if c in keys else F.col(f"_row.{c}").alias(c) for c in df.columns]
    )
