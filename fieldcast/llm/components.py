"""Connected components of a graph given as pairs of long ids."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from fieldcast.llm.common import write_shared


def _state(edges: DataFrame):
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def components(edges: DataFrame, most_rounds: int = 60) -> DataFrame:
    """(u, root) for every node of ``edges`` (columns u, v) but the roots themselves; the root
    is the smallest node of the component.

    Rounds of large-star and small-star, each a minimum per node (with map-side partial
    minima) and a join back, so that a node with very many neighbours is never gathered in
    one task. Every round is a written table: its lineage is one round long.
    """
    edges = write_shared(
        edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        .distinct(), "edges",
    )
    before = _state(edges)
    for _ in range(most_rounds):
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = (
            both.where("v > u").join(least, "u")
            .select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        )
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (
            large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
            .where("u <> v").unionByName(least.withColumnRenamed("m", "v")).distinct()
        )
        edges = write_shared(small, "edges")
        after = _state(edges)
        if after == before:
            return edges.withColumnRenamed("v", "root")
        before = after
    raise RuntimeError(f"components did not settle in {most_rounds} rounds")
