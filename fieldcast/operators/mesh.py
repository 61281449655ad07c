"""Re-gridding: the nearest mesh cell of each point within a radius."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, functions as F

from fieldcast.operators.staging import stage

EARTH_RADIUS_KM = 6371.0
DIGITS = 6  # distances that agree to so many decimals (of a kilometre) are ties


def great_circle_km(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Distance on the sphere, by the haversine of the difference."""
    north = F.sin(F.radians(lat2 - lat1) / 2)
    east = F.sin(F.radians(lon2 - lon1) / 2)
    h = north * north + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * east * east
    return F.lit(2 * EARTH_RADIUS_KM) * F.asin(F.sqrt(F.least(h, F.lit(1.0))))


def _cube(side: float, lat: str, lon: str) -> list[Column]:
    """The cube of a place among cubes of one side length in space: no seam and no narrow
    squares near the poles."""
    flat = F.cos(F.radians(lat)) * EARTH_RADIUS_KM
    place = [flat * F.cos(F.radians(lon)), flat * F.sin(F.radians(lon)), F.sin(F.radians(lat)) * EARTH_RADIUS_KM]
    return [F.floor(p / F.lit(side)) for p in place]


def mesh_step_km(mesh: DataFrame) -> float:
    """Mean distance of neighbouring mesh cells, from the area that the mesh spans."""
    row = mesh.select("lat", "lon").distinct().agg(
        F.count("*"), F.min("lat"), F.max("lat"), F.min("lon"), F.max("lon")).first()
    n, south, north, west, east = row
    if not n or north is None:
        return EARTH_RADIUS_KM
    height = math.radians(north - south) * EARTH_RADIUS_KM
    width = math.radians(east - west) * EARTH_RADIUS_KM * math.cos(math.radians((north + south) / 2))
    return max(math.sqrt(max(height, 1e-3) * max(width, 1e-3) / n), 1e-3)


def candidates(points: DataFrame, places: DataFrame, side: float) -> DataFrame:
    """Points with the mesh cells of their cube and those around it, and the distance ``_km``."""
    keys = ["_x", "_y", "_z"]
    step = F.sequence(F.lit(-1).cast("long"), F.lit(1).cast("long"))
    spread = places.select(
        F.col("lat").alias("_lat"), F.col("lon").alias("_lon"), F.col("cell_id").alias("_cell"))
    for key, cube in zip(keys, _cube(side, "_lat", "_lon")):
        spread = spread.withColumn("_step", F.explode(step)).withColumn(key, cube + F.col("_step"))
    located = points.withColumns(dict(zip(keys, _cube(side, "lat", "lon"))))
    # Sorted, as the copies around each cell escape Spark's size estimate; adaptive execution
    # splits a cube that points crowd in.
    return located.join(spread.drop("_step").hint("merge"), keys, "left").withColumn(
        "_km", great_circle_km(F.col("lat"), F.col("lon"), F.col("_lat"), F.col("_lon"))).drop(*keys)


def assign_cell(
    points: DataFrame, mesh: DataFrame, radius_km: float, point_id: str = "point_id",
    step_km: float | None = None,
) -> DataFrame:
    """Add ``cell_id`` and ``distance`` (km) of the nearest mesh cell to each point.

    The search begins in cubes of the mesh step (``step_km``, measured on the mesh if not
    given): a hit within the side of a cube is the nearest cell. Points without one are sought
    in cubes of twice the side, and so on up to the radius, so a fine mesh does not multiply the
    pairs of points that lie in it. Cells at one place count once; the lower number wins a tie.
    A point with no cell in reach keeps NULL. ``point_id`` must be unique: repeats are an error.
    """
    radius_km = float(radius_km)
    if not radius_km > 0:
        raise ValueError("radius must be above zero")
    side = min(radius_km, step_km or mesh_step_km(mesh))
    places = mesh.groupBy("lat", "lon").agg(F.min("cell_id").alias("cell_id"))
    candidate = F.struct(F.round("_km", DIGITS).alias("distance"), F.col("_cell").alias("cell_id"))
    left, found = points, None
    while True:
        best = candidates(left, places, side).groupBy(point_id).agg(
            F.min(F.when(F.col("_km") <= side, candidate)).alias("_best"),
            *[F.first(c).alias(c) for c in left.columns if c != point_id])
        last = side >= radius_km
        best = best if last else stage(best, "mesh-search")
        done = best if last else best.where("_best IS NOT NULL")
        done = done.select(*points.columns, "_best.cell_id", "_best.distance")
        found = done if found is None else found.unionByName(done)
        if last:
            break
        left = best.where("_best IS NULL").select(*points.columns)
        side = min(2 * side, radius_km)
    repeated = F.raise_error(F.concat(F.lit(f"repeated {point_id}: "), F.col(point_id).cast("string")))
    twice = points.groupBy(point_id).agg(F.count("*").alias("_n"))
    checked = twice.select(
        point_id, F.when(F.col("_n") == 1, F.lit(True)).otherwise(repeated.cast("boolean")).alias("_once"))
    return found.join(checked, point_id).where("_once").select(*points.columns, "cell_id", "distance")
