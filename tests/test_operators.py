import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from fieldcast.operators.climate import bias_correct, complete_seasons, monthly_climate, seasonal_climate
from fieldcast.operators.dedupe import keep_first, keep_largest
from fieldcast.operators.footprint import plot_footprint, plot_stats
from fieldcast.operators.joins import checked_join, closed_domain, key_counts, spread_join
from fieldcast.operators.mesh import assign_cell, candidates, mesh_step_km
from fieldcast.operators import quantiles
from fieldcast.operators.quantiles import exact_quantiles, quantile_table
from fieldcast.operators.staging import stage, staging_root
from fieldcast.operators.thermal import (
    check_delta, thermal_area_share, thermal_exposure, thermal_months, worst_month,
)


def table(df, *keys):
    return {tuple(r[k] for k in keys): r.asDict() for r in df.collect()}


def test_seasons(spark):
    rows = [(1, 2054, m, t, 10.0, 200.0) for m, t in
            [(4, 10.0), (4, 20.0), (5, 30.0), (6, 30.0), (7, 30.0), (8, 30.0), (9, 99.0), (3, 99.0)]]
    rows += [(2, 2054, m, 20.0, None, 200.0) for m in (4, 5, 6, 7)]
    df = spark.createDataFrame(rows, "cell_id int, year int, month int, temp double, rain double, sun double")
    months = table(monthly_climate(df), "cell_id", "month")
    assert len(months) == 9 and months[1, 4]["temp"] == 15.0
    seasons = table(seasonal_climate(df, [2054]), "cell_id")
    one, two = seasons[1,], seasons[2,]
    assert (one["temp_avg"], one["temp_peak"], one["rain"], one["n_months"]) == (27.0, 30.0, 50.0, 5)
    assert one["sun"] == pytest.approx(734.4) and one["sun_mean"] == 200.0
    assert two["n_months"] == 4 and two["rain"] is None
    assert complete_seasons(seasonal_climate(df)).count() == 1
    assert seasonal_climate(df, (2055, 2060)).count() == 0
    assert bias_correct(df) is df
    assert table(seasonal_climate(bias_correct(df, -0.9)), "cell_id")[1,]["temp_avg"] == 26.1


def test_season_on_a_bound_does_not_depend_on_row_order(spark):
    values = [0.1, 0.2, 0.3, 1e3, -1e3, 0.7, 21.7]
    rows = [(c, 2054, m, v, 1.0, 1.0) for c in range(6) for m in (4, 5, 6, 7, 8)
            for v in random.Random(c).sample(values, len(values))]
    df = spark.createDataFrame(rows, "cell_id int, year int, month int, temp double, rain double, sun double")
    assert seasonal_climate(df.repartition(7)).select("temp_avg").distinct().count() == 1


def test_footprint(tables):
    got = table(plot_footprint(tables.plots), "crop_id", "cell_id")
    assert got[1, 1]["area"] == 12.0 and got[1, 1]["plot_count"] == 2 and (2, 2) not in got
    assert (2, 2) in table(plot_footprint(tables.plots, positive_only=False), "crop_id", "cell_id")
    stats = table(plot_stats(tables.plots), "crop_id")[1,]
    assert (stats["n_plots"], stats["n_cells"], stats["total_area"]) == (6, 5, 79.0)


def test_dedupe(spark):
    df = spark.createDataFrame(
        [(1, 5, "b"), (1, 5, "a"), (1, None, "z"), (2, 3, "c"), (2, 2, "d")], "k int, o int, v string")
    assert {tuple(r) for r in keep_first(df, ["k"], ["o"]).collect()} == {(1, None, "z"), (2, 2, "d")}
    assert {tuple(r) for r in keep_first(df.drop("v"), ["k"], ["o"]).collect()} == {(1, None), (2, 2)}
    assert keep_first(df.select("k"), ["k"], ["k"]).count() == 2
    best = keep_largest(df, ["k"], [F.col("o"), F.col("v")])
    assert {tuple(r) for r in best.collect()} == {(1, 5, "b"), (2, 3, "c")}


def test_joins_with_a_hot_key(spark):
    big = spark.range(3000).select(
        "id", F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id")).alias("k"))
    small = spark.createDataFrame([(7, "x"), (8, "y"), (9999, "z")], "k long, t string")
    got = spread_join(big, small, ["k"], ["id"])
    assert got.count() == 3000 and got.where("t = 'x'").count() == 1001 and got.where("t IS NULL").count() == 1998
    assert got.columns == ["k", "id", "t"]
    assert spread_join(big, small, ["k"], ["id"], how="inner").count() == 1002
    twice = spark.createDataFrame([(1, "b"), (1, "a"), (2, "c"), (3, "d")], "k int, t string")
    assert {tuple(r) for r in closed_domain(twice, "k", (2, 3)).collect()} == {(2, "c"), (3, "d")}
    with pytest.raises(Exception, match="repeated k: 1"):
        closed_domain(twice, "k", (1, 2)).collect()


@pytest.mark.parametrize("most", [10_000, 40, 1])
@pytest.mark.parametrize("way", [
    {"small_domain": True}, {"small_domain": False}, {"spread_on": ["r"]},
])
def test_exact_quantiles(spark, way, most):
    """With 40, groups of more than 40 rows are narrowed; with 1 all, down to single values."""
    rng = np.random.default_rng(5)
    groups = {
        1: rng.normal(size=1), 2: rng.normal(size=2), 3: rng.normal(size=39),
        4: rng.normal(size=5000), 5: np.repeat([1.0, 2.0], 900), 6: np.arange(777.0),
        7: np.r_[np.zeros(400), 5e-324, -5e-324, 1e308, -1e308, 10.0 ** rng.uniform(-300, 300, 300)],
        8: np.r_[1.0 + np.arange(300) * 2.0**-52, np.repeat(3.0, 500)],
        10: np.array([float("-inf"), 0.0, 1.0, 1.5, float("inf")]),
    }
    rows = [(k, float(v)) for k, vs in groups.items() for v in vs]
    rows += [(4, None), (4, float("nan")), (None, 1.0), (9, None)]
    df = spark.createDataFrame(
        [(*row, i) for i, row in enumerate(rows)], "k int, v double, r int").repartition(5)
    probs = [0.0, 0.01, 0.5, 0.9, 0.99, 1.0]
    got = table(exact_quantiles(df, ["k"], "v", probs, most=most, **way), "k", "prob")
    assert {k for k, _ in got} == set(groups)
    for k, values in groups.items():
        for p in probs:
            row = got[k, p]
            assert row["n"] == len(values)
            if k == 10:  # numpy subtracts infinities
                assert row["quantile"] == {0.0: -math.inf, 0.01: -math.inf, 0.5: 1.0, 0.9: math.inf, 0.99: math.inf, 1.0: math.inf}[p]
            else:
                assert row["quantile"] == pytest.approx(np.quantile(values, p), rel=1e-12, abs=1e-12)


@pytest.mark.parametrize("n", [1_000_000, 8_000_000])
def test_ranges_of_one_large_group_stay_bounded(spark, n):
    """Whatever its size, at most ``MOST`` rows of a group and ``BINS`` counts meet in a window."""
    rows = spark.range(n, numPartitions=8).select(
        F.lit(1).alias("k"), (F.pow(F.col("id") * 7919 % n / n, 3.0) * 1e6).alias("_v"),
        F.lit(1).cast("long").alias("_w"), F.col("id").alias("_spread"))
    groups = rows.groupBy("k").agg(F.count("*").alias("_n"), F.min("_v").alias("_lo"), F.max("_v").alias("_hi"))
    probs = [0.01, 0.5, 0.99]
    for small_domain in (True, False):
        ranges = quantiles.narrowed(stage(rows, "rows"), stage(groups, "groups"), ["k"], probs, small_domain, quantiles.MOST).collect()
        assert len(ranges) == 6 and all(r["_inside"] <= quantiles.MOST and r["_before"] <= r["_rank"] < r["_before"] + r["_inside"] for r in ranges)
    bins = quantiles._inside(rows, groups, ["k"], True).select(
        quantiles._bin(F.col("_v"), F.col("_lo"), F.col("_hi")).alias("b")).agg(F.min("b"), F.max("b")).first()
    assert tuple(bins) == (0, quantiles.BINS - 1)
    got = exact_quantiles(rows.withColumnsRenamed({"_v": "v", "_spread": "r"}), ["k"], "v", probs, spread_on=["r"]).collect()
    for row in got:
        place = row["prob"] * (n - 1)
        low, high = ((math.floor(place) + e) / n for e in (0, 1))
        want = (low**3 + (high**3 - low**3) * (place - math.floor(place))) * 1e6
        assert row["n"] == n and row["quantile"] == pytest.approx(want, rel=1e-9)


def test_quantile_table(spark):
    df = spark.createDataFrame([(1, 1.0, 5.0), (1, 2.0, None), (1, 4.0, 7.0), (1, 9.0, 9.0)], "k int, a double, b double")
    row = quantile_table(df, ["k"], {"lo": ("a", 0.01), "hi": ("a", 0.99), "mb": ("b", 0.5)}).first()
    assert row["lo"] == pytest.approx(1.03) and row["hi"] == pytest.approx(8.85) and row["mb"] == 7.0


def test_stage_reads_the_shared_folder(spark):
    assert staging_root(spark) == spark.conf.get("spark.checkpoint.dir")
    staged = stage(spark.range(5), "five")
    assert staged.count() == 5
    assert all(f.startswith(("file:" + staging_root(spark), staging_root(spark)))
               or staging_root(spark) in f for f in staged.inputFiles())


def test_thermal(spark, tables, run):
    assert {r[0] for r in thermal_months(tables, run).select("horizon_year").distinct().collect()} == {2054, 2084}
    months = thermal_months(tables, run, [2054])
    rows = table(months, "crop_id", "cell_id", "month")
    assert (1, 4, 4) not in rows  # no future climate
    assert rows[1, 6, 4]["base_temp"] is None and rows[1, 6, 4]["fut_temp"] == 15.0
    assert rows[2, 2, 8]["area"] == 0.0  # plots without an area count here
    hot = spark.createDataFrame(
        [(1, c, 45.0, 1.0, m, t, t, 1, 10.0 * c) for c, m, t in
         [(1, 4, 33.0), (1, 5, 33.0), (1, 6, 31.0), (2, 4, 30.0), (2, 5, 30.1), (3, 4, 32.0), (4, 4, None)]],
        "crop_id int, cell_id long, lat double, lon double, month int, base_temp double, fut_temp double, plot_count long, area double"
    ).withColumn("horizon_year", F.lit(2054))
    no_limit = tables.constraints.withColumn("temp_opt_max", F.lit(None).cast("long"))
    worst = worst_month(thermal_exposure(hot, no_limit, run, deltas=(0.0, 2.0)))
    got = table(worst, "scenario", "delta", "cell_id")
    one = got["observed", 0.0, 1]
    assert (one["month_name"], one["thermal_class"], one["severity"]) == ("April", "fatal", 3)
    assert got["projected", 0.0, 2]["thermal_class"] == "critical" and got["projected", 0.0, 2]["month"] == 5
    assert got["projected", 0.0, 3]["thermal_class"] == "critical"
    assert got["warming", 2.0, 2]["thermal_class"] == "fatal"
    assert got["observed", 0.0, 4]["thermal_class"] == "missing"
    share = table(thermal_area_share(worst), "scenario", "delta", "thermal_class")
    assert share["observed", 0.0, "viable"]["area"] == 0.0
    assert share["observed", 0.0, "critical"]["share_pct"] == pytest.approx(50.0)
    with pytest.raises(ValueError):
        check_delta(0.3)
    with pytest.raises(ValueError):
        check_delta(20.5)


def test_assign_cell_against_brute_force(spark):
    rng = random.Random(3)
    mesh = [(i, 40 + rng.random() * 3, rng.random() * 3) for i in range(60)] + [(99, 41.0, 1.0), (98, 41.0, 1.0)]
    points = [(i, 40 + rng.random() * 3, rng.random() * 3) for i in range(150)]
    points += [(1000 + i, 41.0, 1.0) for i in range(100)] + [(5000, 60.0, 60.0)]
    got = table(assign_cell(
        spark.createDataFrame(points, "point_id long, lat double, lon double"),
        spark.createDataFrame(mesh, "cell_id long, lat double, lon double"), 30.0), "point_id")
    assert len(got) == len(points)

    def km(lat, lon, a, b):
        h = (math.sin(math.radians(a - lat) / 2) ** 2 + math.cos(math.radians(lat)) * math.cos(math.radians(a))
             * math.sin(math.radians(b - lon) / 2) ** 2)
        return round(2 * 6371.0 * math.asin(math.sqrt(h)), 6)

    for p, lat, lon in points:
        near = min((km(lat, lon, a, b), c) for c, a, b in mesh)
        assert got[p,]["cell_id"] == (near[1] if near[0] <= 30.0 else None)


def test_assign_cell_on_a_fine_mesh(spark):
    """The pairs of a point stay few however many cells lie within the radius."""
    mesh = spark.range(10_000).select(
        F.col("id").alias("cell_id"), (45 + F.col("id") % 100 * 0.003).alias("lat"),
        (5 + F.floor(F.col("id") / 100) * 0.003).alias("lon"))
    points = spark.range(500).select(
        F.col("id").alias("point_id"), (45.01 + F.col("id") * 0.0005).alias("lat"), (5.01 + F.col("id") * 0.0005).alias("lon"))
    found = assign_cell(points, mesh, 40.0)
    rows = found.collect()
    assert len(rows) == 500 and all(r["distance"] < 0.3 for r in rows)
    pairs = candidates(points, mesh, mesh_step_km(mesh)).count()
    assert 500 < pairs <= 500 * 40  # of 5 million pairs within the radius
    twice = points.unionByName(points.limit(1))
    with pytest.raises(Exception, match="repeated point_id"):
        assign_cell(twice, mesh, 40.0).collect()


def test_tidy_keeps_large_values_and_nan(spark):
    from fieldcast.catalog.queries import tidy

    rows = tidy(spark.createDataFrame([(1e15,), (-1e20,), (float("nan"),), (1.234567,), (None,)], "x double")).collect()
    got = [r["x"] for r in rows]
    assert got[0] == 1e15 and got[1] == pytest.approx(-1e20) and math.isnan(got[2]) and got[3] == 1.23457 and got[4] is None


def test_checked_join(spark):
    left = spark.createDataFrame([(1, "a"), (2, "b"), (2, "c"), (None, "d"), (None, "e")], "k int, t string")
    right = spark.createDataFrame([(1, "x"), (3, "z"), (None, "n"), (None, "m")], "k int, u string")
    got = checked_join(left, right, ["k"])
    assert got.columns == ["k", "t", "u"] and got.count() == 5 and got.where("u IS NOT NULL").count() == 1
    assert checked_join(left, right, ["k"], "inner").count() == 1
    with pytest.raises(Exception, match=r'repeated key in the left table: .*"k":2'):
        checked_join(left, right, ["k"], validate="one_to_one").collect()
    with pytest.raises(Exception, match=r'repeated key in the right table: .*"k":2'):
        checked_join(right, left, ["k"]).count()
    assert checked_join(right, left, ["k"], "inner", "one_to_many").count() == 1
    with pytest.raises(ValueError, match="many_to_many"):
        checked_join(left, right, ["k"], validate="many_to_many")
    assert tuple(key_counts(left, ["k"]).first()) == (5, 3, 1, 2)
    assert tuple(key_counts(left.where("false"), ["k"]).first()) == (0, 0, 0, 0)
