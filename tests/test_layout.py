import numpy as np
import pytest
from pyspark.sql import functions as F

from fieldcast.operators.climate import seasonal_climate, tagged_seasons
from fieldcast.operators.distinct import bit_counts, merged_bitmaps, number_bitmaps
from fieldcast.operators.footprint import distinct_counts, per_cell_map, plot_footprint, plot_stats
from fieldcast.plans.suitability import cell_crop_horizons, suitability
from fieldcast.sources.tables import read_cell_tables, write_cell_tables


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def rows_of(df):
    return sorted(map(str, df.collect()))


# --- bitmaps -----------------------------------------------------------------------------------

def test_bitmap_counts_equal_distinct_counts(spark):
    rng = np.random.default_rng(3)
    rows = [(int(k), int(v)) for k, v in zip(rng.integers(0, 4, 3000), rng.choice([-40_000, 5, 10**12], 3000) + rng.integers(0, 900, 3000))]
    rows += [(9, None), (None, 7), (None, None), (1, -1), (1, 0)]
    df = spark.createDataFrame(rows, "k int, v long").repartition(5)
    maps = number_bitmaps(df, ["k"], "v")
    want = {r[0]: r[1] for r in df.groupBy("k").agg(F.count_distinct("v")).collect() if r[1]}
    assert {r[0]: r[1] for r in bit_counts(maps, ["k"], "n").collect()} == want
    assert bit_counts(merged_bitmaps(maps, []), [], "n").first()[0] == df.select("v").distinct().where("v IS NOT NULL").count()
    assert bit_counts(number_bitmaps(df.where("false"), ["k"], "v"), ["k"], "n").count() == 0


def test_plot_counts_need_no_expand(tables, spark):
    plots = tables.plots.unionByName(spark.createDataFrame(
        [("p1", 7, None, 1.0), ("p9", None, 1, 2.0)], tables.plots.schema))
    for df in (plot_stats(plots), distinct_counts(plots)):
        assert "Expand" not in plan_of(df)
    assert {tuple(r) for r in plot_stats(plots).collect()} == {
        tuple(r) for r in plots.groupBy(F.col("crop_id").cast("int").alias("crop_id")).agg(
            F.count_distinct("plot_id"), F.count_distinct("cell_id"), F.sum("area_ha")).collect()}
    assert tuple(distinct_counts(plots).first()) == tuple(
        plots.agg(F.count_distinct("plot_id"), F.count_distinct("cell_id"), F.sum("area_ha")).first())
    assert tuple(distinct_counts(plots.where("false")).first()) == (0, 0, None)


# --- tables by cell ------------------------------------------------------------------------------

@pytest.fixture(scope="module")
def cell_tables(spark, tables):
    spark.sql("CREATE DATABASE IF NOT EXISTS by_cell")
    write_cell_tables(tables, "by_cell", int(spark.conf.get("spark.sql.shuffle.partitions")))
    yield read_cell_tables(spark, "by_cell").checked()
    spark.sql("DROP DATABASE by_cell CASCADE")


@pytest.fixture
def no_broadcast(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_seasons_and_their_join_need_no_exchange(cell_tables, tables, run, no_broadcast):
    base = seasonal_climate(cell_tables.climate_past, [run.base_year], dealt=True)
    ahead = per_cell_map(
        seasonal_climate(cell_tables.climate_future, list(run.horizons), dealt=True), "year", ["temp_avg", "n_months"], "ahead")
    grown = per_cell_map(plot_footprint(cell_tables.plots), "crop_id", ["area"], "grown")
    joined = base.join(ahead, "cell_id", "left").join(grown, "cell_id", "left").join(cell_tables.soils, "cell_id")
    assert "Exchange" not in plan_of(joined)
    assert "Exchange" in plan_of(seasonal_climate(tables.climate_past, [run.base_year]))
    assert "Exchange" not in plan_of(cell_crop_horizons(cell_tables, run))


def test_layout_changes_no_result(cell_tables, tables, run):
    assert rows_of(suitability(cell_tables, run, keep_hidden=True)) == rows_of(suitability(tables, run, keep_hidden=True))
    both = [tagged_seasons(t.climate_past, t.climate_future, (2010, 2025), list(run.horizons), t.by_cell) for t in (cell_tables, tables)]
    assert rows_of(both[0]) == rows_of(both[1])
