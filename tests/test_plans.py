import pytest
from pyspark.sql import functions as F

from fieldcast.operators.areas import median_area_by_dept
from fieldcast.plans import marts as M
from fieldcast.plans import quality as Q
from fieldcast.plans.series import (
    cell_temperature_series, compare_all_cells, compare_series, temperature_series,
)
from fieldcast.plans.suitability import cells_without_soil, suitability, status_summary
from fieldcast.plans.yields import horizon_features, trimmed_yields, yield_bounds, yield_training_set
from fieldcast.schemas import FACT, require_columns


def table(df, *keys):
    return {tuple(r[k] for k in keys): r.asDict() for r in df.collect()}


def test_suitability(tables, run):
    everything = table(suitability(tables, run, keep_hidden=True), "cell_id", "crop_id", "horizon_year")
    assert len(everything) == 6 * 2 * 2  # the cell without a soil is gone
    at = {c: everything[c, 1, 2054] for c in (1, 2, 3, 4, 5, 7)}
    assert {c: r["status"] for c, r in at.items()} == {
        1: "kept", 2: "lost", 3: "lost", 4: "lost", 5: "new", 7: "hidden"}
    assert {c: r["fail_reasons"] for c, r in at.items()} == {
        1: "", 2: "temperature", 3: "incomplete climate", 4: "incomplete climate", 5: "", 7: "soil"}
    assert at[4]["climate_complete"] is None and at[4]["temp_ok"] is None and at[4]["suitable"] is False
    assert at[3]["climate_complete"] is False and at[3]["temp_ok"] is False
    assert at[2]["temp_ok"] is False and at[2]["rain_ok"] and at[2]["soil_ok"]
    assert at[7]["soil_ok"] is None and at[7]["is_grown"] is False and at[7]["grown_area"] == 0.0
    assert at[1]["plot_count"] == 2 and at[1]["base_temp_peak"] == 22.0
    shown = suitability(tables, run)
    assert shown.where("status = 'hidden'").count() == 0
    summary = table(status_summary(shown), "crop_id", "horizon_year")
    assert summary[1, 2054]["n_kept"] == 1 and summary[1, 2054]["n_lost"] == 3
    assert summary[2, 2084]["n_kept"] == 1 and summary[2, 2084]["grown_area"] == 4.0
    assert [r[0] for r in cells_without_soil(tables).collect()] == [6]


def test_repeated_dimension_rows_do_not_multiply(tables, without, run):
    t = without(soils=tables.soils.union(tables.soils), coordinates=tables.coordinates.union(tables.coordinates),
                constraints=tables.constraints.union(tables.constraints))
    assert suitability(t, run, keep_hidden=True).count() == 24


def test_training_set(tables, without, run, spark):
    rows = yield_training_set(tables, run)
    assert rows.count() == 4 * 7 * 2
    bad = spark.createDataFrame(
        [(1, 1, 2020, 0.0, 5.0), (1, 1, 2020, 9.0, 0.0), (1, 1, 2020, 9.0, None), (1, 1, 2020, None, 5.0),
         (1, 1, 2005, 9.0, 5.0), (99, 1, 2020, 9.0, 5.0)], tables.yields.schema)
    assert yield_training_set(without(yields=bad), run).count() == 0
    bare = without(soils=tables.soils.where("cell_id <> 1"))
    soils = {r[0] for r in yield_training_set(bare, run).where("cell_id = 1").select("soil_family").collect()}
    assert soils == {"unknown"}
    features = table(horizon_features(tables, run), "cell_id", "year")
    assert {c for c, _ in features} == {1, 2, 5, 6, 7} and features[6, 2054]["soil_family"] == "unknown"


def test_trimming(spark):
    rows = spark.createDataFrame([(1, v) for v in (1.0, 2.0, 4.0, 9.0)], "crop_id int, yield_q_ha double")
    bounds = yield_bounds(rows)
    assert bounds.first()["low_yield"] == pytest.approx(1.03)
    assert sorted(r["yield_q_ha"] for r in trimmed_yields(rows, bounds).collect()) == [2.0, 4.0]


def test_fact(fact, history):
    assert fact.columns == FACT.fieldNames()
    rows = table(fact, "cell_id", "crop_id", "horizon_year")
    assert len(rows) == 2 * (5 + 2)
    kept, lost, gap, new = (rows[c, 1, 2054] for c in (1, 2, 3, 5))
    assert (kept["fut_area"], kept["base_area"], kept["new_area"]) == (12.0, 12.0, 0.0)
    assert (lost["fut_area"], lost["base_area"]) == (0.0, 20.0)
    # cell 4 is the only grown one of department 2: median 8, half of it for the new cell
    assert new["median_grown_area"] == 8.0 and new["fut_area"] == 4.0 == new["new_area"]
    assert new["base_area"] == 0.0 and new["dept_code"] == "2"
    assert gap["climate_complete"] is False and gap["fut_yield"] == 0.0 and gap["fit_score_fut"] == 0.0
    assert gap["fit_score_base"] > 0 and gap["soil_score"] == 100.0 and gap["temp_score_fut"] == 0.0
    assert gap["yield_delta_pct"] == -100.0
    defaults = table(history.defaults, "crop_id")[1,]
    assert new["base_yield"] == defaults["default_yield_q_ha"]
    assert kept["yield_delta_pct"] == 0.0 and kept["score_delta"] == pytest.approx(
        kept["fit_score_fut"] - kept["fit_score_base"])
    # crop 2 falls back to the median over all departments where none is grown
    other = rows[5, 2, 2054]
    assert other["status"] == "new" and other["median_grown_area"] == 4.0
    for r in rows.values():
        for name in r:
            if "_score" in name or name.startswith("fit_score"):
                assert 0.0 <= r[name] <= 100.0, name
        if r["status"] == "kept":
            assert r["fut_area"] == r["base_area"]


def test_medians(spark):
    grown = spark.createDataFrame(
        [(int(a), 1, "D1", "N", a) for a in (10.0, 20.0, 30.0)] + [(1, 1, None, "N", 99.0), (2, 1, "D2", "M", 0.0)],
        "cell_id long, crop_id int, dept_code string, dept_name string, area double")
    assert [tuple(r) for r in median_area_by_dept(grown).collect()] == [(1, "D1", "N", 3, 20.0)]


def fact_rows(spark, rows):
    """(cell, status, grown, base, fut, new, score, yields) rows of crop 1 in 2054."""
    frame = spark.createDataFrame(
        [(c, 1, 2054, d, d and "Name", s, g, b, f, n, q, y, y0, s in ("kept", "new"), k)
         for c, d, s, g, b, f, n, q, y, y0, k in rows],
        "cell_id long, crop_id int, horizon_year int, dept_code string, dept_name string, status string, "
        "is_grown boolean, base_area double, fut_area double, new_area double, fit_score_fut double, "
        "fut_yield double, base_yield double, suitable boolean, climate_complete boolean")
    return frame.withColumn("computed_at", F.lit("2026-01-01 00:00:00").cast("timestamp"))


@pytest.fixture(scope="module")
def small_fact(spark):
    return fact_rows(spark, [
        (1, "A", "kept", True, 10.0, 10.0, 0.0, 80.0, 5.0, 4.0, True),
        (2, "A", "lost", True, 10.0, 0.0, 0.0, 50.0, 2.0, 4.0, None),
        (3, "B", "new", False, 0.0, 5.0, 5.0, 90.0, 9.0, 3.0, True),
        (4, None, "lost", True, 1.0, 0.0, 0.0, 10.0, 1.0, 1.0, False),
    ])


def test_national_kpis(small_fact):
    row = M.national_kpis(small_fact.where("dept_code IS NOT NULL")).first()
    assert row["fit_score"] == 50.0 and row["fut_area"] == 15.0 and row["base_area"] == 20.0
    assert row["fut_yield"] == pytest.approx((50 + 45) / 15) and row["base_yield"] == 4.0
    assert row["area_change_pct"] == -25.0 and row["no_climate_cells"] == 0
    assert row["computed_at"] is not None
    only = M.national_kpis(small_fact.where("status = 'new'")).first()
    assert only["kept_area"] is None and only["kept_cells"] == 0 and only["base_yield"] is None
    assert M.national_kpis(small_fact).first()["no_climate_cells"] == 1


def test_department_kpis_and_ranking(small_fact, spark):
    got = table(M.department_kpis(small_fact), "dept_code")
    assert set(got) == {("A",), ("B",)}
    assert got["A",]["dept_index"] == 0 and got["A",]["band"] == "under watch" and got["A",]["has_base"]
    assert got["B",]["dept_index"] == -50 and got["B",]["has_base"] is False and got["B",]["retention"] == 0.0
    assert got["B",]["area_change_pct"] is None and got["A",]["rating"] == 1
    totals = spark.createDataFrame(
        [(1, 2054, d, d, y, 1.0, a, None) for d, y, a in
         [("p", 5.0, 1.0), ("q", None, 1.0), ("r", 9.0, 1.0), ("s", 12.0, 0.0)]],
        "crop_id int, horizon_year int, dept_code string, dept_name string, fut_yield double, "
        "fit_score double, fut_area double, yield_change_pct double")
    ranks = {r["dept_code"]: r["rank"] for r in M.department_ranking(totals).collect()}
    assert ranks == {"r": 1, "p": 2, "q": 3}
    assert [r["dept_code"] for r in M.ordered_departments(totals).collect()] == ["s", "r", "p", "q"]


def test_map_queries(fact, tables, run, small_fact):
    extract = M.projection_extract(fact, tables.constraints, run)
    row = extract.where("cell_id = 1 AND crop_id = 1").first()
    assert row["sun_season_min"] == pytest.approx(500.0) and "median_grown_area" not in extract.columns
    flags = M.plain_flags(extract).where("temp_ok IS NULL OR soil_ok IS NULL").count()
    assert flags == 0
    sizes = table(M.marker_size(fact, run), "cell_id", "crop_id", "horizon_year")
    assert sizes[3, 1, 2054]["marker_size"] == 11.0 and sizes[5, 1, 2054]["marker_size"] == 2.0
    label = extract.where("cell_id = 2 AND crop_id = 1").select(M.cell_label()).first()[0]
    assert label.startswith("lost on 20 ha | temperature ") and "]: no | rain " in label
    metrics = M.status_metrics(small_fact.where("status = 'new'")).first()
    assert metrics["base_area"] == 0.0 and metrics["lost_area"] == 0.0 and metrics["net_change_pct"] is None
    assert table(M.best_crop(fact), "cell_id", "horizon_year")[5, 2054]["crop_id"] in (1, 2)
    assert M.of_partition(fact, 1, 2054).select("crop_id", "horizon_year").distinct().count() == 1
    assert sum(r["points"] for r in M.score_weights(fact.sparkSession).collect()) == 100


def test_quality(fact, small_fact, spark):
    assert Q.fact_violations(fact).where("violations > 0").count() == 0
    bad = fact_rows(spark, [
        (1, "A", "kept", True, -1.0, 10.0, 0.0, 80.0, 5.0, 4.0, True),
        (1, "A", "kept", True, 1.0, 10.0, 0.0, 80.0, 5.0, 4.0, True),
        (2, "A", "odd", False, 1.0, -1.0, -2.0, 120.0, 5.0, 4.0, True),
        (3, "A", "kept", True, 1.0, 1.0, 0.0, None, 5.0, 4.0, None),
    ])
    got = {r["rule"]: r["violations"] for r in Q.fact_violations(bad).collect()}
    assert got == {"duplicate_key": 2, "unknown_status": 1, "negative_base_area": 1, "negative_fut_area": 1,
                   "negative_new_area": 1, "score_out_of_range": 1, "incomplete_not_lost": 1}
    assert Q.duplicate_examples(bad) == [(1, 1, 2054)]
    assert {r[0] for r in Q.status_domain(small_fact).collect()} == {"kept", "lost", "new"}
    with pytest.raises(ValueError, match="base_area"):
        require_columns(fact.drop("base_area"), FACT.fieldNames())


def test_series(spark, tables, run, without):
    schema = "cell_id int, date date, year int, month int, temp double, rain double, sun double"
    base = spark.createDataFrame([(1, None, 2024, 4, 10.0, 0.0, 0.0), (1, None, 2024, 5, 20.0, 0.0, 0.0),
                                  (2, None, 2024, 4, 30.0, 0.0, 0.0), (2, None, 2024, 9, 99.0, 0.0, 0.0)], schema)
    ahead = spark.createDataFrame([(1, None, 2054, 4, 12.0, 0.0, 0.0), (3, None, 2084, 4, None, 0.0, 0.0)], schema)
    t = without(climate_past=base, climate_future=ahead)
    assert [tuple(r) for r in temperature_series(t, run).collect()] == [(2024, 22.5), (2054, 12.0)]
    assert [tuple(r) for r in cell_temperature_series(t, run, 1).collect()] == [(2024, 15.0), (2054, 12.0)]
    assert [tuple(r) for r in cell_temperature_series(t, run, 77).collect()] == [(2024, None)]
    assert [tuple(r) for r in compare_series(t, run, 3).collect()] == [
        (2024, 22.5, None), (2054, 12.0, None), (2084, None, None)]
    cells = table(compare_all_cells(t, run), "cell_id", "year")
    assert cells[2, 2054]["national"] == 12.0 and cells[2, 2054]["cell"] is None
    assert cells[1, 2024]["cell"] == 15.0 and (3, 2084) in cells and (1, 2084) not in cells


def test_repeated_rows_fail_the_fact_build(tables, without, run, history, spark):
    """Coordinates, soils, references and medians are declared unique; a repeated row raises there."""
    from dataclasses import replace

    from fieldcast.plans.fact import median_areas, projection_fact, with_areas
    from fieldcast.plans.shared import shared_inputs

    for name in ("coordinates", "soils"):
        df = getattr(tables, name)
        twice = without(**{name: df.unionByName(df.where("cell_id = 2"))})
        with pytest.raises(Exception, match=r"repeated key in the (left|right) table: .*cell_id.*2"):
            projection_fact(twice, run, history).collect()
    cells = history.cells.unionByName(history.cells.where("cell_id = 1"))
    shared = shared_inputs(tables, run)
    with pytest.raises(Exception, match="repeated key in the right table"):
        projection_fact(tables, run, replace(history, cells=cells), shared=shared).collect()
    by_dept, by_crop = median_areas(tables, run, shared)
    with pytest.raises(Exception, match="repeated key in medians by department"):
        projection_fact(tables, run, history, medians=(by_dept.union(by_dept), by_crop), shared=shared).collect()
    assert with_areas is not None and projection_fact(
        tables, run, history, medians=(by_dept, by_crop), shared=shared).count() == 14


def test_shared_inputs_equal_separate_ones(tables, run, fact, history):
    from dataclasses import replace

    from fieldcast.operators.climate import seasonal_climate
    from fieldcast.plans.shared import shared_inputs

    outside = replace(run, base_year=2024, history_years=(2018, 2020))
    shared = shared_inputs(tables, outside)
    rows = lambda df: sorted(map(str, df.collect()))
    for mine, separate in (
        (shared.past((2018, 2020)), seasonal_climate(tables.climate_past, (2018, 2020))),
        (shared.past([2024]), seasonal_climate(tables.climate_past, [2024])),
        (shared.future([2054]), seasonal_climate(tables.climate_future, [2054])),
    ):
        assert mine.count() and rows(mine.select(separate.columns)) == rows(separate)
