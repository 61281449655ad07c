from dataclasses import replace
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from fieldcast.operators.staging import stage, staging_run
from fieldcast.plans.department_models import (
    baseline_errors, compare_models, department_baseline, department_yields, unknown_departments,
)
from fieldcast.plans.job import ProjectionError, run_projection
from fieldcast.plans.model import in_fixed_order, predict_by_crop, train_yield_model
from fieldcast.plans.yields import yield_training_set
from fieldcast.settings import Settings
from fieldcast.sources.factstore import read_fact, replace_partitions, vacuum
from fieldcast.sources.grid import bronze_to_silver, clean_grid, first_present, select_period
from fieldcast.sources.tables import (
    missing_crops, ordered_constraints, read_catalog_tables, read_query, read_tables, write_tables,
)
from fieldcast.sources.zones import zone_path


@pytest.fixture(scope="module")
def long_tables(spark, tables):
    """The small world with enough yields of crop 1 to train on; crop 2 has too few."""
    rows = [(c, 1, y, 40.0 + c + y % 5 + k, 5.0) for c in (1, 2, 3, 4) for y in range(2018, 2025) for k in range(4)]
    rows += [(1, 2, 2020, 30.0, 5.0)]
    return replace(tables, yields=spark.createDataFrame(rows, tables.yields.schema))


def test_settings():
    for bad in ("x", 0, -1, None):
        with pytest.raises(ValueError):
            Settings(sun_divisor=bad)
    assert Settings(sun_divisor="2").sun_divisor == 2.0
    with pytest.raises(ValueError):
        Settings().narrowed(crops=[9])
    with pytest.raises(ValueError):
        Settings().narrowed(horizons=[2055])
    assert Settings().narrowed(crops=[2]).horizons == (2054, 2084, 2100)
    with pytest.raises(ValueError):
        Settings(crops=())


def test_run_projection(spark, long_tables, run, tmp_path):
    path = str(tmp_path / "fact")
    with pytest.raises(ProjectionError, match="crop 2: only 1 usable yield rows") as failure:
        run_projection(spark, long_tables, path, run)
    results = [tuple(r) for r in failure.value.results.collect()]
    assert [r[:3] for r in results] == [(1, 2054, 5), (1, 2084, 5), (2, None, 0)]
    stored = read_fact(spark, path)
    first = {tuple(r) for r in stored.drop("computed_at").collect()}
    assert len(first) == 10 and stored.where("fut_yield < 0").count() == 0
    assert stored.where("status = 'kept' AND fut_yield > 0").count() == 2
    # the same run again gives the same rows
    run_projection(spark, long_tables, path, run, crops=[1], horizons=[2084])
    assert {tuple(r) for r in read_fact(spark, path).drop("computed_at").collect()} == first
    # a dry run writes nothing
    out = run_projection(spark, long_tables, None, run, crops=[1], dry_run=True)
    assert out.where("error IS NULL").count() == 2
    lacking = replace(long_tables, constraints=long_tables.constraints.where("crop_id = 1"))
    with pytest.raises(ValueError, match=r"crops without constraints: \[2\]"):
        run_projection(spark, lacking, path, run)


def test_failures_stay_in_their_partition(spark, long_tables, run, history, fact, monkeypatch):
    """A build that breaks for one partition; a check that finds one of the others unsound."""
    from fieldcast.plans import job

    def broken(tables, part, *rest):
        if (1, 2084) in [(c, h) for c in part.crops for h in part.horizons]:
            raise ArithmeticError("bad horizon")
        rows = fact.where(F.col("crop_id").isin(*part.crops) & F.col("horizon_year").isin(*part.horizons))
        return rows.withColumn("fut_area", F.when(F.col("crop_id") == 2, -1.0).otherwise(F.col("fut_area")))

    monkeypatch.setattr(job, "projection_fact", broken)
    monkeypatch.setattr(job, "predict_by_crop", lambda models, mask: None)
    models = [job.YieldModel(c, {}, None) for c in run.crops]
    built, errors = job.build_fact(None, run, history, models, None)
    assert errors == {(1, 2084): "bad horizon"}
    sound, unsound = job.checked_partitions(built, run, run.crops)
    assert sound == {(1, 2054): 5}
    assert unsound == {(1, 2084): "no rows", (2, 2054): "negative_fut_area: 2", (2, 2084): "negative_fut_area: 2"}


def test_failed_builds_are_split_by_crop_first(spark, run):
    """Sound crops are built at once, only the horizons of a broken one on their own."""
    from fieldcast.plans import job

    whole, seen = replace(run, crops=(1, 2, 3), horizons=(2054, 2084, 2100)), []

    def fact_of(part):
        seen.append((part.crops, part.horizons))
        if 2 in part.crops and 2084 in part.horizons:
            raise ArithmeticError("bad horizon")
        return spark.createDataFrame([(c, h) for c in part.crops for h in part.horizons], "crop_id int, horizon_year int")

    built, errors = job.built_partitions(fact_of, whole)
    assert errors == {(2, 2084): "bad horizon"} and len(seen) == 7
    wanted = {(c, h) for c in whole.crops for h in whole.horizons} - {(2, 2084)}
    assert sorted(map(tuple, built.collect())) == sorted(wanted)


def test_partition_overwrite(spark, fact, tmp_path):
    path = str(tmp_path / "fact")
    counts = {tuple(r) for r in replace_partitions(fact, path).collect()}
    assert sum(n for *_, n in counts) == fact.count() and len(counts) == 4
    new = fact.where("crop_id = 1 AND horizon_year = 2054").where("status = 'kept'").withColumn(
        "base_area", F.lit(1.0))
    replace_partitions(new, path)
    stored = read_fact(spark, path)
    assert stored.where("crop_id = 1 AND horizon_year = 2054").count() == 1
    assert stored.count() == fact.where("NOT (crop_id = 1 AND horizon_year = 2054)").count() + 1
    with pytest.raises(ValueError, match="empty"):
        replace_partitions(new.where("FALSE"), path)
    plan = stored.where("crop_id = 1")._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(crop_id" in plan
    vacuum(spark, path)
    assert read_fact(spark, path).count() == stored.count()


def test_replacement_is_all_or_nothing(spark, fact, tmp_path, monkeypatch):
    """A job that dies between write and switch leaves readers with the old rows."""
    from fieldcast.sources import factstore

    path = str(tmp_path / "fact")
    replace_partitions(fact, path)
    before = sorted(map(str, read_fact(spark, path).collect()))

    def dies(*_):
        raise RuntimeError("lost")

    with monkeypatch.context() as m:
        m.setattr(factstore, "switch", dies)
        with pytest.raises(RuntimeError, match="lost"):
            replace_partitions(fact.withColumn("base_area", F.lit(-1.0)), path)
    assert sorted(map(str, read_fact(spark, path).collect())) == before
    replace_partitions(fact.where("crop_id = 1").withColumn("base_area", F.lit(-1.0)), path)
    assert read_fact(spark, path).where("base_area = -1").count() == fact.where("crop_id = 1").count()


def test_staged_tables_go_with_their_run(spark):
    with staging_run(spark) as folder:
        files = stage(spark.range(5), "five").inputFiles()
        assert files and all(folder in f for f in files)
    assert not Path(folder.removeprefix("file:")).exists()


def test_model(spark, long_tables, run):
    training = yield_training_set(long_tables, run)
    model = train_yield_model(1, training, run)
    assert model.metrics["n_rows"] == 112 and model.metrics["mae"] is not None
    again = train_yield_model(1, training, run)
    assert model.metrics == again.metrics
    rows = spark.createDataFrame(
        [(1, "b ", 18.0, 22.0, 50.0, 200.0), (1, "never seen", 18.0, 22.0, 50.0, None), (2, "B", 1.0, 1.0, 1.0, 1.0)],
        "crop_id int, soil_family string, x_temp_avg double, x_temp_peak double, x_rain double, x_sun_mean double")
    got = predict_by_crop([model])(rows)
    assert got.columns == [*rows.columns, "predicted"]
    values = {r["soil_family"]: r["predicted"] for r in got.collect()}
    assert values["b "] > 0 and values["never seen"] > 0 and values["B"] is None
    with pytest.raises(ValueError, match="only 1 usable"):
        train_yield_model(2, training, run)
    short = train_yield_model(1, training, replace(run, last_training_year=2030))
    assert short.metrics["mae"] is None


def test_training_partitions_follow_the_rows(spark, long_tables, run):
    """Not the session, or every further partition shuffles the nodes of all trees once more."""
    training = yield_training_set(long_tables, run).where("crop_id = 1")
    before = spark.conf.get("spark.sql.shuffle.partitions")
    found = []
    try:
        for n in ("3", "7"):
            spark.conf.set("spark.sql.shuffle.partitions", n)
            found.append(train_yield_model(1, training, run).metrics)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert found[0] == found[1]
    sizes = {n: in_fixed_order(training, n).rdd.getNumPartitions() for n in (112, 400_000, 400_001, 60_000_000)}
    assert sizes == {112: 4, 400_000: 4, 400_001: 5, 60_000_000: 600}


def test_department_models(spark, long_tables, run):
    rows = department_yields(yield_training_set(long_tables, run), long_tables.soils)
    base = {(r["crop_id"], r["dept_code"], r["year"]): r for r in department_baseline(rows).collect()}
    first = [base[1, "1", y] for y in range(2018, 2021)]
    assert first[0]["predicted"] is None
    assert first[2]["predicted"] == pytest.approx((first[0]["yield_q_ha"] + first[1]["yield_q_ha"]) / 2)
    assert baseline_errors(department_baseline(rows), run).where("crop_id = 1").first()["n_rows"] == 4
    found = compare_models(yield_training_set(long_tables, run).where("crop_id = 1"), run, names=("linear", "lasso"))
    assert {(r["crop_id"], r["model"]) for r in found.collect()} == {(1, "linear"), (1, "lasso")}
    copies = rows.withColumn("copy", F.explode(F.sequence(F.lit(0), F.lit(8))))
    many = copies.withColumn("dept_code", F.concat("dept_code", F.col("copy").cast("string")))
    some = unknown_departments(many.where("crop_id = 1"), (0, 1), run).collect()
    assert {r["fold"] for r in some} <= {0, 1} and some and all(r["n_rows"] > 0 for r in some)


def test_tables_round_trip(spark, tables, tmp_path):
    root = str(tmp_path / "in")
    odd = tables.coordinates.withColumn("lon", F.when(F.col("cell_id") == 1, float("nan")).otherwise(F.col("lon")))
    write_tables(replace(tables, coordinates=odd), root)
    back = read_tables(spark, root).checked()
    assert back.coordinates.where("lon IS NULL").count() == 1
    assert back.climate_past.count() == tables.climate_past.count()
    plan = back.climate_past.where("year = 2024 AND month BETWEEN 4 AND 8")._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(year" in plan and "GreaterThanOrEqual(month,4)" in plan
    assert [r["crop_id"] for r in ordered_constraints(back.constraints).collect()] == [1, 2]
    assert sorted(r[0] for r in missing_crops(back.constraints, (1, 2, 3)).collect()) == [3]
    assert read_query(spark, "SELECT :a + 1 AS b", {"a": 2}).first()["b"] == 3
    for name in ("constraints", "coordinates", "soils", "climate_past", "climate_future", "plots", "yields"):
        getattr(tables, name).createOrReplaceTempView(name)
    with pytest.raises(Exception):
        read_catalog_tables(spark, "no_such_database")


def test_grid(spark, tmp_path):
    raw = spark.createDataFrame(
        [("2054-04-16", 45.0, 1.0, 288.15, "x"), ("2054-04-16", 45.0, 1.0, 288.15, "y"),
         ("2054-04-16", 46.0, 1.0, None, "z"), ("2054-05-16", 46.0, 1.0, 290.0, "z")],
        "time string, lat double, lon double, tas double, other string").withColumn("time", F.col("time").cast("timestamp"))
    clean = clean_grid(raw)
    assert clean.columns == ["time", "lat", "lon", "temp_celsius"]
    assert sorted(r["temp_celsius"] for r in clean.collect()) == [15.0, 16.85]
    rain = clean_grid(raw.withColumnRenamed("tas", "pr"), "pr", "rain", convert=lambda c: c)
    assert rain.columns[-1] == "rain"
    assert first_present(raw, ("tas", "t2m")) == "tas"
    with pytest.raises(ValueError):
        first_present(raw, ("q",))
    assert select_period(raw, [2054], [5]).count() == 1
    raw.write.parquet(str(tmp_path / "pruned"))
    stored = spark.read.parquet(str(tmp_path / "pruned"))
    plan = select_period(stored, [2054, 2055])._jdf.queryExecution().toString()
    assert "PushedFilters: [IsNotNull(time), GreaterThanOrEqual(time" in plan
    assert zone_path("s3a://bucket/", "silver", "a") == "s3a://bucket/silver/a"
    with pytest.raises(ValueError):
        zone_path("/x", "copper", "a")
    root = str(tmp_path)
    raw.write.parquet(zone_path(root, "bronze", "grid"))
    out = bronze_to_silver(spark, root, "grid", "grid")
    assert out.count() == 2
    assert spark.read.option("header", True).csv(zone_path(root, "silver", "grid_clean_csv")).count() == 2
    assert spark.read.option("header", True).csv(zone_path(root, "bronze", "grid_raw_csv")).count() == 4
