from pathlib import Path

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fieldcast.operators.scans import scan_metrics
from fieldcast.plans import department_models as D
from fieldcast.plans import quality as Q
from fieldcast.plans.job import error_class, refresh_partitions, run_projection
from fieldcast.plans.marts import status_metrics
from fieldcast.plans.martstore import stored_mart
from fieldcast.sources import factstore
from fieldcast.sources.factstore import read_fact, replace_partitions, vacuum
from fieldcast.sources.grid import land_csv, requested, write_grid
from fieldcast.sources.zones import REJECTED, read_typed_csv, sound_lines, zone_path


def rows_of(df):
    return sorted(map(str, df.collect()))


# --- stored marts --------------------------------------------------------------------------------

def test_mart_is_built_once_for_each_state_of_the_facts(spark, fact, tmp_path):
    path, built = str(tmp_path / "fact"), []

    def build(rows):
        built.append(1)
        return status_metrics(rows)

    replace_partitions(fact, path)
    first = rows_of(stored_mart(spark, path, "metrics", build))
    assert rows_of(stored_mart(spark, path, "metrics", build)) == first and len(built) == 1
    new = fact.where("crop_id = 1 AND horizon_year = 2054").withColumn("base_area", F.col("base_area") + 1.0)
    replace_partitions(new, path)  # the switch makes the next read fresh
    fresh = rows_of(stored_mart(spark, path, "metrics", build))
    assert len(built) == 2 and fresh != first and fresh == rows_of(status_metrics(read_fact(spark, path)))
    vacuum(spark, path)
    assert [p.name for p in Path(path, factstore.MARTS, "metrics").iterdir()] == [f"{2:012d}"]
    assert rows_of(stored_mart(spark, path, "metrics", build)) == fresh and len(built) == 2


def test_mart_keeps_rows_and_number_together(spark, fact, tmp_path):
    """Facts that change while a mart is built: it holds, under the old number, the old rows."""
    path = str(tmp_path / "fact")
    replace_partitions(fact, path)
    old = rows_of(status_metrics(fact))

    def build(rows):
        if factstore.current_manifest(spark, path)["number"] == 1:
            replace_partitions(fact.withColumn("base_area", F.lit(1.0)), path)
        return status_metrics(rows)

    assert rows_of(stored_mart(spark, path, "metrics", build)) == old
    assert rows_of(stored_mart(spark, path, "metrics", build)) != old
    broken = str(tmp_path / "other")
    replace_partitions(fact, broken)
    with pytest.raises(Exception, match="no rows here"):
        stored_mart(spark, broken, "metrics", lambda rows: rows.select(F.raise_error(F.lit("no rows here")).alias("x")))
    assert rows_of(stored_mart(spark, broken, "metrics", status_metrics)) == old


# --- failures ------------------------------------------------------------------------------------

def test_failures_stay_in_their_partition_of_the_store(spark, fact, run, tmp_path):
    path = str(tmp_path / "fact")
    replace_partitions(fact.withColumn("model_version", F.lit("first")), path)
    at = lambda c, h: (F.col("crop_id") == c) & (F.col("horizon_year") == h)

    def build(part):
        here = fact.where(F.col("crop_id").isin(*part.crops) & F.col("horizon_year").isin(*part.horizons))
        return here.withColumns({
            "model_version": F.lit("second"),
            "fut_area": F.when(at(1, 2054), F.raise_error(F.lit("lost season")).cast("double"))
            .when(at(2, 2084), -1.0).otherwise(F.col("fut_area"))})

    frame = refresh_partitions(spark, build, path, run)
    got = {(r[0], r[1]): (r["n_rows"], r["kind"]) for r in frame.withColumn("kind", error_class(F.col("error"))).collect()}
    assert got == {(1, 2054): (0, "USER_RAISED_EXCEPTION"), (1, 2084): (5, None), (2, 2054): (2, None),
                   (2, 2084): (0, "negative_fut_area")}
    assert "lost season" in frame.where("n_rows = 0 AND crop_id = 1").first()["error"]
    stored = {(r[0], r[1]): r[2] for r in read_fact(spark, path).select(
        "crop_id", "horizon_year", "model_version").distinct().collect()}
    assert stored == {(1, 2054): "first", (1, 2084): "second", (2, 2054): "second", (2, 2084): "first"}
    kept = read_fact(spark, path).where(at(1, 2054)).drop("model_version", "computed_at")
    assert rows_of(kept) == rows_of(fact.where(at(1, 2054)).drop("model_version", "computed_at"))
    with pytest.raises(ValueError, match="needs a path"):
        run_projection(spark, None, None, run)


def test_error_classes(spark):
    texts = [None, "duplicate_key: 4, such as [(1, 2)]", "Job aborted: [TASK_WRITE_FAILED] x [DIVIDE_BY_ZERO] y", "boom", "no rows"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    got = [r[0] for r in df.orderBy("i").select(error_class(F.col("t"))).collect()]
    assert got == [None, "duplicate_key", "DIVIDE_BY_ZERO", "other", "other"]


# --- landing -------------------------------------------------------------------------------------

GRID = T.StructType([T.StructField("time", T.TimestampNTZType()), T.StructField("lat", T.DoubleType()),
                     T.StructField("lon", T.DoubleType()), T.StructField("tas", T.DoubleType())])
LINES = ["time,lat,lon,tas", "2054-04-16 00:00:00,45.0,1.0,288.15", "2054-04-16 00:00:00,45.0,1.0,287.15",
         "yesterday,45.0,1.0,288.15", "2054-04-16 00:00:00,45.0,1.0", "2054-04-16 00:00:00,45.0,1.0,warm",
         "2054-04-16 00:00:00,45.0,1.0,288.15,7", "2054-05-16 00:00:00,46.0,1.0,", "2054-05-16 00:00:00,46.0,2.0,290.0"]


@pytest.fixture
def landed(spark, tmp_path):
    folder = Path(zone_path(str(tmp_path), "bronze", "grid"))
    folder.mkdir(parents=True)
    (folder / "part.csv").write_text("\n".join(LINES) + "\n")
    return str(tmp_path)


def test_lines_that_do_not_fit_are_kept_apart(spark, landed):
    sound, rejected = sound_lines(read_typed_csv(spark, zone_path(landed, "bronze", "grid"), GRID))
    assert sound.schema == GRID and sound.count() == 4 and sound.where("tas IS NULL").count() == 1
    assert sorted(r[REJECTED] for r in rejected.collect()) == sorted(LINES[3:7])


def test_landing_reads_back_what_it_wrote(spark, landed):
    silver, rejected = land_csv(spark, landed, "grid", "t2", GRID)
    assert sorted(r["temp_celsius"] for r in silver.collect()) == [14.0, 16.85]
    assert dict(silver.dtypes) == {"time": "timestamp_ntz", "lat": "double", "lon": "double", "temp_celsius": "double"}
    assert rejected.count() == 4
    assert rows_of(silver) == rows_of(spark.read.parquet(zone_path(landed, "silver", "t2_clean")))
    assert spark.read.parquet(zone_path(landed, "bronze", "t2_rejected")).count() == 4


def test_request_opens_its_folders_and_pages_only(spark, tmp_path):
    path = str(tmp_path / "grid")
    rows = spark.range(24_000).select(
        F.make_timestamp_ntz(2050 + F.col("id") % 2, 1 + (F.col("id") / 2).cast("long") % 12, F.lit(3), F.lit(0), F.lit(0), F.lit(0)).alias("time"),
        (40.0 + (F.col("id") / 24).cast("long") % 100 / 10.0).alias("lat"), (F.col("id") % 7).cast("double").alias("lon"),
        F.col("id").cast("double").alias("tas"))
    write_grid(rows, path, page_rows=100)
    stored = spark.read.parquet(path)
    box = {"north": 44.0, "west": 0.0, "south": 43.0, "east": 3.0}
    asked = requested(stored, [2051], [4, 5], **box)
    want = rows.where("year(time) = 2051 AND month(time) IN (4, 5) AND lat BETWEEN 43 AND 44 AND lon BETWEEN 0 AND 3")
    assert asked.count() == want.count() > 0
    (scan,) = scan_metrics(asked.select("time", "lat", "lon", "tas"))
    assert scan["folders"] == 2 and want.count() <= scan["rows"] <= 600  # of 2,000 rows in the two folders
    assert requested(stored, [], None).count() == 0 and requested(stored).count() == 24_000


# --- small checks --------------------------------------------------------------------------------

def test_first_duplicates_and_emptiness(spark):
    df = spark.createDataFrame([(k % 15, 1) for k in range(45)] + [(99, 1)], "k int, v int")
    assert [tuple(r) for r in Q.first_duplicates(df, ["k"]).collect()] == [(k, 3) for k in range(10)]
    got = {r[0]: r[1] for r in Q.emptiness({"full": df, "none": df.where("false")}).collect()}
    assert got == {"full": False, "none": True}


def test_folds_hold_every_department_once(spark):
    rows = spark.createDataFrame([(1, f"{d:02d}", y) for d in range(40) for y in (1, 2)], "crop_id int, dept_code string, year int")
    sizes = D.fold_sizes(rows).collect()
    assert {r["fold"] for r in sizes} == set(range(D.FOLDS))
    assert sum(r["n_departments"] for r in sizes) == 40 and sum(r["n_rows"] for r in sizes) == 80


def test_intermediate_tables_need_a_shared_folder():
    from types import SimpleNamespace as Name

    from fieldcast.operators.staging import staging_root

    def session(master, warehouse, checkpoint=None, named=None):
        conf = {"spark.checkpoint.dir": named, "spark.sql.warehouse.dir": warehouse}
        return Name(conf=Name(get=lambda k, d=None: conf.get(k) or d),
                    sparkContext=Name(master=master, getCheckpointDir=lambda: checkpoint))

    assert staging_root(session("local[4]", "file:/tmp/w/")) == "file:/tmp/w"
    assert staging_root(session("yarn", "hdfs://n/w/")) == "hdfs://n/w"
    assert staging_root(session("yarn", "file:/w", named="s3a://b/c/")) == "s3a://b/c"
    assert staging_root(session("yarn", "/w", checkpoint="file:///mnt/shared/c")) == "file:///mnt/shared/c"
    for warehouse in ("/w", "file:/w", "spark-warehouse"):
        with pytest.raises(ValueError, match="spark.checkpoint.dir"):
            staging_root(session("spark://host:7077", warehouse))
