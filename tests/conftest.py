import sys
from dataclasses import replace
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from fieldcast import schemas  # noqa: E402
from fieldcast.settings import Settings  # noqa: E402
from fieldcast.sources.tables import Tables  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[4]").appName("tests")
        .config("spark.sql.shuffle.partitions", "4").config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC").config("spark.driver.memory", "6g")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("checkpoint")))
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


RUN = Settings(
    crops=(1, 2), base_year=2024, horizons=(2054, 2084), history_years=(2010, 2025),
)


def climate_rows(cell, year, temps, rain=10.0, sun=200.0, months=(4, 5, 6, 7, 8)):
    return [(cell, None, year, m, float(t), rain, sun) for m, t in zip(months, temps)]


@pytest.fixture(scope="session")
def tables(spark):
    """A small world: two departments, cells 1-7, crops 1 and 2.

    Cell 1 stays suitable, 2 gets too hot, 3 lacks August, 4 has no future climate,
    5 becomes suitable, 6 has no soil row, 7 has the wrong soil and is not grown.
    """
    past, future = [], []
    for cell in (1, 2, 3, 4, 5, 7):
        for year in range(2018, 2025):
            past += climate_rows(cell, year, [14, 16, 18, 20, 22])
    for year in (2054, 2084):
        future += climate_rows(1, year, [14, 16, 18, 20, 22])
        future += climate_rows(2, year, [16, 20, 24, 28, 30])
        future += climate_rows(3, year, [14, 16, 18, 20], months=(4, 5, 6, 7))
        future += climate_rows(5, year, [15, 16, 17, 18, 19])
        future += climate_rows(6, year, [15, 16, 17, 18, 19])
        future += climate_rows(7, year, [15, 16, 17, 18, 19])
    yields = []
    for cell in (1, 2, 3, 4):
        for year in range(2018, 2025):
            for crop in (1, 2):
                yields.append((cell, crop, year, 40.0 + cell + (year - 2018) * 0.5, 5.0))
    make = spark.createDataFrame
    return Tables(
        constraints=make(
            [
                (1, "a", 10, 25, 5, 35, None, None, 20.0, 80.0, 1800.0, 3600.0, "B", None, None),
                (2, "b", 10, 25, 5, 35, 12.0, 20.0, 20.0, 80.0, 1800.0, 3600.0, "B", "L", None),
            ],
            schemas.CONSTRAINTS,
        ),
        coordinates=make([(c, 45.0 + c / 10, 1.0) for c in range(1, 8)], schemas.COORDINATES),
        soils=make(
            [(c, " b ", "2", "1", "One", "R", "Region") for c in (1, 2, 3)]
            + [(4, "B", "2", "2 ", "Two", "R", "Region"), (5, "B", "2", "2", "Two", "R", "Region"),
               (7, "Z", "2", "2", "Two", "R", "Region")],
            schemas.SOILS,
        ),
        climate_past=make(past, schemas.CLIMATE_PAST),
        climate_future=make(future, schemas.CLIMATE_FUTURE),
        plots=make(
            [("p1", 1, 1, 10.0), ("p2", 1, 1, 2.0), ("p3", 2, 1, 20.0), ("p4", 3, 1, 30.0),
             ("p5", 4, 1, 8.0), ("p6", 1, 2, 4.0), ("p7", 2, 2, 0.0), ("p8", 6, 1, 9.0)],
            schemas.PLOTS,
        ),
        yields=make(yields, schemas.YIELDS),
    )


@pytest.fixture(scope="session")
def run():
    return RUN


@pytest.fixture(scope="session")
def history(tables, run):
    from fieldcast.plans.yields import yield_history
    return yield_history(tables, run)


@pytest.fixture(scope="session")
def fact(tables, run, history):
    from fieldcast.operators.staging import stage
    from fieldcast.plans.fact import projection_fact
    return stage(projection_fact(tables, run, history), "fact")


@pytest.fixture
def without(tables):
    """The tables with one of them replaced."""
    return lambda **parts: replace(tables, **parts)
