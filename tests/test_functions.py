from pyspark.sql import functions as F

from fieldcast import functions as X
from fieldcast.plans.marts import department_index, index_band, index_rating
from fieldcast.plans.quality import RULES
from fieldcast.settings import SCORE_WEIGHTS


def evaluate(spark, **columns):
    return spark.range(1).select(*[c.alias(n) for n, c in columns.items()]).first().asDict()


def lit(value):
    return F.lit(value).cast("double")


def test_tolerance_score(spark):
    cases = {
        (20, 30, None, None): {20: 100, 25: 100, 30: 100, 15: 50, 35: 50, 10: 0, 40: 0, None: 0},
        (0, 10, None, None): {-1: 0, 15: 50, 20: 0},
        (20, 30, 18, 40): {19: 50, 18: 0, 35: 50},
        (20, 30, 22, 28): {21: 100, 19: 0, 31: 0},
        (None, 30, None, None): {25: 0},
        (20, 20, None, None): {20: 100, 21: 0, 19: 0},
    }
    columns, wanted = {}, {}
    for i, ((lo, hi, alo, ahi), points) in enumerate(cases.items()):
        for j, (value, score) in enumerate(points.items()):
            columns[f"c{i}_{j}"] = X.tolerance_score(lit(value), lit(lo), lit(hi), lit(alo), lit(ahi))
            wanted[f"c{i}_{j}"] = float(score)
    assert evaluate(spark, **columns) == wanted


def test_other_scores(spark):
    part = {"yield": lit(50), "temp": lit(100), "rain": lit(80), "sun": lit(0), "soil": lit(100)}
    got = evaluate(
        spark,
        fit=X.composite_score(part),
        capped=X.yield_score(lit(300), lit(100)),
        tiny=X.yield_score(lit(0.00005), lit(0)),
        none=X.yield_score(lit(None), lit(100)),
        soil=X.soil_score(F.lit("\tb \n"), [F.lit("B"), F.lit(None).cast("string")]),
        no_soil=X.soil_score(F.lit(None).cast("string"), [F.lit("B")]),
    )
    assert got == {"fit": 73.5, "capped": 100.0, "tiny": 50.0, "none": None, "soil": 100.0,
                   "no_soil": 0.0}
    assert abs(sum(SCORE_WEIGHTS.values()) - 1) < 1e-12 and len(RULES) == 7


def test_numbers_and_calendar(spark):
    got = evaluate(
        spark,
        even=X.round_even(lit(12.5)), odd=X.round_even(lit(13.5)), tenth=X.round_even(lit(0.25), 1),
        ratio=X.safe_ratio(lit(1), lit(0)), number=X.coerce_double(F.lit("1.5")),
        text=X.coerce_double(F.lit("n/a")), nan=X.coerce_double(F.lit("NaN")),
        clipped=X.clip(lit(120), 0.0, 100.0), gap=X.clip(lit(None), 0.0, 100.0),
        feb24=X.days_in_month(F.lit(2024), F.lit(2)), apr54=X.days_in_month(F.lit(2054), F.lit(4)),
        feb00=X.days_in_month(F.lit(2100), F.lit(2)),
        april=X.mean_flux_to_kwh(lit(200), F.lit(2054), F.lit(4)),
        may=X.mean_flux_to_kwh(lit(200), F.lit(2054), F.lit(5)),
    )
    assert got == {"even": 12.0, "odd": 14.0, "tenth": 0.2, "ratio": None, "number": 1.5,
                   "text": None, "nan": None, "clipped": 100.0, "gap": None, "feb24": 29,
                   "apr54": 30, "feb00": 28, "april": 144.0, "may": 148.8}


def test_text(spark):
    got = evaluate(
        spark, **{f"d{i}": X.dept_code_normalise(F.lit(c)) for i, c in enumerate(["1.0", " 5 ", "2A", "974"])},
        number=X.number_text(lit(1234567.25), 1, " ha"), gap=X.number_text(lit(None)),
        yes=X.yes_no(F.lit(True)), no=X.yes_no(F.lit(None).cast("boolean")),
        label=X.lookup(F.lit("D"), {"P": "Podzols", "D": "Podzols"}),
        unknown=X.lookup(F.lit("X"), {"P": "Podzols"}),
    )
    assert [got[f"d{i}"] for i in range(4)] == ["01", "05", "2A", "974"]
    assert got["number"] == "1 234 567.2 ha" and got["gap"] == "not available"
    assert (got["yes"], got["no"], got["label"], got["unknown"]) == ("yes", "no", "Podzols", None)


def test_department_index_and_bands(spark):
    cases = {"a": (100, 60, 30), "b": (0, 0, 5), "c": (8, 5, 0), "d": (10, 10, 100), "e": (9, None, None)}
    got = evaluate(spark, **{n: department_index(*map(lit, v)) for n, v in cases.items()})
    assert got == {"a": 35, "b": -50, "c": 12, "d": 75, "e": -50}
    values = [80, 75, 59, 35, 0, -1]
    bands = evaluate(spark, **{f"b{i}": index_band(F.lit(v)) for i, v in enumerate(values)},
                     **{f"r{i}": index_rating(F.lit(v)) for i, v in enumerate(values)})
    assert [bands[f"b{i}"] for i in range(6)] == [
        "very favourable", "improving", "fairly favourable", "stable", "under watch",
        "highly vulnerable"]
    assert [bands[f"r{i}"] for i in range(6)] == [5, 4, 3, 2, 1, 0]
