"""Yield models by department, their baseline, and a comparison of regressors."""

from __future__ import annotations

from functools import partial

from pyspark.ml import Pipeline
from pyspark.ml.regression import GBTRegressor, LinearRegression
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from fieldcast.operators.together import run_together
from fieldcast.plans.model import errors, fill_values, filled, fit, forest, preparation
from fieldcast.plans.yields import FEATURES
from fieldcast.settings import Settings

FOLDS = 5


def department_yields(training: DataFrame, soils: DataFrame) -> DataFrame:
    """Area-weighted yield and season means per crop, department and year."""
    depts = soils.groupBy("cell_id").agg(
        F.min("dept_code").alias("dept_code")
    ).where("dept_code IS NOT NULL")
    weight = F.col("area_ha")
    return (
        training.join(depts, "cell_id")
        .groupBy("crop_id", "dept_code", "year")
        .agg(
            (F.sum(F.col("yield_q_ha") * weight) / F.nullif(F.sum(weight), F.lit(0.0)))
            .alias("yield_q_ha"),
            *[F.avg(c).alias(c) for c in ("temp_avg", "temp_peak", "rain", "sun_mean")],
        )
        .withColumn("soil_family", F.lit(None).cast("string"))
    )


def department_baseline(rows: DataFrame) -> DataFrame:
    """Mean yield of a department in all earlier years as the forecast of a year.

    A window holds one department's years, a few dozen rows.
    """
    before = Window.partitionBy("crop_id", "dept_code").orderBy("year").rowsBetween(
        Window.unboundedPreceding, -1
    )
    return rows.select(
        "crop_id", "dept_code", "year", "yield_q_ha",
        F.avg("yield_q_ha").over(before).alias("predicted"),
    )


def baseline_errors(baseline: DataFrame, settings: Settings) -> DataFrame:
    """Mean absolute error and R2 of the baseline on the validation years, per crop."""
    test = baseline.where(
        (F.col("year") > settings.last_training_year) & F.col("predicted").isNotNull()
    )
    miss = F.col("yield_q_ha") - F.col("predicted")
    return test.groupBy("crop_id").agg(
        F.count("*").alias("n_rows"),
        F.avg(F.abs(miss)).alias("mae"),
        (F.lit(1.0) - F.sum(miss * miss)
         / F.nullif(F.var_pop("yield_q_ha") * F.count("*"), F.lit(0.0))).alias("r2"),
    )


def regressors() -> dict:
    """The compared regressors; gradient-boosted trees stand for the boosted model."""
    common = {"labelCol": "yield_q_ha", "featuresCol": "features", "predictionCol": "predicted"}
    return {
        "linear": LinearRegression(**common),
        "ridge": LinearRegression(regParam=1.0, elasticNetParam=0.0, **common),
        "lasso": LinearRegression(regParam=1.0, elasticNetParam=1.0, **common),
        "forest": forest(),
        "boosted": GBTRegressor(maxIter=10, maxDepth=5, seed=42, **common),
    }


def compare_models(
    trimmed: DataFrame, settings: Settings, names=None, features=FEATURES
) -> DataFrame:
    """Errors of each regressor and crop on the years after the last training year.

    The inputs are prepared once per crop and shared by all regressors; the crops, and then the
    fits of a crop, run side by side.
    """
    spark: SparkSession = trimmed.sparkSession
    past = F.col("year") <= settings.last_training_year
    counts = {r["crop_id"]: r for r in trimmed.groupBy("crop_id").agg(
        F.count_if(past).alias("old"), F.count_if(~past).alias("new")).collect()}
    chosen = {n: r for n, r in regressors().items() if names is None or n in names}

    def compared(crop: int) -> list[tuple]:
        rows = trimmed.where(F.col("crop_id") == crop)
        train, test = rows.where(past), rows.where(~past)
        fills = fill_values(train, features)
        prepare = Pipeline(stages=preparation(features)).fit(filled(train, fills))
        columns = ["yield_q_ha", "features"]
        ready = prepare.transform(filled(train, fills)).select(*columns).persist()
        unseen = prepare.transform(filled(test, fills)).select(*columns).persist()

        def judged(name: str) -> tuple:
            score = errors(chosen[name].fit(ready).transform(unseen))
            return crop, name, score["mae"], score["r2"]

        try:
            return run_together(spark, *[partial(judged, n) for n in chosen], most=2)
        finally:
            ready.unpersist()
            unseen.unpersist()

    usable = [c for c in settings.crops if c in counts and counts[c]["old"] and counts[c]["new"]]
    found = run_together(spark, *[partial(compared, c) for c in usable], most=3) if usable and chosen else []
    return spark.createDataFrame(
        [r for part in found for r in part], "crop_id int, model string, mae double, r2 double")


def dept_fold(code) -> "F.Column":
    return (F.crc32(code.cast("binary")) % FOLDS).cast("int")


def fold_sizes(rows: DataFrame) -> DataFrame:
    """``(crop_id, fold, n_departments, n_rows)`` of the folds that ``unknown_departments`` leaves out."""
    return rows.groupBy("crop_id", dept_fold(F.col("dept_code")).alias("fold")).agg(
        F.count_distinct("dept_code").alias("n_departments"), F.count("*").alias("n_rows"))


def comparison_sizes(trimmed: DataFrame, settings: Settings) -> DataFrame:
    """``(crop_id, model, n_train, n_test)``: the rows on which each compared regressor is fitted and
    judged; crops that lack either have none."""
    past = F.col("year") <= settings.last_training_year
    counts = trimmed.where(F.col("crop_id").isin(*settings.crops)).groupBy("crop_id").agg(
        F.count_if(past).alias("n_train"), F.count_if(~past).alias("n_test"))
    names = F.explode(F.array(*[F.lit(m) for m in regressors()]))
    return counts.where("n_train > 0 AND n_test > 0").select("crop_id", names.alias("model"), "n_train", "n_test")


def unknown_departments(rows: DataFrame, folds=range(FOLDS), settings: Settings | None = None) -> DataFrame:
    """Errors on departments the model has never seen: each fold of them is left out in turn.

    ``rows`` should be a staged table: the fits of all crops and folds run side by side on it.
    """
    settings = settings or Settings()

    def left_out(crop: int, fold: int):
        here = rows.where(F.col("crop_id") == crop)
        unseen = dept_fold(F.col("dept_code")) == fold
        train, test = here.where(~unseen), here.where(unseen)
        n_rows = test.count()
        if train.isEmpty() or not n_rows:
            return []
        fills, model = fit(train, regressors()["ridge"])
        score = errors(model.transform(filled(test, fills)))
        return [(crop, fold, n_rows, score["mae"], score["r2"])]

    found = run_together(
        rows.sparkSession, *[partial(left_out, c, f) for c in settings.crops for f in folds], most=4)
    return rows.sparkSession.createDataFrame(
        [r for part in found for r in part], "crop_id int, fold int, n_rows long, mae double, r2 double")
