"""Regressors on department rows: ridge from summed products, boosted trees, and the baseline.

A ridge regression needs of its rows only their number and the sums of all values and of all
products of two values. One aggregation by crop gives these with map-side partial sums, however
many rows there are; the normal equations, one small system per crop, are then solved as column
expressions on that one row. No row is gathered, and no iteration reads the data again.
"""

from __future__ import annotations

from functools import partial, reduce

from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import Column, DataFrame, Window, functions as F

from fieldcast.operators.staging import stage
from fieldcast.operators.together import run_together
from fieldcast.plans.yields import FEATURES
from fieldcast.settings import Settings

INPUTS = [*FEATURES, "past_mean"]
TARGET = "yield_q_ha"
PENALTY = 1.0  # on inputs of mean 0 and deviation 1


def department_inputs(rows: DataFrame) -> DataFrame:
    """Department rows with ``past_mean``, the mean yield of all earlier years of the department,
    where it and all other inputs are known. A window holds the years of one department."""
    before = Window.partitionBy("crop_id", "dept_code").orderBy("year").rowsBetween(
        Window.unboundedPreceding, -1)
    known = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in (*INPUTS, TARGET)])
    return rows.withColumn("past_mean", F.avg(TARGET).over(before)).where(known).select(
        "crop_id", "dept_code", "year", TARGET, *INPUTS)


def product_name(a: str, b: str) -> str:
    return f"sum_{a}_x_{b}"


def gram_sums(rows: DataFrame, inputs=INPUTS, target: str = TARGET) -> DataFrame:
    """One row per crop: ``n_rows``, the sum of each column and of each product of two columns."""
    columns = [*inputs, target]
    return rows.groupBy("crop_id").agg(
        F.count("*").alias("n_rows"),
        *[F.sum(c).alias(f"sum_{c}") for c in columns],
        *[F.sum(F.col(a) * F.col(b)).alias(product_name(a, b))
          for i, a in enumerate(columns) for b in columns[i:]])


def ridge_weights(gram: DataFrame, inputs=INPUTS, target: str = TARGET, penalty: float = PENALTY) -> DataFrame:
    """One row per crop: ``mean_<target>`` and per input ``mean_``, ``sd_`` and ``weight_``.

    The system of correlations plus penalty is symmetric and positive, so elimination needs no
    exchange of rows. A constant input gets the weight 0.
    """
    columns = [*inputs, target]
    n, d = F.col("n_rows"), len(inputs)
    df = gram.withColumns({f"mean_{c}": F.col(f"sum_{c}") / n for c in columns})

    def moment(a: str, b: str) -> Column:
        return F.col(product_name(a, b)) / n - F.col(f"mean_{a}") * F.col(f"mean_{b}")

    df = df.withColumns({f"sd_{c}": F.sqrt(F.greatest(moment(c, c), F.lit(0.0))) for c in inputs})

    def scaled(x: Column, *by: str) -> Column:
        divisor = reduce(lambda a, b: a * b, [F.col(f"sd_{c}") for c in by])
        return F.coalesce(x / F.nullif(divisor, F.lit(0.0)), F.lit(0.0))

    df = df.withColumns({
        **{f"a_{i}_{j}": scaled(moment(inputs[i], inputs[j]), inputs[i], inputs[j])
           + (F.lit(penalty) / n if i == j else F.lit(0.0)) for i in range(d) for j in range(i, d)},
        **{f"a_{i}_{d}": scaled(moment(inputs[i], target), inputs[i]) for i in range(d)},
    })
    for k in range(d - 1):  # entries below the diagonal mirror those above it
        df = df.withColumns({
            f"a_{i}_{j}": F.col(f"a_{i}_{j}") - F.col(f"a_{k}_{i}") * F.col(f"a_{k}_{j}") / F.col(f"a_{k}_{k}")
            for i in range(k + 1, d) for j in range(i, d + 1)})
    for i in reversed(range(d)):
        rest = [F.col(f"a_{i}_{j}") * F.col(f"weight_{inputs[j]}") for j in range(i + 1, d)]
        df = df.withColumn(f"weight_{inputs[i]}", reduce(
            lambda a, b: a - b, rest, F.col(f"a_{i}_{d}")) / F.col(f"a_{i}_{i}"))
    return df.select(
        "crop_id", f"mean_{target}",
        *[f"{kind}_{c}" for kind in ("mean", "sd", "weight") for c in inputs])


def ridge_predictions(rows: DataFrame, weights: DataFrame, inputs=INPUTS, target: str = TARGET) -> DataFrame:
    """``rows`` with ``predicted``. ``weights`` has one row per crop of the run, a closed list."""
    parts = [
        F.coalesce((F.col(c) - F.col(f"mean_{c}")) / F.nullif(F.col(f"sd_{c}"), F.lit(0.0)), F.lit(0.0))
        * F.col(f"weight_{c}") for c in inputs]
    joined = rows.join(F.broadcast(weights), "crop_id")
    return joined.withColumn(
        "predicted", reduce(lambda a, b: a + b, parts, F.col(f"mean_{target}"))).select(*rows.columns, "predicted")


def errors_by_crop(predicted: DataFrame, model: str, target: str = TARGET) -> DataFrame:
    miss = F.col(target) - F.col("predicted")
    return predicted.groupBy("crop_id").agg(
        F.count("*").alias("n_rows"), F.avg(F.abs(miss)).alias("mae"),
        (F.lit(1.0) - F.sum(miss * miss) / F.nullif(F.var_pop(target) * F.count("*"), F.lit(0.0))).alias("r2"),
    ).select("crop_id", F.lit(model).alias("model"), "n_rows", "mae", "r2")


def split(inputs: DataFrame, settings: Settings) -> tuple[DataFrame, DataFrame]:
    here = inputs.where(F.col("crop_id").isin(*settings.crops))
    past = F.col("year") <= settings.last_training_year
    return here.where(past), here.where(~past)


def ridge_and_baseline(inputs: DataFrame, settings: Settings) -> DataFrame:
    """Errors of the historical mean and of the ridge on the years after the last training year."""
    train, test = split(inputs, settings)
    ridge = ridge_predictions(test, ridge_weights(gram_sums(train)))
    return errors_by_crop(test.withColumn("predicted", F.col("past_mean")), "baseline").unionByName(
        errors_by_crop(ridge, "ridge"))


def boosted_trees() -> GBTRegressor:
    return GBTRegressor(maxIter=20, maxDepth=3, stepSize=0.1, seed=42, labelCol=TARGET,
                        featuresCol="features", predictionCol="predicted")


def department_models(inputs: DataFrame, settings: Settings) -> DataFrame:
    """Errors per crop of baseline, ridge and boosted trees on the same rows and years.

    The trees of the crops are trained side by side on one staged table; a crop without rows
    before or after the split has no trees.
    """
    inputs = stage(inputs, "department-inputs")
    train, test = (VectorAssembler(inputCols=INPUTS, outputCol="features").transform(x) for x in split(inputs, settings))
    counts = {r["crop_id"]: r for r in inputs.groupBy("crop_id").agg(
        F.count_if(F.col("year") <= settings.last_training_year).alias("old"),
        F.count_if(F.col("year") > settings.last_training_year).alias("new")).collect()}
    usable = [c for c in settings.crops if c in counts and counts[c]["old"] and counts[c]["new"]]

    def boosted(crop: int) -> DataFrame:
        model = boosted_trees().fit(train.where(F.col("crop_id") == crop))
        return model.transform(test.where(F.col("crop_id") == crop))

    found = ridge_and_baseline(inputs, settings)
    if usable:
        trees = run_together(inputs.sparkSession, *[partial(boosted, c) for c in usable], most=4)
        found = found.unionByName(errors_by_crop(reduce(DataFrame.unionByName, trees), "boosted"))
    return found
