"""Yield model of each crop: imputation, soil encoding and a random forest in Spark ML."""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.feature import OneHotEncoder, StringIndexer, VectorAssembler
from pyspark.ml.regression import RandomForestRegressor
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from fieldcast.operators.quantiles import quantile_table
from fieldcast.operators.staging import stage
from fieldcast.plans.yields import FEATURES
from fieldcast.settings import MIN_MODEL_ROWS, MIN_VALIDATION_ROWS, UNKNOWN_SOIL, Settings

# Fixed values of the forest.
TREES, DEPTH, MIN_LEAF, SEED = 40, 10, 4, 42
PARTITION_ROWS = 100_000  # training rows of a partition
MIN_PARTITIONS = 4


def forest() -> RandomForestRegressor:
    return RandomForestRegressor(
        numTrees=TREES, maxDepth=DEPTH, minInstancesPerNode=MIN_LEAF,
        featureSubsetStrategy="sqrt", seed=SEED, maxMemoryInMB=512,
        labelCol="yield_q_ha", featuresCol="features", predictionCol="predicted",
    )


def fill_values(training: DataFrame, features=FEATURES) -> dict[str, float | str]:
    """Median of each numeric input and the most frequent soil (the first by name on a tie).

    Computed for one crop; the two results are single rows.
    """
    one = training.select(F.lit(1).alias("all"), "soil_family", *features)
    medians = quantile_table(one, ["all"], {c: (c, 0.5) for c in features}, small_domain=True)
    soil = (
        one.where("soil_family IS NOT NULL").groupBy("soil_family").count()
        .agg(F.min_by("soil_family", F.struct(-F.col("count"), F.col("soil_family"))).alias("s"))
    )
    values = medians.first()
    found = {c: values[c] for c in features} if values else {}
    return {
        **{c: (0.0 if found.get(c) is None else found[c]) for c in features},
        "soil_family": soil.first()["s"] or UNKNOWN_SOIL,
    }


def filled(rows: DataFrame, fills: dict, prefix: str = "") -> DataFrame:
    """Model inputs without gaps, under the names ``in_*``."""
    numeric = [c for c in fills if c != "soil_family"]
    return rows.withColumns({
        **{f"in_{c}": F.coalesce(F.col(f"{prefix}{c}"), F.lit(float(fills[c]))) for c in numeric},
        "in_soil": F.coalesce("soil_family", F.lit(fills["soil_family"])),
    })


def preparation(features=FEATURES) -> list:
    """Soil to indicator columns (an unseen soil has none set), then one input vector."""
    return [
        StringIndexer(inputCol="in_soil", outputCol="soil_index", handleInvalid="keep",
                      stringOrderType="alphabetAsc"),
        OneHotEncoder(inputCol="soil_index", outputCol="soil_vector", dropLast=True),
        VectorAssembler(inputCols=[*[f"in_{c}" for c in features], "soil_vector"],
                        outputCol="features"),
    ]


MODEL_COLUMNS = [*[f"in_{c}" for c in FEATURES], "in_soil", "soil_index", "soil_vector", "features"]


@dataclass(frozen=True)
class YieldModel:
    crop_id: int
    fills: dict
    fitted: PipelineModel
    metrics: dict = field(default_factory=dict)

    def predict(self, rows: DataFrame, prefix: str = "x_") -> DataFrame:
        ready = filled(rows, self.fills, prefix)
        return self.fitted.transform(ready).drop(*MODEL_COLUMNS)


def fit(training: DataFrame, regressor=None, features=FEATURES) -> tuple[dict, PipelineModel]:
    fills = fill_values(training, features)
    stages = [*preparation(features), regressor or forest()]
    return fills, Pipeline(stages=stages).fit(filled(training, fills))


def errors(predicted: DataFrame, column: str = "predicted") -> dict[str, float]:
    """Mean absolute error and coefficient of determination."""
    score = RegressionEvaluator(labelCol="yield_q_ha", predictionCol=column)
    return {m: score.setMetricName(m).evaluate(predicted) for m in ("mae", "r2")}


def in_fixed_order(rows: DataFrame, n_rows: int) -> DataFrame:
    """The same rows in the same partitions and order, however the table they come from lies in
    files: the forest draws its samples by partition and row, and a repeated run must draw the same.

    For each level of the trees every partition shuffles the statistics of all nodes, however few
    rows it holds. Partitions of many rows keep that in proportion to the rows; their number depends
    on nothing else, so any session draws the same.
    """
    n = max(MIN_PARTITIONS, -(-n_rows // PARTITION_ROWS))
    return rows.repartition(n, "cell_id", "year").sortWithinPartitions(*rows.columns)


def train_yield_model(
    crop_id: int, trimmed: DataFrame, settings: Settings, n_valid: int | None = None,
) -> YieldModel:
    """Fit the model of one crop; judge it on the years after the last training year.

    ``n_valid`` is the number of usable rows before trimming; too few fail the crop.
    """
    rows = trimmed.where(F.col("crop_id") == crop_id)
    past = F.col("year") <= settings.last_training_year
    counts = rows.agg(
        F.count("*").alias("all"), F.count_if(past).alias("old"), F.count_if(~past).alias("new")
    ).first()
    n_valid = counts["all"] if n_valid is None else n_valid
    if n_valid < MIN_MODEL_ROWS:
        raise ValueError(
            f"crop {crop_id}: only {n_valid} usable yield rows, {MIN_MODEL_ROWS} are needed"
        )
    metrics = {"mae": None, "r2": None, "n_rows": counts["all"]}
    rows = in_fixed_order(rows, counts["all"]).persist()
    try:
        if counts["old"] >= MIN_MODEL_ROWS and counts["new"] >= MIN_VALIDATION_ROWS:
            fills, trial = fit(rows.where(past))
            metrics.update(errors(trial.transform(filled(rows.where(~past), fills))))
        fills, fitted = fit(rows)
    finally:
        rows.unpersist()
    return YieldModel(crop_id, fills, fitted, metrics)


def usable_rows(training: DataFrame, settings: Settings) -> dict[int, int]:
    """Usable training rows by crop (crops are a closed list)."""
    counted = training.groupBy("crop_id").count().where(F.col("crop_id").isin(*settings.crops))
    found = {r["crop_id"]: r["count"] for r in counted.collect()}
    return {c: found.get(c, 0) for c in settings.crops}


def predict_by_crop(models: list[YieldModel], mask: Column | None = None):
    """Each model sees the rows of its own crop only, and of those the ones in ``mask`` (all, if
    it is not given). Other rows get a NULL, which the caller's own mask turns into its value.

    The rows are staged, as every model reads its part of them.
    """

    def predict(rows: DataFrame) -> DataFrame:
        held = stage(rows, "to-predict")
        wanted = F.lit(True) if mask is None else F.coalesce(mask, F.lit(False))
        known = F.col("crop_id").isin(*[m.crop_id for m in models]) & wanted
        parts = [m.predict(held.where((F.col("crop_id") == m.crop_id) & wanted)) for m in models]
        rest = held.where(~F.coalesce(known, F.lit(False))).withColumn("predicted", F.lit(None).cast("double"))
        return reduce(DataFrame.unionByName, parts, rest)

    return predict


def metrics_table(spark: SparkSession, models: list[YieldModel]) -> DataFrame:
    return spark.createDataFrame(
        [(m.crop_id, m.metrics["n_rows"], m.metrics["mae"], m.metrics["r2"]) for m in models],
        "crop_id int, n_rows long, mae double, r2 double",
    )
