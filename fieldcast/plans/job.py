"""The batch job: train, build, check, and replace partitions of the fact table."""

from __future__ import annotations

import logging
from collections.abc import Callable
from functools import partial, reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from fieldcast.operators.staging import stage, staging_run
from fieldcast.operators.together import run_together
from fieldcast.plans.fact import median_areas, prediction_mask, projection_fact
from fieldcast.plans.model import YieldModel, predict_by_crop, train_yield_model, usable_rows
from fieldcast.plans.quality import duplicate_examples, fact_violations, partition_summary
from fieldcast.plans.shared import shared_inputs
from fieldcast.plans.yields import yield_history
from fieldcast.settings import Settings
from fieldcast.sources.factstore import replace_partitions
from fieldcast.sources.tables import missing_crops

log = logging.getLogger("fieldcast")

#: Failures of the cluster, which no narrower build could avoid.
NOT_THE_DATA = ("ExecutorLostFailure", "No space left", "SparkContext was shut down", "cancelled", "FetchFailed")
RESULT = "crop_id int, horizon_year int, n_rows long, error string"


class ProjectionError(RuntimeError):
    """Some crops or partitions failed; ``results`` tells which, the others are written."""

    def __init__(self, message: str, results: DataFrame):
        super().__init__(message)
        self.results = results


def check_constraints(tables, settings: Settings) -> None:
    missing = sorted(r[0] for r in missing_crops(tables.constraints, settings.crops).collect())
    if missing:
        raise ValueError(f"crops without constraints: {missing}")
    crop = F.col("crop_id").cast("int").alias("crop_id")
    twice = tables.constraints.select(crop).where(F.col("crop_id").isin(*settings.crops))
    repeated = sorted(r[0] for r in twice.groupBy("crop_id").count().where("count > 1").collect())
    if repeated:
        raise ValueError(f"crops with several rows of constraints: {repeated}")


def train_models(history, settings: Settings):
    """A model per crop, trained side by side; a crop that cannot be trained is reported."""
    counts = usable_rows(history.training, settings)

    def train(crop: int):
        try:
            return train_yield_model(crop, history.trimmed, settings, counts[crop])
        except Exception as error:  # noqa: BLE001
            log.exception("crop %s: training failed", crop)
            return str(error)

    found = run_together(
        history.trimmed.sparkSession, *[partial(train, crop) for crop in settings.crops]
    )
    models = [m for m in found if isinstance(m, YieldModel)]
    for model in models:
        log.info("model of crop %s: %s", model.crop_id, model.metrics)
    return models, {c: m for c, m in zip(settings.crops, found) if isinstance(m, str)}


def checked_partitions(fact: DataFrame, settings: Settings, crops) -> tuple[dict, dict]:
    """Row counts of sound partitions and the errors of the others.

    At most one row per crop, horizon and rule reaches the driver.
    """
    rows = fact_violations(fact).collect()
    counts = {(r["crop_id"], r["horizon_year"]): r["n_rows"] for r in rows}
    errors: dict[tuple, str] = {}
    for crop in crops:
        for horizon in settings.horizons:
            if not counts.get((crop, horizon)):
                errors[(crop, horizon)] = "no rows"
    for r in rows:
        if r["violations"]:
            key = (r["crop_id"], r["horizon_year"])
            text = f"{r['rule']}: {r['violations']}"
            if r["rule"] == "duplicate_key":
                here = fact.where(
                    (F.col("crop_id") == key[0]) & (F.col("horizon_year") == key[1])
                )
                text += f", such as {duplicate_examples(here)}"
            errors[key] = f"{errors[key]}; {text}" if key in errors else text
    return {k: n for k, n in counts.items() if k not in errors}, errors


def build_fact(tables, settings: Settings, history, models, medians, shared=None) -> tuple:
    """Staged fact rows of all partitions, by the models of their crops, and the errors of those
    that cannot be built."""
    def build(part: Settings) -> DataFrame:
        used = [m for m in models if m.crop_id in part.crops]
        return projection_fact(tables, part, history, predict_by_crop(used, prediction_mask()), medians, shared)

    return built_partitions(build, settings)


def built_partitions(fact_of: Callable[[Settings], DataFrame], settings: Settings) -> tuple:
    """Staged rows of all partitions of ``settings`` and the errors of those that cannot be built.

    One plan builds everything. Only if that fails are the crops built one by one, and of a crop that
    fails the horizons, to tell the sound partitions from the others.
    """
    def build(part: Settings) -> DataFrame:
        return stage(fact_of(part), "fact")

    def apart(part: Settings) -> list[Settings]:
        if len(part.crops) > 1:
            return [part.narrowed([crop]) for crop in part.crops]
        return [part.narrowed(horizons=[horizon]) for horizon in part.horizons]

    try:
        return build(settings), {}
    except Exception as error:  # noqa: BLE001
        if any(mark in str(error) for mark in NOT_THE_DATA):
            raise  # smaller builds would meet the same cluster
        log.exception("the joint build failed, building in parts")
    built, errors, parts = [], {}, apart(settings)
    while parts:
        part = parts.pop(0)
        try:
            built.append(build(part))
        except Exception as error:  # noqa: BLE001
            log.exception("crop %s, horizons %s: build failed", part.crops[0], part.horizons)
            if len(part.horizons) > 1:
                parts += apart(part)
            else:
                errors[(part.crops[0], part.horizons[0])] = str(error)
    return (reduce(DataFrame.unionByName, built) if built else None), errors


def store_sound(fact: DataFrame | None, unbuilt: dict, fact_path: str | None, settings: Settings) -> list[tuple]:
    """Check built rows and replace the stored partitions that passed, all at once; ``(crop, horizon,
    n_rows, error)`` of every partition. Without a path nothing is written."""
    sound, errors = {}, {}
    if fact is not None:
        sound, errors = checked_partitions(fact, settings, settings.crops)
        for row in partition_summary(fact).collect():
            log.info("%s", row.asDict())
    errors |= unbuilt
    if sound and fact_path is not None:
        good = F.lit(False)
        for crop, horizon in sound:
            good = good | ((F.col("crop_id") == crop) & (F.col("horizon_year") == horizon))
        replace_partitions(fact.where(good), fact_path)
    return [(c, h, 0, e) for (c, h), e in errors.items()] + [(c, h, n, None) for (c, h), n in sound.items()]


def refresh_partitions(
    spark: SparkSession, fact_of: Callable[[Settings], DataFrame], fact_path: str, settings: Settings,
) -> DataFrame:
    """Build partitions by ``fact_of``, check them, and replace the sound ones; every failure stays
    in its partition, whose stored rows stay too. ``(crop_id, horizon_year, n_rows, error)``."""
    with staging_run(spark):
        results = store_sound(*built_partitions(fact_of, settings), fact_path, settings)
    return spark.createDataFrame(results, RESULT).orderBy("crop_id", "horizon_year")


def error_class(error: Column) -> Column:
    """What kind of failure a result's text tells of: the rule that rows broke, or Spark's name of
    the error condition; NULL for none."""
    conditions = F.regexp_extract_all(error, F.lit(r"\[([A-Z_]+)[.\]]"), 1)  # the cause comes last
    condition = F.try_element_at(conditions, F.lit(-1))
    rule = F.regexp_extract(error, r"^([a-z_]+): \d+", 1)
    return F.when(error.isNull(), None).otherwise(F.coalesce(
        F.nullif(rule, F.lit("")), condition, F.lit("other")))


def run_projection(
    spark: SparkSession, tables, fact_path: str | None, settings: Settings | None = None,
    crops=None, horizons=None, dry_run: bool = False, raise_on_failure: bool = True,
) -> DataFrame:
    """Build the fact rows of the chosen crops and horizons and replace those partitions.

    All partitions come from one plan, computed once into a staged table, checked in one
    pass, and written in one go without the unsound ones, whose stored rows stay as they
    were. Returns ``(crop_id, horizon_year, n_rows, error)``. With ``dry_run`` nothing is
    written. Intermediate tables lie in one folder, which is removed at the end.
    """
    settings = (settings or Settings()).narrowed(crops, horizons)
    if fact_path is None and not dry_run:
        raise ValueError("a run that is not dry needs a path for the fact table")
    check_constraints(tables, settings)
    with staging_run(spark):
        shared = shared_inputs(tables, settings)
        history = yield_history(tables, settings, shared.past(settings.history_years))
        (models, failed), medians = run_together(
            spark, lambda: train_models(history, settings), lambda: median_areas(tables, settings, shared)
        )
        results = [(c, None, 0, e) for c, e in failed.items()]
        if models:
            trained = settings.narrowed(crops=[m.crop_id for m in models])
            fact, unbuilt = build_fact(tables, trained, history, models, medians, shared)
            results += store_sound(fact, unbuilt, None if dry_run else fact_path, trained)
    frame = spark.createDataFrame(results, RESULT).orderBy("crop_id", "horizon_year")
    broken = [r for r in results if r[3]]
    if broken and raise_on_failure:
        lines = "\n".join(
            f"- crop {c}" + (f", horizon {h}" if h else "") + f": {e}" for c, h, _, e in broken
        )
        raise ProjectionError(f"the projection ended with errors:\n{lines}", frame)
    return frame
