"""Registered training runs, at the published model sizes and over the whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml import Pipeline
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from floorlens.ml import clustering, datasets, evaluation, isolation, model_store, pipelines, scoring, segments, training
from floorlens.operators import features
from floorlens.operators.reports.player import active_players
from floorlens.operators.views import machine_daily
from floorlens.session import pin, unpin
from floorlens.sources.bind import Floor


def preprocessed(floor: Floor) -> DataFrame:
    """Churn features after imputing and scaling, one column per number, categories one-hot."""
    numbers, categories = datasets.CHURN_NUMERIC, datasets.CHURN_CATEGORICAL
    rows = pipelines.prepare(features.player_churn(floor), numbers, categories)
    rows = pipelines.with_modes(rows, pipelines.most_frequent(rows, categories))
    model = Pipeline(stages=pipelines.preprocessing(numbers, categories)).fit(rows)
    names = pipelines.feature_names(model, rows)
    values = vector_to_array("features")
    kept = [(i, n) for i, n in enumerate(names) if not n.endswith("__unknown")]
    clean = lambda n: n.lower().replace(" ", "_").replace("-", "_").replace("+", "_up")
    return model.transform(rows).select("player_id", *[values[i].alias(clean(n)) for i, n in kept])


def _churn_run(rows: DataFrame) -> training.Trained:
    return model_store.fitted_once("churn", rows, training.train_churn, pipelines.CHURN_FOREST)


def _churn(floor: Floor) -> training.Trained:
    """The churn run; fitted once for all queries that read it."""
    return _churn_run(features.player_churn(floor))


def _failure(floor: Floor) -> training.Trained:
    return model_store.fitted_once("failure", features.machine_failure(floor), training.train_failure, pipelines.FAILURE_FOREST)


def _daily(floor: Floor) -> training.Trained:
    rows = features.daily_forecast(floor)
    return model_store.fitted_once("daily", rows, training.train_daily, pipelines.DAILY_FOREST, pipelines.DAILY_BOOSTING)


def _weekly(floor: Floor) -> training.Trained:
    rows = features.weekly_forecast(floor)
    return model_store.fitted_once("weekly", rows, training.train_weekly, pipelines.WEEKLY_FOREST, pipelines.WEEKLY_BOOSTING)


def churn_models(floor: Floor) -> DataFrame:
    return _churn(floor).metrics


def churn_scores(floor: Floor) -> DataFrame:
    return scoring.churn_scores(_churn(floor).scored)


def churn_validation(floor: Floor) -> DataFrame:
    """Each of five folds scored by a refit of the chosen kind of model on the other four; both runs read the same rows."""
    rows, forest = pin(features.player_churn(floor)), pipelines.CHURN_FOREST
    folds = model_store.fitted_once("churn-folds", rows, training.validate_churn, _churn_run(rows).name, forest).folds
    unpin(rows)
    return folds


def churn_validation_summary(floor: Floor) -> DataFrame:
    return evaluation.summarise_folds(churn_validation(floor))


def churn_drivers(floor: Floor) -> DataFrame:
    """What moves the chosen churn model, and in which direction."""
    run = _churn(floor)
    return pipelines.importance(run.model, run.scored, "Higher churn risk", "Lower churn risk")


def churn_retention(floor: Floor) -> DataFrame:
    """Players by the revenue the trained model sees at risk."""
    return scoring.retention_priority(churn_scores(floor))


def failure_models(floor: Floor) -> DataFrame:
    return _failure(floor).metrics


def failure_validation(floor: Floor) -> DataFrame:
    return _failure(floor).folds


def failure_scores(floor: Floor) -> DataFrame:
    return scoring.failure_scores(_failure(floor).scored)


def failure_thresholds(floor: Floor) -> DataFrame:
    """What each cut of the trained model's probability reaches."""
    return evaluation.threshold_sweep(_failure(floor).scored, datasets.FAILURE.target, "failure_probability")


def failure_at_best_threshold(floor: Floor) -> DataFrame:
    return scoring.failure_scores(_failure(floor).scored, evaluation.best_threshold(failure_thresholds(floor)))


def failure_maintenance(floor: Floor) -> DataFrame:
    """Machines by the trained model's maintenance priority."""
    return scoring.maintenance_priority(failure_scores(floor))


def failure_importance(floor: Floor) -> DataFrame:
    run = _failure(floor)
    return pipelines.importance(run.model, run.scored)


def isolation_forest(floor: Floor) -> DataFrame:
    daily = pin(machine_daily(floor))
    days = pin(features.with_anomalies(daily))
    unpin(daily)
    found = isolation.detect(days)
    unpin(days)
    return scoring.anomaly_output(found)


def cluster_evaluation(floor: Floor) -> DataFrame:
    return clustering.evaluate(clustering.scaled(active_players(floor)))


def player_clusters(floor: Floor) -> DataFrame:
    rows = clustering.scaled(active_players(floor))
    assigned = clustering.assign(rows, clustering.choose(clustering.evaluate(rows)))
    names = segments.segment_names(segments.cluster_scores(segments.cluster_profiles(assigned)))
    return segments.player_output(assigned, names)


def daily_models(floor: Floor) -> DataFrame:
    return _daily(floor).metrics


def weekly_models(floor: Floor) -> DataFrame:
    return _weekly(floor).metrics


def daily_forecast(floor: Floor) -> DataFrame:
    """Forecasts of the best trained daily model."""
    return training.daily_output(_daily(floor))


def weekly_forecast(floor: Floor) -> DataFrame:
    """Weekly forecasts as shipped: the baseline's where no model beats it."""
    return training.weekly_output(_weekly(floor))


TRAINED: dict[str, Callable[[Floor], DataFrame]] = {
    "ml1_preprocessing": preprocessed,
    "ml2_churn_models": churn_models,
    "ml2_churn_scores": churn_scores,
    "ml2_churn_validation": churn_validation,
    "ml2_churn_validation_summary": churn_validation_summary,
    "ml2_churn_retention": churn_retention,
    "ml3_failure_models": failure_models,
    "ml3_failure_validation": failure_validation,
    "ml3_failure_scores": failure_scores,
    "ml3_failure_thresholds": failure_thresholds,
    "ml3_failure_at_best_threshold": failure_at_best_threshold,
    "ml3_failure_maintenance": failure_maintenance,
    "ml8_churn_drivers": churn_drivers,
    "ml8_failure_importance": failure_importance,
    "ml13_isolation_forest": isolation_forest,
    "ml16_cluster_evaluation": cluster_evaluation,
    "ml16_player_clusters": player_clusters,
    "ml20_daily_models": daily_models,
    "ml20_daily_forecast": daily_forecast,
    "ml21_weekly_models": weekly_models,
    "ml21_weekly_forecast": weekly_forecast,
}
