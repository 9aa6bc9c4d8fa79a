"""Training runs: split, fit, evaluate, choose and score."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from multiprocessing.pool import ThreadPool

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from floorlens.ml import datasets, evaluation, pipelines, scoring
from floorlens.session import pin, unpin

LOGISTIC = "Logistic Regression"
FOREST = "Random Forest"
FOREST_REGRESSOR = "Random Forest Regressor"
BOOSTING_REGRESSOR = "Gradient Boosting Regressor"
DAILY_BASELINE = "Naive Previous-Day Baseline"
WEEKLY_BASELINE = "Naive Previous-Week Baseline"


@dataclass(frozen=True)
class Trained:
    """The chosen model, its name, what each candidate reached, and every row scored."""

    name: str
    model: PipelineModel
    metrics: DataFrame
    scored: DataFrame
    folds: DataFrame | None = None


def _classifiers(label: str, rows: int, forest: pipelines.Forest) -> dict[str, object]:
    return {LOGISTIC: pipelines.logistic(label, rows), FOREST: pipelines.forest_classifier(label, forest)}


def _measure(scored: DataFrame, label: str, probability: str) -> dict[str, float]:
    """Metrics at 0.5 and the exact AUC of one scored frame; one row reaches the driver."""
    flagged = scored.withColumn("_flag", (F.col(probability) >= 0.5).cast("int"))
    row = (
        evaluation.classification_metrics(flagged, label, "_flag")
        .crossJoin(F.broadcast(evaluation.roc_auc(flagged, label, probability)))
        .first()
    )
    return row.asDict()


def _accuracy(scored: DataFrame, label: str, probability: str) -> float:
    right = (F.col(probability) >= 0.5).cast("int") == F.col(label)
    return scored.agg(F.avg(right.cast("double"))).first()[0]


def _holdout(train: DataFrame, test: DataFrame, columns, estimator, label: str) -> dict[str, float]:
    model = pipelines.fit(train, *columns, estimator)
    return _measure(pipelines.probability(model, test, "_p"), label, "_p")


def _training_frame(df: DataFrame, spec: datasets.Dataset, columns) -> DataFrame:
    """Cleaned rows with class weights, written once so every fit reads the same rows."""
    numbers, categories = columns
    clean = pipelines.prepare(datasets.validate(df, spec), numbers, categories, spec.target)
    clean = pipelines.with_modes(clean, pipelines.most_frequent(clean, categories))
    return pin(pipelines.balanced_weights(clean, spec.target))


def train_churn(df: DataFrame, forest: pipelines.Forest = pipelines.CHURN_FOREST) -> Trained:
    """Logistic regression against a forest on a stratified 80/20 split; the better AUC is kept."""
    spec, columns = datasets.CHURN, (datasets.CHURN_NUMERIC, datasets.CHURN_CATEGORICAL)
    rows = evaluation.stratified_split(_training_frame(df, spec, columns), spec.target, "player_id", 0.20)
    train = rows.where("is_test = 0")
    n = train.count()
    models, scored, records = {}, {}, []
    for name, estimator in _classifiers(spec.target, n, forest).items():
        models[name] = pipelines.fit(train, *columns, estimator)
        # Trees cost far more per row than reading a score, so every row is scored once.
        scored[name] = pin(pipelines.probability(models[name], rows, "churn_probability"))
        reached = _measure(scored[name].where("is_test = 1"), spec.target, "churn_probability")
        records.append((name, *_in_order(reached)))
    metrics = _metrics_frame(df, records)
    best = metrics.orderBy(F.desc("roc_auc"), "model").first()["model"]
    unpin(*[frame for name, frame in scored.items() if name != best])
    return Trained(best, models[best], metrics, scored[best])


_METRICS = ["accuracy", "precision", "recall", "f1_score", "roc_auc"]


def _measures(reached: dict) -> list:
    """Metrics in order; a test set of one class has no AUC."""
    return [None if reached[m] is None else float(reached[m]) for m in _METRICS]


def _in_order(reached: dict) -> list:
    return _measures(reached) + [int(reached[c]) for c in evaluation.CONFUSION]


def _metrics_frame(df: DataFrame, records: list, extra: str = "") -> DataFrame:
    fields = ["model string", *[f"{m} double" for m in _METRICS], *[f"{c} long" for c in evaluation.CONFUSION]]
    return df.sparkSession.createDataFrame(records, ", ".join(fields) + extra)


def cross_validate(
    rows: DataFrame, columns, build: Callable[[int], object], spec: datasets.Dataset, key: str, k: int = 5, side_by_side: int = 2,
) -> DataFrame:
    """Metrics of each of k stratified folds; k fits, each distributed, some side by side."""
    folded = pin(evaluation.stratified_folds(rows, spec.target, key, k))

    def measured(fold: int) -> tuple:
        train = folded.where(F.col("fold") != fold)
        model = pipelines.fit(train, *columns, build(train.count()))
        # Every row is scored once, for both measures.
        scored = pin(pipelines.probability(model, folded, "_p").select(spec.target, "fold", "_p"))
        seen = _accuracy(scored.where(F.col("fold") != fold), spec.target, "_p")
        reached = _measure(scored.where(F.col("fold") == fold), spec.target, "_p")
        unpin(scored)
        return (fold + 1, seen, *_measures(reached))

    with ThreadPool(side_by_side) as pool:
        records = pool.map(measured, range(k), chunksize=1)
    unpin(folded)
    fields = ", ".join(f"{m} double" for m in evaluation.FOLD_METRICS)
    return rows.sparkSession.createDataFrame(records, f"fold int, {fields}")


def validate_churn(df: DataFrame, name: str, forest: pipelines.Forest = pipelines.CHURN_FOREST, k: int = 5) -> Trained:
    """Folds of the named kind of churn model, and that kind refitted on all rows."""
    spec, columns = datasets.CHURN, (datasets.CHURN_NUMERIC, datasets.CHURN_CATEGORICAL)
    rows = _training_frame(df, spec, columns)
    build = lambda size: _classifiers(spec.target, size, forest)[name]
    folds = cross_validate(rows, columns, build, spec, "player_id", k)
    model = pipelines.fit(rows, *columns, build(rows.count()))
    scored = pin(pipelines.probability(model, rows, "churn_probability"))
    reached = _measure(scored, spec.target, "churn_probability")
    return Trained(name, model, _metrics_frame(df, [(name, *_in_order(reached))]), scored, folds)


def train_failure(df: DataFrame, forest: pipelines.Forest = pipelines.FAILURE_FOREST, k: int = 5) -> Trained:
    """Holdout of 25 % and k folds per model; best mean AUC, then F1, is refitted on all rows."""
    spec, columns = datasets.FAILURE, (datasets.FAILURE_NUMERIC, datasets.FAILURE_CATEGORICAL)
    rows = _training_frame(df, spec, columns)
    split = evaluation.stratified_split(rows, spec.target, "machine_id", 0.25)
    train, test = split.where("is_test = 0"), split.where("is_test = 1")
    n, n_train = rows.count(), train.count()
    builders = {
        LOGISTIC: lambda size: pipelines.logistic(spec.target, size),
        FOREST: lambda size: pipelines.forest_classifier(spec.target, forest),
    }
    records, folds = [], {}
    for name, build in builders.items():
        folds[name] = cross_validate(rows, columns, build, spec, "machine_id", k)
        spread = evaluation.summarise_folds(folds[name], population=True)
        summary = {r["metric"]: r for r in spread.collect()}  # one row per metric
        reached = _holdout(train, test, columns, build(n_train), spec.target)
        cv = [summary[f"validation_{m}"]["mean"] for m in ("accuracy", "precision", "recall", "f1", "roc_auc")]
        deviations = [summary[f"validation_{m}"]["standard_deviation"] for m in ("accuracy", "roc_auc")]
        records.append((name, *_in_order(reached), *cv, *deviations))
    extra = "".join(
        f", {c} double"
        for c in ("cv_accuracy_mean", "cv_precision_mean", "cv_recall_mean", "cv_f1_mean", "cv_roc_auc_mean",
                  "cv_accuracy_std", "cv_roc_auc_std")
    )
    metrics = _metrics_frame(df, records, extra)
    best = metrics.orderBy(F.desc("cv_roc_auc_mean"), F.desc("cv_f1_mean"), "model").first()["model"]
    model = pipelines.fit(rows, *columns, builders[best](n))
    scored = pipelines.probability(model, rows, "failure_probability")
    return Trained(best, model, metrics, scored, folds[best])


def fit_failure(df: DataFrame, forest: pipelines.Forest = pipelines.FAILURE_FOREST) -> tuple[PipelineModel, DataFrame]:
    """The failure forest on all rows, with the rows it was fitted on."""
    columns = (datasets.FAILURE_NUMERIC, datasets.FAILURE_CATEGORICAL)
    rows = _training_frame(df, datasets.FAILURE, columns)
    return pipelines.fit(rows, *columns, pipelines.forest_classifier(datasets.FAILURE.target, forest)), rows


def train_forecast(
    df: DataFrame, spec: datasets.Dataset, numbers: list[str], categories: list[str], baseline: str, baseline_name: str,
    forest: pipelines.Forest, boosting: pipelines.Boosting,
) -> Trained:
    """Forest and boosting on the earlier periods; metrics of both and of the naive baseline on the later ones."""
    usable = datasets.forecast_rows(datasets.validate(df, spec), spec)
    checked = usable.agg(F.count("*").alias("rows"), F.countDistinct(spec.period).alias("periods")).first()
    if checked["rows"] < spec.minimum_rows or checked["periods"] < spec.minimum_periods:
        raise ValueError(f"{spec.name}: too few rows with complete history")
    split = datasets.chronological_split(usable, spec.period)
    clean = pipelines.prepare(split, numbers, categories, spec.target)
    rows = pin(pipelines.with_modes(clean, pipelines.most_frequent(clean, categories)))
    train, scored = rows.where("is_test = 0"), rows.where("is_test = 1")
    estimators = {
        FOREST_REGRESSOR: pipelines.forest_regressor(spec.target, forest),
        BOOSTING_REGRESSOR: pipelines.boosting_regressor(spec.target, boosting),
    }
    with ThreadPool(len(estimators)) as pool:
        fitted = pool.map(lambda estimator: pipelines.fit(train, numbers, categories, estimator), estimators.values(), chunksize=1)
    models, columns = dict(zip(estimators, fitted)), {baseline_name: baseline}
    for i, name in enumerate(models):
        columns[name] = f"prediction_{i}"
        scored = pipelines.prediction(models[name], scored, columns[name])
    scored = pin(scored)
    metrics = scoring.forecast_metrics(scored, columns)
    best = metrics.where(F.col("model").isin(list(models))).orderBy("rmse", "model").first()["model"]
    return Trained(best, models[best], metrics, scored.withColumn("best_prediction", F.col(columns[best])))


def train_daily(df: DataFrame, forest=pipelines.DAILY_FOREST, boosting=pipelines.DAILY_BOOSTING) -> Trained:
    return train_forecast(
        df, datasets.DAILY, datasets.DAILY_NUMERIC, datasets.DAILY_CATEGORICAL, "revenue_lag_1_day", DAILY_BASELINE,
        forest, boosting,
    )


def train_weekly(df: DataFrame, forest=pipelines.WEEKLY_FOREST, boosting=pipelines.WEEKLY_BOOSTING) -> Trained:
    return train_forecast(
        df, datasets.WEEKLY, datasets.WEEKLY_NUMERIC, datasets.WEEKLY_CATEGORICAL, "revenue_lag_1_week",
        WEEKLY_BASELINE, forest, boosting,
    )


def daily_output(trained: Trained) -> DataFrame:
    """Daily always ships the best trained model."""
    return scoring.daily_forecast_output(trained.scored, "best_prediction")


def weekly_output(trained: Trained) -> DataFrame:
    """Weekly ships the baseline where its error is the lowest of all."""
    winner = trained.metrics.orderBy("rmse", "model").first()["model"]
    selected = "revenue_lag_1_week" if winner == WEEKLY_BASELINE else "best_prediction"
    method = WEEKLY_BASELINE if winner == WEEKLY_BASELINE else trained.name
    return scoring.weekly_forecast_output(trained.scored, "best_prediction", method, selected)
