"""Registered queries over scored outputs.

The operators take any probability, score, cluster or forecast column. Trained models cannot be
reproduced in SQL, so these queries feed them rules of thumb that can, over the whole tables:
recency for churn, the share of serious events for failure, the sum of absolute z-scores for
anomalies, bands of session counts for clusters and trailing averages for forecasts.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from floorlens.functions.calendar import minute_index
from floorlens.functions.exact import ratio
from floorlens.ml import datasets, evaluation, isolation, scoring, segments
from floorlens.operators import features, lookups, tiers
from floorlens.operators.reports.executive import daily_activity
from floorlens.operators.reports.player import active_players
from floorlens.operators.views import machine_daily
from floorlens.session import pin, unpin
from floorlens.sources.bind import Floor

SESSION_BANDS = [(46, 3), (38, 2), (30, 1)]
SLA_MINUTES = {"Critical": 20_000, "High": 40_000, "Medium": 80_000}
SLA_OTHER = 160_000


def churn(floor: Floor) -> DataFrame:
    """Days away as a share of 90."""
    p = ratio(F.least(F.col("days_since_last_session"), F.lit(90)), F.lit(90)).cast("double")
    return features.player_churn(floor).withColumn("churn_probability", p)


def failure(floor: Floor) -> DataFrame:
    serious = F.col("high_severity_event_count") + F.col("critical_event_count") * 2
    p = ratio(F.least(serious * 2, F.col("total_historical_events") + 1), F.col("total_historical_events") + 1)
    return features.machine_failure(floor).withColumn("failure_probability", p.cast("double"))


def anomaly(floor: Floor) -> DataFrame:
    """Machine-days scored by their z-scores; as large a share is flagged as the rules flag, within bounds."""
    # The z-scores are decimals, so their sum and its ties are the same in every engine.
    parts = [F.coalesce(F.abs(f"{m}_z_score"), F.lit(0)) for m in ("revenue", "wager", "downtime")]
    score = (parts[0] + parts[1] + parts[2]).cast("double")
    daily = pin(machine_daily(floor))
    scored = pin(features.with_anomalies(daily).withColumn("anomaly_score", score))
    unpin(daily)
    return isolation.flag(scored, isolation.contamination(scored))


def clusters(floor: Floor) -> DataFrame:
    band = tiers.ladder(F.col("session_count"), SESSION_BANDS, 0)
    return active_players(floor).withColumn("cluster_id", band.cast("int"))


def churn_output(floor: Floor) -> DataFrame:
    return scoring.churn_scores(churn(floor))


def failure_output(floor: Floor) -> DataFrame:
    return scoring.failure_scores(failure(floor))


def anomaly_output(floor: Floor, **less) -> DataFrame:
    return scoring.anomaly_output(anomaly(floor), **less)


def retention(floor: Floor) -> DataFrame:
    return scoring.retention_priority(churn_output(floor))


def maintenance(floor: Floor) -> DataFrame:
    return scoring.maintenance_priority(failure_output(floor))


def anomaly_summary(floor: Floor) -> DataFrame:
    return scoring.anomaly_machine_summary(anomaly_output(floor, drop=scoring.NOT_SUMMARISED))


def daily_rows(floor: Floor) -> DataFrame:
    rows = datasets.forecast_rows(features.daily_forecast(floor), datasets.DAILY)
    return datasets.chronological_split(rows, "activity_date")


def weekly_rows(floor: Floor) -> DataFrame:
    rows = datasets.forecast_rows(features.weekly_forecast(floor), datasets.WEEKLY)
    return datasets.chronological_split(rows, "week_start_date")


def _test(df: DataFrame) -> DataFrame:
    return df.where("is_test = 1")


DAILY_MODELS = {
    "Naive Previous-Day Baseline": "revenue_lag_1_day",
    "Trailing 7 days": "previous_7_day_average_revenue",
    "Trailing 30 days": "previous_30_day_average_revenue",
}
WEEKLY_MODELS = {
    "Naive Previous-Week Baseline": "revenue_lag_1_week",
    "Trailing 4 weeks": "previous_4_week_average_revenue",
    "Trailing 8 weeks": "previous_8_week_average_revenue",
}


def daily_metrics(floor: Floor) -> DataFrame:
    return scoring.forecast_metrics(_test(daily_rows(floor)), DAILY_MODELS)


def weekly_metrics(floor: Floor) -> DataFrame:
    return scoring.forecast_metrics(_test(weekly_rows(floor)), WEEKLY_MODELS)


def daily_output(floor: Floor) -> DataFrame:
    return scoring.daily_forecast_output(_test(daily_rows(floor)), "previous_30_day_average_revenue")


def weekly_output(floor: Floor) -> DataFrame:
    column = "previous_8_week_average_revenue"
    return scoring.weekly_forecast_output(_test(weekly_rows(floor)), column, "Trailing 8 weeks", column)


def forecast_choice(floor: Floor) -> DataFrame:
    """Daily ships the best trained model; weekly lets the baseline win."""
    daily = daily_metrics(floor).where(F.col("model") != "Naive Previous-Day Baseline").orderBy("rmse", "model").limit(1)
    weekly = weekly_metrics(floor).orderBy("rmse", "model").limit(1)
    return daily.select(F.lit("daily").alias("horizon"), "model", "rmse").unionByName(
        weekly.select(F.lit("weekly").alias("horizon"), "model", "rmse")
    )


def churn_metrics(floor: Floor) -> DataFrame:
    scored = pin(churn_output(floor).select("churn_flag", "churn_probability", "predicted_churn_flag"))
    auc = evaluation.roc_auc(scored, "churn_flag", "churn_probability")
    return evaluation.classification_metrics(scored, "churn_flag", "predicted_churn_flag").crossJoin(F.broadcast(auc))


def churn_class_report(floor: Floor) -> DataFrame:
    return evaluation.class_report(churn_output(floor), "churn_flag", "predicted_churn_flag")


def churn_report_averages(floor: Floor) -> DataFrame:
    return evaluation.report_averages(pin(churn_class_report(floor)))


def second_page(listing: Callable[..., DataFrame], rows: DataFrame, page_size: int, **filters) -> DataFrame:
    """The page behind the last row of the first one, by its keys."""
    held = pin(rows)
    last = listing(held, page_size=page_size, **filters).tail(1)  # one row
    return listing(held, page_size=page_size, after=last[0].asDict(), **filters) if last else held.limit(0)


def location_errors(floor: Floor) -> DataFrame:
    return lookups.location_errors(scoring.location_accuracy(weekly_output(floor)))


def anomaly_agreement(floor: Floor) -> DataFrame:
    return evaluation.classification_metrics(
        anomaly(floor), "rule_based_anomaly_flag", "isolation_forest_anomaly_flag"
    )


def _folded(floor: Floor) -> DataFrame:
    return evaluation.stratified_folds(churn_output(floor), "churn_flag", "player_id")


def churn_folds(floor: Floor) -> DataFrame:
    return _folded(floor).select("player_id", "churn_flag", "fold")


def churn_split(floor: Floor) -> DataFrame:
    scored = churn(floor).select("player_id", "churn_flag")
    return evaluation.stratified_split(scored, "churn_flag", "player_id", 0.20)


def fold_metrics(floor: Floor) -> DataFrame:
    folded = pin(_folded(floor).select("fold", "churn_flag", "churn_probability", "predicted_churn_flag"))
    by_fold = evaluation.classification_metrics(folded, "churn_flag", "predicted_churn_flag", ["fold"])
    auc = evaluation.roc_auc(folded, "churn_flag", "churn_probability", ["fold"])
    return by_fold.join(auc, "fold").select(
        "fold", F.col("accuracy").alias("validation_accuracy"), F.col("precision").alias("validation_precision"),
        F.col("recall").alias("validation_recall"), F.col("f1_score").alias("validation_f1"),
        F.col("roc_auc").alias("validation_roc_auc"),
    )


def fold_summary(floor: Floor) -> DataFrame:
    return evaluation.summarise_folds(fold_metrics(floor))


def threshold_sweep(floor: Floor) -> DataFrame:
    return evaluation.threshold_sweep(churn(floor), "churn_flag", "churn_probability")


def churn_at_best_threshold(floor: Floor) -> DataFrame:
    scored = churn(floor)
    threshold = evaluation.best_threshold(evaluation.threshold_sweep(scored, "churn_flag", "churn_probability"))
    return scoring.churn_scores(scored, threshold)


def cluster_profiles(floor: Floor) -> DataFrame:
    return segments.cluster_scores(segments.cluster_profiles(clusters(floor)))


def segment_profiles(floor: Floor) -> DataFrame:
    scored = cluster_profiles(floor)
    return segments.segment_profiles(scored, segments.segment_names(scored))


def segment_players(floor: Floor) -> DataFrame:
    players = clusters(floor)
    return segments.player_output(players, segments.segment_names(cluster_profiles(floor)))


def churn_checks(floor: Floor) -> DataFrame:
    parts = []
    for spec, build in (
        (datasets.CHURN, features.player_churn), (datasets.FAILURE, features.machine_failure),
        (datasets.ANOMALY, features.machine_anomaly), (datasets.SEGMENTS, active_players),
        (datasets.DAILY, features.daily_forecast), (datasets.WEEKLY, features.weekly_forecast),
    ):
        parts.append(datasets.problems(build(floor), spec).select(F.lit(spec.name).alias("dataset"), "rule", "violations"))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def anomaly_features(floor: Floor) -> DataFrame:
    columns = ["revenue_per_active_hour", "revenue_z_score", "wager_z_score", "downtime_z_score"]
    cleaned = datasets.numeric(features.machine_anomaly(floor).select("activity_date", "machine_id", *columns), columns)
    return datasets.fill_medians(pin(cleaned), columns)


def confusion(floor: Floor) -> DataFrame:
    return evaluation.classification_metrics(churn_output(floor), "churn_flag", "predicted_churn_flag").select(
        *evaluation.CONFUSION
    )


def tickets(floor: Floor) -> DataFrame:
    """Events that need investigation as tickets; age runs to the last event of the log."""
    last = floor.event.agg(F.max("event_timestamp").alias("_now"))
    target = F.lit(SLA_OTHER)
    for severity, minutes in SLA_MINUTES.items():
        target = F.when(F.col("severity") == severity, minutes).otherwise(target)
    return floor.event.where("requires_investigation = 1").crossJoin(F.broadcast(last)).select(
        "event_id", "machine_id", "location_id", "severity",
        (minute_index("_now") - minute_index("event_timestamp")).alias("age_minutes"),
        target.alias("sla_target_minutes"),
    )


ML: dict[str, Callable[[Floor], DataFrame]] = {
    "ml4_stratified_folds": churn_folds,
    "ml4_stratified_split": churn_split,
    "ml5_binary_metrics": churn_metrics,
    "ml5_class_report": churn_class_report,
    "ml5_report_averages": churn_report_averages,
    "ml6_fold_metrics": fold_metrics,
    "ml6_fold_summary": fold_summary,
    "ml7_threshold_sweep": threshold_sweep,
    "ml9_churn_scores": churn_at_best_threshold,
    "ml10_failure_scores": failure_output,
    "ml11_retention_priority": retention,
    "ml11_retention_summary": lambda floor: scoring.retention_summary(retention(floor)),
    "ml12_maintenance_priority": maintenance,
    "ml12_maintenance_summary": lambda floor: scoring.maintenance_summary(maintenance(floor)),
    "ml13_rule_agreement": anomaly_agreement,
    "ml14_anomaly_output": anomaly_output,
    "ml15_anomaly_machine_summary": anomaly_summary,
    "ml17_cluster_profiles": cluster_profiles,
    "ml18_segment_profiles": segment_profiles,
    "ml19_segment_players": segment_players,
    "ml22_daily_split": lambda floor: daily_rows(floor).select("activity_date", "location_id", "is_test"),
    "ml22_weekly_split": lambda floor: weekly_rows(floor).select("week_start_date", "location_id", "is_test"),
    "ml23_daily_metrics": daily_metrics,
    "ml23_weekly_metrics": weekly_metrics,
    "ml24_forecast_choice": forecast_choice,
    "ml25_daily_output": daily_output,
    "ml25_weekly_output": weekly_output,
    "ml26_location_accuracy": lambda floor: scoring.location_accuracy(weekly_output(floor)),
    "ml27_confusion": confusion,
    "ml27_roc": lambda floor: evaluation.roc_points(churn(floor), "churn_flag", "churn_probability"),
    "ml27_precision_recall": lambda floor: evaluation.precision_recall_points(
        churn(floor), "churn_flag", "churn_probability"
    ),
    "ml27_histogram": lambda floor: evaluation.probability_histogram(churn(floor), "churn_flag", "churn_probability"),
    "ml28_dataset_checks": churn_checks,
    "ml29_clean_features": anomaly_features,
}

LOOKUPS: dict[str, Callable[[Floor], DataFrame]] = {
    "a1_executive_kpis": lookups.executive_kpis,
    "a2_revenue_trend": lookups.revenue_trend,
    "a3_high_risk_machines": lambda floor: lookups.high_risk_machines(floor, page=1),
    "a4_player_kpis": lambda floor: lookups.player_kpis(churn_output(floor), segment_players(floor)),
    "a4_segment_distribution": lambda floor: lookups.segment_distribution(segment_players(floor)),
    "a5_churn_risk": lambda floor: lookups.churn_risk(
        churn_output(floor), loyalty_tier="STANDARD", minimum_probability=0.25, search="p1", page=2, page_size=15
    ),
    "a6_player_segments": lambda floor: lookups.player_segments(segment_players(floor), segment="vip high value", page_size=25),
    "a7_player_detail": lambda floor: lookups.player_detail(churn_output(floor), segment_players(floor), "p7"),
    "a8_machine_kpis": lambda floor: lookups.machine_kpis(failure_output(floor), anomaly_output(floor)),
    "a9_failure_risk": lambda floor: lookups.failure_risk(
        failure_output(floor), manufacturer="maker 1", minimum_probability=0.30, page_size=10
    ),
    "a10_anomalies": lambda floor: lookups.anomalies(anomaly_output(floor), risk_level="critical", page=1, page_size=50),
    "a11_maintenance_ranking": lambda floor: lookups.maintenance_ranking(maintenance(floor), page=2),
    "a12_anomaly_ranking": lambda floor: lookups.anomaly_ranking(anomaly_summary(floor), page=1),
    "a12_next_page": lambda floor: second_page(lookups.anomaly_ranking, anomaly_summary(floor), 20),
    "a13_machine_detail": lambda floor: lookups.machine_detail(
        failure_output(floor), maintenance(floor), anomaly_summary(floor), "m7"
    ),
    "a13_machine_top_anomalies": lambda floor: lookups.machine_top_anomalies(
        anomaly_output(floor, only=lookups.is_one("machine_id", "m7")), "m7"
    ),
    "a14_forecast_accuracy": lambda floor: lookups.forecast_accuracy(
        weekly_output(floor), "net_gaming_revenue", "selected_predicted_revenue"
    ),
    "a15_forecast_summary": lambda floor: lookups.forecast_summary(
        daily_output(floor), weekly_output(floor), daily_metrics(floor), weekly_metrics(floor)
    ),
    "a16_daily_list": lambda floor: lookups.forecast_list(
        daily_output(floor), "activity_date", region="europe", forecast_status="review", start_date="2000-06-01",
        end_date="2001-05-31", page=2,
    ),
    "a16_next_page": lambda floor: second_page(
        lookups.forecast_list, daily_output(floor), 50, period="activity_date", region="europe", forecast_status="review"
    ),
    "a17_weekly_list": lambda floor: lookups.forecast_list(weekly_output(floor), "week_start_date", location_id="l3"),
    "a18_model_comparison": lambda floor: lookups.model_comparison(daily_metrics(floor), weekly_metrics(floor)),
    "a18_location_errors": location_errors,
    "a19_location_forecast": lambda floor: lookups.location_forecast(daily_output(floor), weekly_output(floor), "l3"),
    "a19_location_summary": lambda floor: lookups.location_forecast_summary(
        daily_output(floor), weekly_output(floor), "l3"
    ),
    "a20_page_envelope": lambda floor: lookups.envelope(lookups.high_risk(floor), page=1, page_size=20),
    "a21_service_queue": lambda floor: lookups.service_queue(tickets(floor)),
    "a22_probability_band": lambda floor: lookups.probability_band(
        churn_output(floor), "churn_probability", "Medium Risk"
    ),
    "a23_by_severity": lambda floor: lookups.by_severity(
        failure_output(floor), "failure_risk_level", F.asc("machine_id")
    ),
    "a24_revenue_peaks": lambda floor: lookups.revenue_peaks(daily_activity(floor)),
    "a25_maintenance_queue": lambda floor: lookups.maintenance_queue(
        failure_output(floor), minimum_probability=0.2, game_category="category 1"
    ),
}
