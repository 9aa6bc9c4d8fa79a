"""What is derived from model outputs: labels, actions, exposure and priorities.

Every function takes a DataFrame that already carries a probability, score or prediction column,
whichever model produced it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from floorlens.functions.exact import near
from floorlens.operators import tiers
from floorlens.operators.ranks import Ranking, with_global_ranks

# Actions per tier, strongest first.
CHURN_ACTIONS = [
    "Immediate retention outreach", "Targeted loyalty offer", "Monitor engagement", "No immediate action",
]
FAILURE_ACTIONS = [
    "Immediate maintenance inspection", "Schedule preventive maintenance", "Increase monitoring frequency",
    "Routine monitoring",
]
ANOMALY_ACTIONS = {
    "Critical": "Immediate operational investigation",
    "High": "Review machine and event history",
    "Medium": "Increase monitoring frequency",
    "Low": "Routine monitoring",
}
ANOMALY_CUTS = (0.80, 0.95, 0.99)


def _number(name: str) -> Column:
    return F.col(name).cast("double")


def _or_zero(name: str) -> Column:
    return F.coalesce(_number(name), F.lit(0.0))


def exposure(revenue: str, probability: str) -> Column:
    """Positive revenue weighted by probability, to the cent."""
    return near(F.greatest(_number(revenue), F.lit(0.0)) * F.col(probability))


def churn_scores(df: DataFrame, threshold: float = 0.50) -> DataFrame:
    p = F.col("churn_probability")
    return df.select(
        "player_id", "loyalty_tier", "age_band", "home_region", "marketing_opt_in", "days_since_last_session",
        "total_historical_sessions", "sessions_last_30_days", "sessions_last_90_days", "total_wager",
        "player_net_revenue", "churn_flag", p,
        F.when(p >= threshold, 1).otherwise(0).alias("predicted_churn_flag"),
        tiers.probability_tier(p).alias("risk_level"),
        tiers.probability_action(p, CHURN_ACTIONS).alias("recommended_action"),
    )


def failure_scores(df: DataFrame, threshold: float = 0.50) -> DataFrame:
    p = F.col("failure_probability")
    return df.select(
        "machine_id", "location_id", "manufacturer", "cabinet_type", "game_title", "game_category",
        "software_version", "machine_status", "machine_age_days", "total_historical_events",
        "unplanned_event_count", "critical_event_count", "high_severity_event_count", "total_downtime_minutes",
        "average_downtime_minutes", "events_last_30_days", "downtime_last_30_days", "events_last_90_days",
        "downtime_last_90_days", "historical_net_revenue", "revenue_last_30_days", "failure_target_flag", p,
        F.when(p >= threshold, 1).otherwise(0).alias("predicted_failure_flag"),
        tiers.probability_tier(p).alias("failure_risk_level"),
        tiers.probability_action(p, FAILURE_ACTIONS).alias("recommended_action"),
        exposure("historical_net_revenue", "failure_probability").alias("revenue_at_risk"),
    )


def _dense(df: DataFrame, score: str, name: str, ids: list[str]) -> DataFrame:
    return with_global_ranks(df, [Ranking(score, {name: "dense_rank"}, True)], ids)


def retention_priority(scored: DataFrame) -> DataFrame:
    """Players by revenue at risk, weighted up the longer they have been away."""
    at_risk = exposure("player_net_revenue", "churn_probability")
    weight = F.lit(1.0) + _or_zero("days_since_last_session") / F.lit(365.0)
    base = (
        scored.select(
            "player_id", "loyalty_tier", "days_since_last_session", "total_historical_sessions",
            "player_net_revenue", "churn_probability", "risk_level", "recommended_action",
        )
        .withColumn("expected_revenue_at_risk", at_risk)
        .withColumn("retention_priority_score", near(F.col("expected_revenue_at_risk") * weight))
    )
    return _dense(base, "retention_priority_score", "priority_rank", ["player_id"])


def retention_summary(prioritised: DataFrame) -> DataFrame:
    return (
        prioritised.groupBy("risk_level")
        .agg(
            F.count("player_id").alias("player_count"),
            F.sum("player_net_revenue").alias("total_player_revenue"),
            F.sum("expected_revenue_at_risk").alias("expected_revenue_at_risk"),
            F.avg("churn_probability").alias("average_churn_probability"),
            F.avg("days_since_last_session").alias("average_days_since_last_session"),
        )
        .orderBy(F.desc("expected_revenue_at_risk"), "risk_level")
    )


def maintenance_priority(scored: DataFrame) -> DataFrame:
    score = (
        F.col("failure_probability") * F.lit(100.0)
        + _or_zero("revenue_at_risk") / F.lit(100.0)
        + _or_zero("total_downtime_minutes") / F.lit(100.0)
        + _or_zero("critical_event_count") * F.lit(2.0)
    )
    base = scored.withColumn("maintenance_priority_score", near(score))
    return _dense(base, "maintenance_priority_score", "maintenance_priority_rank", ["machine_id"])


def maintenance_summary(prioritised: DataFrame) -> DataFrame:
    return (
        prioritised.groupBy("failure_risk_level")
        .agg(
            F.count("machine_id").alias("machine_count"),
            F.avg("failure_probability").alias("average_failure_probability"),
            F.sum("revenue_at_risk").alias("total_revenue_at_risk"),
            F.sum("total_downtime_minutes").alias("total_downtime_minutes"),
            F.sum("critical_event_count").alias("total_critical_events"),
            F.sum("unplanned_event_count").alias("total_unplanned_events"),
        )
        .orderBy(F.desc("total_revenue_at_risk"), "failure_risk_level")
    )


def anomaly_output(df: DataFrame, limit: float = 3, drop: list[str] = [], only: Column | None = None) -> DataFrame:
    """Machine-days with percentile, tier, reason and exposure of their anomaly score.

    Needs ``anomaly_score`` and ``isolation_forest_anomaly_flag``. Percentiles are among all machine-days. For callers
    that need less, columns in ``drop`` are left out, and of rows for which ``only`` (a condition on the key) does not
    hold nothing but key and score is ranked, and none is returned.
    """
    kept = [
        "activity_date", "machine_id", "location_id", "manufacturer", "game_title", "game_category",
        "software_version", "transaction_count", "session_count", "unique_player_count", "total_wager",
        "total_payout", "jackpot_amount", "net_gaming_revenue", "actual_hold_pct", "event_count",
        "downtime_minutes", "critical_event_count", "investigation_count", "availability_pct",
        "revenue_per_active_hour", "revenue_z_score", "wager_z_score", "downtime_z_score",
        "rule_based_anomaly_flag", "isolation_forest_anomaly_flag", "anomaly_score",
    ]
    key = ["activity_date", "machine_id", "location_id"]
    carried = df.select(*[c for c in kept if c not in drop])
    if only is not None:
        carried = carried.withColumns({c: F.when(only, F.col(c)) for c in carried.columns if c not in (*key, "anomaly_score")})
    ranked = with_global_ranks(carried, [Ranking("anomaly_score", {"anomaly_percentile": "average_pct"})], key)
    ranked = ranked if only is None else ranked.where(only)
    reason = (
        F.when(F.col("critical_event_count") > 0, "Critical machine event")
        .when(F.col("downtime_z_score") >= limit, "Unusually high downtime")
        .when(F.abs("revenue_z_score") >= limit, "Unusual revenue behavior")
        .when(F.abs("wager_z_score") >= limit, "Unusual wagering behavior")
        .otherwise("Multivariate behavior anomaly")
    )
    level = F.col("anomaly_risk_level")
    action = F.lit(ANOMALY_ACTIONS["Low"])
    for tier in ("Medium", "High", "Critical"):
        action = F.when(level == tier, ANOMALY_ACTIONS[tier]).otherwise(action)
    return (
        ranked.withColumn(
            "anomaly_risk_level", tiers.probability_tier(F.col("anomaly_percentile"), ANOMALY_CUTS)
        )
        .withColumn("anomaly_reason", reason)
        .withColumn("recommended_action", action)
        .withColumn(
            "revenue_exposure", near(F.abs(_number("net_gaming_revenue")) * F.col("anomaly_percentile"))
        )
    )


#: What ``anomaly_machine_summary`` does not need of an output.
NOT_SUMMARISED = [
    "game_category", "transaction_count", "session_count", "unique_player_count", "total_wager", "total_payout", "jackpot_amount",
    "actual_hold_pct", "event_count", "investigation_count", "availability_pct", "revenue_per_active_hour",
]


def anomaly_machine_summary(output: DataFrame) -> DataFrame:
    keys = ["machine_id", "location_id", "manufacturer", "game_title", "software_version"]
    score = (
        F.col("anomaly_rate") * F.lit(100.0)
        + F.col("maximum_anomaly_score") * F.lit(20.0)
        + F.col("total_critical_events") * F.lit(2.0)
        + F.col("total_revenue_exposure") / F.lit(100.0)
    )
    base = (
        output.groupBy(*keys)
        .agg(
            F.count("activity_date").alias("machine_day_count"),
            F.sum("isolation_forest_anomaly_flag").alias("anomaly_day_count"),
            F.sum("rule_based_anomaly_flag").alias("rule_based_anomaly_day_count"),
            F.avg("anomaly_score").alias("average_anomaly_score"),
            F.max("anomaly_score").alias("maximum_anomaly_score"),
            F.sum("downtime_minutes").alias("total_downtime_minutes"),
            F.sum("critical_event_count").alias("total_critical_events"),
            # Cents are summed as decimals: a float sum would depend on the order of the rows.
            F.sum(F.col("revenue_exposure").cast("decimal(18,2)")).cast("double").alias("total_revenue_exposure"),
        )
        .withColumn("anomaly_rate", F.col("anomaly_day_count") / F.col("machine_day_count"))
        .withColumn("operational_priority_score", near(score))
    )
    return _dense(base, "operational_priority_score", "priority_rank", keys)


# ---- forecasts ---------------------------------------------------------------------------------

TARGET = "net_gaming_revenue"


def _percentage_error(error: Column, actual: Column) -> Column:
    """Absolute error in percent of the actual; NULL where the actual is within one unit of zero."""
    return F.when(F.abs(actual) > 1.0, error / F.abs(actual) * F.lit(100.0))


def _status(error: Column) -> Column:
    return F.when(error <= 10, "High Accuracy").when(error <= 25, "Acceptable").otherwise("Review")


def daily_forecast_output(test: DataFrame, prediction: str, baseline: str = "revenue_lag_1_day") -> DataFrame:
    actual = _number(TARGET)
    return (
        test.select(
            "activity_date", "location_id", "location_name", "region", "location_type", "session_count",
            "unique_player_count", "active_machine_count", "total_wager", "event_count", "downtime_minutes",
            "critical_event_count", TARGET,
            _number(prediction).alias("predicted_revenue"),
            _number(baseline).alias("baseline_predicted_revenue"),
        )
        .withColumn("forecast_error", actual - F.col("predicted_revenue"))
        .withColumn("absolute_error", F.abs("forecast_error"))
        .withColumn("absolute_percentage_error", _percentage_error(F.col("absolute_error"), actual))
        .withColumn("forecast_status", _status(F.col("absolute_percentage_error")))
    )


def weekly_forecast_output(
    test: DataFrame, best_model: str, method: str, selected: str, baseline: str = "revenue_lag_1_week"
) -> DataFrame:
    """``selected`` is the column shipped: the best model's or, where it wins, the baseline's."""
    actual = _number(TARGET)
    return (
        test.select(
            "week_start_date", "location_id", "location_name", "region", "location_type", "transaction_count",
            "session_count", "unique_player_count", "active_machine_count", "total_wager", "event_count",
            "downtime_minutes", "critical_event_count", TARGET,
            F.lit(method).alias("selected_forecasting_method"),
            _number(selected).alias("selected_predicted_revenue"),
            _number(best_model).alias("best_ml_predicted_revenue"),
            _number(baseline).alias("baseline_predicted_revenue"),
        )
        .withColumn("selected_forecast_error", actual - F.col("selected_predicted_revenue"))
        .withColumn("selected_absolute_error", F.abs("selected_forecast_error"))
        .withColumn("ml_absolute_error", F.abs(actual - F.col("best_ml_predicted_revenue")))
        .withColumn("baseline_absolute_error", F.abs(actual - F.col("baseline_predicted_revenue")))
        .withColumn(
            "ml_beats_baseline_flag",
            F.when(F.col("ml_absolute_error") < F.col("baseline_absolute_error"), 1).otherwise(0),
        )
        .withColumn(
            "selected_absolute_percentage_error", _percentage_error(F.col("selected_absolute_error"), actual)
        )
        .withColumn("forecast_status", _status(F.col("selected_absolute_percentage_error")))
    )


def location_accuracy(output: DataFrame) -> DataFrame:
    """Accuracy per location with the exact median error."""
    error = F.col("selected_absolute_error")
    return (
        output.groupBy("location_id", "location_name")
        .agg(
            F.count("week_start_date").alias("test_week_count"),
            F.sum(TARGET).cast("double").alias("actual_revenue"),
            F.sum("selected_predicted_revenue").alias("selected_predicted_revenue"),
            F.avg(error).alias("average_selected_absolute_error"),
            F.median(error).alias("median_selected_absolute_error"),
            F.avg("ml_beats_baseline_flag").alias("ml_beats_baseline_rate"),
        )
        .withColumn("selected_total_forecast_error", F.col("actual_revenue") - F.col("selected_predicted_revenue"))
        .orderBy("average_selected_absolute_error", "location_id")
    )


def forecast_metrics(df: DataFrame, predictions: dict[str, str], actual: str = TARGET) -> DataFrame:
    """One row per model with MAE, RMSE, MAPE, WAPE and R squared, best RMSE first."""
    y = _number(actual)
    names = F.array(*[F.struct(F.lit(m).alias("model"), _number(c).alias("p")) for m, c in predictions.items()])
    long = df.select(y.alias("y"), F.explode(names).alias("m")).select("y", "m.model", "m.p")
    error = F.col("y") - F.col("p")
    return (
        long.groupBy("model")
        .agg(
            F.avg(F.abs(error)).alias("mae"),
            F.sqrt(F.avg(error * error)).alias("rmse"),
            F.avg(_percentage_error(F.abs(error), F.col("y"))).alias("mape_pct"),
            (F.sum(F.abs(error)) / F.nullif(F.sum(F.abs("y")), F.lit(0.0)) * 100).alias("wape_pct"),
            (1 - F.sum(error * error) / F.nullif(F.var_pop("y") * F.count("y"), F.lit(0.0))).alias("r2_score"),
        )
        .orderBy("rmse", "model")
    )
