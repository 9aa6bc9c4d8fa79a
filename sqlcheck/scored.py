"""SQL for queries over scored outputs and for look-ups."""

from __future__ import annotations

from sqlcheck.base import add, catalog
from sqlcheck.text import case, mean, near, ratio

BODY: dict[str, str] = {}


def tier(p: str, cuts=(0.30, 0.60, 0.80)) -> str:
    return (f"CASE WHEN {p} <= {cuts[0]} THEN 'Low' WHEN {p} <= {cuts[1]} THEN 'Medium' "
            f"WHEN {p} <= {cuts[2]} THEN 'High' ELSE 'Critical' END")


# ---- churn -------------------------------------------------------------------------------------
add("churn_scored", f"""
SELECT *, CAST({ratio('least(days_since_last_session, 90)', '90')} AS DOUBLE) AS churn_probability
FROM churn_feature""")
_churn_actions = case("churn_probability", [
    ("0.80e0", "Immediate retention outreach"), ("0.60e0", "Targeted loyalty offer"),
    ("0.30e0", "Monitor engagement")], "No immediate action")
_churn_columns = f"""
SELECT player_id, loyalty_tier, age_band, home_region, marketing_opt_in, days_since_last_session,
  total_historical_sessions, sessions_last_30_days, sessions_last_90_days, total_wager, player_net_revenue, churn_flag,
  churn_probability, CASE WHEN churn_probability >= {{0}} THEN 1 ELSE 0 END AS predicted_churn_flag,
  {tier('churn_probability')} AS risk_level, {_churn_actions} AS recommended_action
FROM churn_scored"""
add("churn_output", _churn_columns.format("0.50e0"))

_counts = """count(*) FILTER ({y} = 1 AND {p}) AS true_positive, count(*) FILTER ({y} = 0 AND {p}) AS false_positive,
  count(*) FILTER ({y} = 0 AND NOT {p}) AS true_negative, count(*) FILTER ({y} = 1 AND NOT {p}) AS false_negative"""
_churn_counts = _counts.format(y="churn_flag", p="(predicted_churn_flag = 1)")
TP, FP, TN, FN = "true_positive", "false_positive", "true_negative", "false_negative"


def rate(top: str, bottom: str) -> str:
    return f"coalesce(CAST({top} AS DOUBLE) / nullif({bottom}, 0), 0.0)"


METRICS = {
    "accuracy": rate(f"({TP}+{TN})", f"({TP}+{FP}+{TN}+{FN})"), "precision": rate(TP, f"({TP}+{FP})"),
    "recall": rate(TP, f"({TP}+{FN})"), "f1_score": rate(f"(2*{TP})", f"(2*{TP}+{FP}+{FN})"),
}
_metrics = ", ".join(f"{sql} AS {name}" for name, sql in METRICS.items())
_auc = """(sum(r) FILTER (churn_flag = 1) - count(*) FILTER (churn_flag = 1) * (count(*) FILTER (churn_flag = 1) + 1) / 2.0)
  / (count(*) FILTER (churn_flag = 1) * count(*) FILTER (churn_flag = 0))"""
_ranked = """
SELECT *, rank() OVER (PARTITION BY {0} ORDER BY churn_probability)
  + (count(*) OVER (PARTITION BY {0}, churn_probability) - 1) / 2.0e0 AS r FROM {1}"""
BODY["ml5_binary_metrics"] = f"""
SELECT *, {_metrics}, (SELECT {_auc} FROM ({_ranked.format('1', 'churn_output')}) AS a) AS roc_auc
FROM (SELECT {_churn_counts} FROM churn_output) AS c"""
BODY["ml5_class_report"] = f"""
SELECT 1 AS class, {METRICS['precision']} AS precision, {METRICS['recall']} AS recall, {METRICS['f1_score']} AS f1_score,
  {TP} + {FN} AS support FROM (SELECT {_churn_counts} FROM churn_output) AS c
UNION ALL
SELECT 0, {rate(TN, f'({TN}+{FN})')}, {rate(TN, f'({TN}+{FP})')}, {rate(f'(2*{TN})', f'(2*{TN}+{FP}+{FN})')}, {TN} + {FP}
FROM (SELECT {_churn_counts} FROM churn_output) AS c"""
_report = f"({BODY['ml5_class_report']}) AS r"
BODY["ml5_report_averages"] = f"""
SELECT 'accuracy' AS average, {{0}} AS precision, {{0}} AS recall, {{0}} AS f1_score, sum(support) AS support FROM {_report}
UNION ALL
SELECT 'macro avg', avg(precision), avg(recall), avg(f1_score), sum(support) FROM {_report}
UNION ALL
SELECT 'weighted avg', sum(precision * support) / sum(support), sum(recall * support) / sum(support),
  sum(f1_score * support) / sum(support), sum(support) FROM {_report}""".replace("{0}", "sum(recall * support) / sum(support)")
_place = "row_number() OVER (PARTITION BY churn_flag ORDER BY md5(player_id || '|42'), player_id)"
add("churn_folded", f"SELECT *, ({_place} - 1) % 5 AS fold FROM churn_output")
BODY["ml4_stratified_folds"] = "SELECT player_id, churn_flag, fold FROM churn_folded"
BODY["ml4_stratified_split"] = f"""
SELECT player_id, churn_flag,
  CASE WHEN {_place} <= floor(count(*) OVER (PARTITION BY churn_flag) * 0.2e0 + 0.5) THEN 1 ELSE 0 END AS is_test
FROM churn_output"""
add("fold_metric", f"""
SELECT c.fold, {METRICS['accuracy']} AS validation_accuracy, {METRICS['precision']} AS validation_precision,
  {METRICS['recall']} AS validation_recall, {METRICS['f1_score']} AS validation_f1, validation_roc_auc
FROM (SELECT fold, {_churn_counts} FROM churn_folded GROUP BY 1) AS c
JOIN (SELECT fold, {_auc} AS validation_roc_auc FROM ({_ranked.format('fold', 'churn_folded')}) AS r GROUP BY 1) AS a
  ON a.fold = c.fold""")
BODY["ml6_fold_metrics"] = "SELECT * FROM fold_metric"
BODY["ml6_fold_summary"] = "\nUNION ALL ".join(
    f"SELECT '{m}' AS metric, avg({m}) AS mean, stddev_samp({m}) AS standard_deviation, min({m}) AS minimum, "
    f"max({m}) AS maximum FROM fold_metric"
    for m in ("validation_accuracy", "validation_precision", "validation_recall", "validation_f1", "validation_roc_auc"))
_cuts = "[0.20e0,0.25e0,0.30e0,0.35e0,0.40e0,0.45e0,0.50e0,0.55e0,0.60e0,0.65e0,0.70e0,0.75e0,0.80e0]"
add("sweep", f"""
SELECT threshold, {_metrics} FROM (
  SELECT threshold, {_counts.format(y='churn_flag', p='(churn_probability >= threshold)')}
  FROM churn_scored CROSS JOIN (SELECT unnest({_cuts}) AS threshold) AS t GROUP BY 1) AS c""")
BODY["ml7_threshold_sweep"] = "SELECT * FROM sweep"
BODY["ml9_churn_scores"] = _churn_columns.format(
    "(SELECT threshold FROM sweep ORDER BY f1_score DESC, recall DESC, precision DESC, threshold LIMIT 1)")
add("retention", f"""
SELECT *, dense_rank() OVER (ORDER BY retention_priority_score DESC) AS priority_rank FROM (
  SELECT *, {near('expected_revenue_at_risk * (1.0e0 + coalesce(CAST(days_since_last_session AS DOUBLE), 0) / 365.0e0)')}
    AS retention_priority_score
  FROM (
    SELECT player_id, loyalty_tier, days_since_last_session, total_historical_sessions, player_net_revenue,
      churn_probability, risk_level, recommended_action,
      {near('greatest(CAST(player_net_revenue AS DOUBLE), 0.0e0) * churn_probability')} AS expected_revenue_at_risk
    FROM churn_output) AS e) AS s""")
BODY["ml11_retention_priority"] = "SELECT * FROM retention"
BODY["ml11_retention_summary"] = """
SELECT risk_level, count(*) AS player_count, sum(player_net_revenue) AS total_player_revenue,
  sum(expected_revenue_at_risk) AS expected_revenue_at_risk, avg(churn_probability) AS average_churn_probability,
  avg(days_since_last_session) AS average_days_since_last_session FROM retention GROUP BY 1"""
BODY["ml27_confusion"] = f"SELECT {_churn_counts} FROM churn_output"
_curve = f"""
SELECT threshold, {{0}} FROM (
  SELECT DISTINCT churn_probability AS threshold,
    sum(churn_flag) OVER w AS tp, count(*) OVER w - sum(churn_flag) OVER w AS fp,
    sum(churn_flag) OVER () AS positives, count(*) OVER () - sum(churn_flag) OVER () AS negatives
  FROM churn_scored WINDOW w AS (ORDER BY churn_probability DESC)) AS c"""
BODY["ml27_roc"] = _curve.format(
    f"{rate('fp', 'negatives')} AS false_positive_rate, {rate('tp', 'positives')} AS true_positive_rate"
) + " UNION ALL SELECT NULL, 0.0e0, 0.0e0"
BODY["ml27_precision_recall"] = _curve.format(
    f"{rate('tp', '(tp + fp)')} AS precision, {rate('tp', 'positives')} AS recall"
) + " UNION ALL SELECT NULL, 1.0e0, 0.0e0"
BODY["ml27_histogram"] = """
SELECT churn_flag, least(CASE WHEN high = low THEN 15 ELSE floor((churn_probability - low) / (high - low) * 30) END, 29)::BIGINT
    AS bin, count(*) AS row_count, min(churn_probability) AS lowest, max(churn_probability) AS highest
FROM (SELECT churn_flag, churn_probability, min(churn_probability) OVER (PARTITION BY churn_flag) AS low,
    max(churn_probability) OVER (PARTITION BY churn_flag) AS high FROM churn_scored) AS x
GROUP BY 1, 2"""

_numbers = ["marketing_opt_in", "registered_active_flag", "days_since_last_session", "observed_player_lifetime_days",
            "total_historical_sessions", "sessions_last_30_days", "sessions_last_90_days", "locations_visited",
            "machines_played", "total_session_minutes", "average_session_minutes", "total_rounds", "total_wager",
            "total_payout", "player_net_revenue", "average_wager_per_session", "wager_last_30_days", "wager_last_90_days",
            "revenue_last_30_days", "revenue_last_90_days", "sessions_per_observed_day"]
_scaled = ", ".join(f"coalesce((CAST({c} AS DOUBLE) - avg(CAST({c} AS DOUBLE)) OVER ()) / "
                    f"nullif(stddev_samp(CAST({c} AS DOUBLE)) OVER (), 0), 0) AS {c}" for c in _numbers)
_hot = ", ".join(
    f"CASE WHEN {column} = '{value}' THEN 1.0e0 ELSE 0.0e0 END AS "
    f"{column}_{value.lower().replace(' ', '_').replace('-', '_').replace('+', '_up')}"
    for column, values in (
        ("loyalty_tier", ["Gold", "Platinum", "Silver", "Standard"]),
        ("age_band", ["21-30", "31-40", "41-50", "51-64", "65+"]),
        ("home_region", ["AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST"]))
    for value in values)
BODY["ml1_preprocessing"] = f"SELECT player_id, {_scaled}, {_hot} FROM churn_feature"

# ---- failure -----------------------------------------------------------------------------------
_p = ratio("least((high_severity_event_count + critical_event_count*2)*2, total_historical_events + 1)",
           "total_historical_events + 1")
_failure_actions = case("failure_probability", [
    ("0.80e0", "Immediate maintenance inspection"), ("0.60e0", "Schedule preventive maintenance"),
    ("0.30e0", "Increase monitoring frequency")], "Routine monitoring")
add("failure_output", f"""
SELECT machine_id, location_id, manufacturer, cabinet_type, game_title, game_category, software_version,
  machine_status, machine_age_days, total_historical_events, unplanned_event_count, critical_event_count,
  high_severity_event_count, total_downtime_minutes, average_downtime_minutes, events_last_30_days,
  downtime_last_30_days, events_last_90_days, downtime_last_90_days, historical_net_revenue, revenue_last_30_days,
  failure_target_flag, failure_probability,
  CASE WHEN failure_probability >= 0.5e0 THEN 1 ELSE 0 END AS predicted_failure_flag,
  {tier('failure_probability')} AS failure_risk_level, {_failure_actions} AS recommended_action,
  {near('greatest(CAST(historical_net_revenue AS DOUBLE), 0.0e0) * failure_probability')} AS revenue_at_risk
FROM (SELECT *, CAST({_p} AS DOUBLE) AS failure_probability FROM failure_feature) AS f""")
BODY["ml10_failure_scores"] = "SELECT * FROM failure_output"
_score = ("failure_probability*100.0e0 + coalesce(revenue_at_risk, 0)/100.0e0 "
          "+ coalesce(CAST(total_downtime_minutes AS DOUBLE), 0)/100.0e0 "
          "+ coalesce(CAST(critical_event_count AS DOUBLE), 0)*2.0e0")
add("maintenance", f"""
SELECT *, dense_rank() OVER (ORDER BY maintenance_priority_score DESC) AS maintenance_priority_rank
FROM (SELECT *, {near(_score)} AS maintenance_priority_score FROM failure_output) AS s""")
BODY["ml12_maintenance_priority"] = "SELECT * FROM maintenance"
BODY["ml12_maintenance_summary"] = """
SELECT failure_risk_level, count(*) AS machine_count, avg(failure_probability) AS average_failure_probability,
  sum(revenue_at_risk) AS total_revenue_at_risk, sum(total_downtime_minutes) AS total_downtime_minutes,
  sum(critical_event_count) AS total_critical_events, sum(unplanned_event_count) AS total_unplanned_events
FROM maintenance GROUP BY 1"""

# ---- anomalies ---------------------------------------------------------------------------------
add("anomaly_points", """
  SELECT *, CAST(coalesce(abs(revenue_z_score), 0) + coalesce(abs(wager_z_score), 0)
    + coalesce(abs(downtime_z_score), 0) AS DOUBLE) AS anomaly_score FROM anomaly_feature""")
add("anomaly_border", """
SELECT low + (high - low) * (place - floor(place)) AS border FROM (
  SELECT place, max(CASE WHEN i = floor(place) THEN anomaly_score END) AS low,
    max(CASE WHEN i = ceil(place) THEN anomaly_score END) AS high
  FROM (
    SELECT anomaly_score, row_number() OVER (ORDER BY anomaly_score) - 1 AS i, (count(*) OVER () - 1) * (1 - greatest(0.02e0, least(0.20e0,
      CAST(count(*) FILTER (rule_based_anomaly_flag = 1) OVER () AS DOUBLE) / count(*) OVER ()))) AS place
    FROM anomaly_points) AS r
  GROUP BY place) AS ends""")
add("anomaly_scored", """
SELECT p.*, CASE WHEN anomaly_score > border THEN 1 ELSE 0 END AS isolation_forest_anomaly_flag
FROM anomaly_points AS p CROSS JOIN anomaly_border""")
BODY["ml13_rule_agreement"] = f"""
SELECT *, {_metrics} FROM (SELECT {_counts.format(y='rule_based_anomaly_flag', p='(isolation_forest_anomaly_flag = 1)')}
  FROM anomaly_scored) AS c"""
add("anomaly_out", f"""
SELECT *, {near('abs(CAST(net_gaming_revenue AS DOUBLE)) * anomaly_percentile')} AS revenue_exposure,
  CASE anomaly_risk_level WHEN 'Critical' THEN 'Immediate operational investigation'
    WHEN 'High' THEN 'Review machine and event history' WHEN 'Medium' THEN 'Increase monitoring frequency'
    ELSE 'Routine monitoring' END AS recommended_action
FROM (
  SELECT *, {tier('anomaly_percentile', (0.80, 0.95, 0.99))} AS anomaly_risk_level,
    CASE WHEN critical_event_count > 0 THEN 'Critical machine event' WHEN downtime_z_score >= 3 THEN 'Unusually high downtime'
      WHEN abs(revenue_z_score) >= 3 THEN 'Unusual revenue behavior'
      WHEN abs(wager_z_score) >= 3 THEN 'Unusual wagering behavior' ELSE 'Multivariate behavior anomaly' END AS anomaly_reason
  FROM (
    SELECT * EXCLUDE (active_minutes), (rank() OVER (ORDER BY anomaly_score)
      + (count(*) OVER (PARTITION BY anomaly_score) - 1) / 2.0e0) / count(*) OVER () AS anomaly_percentile
    FROM anomaly_scored) AS r) AS t""")
BODY["ml14_anomaly_output"] = "SELECT * FROM anomaly_out"
add("anomaly_machine", f"""
SELECT *, dense_rank() OVER (ORDER BY operational_priority_score DESC) AS priority_rank FROM (
  SELECT *, {near('anomaly_rate*100.0e0 + maximum_anomaly_score*20.0e0 + total_critical_events*2.0e0 + total_revenue_exposure/100.0e0')}
    AS operational_priority_score
  FROM (
    SELECT machine_id, location_id, manufacturer, game_title, software_version, count(*) AS machine_day_count,
      sum(isolation_forest_anomaly_flag) AS anomaly_day_count,
      sum(rule_based_anomaly_flag) AS rule_based_anomaly_day_count, avg(anomaly_score) AS average_anomaly_score,
      max(anomaly_score) AS maximum_anomaly_score, sum(downtime_minutes) AS total_downtime_minutes,
      sum(critical_event_count) AS total_critical_events,
      CAST(sum(CAST(revenue_exposure AS DECIMAL(18,2))) AS DOUBLE) AS total_revenue_exposure,
      CAST(sum(isolation_forest_anomaly_flag) AS DOUBLE) / count(*) AS anomaly_rate
    FROM anomaly_out GROUP BY 1, 2, 3, 4, 5) AS g) AS s""")
BODY["ml15_anomaly_machine_summary"] = "SELECT * FROM anomaly_machine"
_clean = ["revenue_per_active_hour", "revenue_z_score", "wager_z_score", "downtime_z_score"]
BODY["ml29_clean_features"] = "SELECT activity_date, machine_id, " + ", ".join(
    f"coalesce(CAST({c} AS DOUBLE), (SELECT median(CAST({c} AS DOUBLE)) FROM anomaly_feature)) AS {c}" for c in _clean
) + " FROM anomaly_feature"

# ---- segments ----------------------------------------------------------------------------------
add("clustered", """
SELECT *, CASE WHEN session_count >= 46 THEN 3 WHEN session_count >= 38 THEN 2 WHEN session_count >= 30 THEN 1 ELSE 0 END
  AS cluster_id FROM v_player WHERE session_count > 0""")
add("cluster_profile", """
SELECT *, count(*) OVER () - value_rank + 1 AS value_score, count(*) OVER () - engagement_rank + 1 AS engagement_score,
  count(*) OVER () - recency_risk_rank + 1 AS risk_score
FROM (
  SELECT *, CAST(player_count AS DOUBLE) / sum(player_count) OVER () * 100 AS player_distribution_pct,
    total_segment_revenue / sum(total_segment_revenue) OVER () * 100 AS revenue_contribution_pct,
    dense_rank() OVER (ORDER BY average_player_revenue DESC) AS value_rank,
    dense_rank() OVER (ORDER BY average_total_wager DESC) AS wager_rank,
    dense_rank() OVER (ORDER BY average_sessions DESC) AS engagement_rank,
    dense_rank() OVER (ORDER BY average_days_since_last_session DESC) AS recency_risk_rank
  FROM (
    SELECT cluster_id, count(*) AS player_count, avg(CAST(session_count AS DOUBLE)) AS average_sessions,
      avg(CAST(locations_visited AS DOUBLE)) AS average_locations_visited,
      avg(CAST(machines_played AS DOUBLE)) AS average_machines_played,
      avg(CAST(average_session_minutes AS DOUBLE)) AS average_session_minutes,
      avg(CAST(average_wager_per_session AS DOUBLE)) AS average_wager_per_session,
      avg(CAST(total_wager AS DOUBLE)) AS average_total_wager,
      avg(CAST(player_net_revenue AS DOUBLE)) AS average_player_revenue,
      avg(CAST(days_since_last_session AS DOUBLE)) AS average_days_since_last_session,
      CAST(sum(player_net_revenue) AS DOUBLE) AS total_segment_revenue
    FROM clustered GROUP BY 1) AS g) AS p""")
BODY["ml17_cluster_profiles"] = "SELECT * FROM cluster_profile"
_pick = "(SELECT cluster_id FROM cluster_profile WHERE cluster_id NOT IN ({taken}) ORDER BY {order}, cluster_id LIMIT 1)"
add("pick_vip", "SELECT cluster_id FROM cluster_profile ORDER BY average_player_revenue DESC, average_total_wager DESC, "
                "average_sessions DESC, cluster_id LIMIT 1")
add("pick_away", "SELECT cluster_id FROM cluster_profile WHERE cluster_id NOT IN (SELECT * FROM pick_vip) "
                 "ORDER BY average_days_since_last_session DESC, average_sessions, cluster_id LIMIT 1")
add("pick_loyal", "SELECT cluster_id FROM cluster_profile WHERE cluster_id NOT IN (SELECT * FROM pick_vip UNION ALL "
                  "SELECT * FROM pick_away) ORDER BY average_sessions DESC, average_days_since_last_session, cluster_id LIMIT 1")
add("named", """
SELECT cluster_id, player_segment,
  CASE player_segment WHEN 'VIP High Value' THEN 'Protect high-value relationships'
    WHEN 'At-Risk Players' THEN 'Reduce churn and reactivate engagement'
    WHEN 'Loyal Regulars' THEN 'Increase wallet share and loyalty' ELSE 'Increase visit frequency' END AS segment_strategy,
  CASE player_segment
    WHEN 'VIP High Value' THEN 'Offer exclusive rewards, VIP support, and personalized premium promotions'
    WHEN 'At-Risk Players' THEN 'Launch targeted retention outreach and time-sensitive return offers'
    WHEN 'Loyal Regulars' THEN 'Provide frequency-based rewards and cross-location loyalty incentives'
    ELSE 'Use low-cost promotional offers and beginner-friendly engagement campaigns' END AS recommended_action
FROM (SELECT cluster_id, CASE WHEN cluster_id IN (SELECT * FROM pick_vip) THEN 'VIP High Value'
    WHEN cluster_id IN (SELECT * FROM pick_away) THEN 'At-Risk Players'
    WHEN cluster_id IN (SELECT * FROM pick_loyal) THEN 'Loyal Regulars' ELSE 'Casual Players' END AS player_segment
  FROM cluster_profile) AS n""")
BODY["ml18_segment_profiles"] = "SELECT p.*, n.* EXCLUDE (cluster_id) FROM cluster_profile AS p JOIN named AS n ON n.cluster_id = p.cluster_id"
_value = ("greatest(CAST(player_net_revenue AS DOUBLE), 0.0e0) * (1.0e0 + CAST(session_count AS DOUBLE) / "
          "(SELECT max(session_count) FROM clustered))")
add("segmented", f"""
SELECT c.*, n.* EXCLUDE (cluster_id), {near(_value)} AS estimated_player_value
FROM clustered AS c JOIN named AS n ON n.cluster_id = c.cluster_id""")
BODY["ml19_segment_players"] = "SELECT * FROM segmented"

# ---- forecasts ---------------------------------------------------------------------------------
_split = """
SELECT * EXCLUDE (place, periods), CASE WHEN place >= greatest(1, least(floor(periods * 0.8e0), periods - 1)) THEN 1 ELSE 0 END
  AS is_test
FROM (
  SELECT *, dense_rank() OVER (ORDER BY {0}) - 1 AS place, (SELECT count(DISTINCT {0}) FROM {1} WHERE {2}) AS periods
  FROM {1} WHERE {2}) AS d"""
add("daily_split", _split.format(
    "activity_date", "daily_feature", "revenue_lag_14_days IS NOT NULL AND revenue_lag_7_days IS NOT NULL"))
add("weekly_split", _split.format("week_start_date", "weekly_feature", "revenue_lag_4_weeks IS NOT NULL"))
BODY["ml22_daily_split"] = "SELECT activity_date, location_id, is_test FROM daily_split"
BODY["ml22_weekly_split"] = "SELECT week_start_date, location_id, is_test FROM weekly_split"


def _model_metrics(source: str, models: dict[str, str]) -> str:
    y = "CAST(net_gaming_revenue AS DOUBLE)"
    return "\nUNION ALL ".join(f"""
SELECT '{name}' AS model, avg(abs({y} - p)) AS mae, sqrt(avg(({y} - p) * ({y} - p))) AS rmse,
  avg(abs({y} - p) / abs({y}) * 100) FILTER (abs({y}) > 1) AS mape_pct,
  sum(abs({y} - p)) / nullif(sum(abs({y})), 0) * 100 AS wape_pct,
  1 - sum(({y} - p) * ({y} - p)) / nullif(var_pop({y}) * count(*), 0) AS r2_score
FROM (SELECT *, CAST({column} AS DOUBLE) AS p FROM {source} WHERE is_test = 1) AS t""" for name, column in models.items())


add("daily_metric", _model_metrics("daily_split", {
    "Naive Previous-Day Baseline": "revenue_lag_1_day", "Trailing 7 days": "previous_7_day_average_revenue",
    "Trailing 30 days": "previous_30_day_average_revenue"}))
add("weekly_metric", _model_metrics("weekly_split", {
    "Naive Previous-Week Baseline": "revenue_lag_1_week", "Trailing 4 weeks": "previous_4_week_average_revenue",
    "Trailing 8 weeks": "previous_8_week_average_revenue"}))
BODY["ml23_daily_metrics"] = "SELECT * FROM daily_metric"
BODY["ml23_weekly_metrics"] = "SELECT * FROM weekly_metric"
BODY["ml24_forecast_choice"] = """
SELECT 'daily' AS horizon, * FROM (SELECT model, rmse FROM daily_metric WHERE model <> 'Naive Previous-Day Baseline'
  ORDER BY rmse, model LIMIT 1) AS d
UNION ALL SELECT 'weekly', * FROM (SELECT model, rmse FROM weekly_metric ORDER BY rmse, model LIMIT 1) AS w"""
_status = "CASE WHEN {0} <= 10 THEN 'High Accuracy' WHEN {0} <= 25 THEN 'Acceptable' ELSE 'Review' END AS forecast_status"
_y = "CAST(net_gaming_revenue AS DOUBLE)"
add("daily_out", f"""
SELECT *, {_status.format('absolute_percentage_error')} FROM (
  SELECT *, CASE WHEN abs({_y}) > 1 THEN absolute_error / abs({_y}) * 100 END AS absolute_percentage_error FROM (
    SELECT activity_date, location_id, location_name, region, location_type, session_count, unique_player_count,
      active_machine_count, total_wager, event_count, downtime_minutes, critical_event_count, net_gaming_revenue,
      CAST(previous_30_day_average_revenue AS DOUBLE) AS predicted_revenue,
      CAST(revenue_lag_1_day AS DOUBLE) AS baseline_predicted_revenue,
      {_y} - CAST(previous_30_day_average_revenue AS DOUBLE) AS forecast_error,
      abs({_y} - CAST(previous_30_day_average_revenue AS DOUBLE)) AS absolute_error
    FROM daily_split WHERE is_test = 1) AS a) AS b""")
_w = "CAST(previous_8_week_average_revenue AS DOUBLE)"
add("weekly_out", f"""
SELECT *, {_status.format('selected_absolute_percentage_error')} FROM (
  SELECT *, CASE WHEN ml_absolute_error < baseline_absolute_error THEN 1 ELSE 0 END AS ml_beats_baseline_flag,
    CASE WHEN abs({_y}) > 1 THEN selected_absolute_error / abs({_y}) * 100 END AS selected_absolute_percentage_error
  FROM (
    SELECT week_start_date, location_id, location_name, region, location_type, transaction_count, session_count,
      unique_player_count, active_machine_count, total_wager, event_count, downtime_minutes, critical_event_count,
      net_gaming_revenue, 'Trailing 8 weeks' AS selected_forecasting_method, {_w} AS selected_predicted_revenue,
      {_w} AS best_ml_predicted_revenue, CAST(revenue_lag_1_week AS DOUBLE) AS baseline_predicted_revenue,
      {_y} - {_w} AS selected_forecast_error, abs({_y} - {_w}) AS selected_absolute_error,
      abs({_y} - {_w}) AS ml_absolute_error, abs({_y} - CAST(revenue_lag_1_week AS DOUBLE)) AS baseline_absolute_error
    FROM weekly_split WHERE is_test = 1) AS a) AS b""")
BODY["ml25_daily_output"] = "SELECT * FROM daily_out"
BODY["ml25_weekly_output"] = "SELECT * FROM weekly_out"
BODY["ml26_location_accuracy"] = """
SELECT *, actual_revenue - selected_predicted_revenue AS selected_total_forecast_error FROM (
  SELECT location_id, location_name, count(*) AS test_week_count, CAST(sum(net_gaming_revenue) AS DOUBLE) AS actual_revenue,
    sum(selected_predicted_revenue) AS selected_predicted_revenue,
    avg(selected_absolute_error) AS average_selected_absolute_error,
    median(selected_absolute_error) AS median_selected_absolute_error,
    avg(ml_beats_baseline_flag) AS ml_beats_baseline_rate
  FROM weekly_out GROUP BY 1, 2) AS g"""

# ---- dataset checks ----------------------------------------------------------------------------
_binary = """SELECT '{name}' AS dataset, 'target not 0 or 1' AS rule,
  (SELECT count(*) FROM {source} WHERE {target} NOT IN (0, 1)) AS violations"""
_checks = []
for name, source, key, target, rows, binary in (
    ("player churn", "churn_feature", "player_id", "churn_flag", 0, 2),
    ("machine failure", "failure_feature", "machine_id", "failure_target_flag", 0, 2),
    ("machine anomaly", "anomaly_feature", "activity_date, machine_id", "rule_based_anomaly_flag", 0, 1),
    ("player segments", "clustered", "player_id", None, 100, 0),
    ("daily forecast", "daily_feature", "activity_date, location_id", "net_gaming_revenue", 100, 0),
    ("weekly forecast", "weekly_feature", "week_start_date, location_id", "net_gaming_revenue", 100, 0),
):
    counted = [("key repeated", f"(SELECT count(*) - count(DISTINCT ({key})) FROM {source})"),
               ("rows missing", f"(SELECT greatest({rows} - count(*), 0) FROM {source})")]
    if target:
        counted.append(("target null", f"(SELECT count(*) FROM {source} WHERE {target} IS NULL)"))
    if binary:
        counted.append(("target not 0 or 1", f"(SELECT count(*) FROM {source} WHERE {target} NOT IN (0, 1))"))
    if binary == 2:
        counted.append(("class missing", f"(SELECT 2 - count(DISTINCT {target}) FROM {source} WHERE {target} IN (0, 1))"))
    _checks += [f"SELECT '{name}' AS dataset, '{rule}' AS rule, {sql} AS violations" for rule, sql in counted]
BODY["ml28_dataset_checks"] = "\nUNION ALL ".join(_checks)

# ---- look-ups ----------------------------------------------------------------------------------
BODY["a1_executive_kpis"] = """
SELECT active_location_count, revenue_generating_machine_count AS active_machine_count,
  (SELECT count(*) FROM d_machine) AS registered_machine_count, active_player_count,
  (SELECT count(*) FROM d_player) AS registered_player_count, total_session_count, total_transaction_count,
  total_wager, total_payout, net_gaming_revenue, actual_hold_pct, revenue_per_session, revenue_per_machine, h.*
FROM v_exec, (SELECT sum(total_downtime_minutes) AS total_downtime_minutes,
  sum(critical_event_count) AS total_critical_events,
  avg(CAST(annual_availability_pct AS DOUBLE)) AS average_machine_availability_pct FROM v_health) AS h"""
BODY["a2_revenue_trend"] = f"""
SELECT * EXCLUDE (jackpot_amount), {ratio('net_gaming_revenue', 'total_wager')} AS actual_hold_pct
FROM day_activity WHERE activity_date IN (SELECT activity_date FROM day_activity ORDER BY activity_date DESC LIMIT 30)"""
add("high_risk", """
SELECT machine_id, location_id, location_name, manufacturer, game_title, game_category, software_version,
  total_event_count, unplanned_event_count, critical_event_count, total_downtime_minutes, annual_availability_pct,
  CASE WHEN critical_event_count >= 8 OR total_downtime_minutes >= 5000 THEN 'Critical' ELSE 'High' END AS health_risk_level
FROM v_health WHERE critical_event_count >= 4 OR total_downtime_minutes >= 3500""")
BODY["a3_high_risk_machines"] = """
SELECT * FROM high_risk ORDER BY critical_event_count DESC, total_downtime_minutes DESC, machine_id LIMIT 20"""
BODY["a4_player_kpis"] = """
SELECT count(DISTINCT player_id) AS total_players_scored,
  count(*) FILTER (risk_level IN ('High','Critical')) AS high_and_critical_risk_players,
  count(*) FILTER (risk_level = 'Critical') AS critical_risk_players,
  round(avg(churn_probability), 4) AS average_churn_probability,
  round(sum(greatest(CAST(player_net_revenue AS DOUBLE), 0) * churn_probability), 2) AS estimated_revenue_at_risk,
  (SELECT count(*) FROM segmented WHERE player_segment = 'VIP High Value') AS vip_players,
  (SELECT count(*) FROM segmented WHERE player_segment = 'At-Risk Players') AS at_risk_segment_players
FROM churn_output"""
BODY["a4_segment_distribution"] = "SELECT player_segment, count(*) AS player_count FROM segmented GROUP BY 1"
BODY["a5_churn_risk"] = """
SELECT * FROM churn_output WHERE loyalty_tier = 'Standard' AND churn_probability >= 0.25e0 AND player_id ILIKE '%p1%'
ORDER BY churn_probability DESC, player_net_revenue DESC, player_id LIMIT 15 OFFSET 15"""
BODY["a6_player_segments"] = """
SELECT * FROM segmented WHERE player_segment = 'VIP High Value'
ORDER BY estimated_player_value DESC, player_net_revenue DESC, total_wager DESC, player_id LIMIT 25"""
BODY["a7_player_detail"] = """
SELECT * FROM (SELECT * FROM churn_output WHERE player_id = 'P7') AS c FULL JOIN (
  SELECT player_id, cluster_id, player_segment, segment_strategy, estimated_player_value
  FROM segmented WHERE player_id = 'P7') AS s USING (player_id)"""
BODY["a8_machine_kpis"] = """
SELECT count(DISTINCT machine_id) AS total_machines_scored,
  count(*) FILTER (failure_risk_level IN ('High','Critical')) AS high_and_critical_failure_risk_machines,
  count(*) FILTER (failure_risk_level = 'Critical') AS critical_failure_risk_machines,
  round(avg(failure_probability), 4) AS average_failure_probability,
  round(coalesce(sum(revenue_at_risk), 0), 2) AS failure_revenue_at_risk, a.*
FROM failure_output, (
  SELECT sum(isolation_forest_anomaly_flag) AS detected_anomalous_machine_days,
    count(*) FILTER (anomaly_risk_level = 'Critical') AS critical_anomaly_days,
    round(sum(revenue_exposure), 2) AS anomaly_revenue_exposure FROM anomaly_out) AS a
GROUP BY ALL"""
BODY["a9_failure_risk"] = """
SELECT * FROM failure_output WHERE manufacturer = 'Maker 1' AND failure_probability >= 0.3e0
ORDER BY failure_probability DESC, revenue_at_risk DESC, total_downtime_minutes DESC, machine_id LIMIT 10"""
BODY["a10_anomalies"] = """
SELECT * FROM anomaly_out WHERE isolation_forest_anomaly_flag = 1 AND anomaly_risk_level = 'Critical'
ORDER BY anomaly_score DESC, revenue_exposure DESC, activity_date, machine_id LIMIT 50"""
BODY["a11_maintenance_ranking"] = """
SELECT * FROM maintenance ORDER BY maintenance_priority_rank, failure_probability DESC, machine_id LIMIT 20 OFFSET 20"""
BODY["a12_anomaly_ranking"] = """
SELECT * FROM anomaly_machine ORDER BY priority_rank, operational_priority_score DESC, machine_id LIMIT 20"""
BODY["a13_machine_detail"] = """
SELECT * FROM (SELECT * FROM failure_output WHERE machine_id = 'M7') AS f FULL JOIN (
  SELECT machine_id, maintenance_priority_score, maintenance_priority_rank FROM maintenance WHERE machine_id = 'M7') AS m
  USING (machine_id) FULL JOIN (
  SELECT machine_id, machine_day_count, anomaly_day_count, anomaly_rate, maximum_anomaly_score,
    operational_priority_score, priority_rank FROM anomaly_machine WHERE machine_id = 'M7') AS a USING (machine_id)"""
BODY["a13_machine_top_anomalies"] = """
SELECT * FROM anomaly_out WHERE machine_id = 'M7' ORDER BY anomaly_score DESC, activity_date LIMIT 20"""


def _accuracy(source: str, predicted: str, where: str = "true", head: str = "") -> str:
    e = f"(CAST(net_gaming_revenue AS DOUBLE) - {predicted})"
    return f"""
SELECT {head} count(*) AS record_count, round(coalesce(CAST(sum(net_gaming_revenue) AS DOUBLE), 0), 2) AS actual_revenue,
  round(coalesce(sum({predicted}), 0), 2) AS predicted_revenue,
  round(coalesce(avg(abs({e})), 0), 2) AS average_absolute_error,
  round(coalesce(sqrt(avg({e} * {e})), 0), 2) AS root_mean_squared_error,
  round(coalesce(sum(abs({e})) / nullif(CAST(sum(abs(net_gaming_revenue)) AS DOUBLE), 0) * 100, 0), 2)
    AS weighted_absolute_percentage_error
FROM {source} WHERE {where}"""


BODY["a14_forecast_accuracy"] = _accuracy("weekly_out", "selected_predicted_revenue")
BODY["a15_forecast_summary"] = "\nUNION ALL ".join(f"""
SELECT a.*, m.* FROM ({_accuracy(source, predicted, head=f"'{horizon}' AS horizon,")}) AS a, (
  SELECT model AS best_evaluated_model, mae AS saved_mae, rmse AS saved_rmse, mape_pct AS saved_mape_pct,
    wape_pct AS saved_wape_pct, r2_score AS saved_r2_score FROM {metric} ORDER BY rmse, model LIMIT 1) AS m"""
    for horizon, source, predicted, metric in (
        ("daily", "daily_out", "predicted_revenue", "daily_metric"),
        ("weekly", "weekly_out", "selected_predicted_revenue", "weekly_metric")))
BODY["a16_daily_list"] = """
SELECT * FROM daily_out WHERE lower(region) = 'europe' AND forecast_status = 'Review'
  AND activity_date BETWEEN DATE '2000-06-01' AND DATE '2001-05-31'
ORDER BY activity_date DESC, location_id LIMIT 50 OFFSET 50"""
BODY["a17_weekly_list"] = """
SELECT * FROM weekly_out WHERE location_id = 'L3' ORDER BY week_start_date DESC LIMIT 50"""
BODY["a18_model_comparison"] = """
SELECT 'daily' AS horizon, * FROM daily_metric UNION ALL SELECT 'weekly', * FROM weekly_metric"""
BODY["a18_location_errors"] = BODY["ml26_location_accuracy"]
BODY["a12_next_page"] = """
SELECT * FROM anomaly_machine ORDER BY priority_rank, operational_priority_score DESC, machine_id LIMIT 20 OFFSET 20"""
BODY["a16_next_page"] = """
SELECT * FROM daily_out WHERE lower(region) = 'europe' AND forecast_status = 'Review'
ORDER BY activity_date DESC, location_id LIMIT 50 OFFSET 50"""
BODY["a19_location_forecast"] = """
SELECT 'daily' AS horizon, location_id, location_name, activity_date AS period, net_gaming_revenue, predicted_revenue,
  forecast_status FROM (SELECT * FROM daily_out WHERE location_id = 'L3' ORDER BY activity_date DESC LIMIT 30) AS d
UNION ALL
SELECT 'weekly', location_id, location_name, week_start_date, net_gaming_revenue, selected_predicted_revenue,
  forecast_status FROM (SELECT * FROM weekly_out WHERE location_id = 'L3' ORDER BY week_start_date DESC LIMIT 12) AS w"""
BODY["a19_location_summary"] = (
    _accuracy("daily_out", "predicted_revenue", "location_id = 'L3'", "'daily' AS horizon,") + "\nUNION ALL"
    + _accuracy("weekly_out", "selected_predicted_revenue", "location_id = 'L3'", "'weekly' AS horizon,"))
BODY["a20_page_envelope"] = """
SELECT 1 AS page, 20 AS page_size, count(*) AS total_records, CAST(ceil(count(*) / 20.0) AS BIGINT) AS total_pages
FROM high_risk"""
BODY["a21_service_queue"] = """
SELECT *, sla_target_minutes - age_minutes AS sla_remaining_minutes,
  CASE WHEN sla_target_minutes < age_minutes THEN 'Breached' WHEN sla_target_minutes - age_minutes <= 30 THEN 'At Risk'
    ELSE 'Within SLA' END AS sla_status
FROM (
  SELECT event_id, machine_id, location_id, severity,
    date_diff('minute', moment, (SELECT max(moment) FROM f_event)) AS age_minutes,
    CASE severity WHEN 'Critical' THEN 20000 WHEN 'High' THEN 40000 WHEN 'Medium' THEN 80000 ELSE 160000 END
      AS sla_target_minutes
  FROM f_event WHERE investigate = 1) AS t"""
BODY["a22_probability_band"] = """
SELECT * FROM churn_output WHERE churn_probability >= 0.40e0 AND churn_probability < 0.70e0"""
BODY["a23_by_severity"] = "SELECT * FROM failure_output"
BODY["a24_revenue_peaks"] = f"""
SELECT sum(net_gaming_revenue) AS total_revenue, {mean('net_gaming_revenue')} AS average_daily_revenue,
  max(net_gaming_revenue) AS peak_revenue,
  (SELECT activity_date FROM day_activity ORDER BY net_gaming_revenue DESC, activity_date LIMIT 1) AS peak_date
FROM day_activity"""
BODY["a25_maintenance_queue"] = """
SELECT * FROM failure_output WHERE failure_probability >= 0.2e0 AND game_category = 'Category 1'"""


def bodies() -> dict[str, str]:
    return {key: catalog.sql(body) for key, body in BODY.items()}
