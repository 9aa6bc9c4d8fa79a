"""SQL for the feature tables."""

from __future__ import annotations

from sqlcheck.base import add, catalog
from sqlcheck.text import mean, mean_over, ratio

BODY: dict[str, str] = {}

add("churn_feature", f"""
SELECT p.player_id, loyalty_tier, age_band, home_region, marketing_opt_in, active_flag AS registered_active_flag,
  cutoff AS observation_cutoff_date, last_day AS dataset_end_date, first_session_date,
  latest_historical_session_date, date_diff('day', latest_historical_session_date, cutoff) AS days_since_last_session,
  date_diff('day', first_session_date, cutoff) + 1 AS observed_player_lifetime_days,
  h.* EXCLUDE (player_id, first_session_date, latest_historical_session_date),
  {ratio('total_historical_sessions', "date_diff('day', first_session_date, cutoff) + 1")} AS sessions_per_observed_day,
  coalesce(later, 0) AS future_session_count, CASE WHEN coalesce(later, 0) = 0 THEN 1 ELSE 0 END AS churn_flag
FROM d_player AS p
CROSS JOIN (SELECT CAST(max(session_start) AS DATE) AS last_day, CAST(max(session_start) AS DATE) - 60 AS cutoff
            FROM f_session) AS c
JOIN (
  SELECT player_id, min(day) AS first_session_date, max(day) AS latest_historical_session_date,
    count(*) AS total_historical_sessions, count(*) FILTER (day >= cutoff - 30) AS sessions_last_30_days,
    count(*) FILTER (day >= cutoff - 90) AS sessions_last_90_days, count(DISTINCT location_id) AS locations_visited,
    count(DISTINCT machine_id) AS machines_played, sum(minutes) AS total_session_minutes,
    {mean('minutes', 6)} AS average_session_minutes, sum(rounds) AS total_rounds, sum(wager) AS total_wager,
    sum(payout) AS total_payout, sum(net) AS player_net_revenue, {mean('wager', 6)} AS average_wager_per_session,
    coalesce(sum(wager) FILTER (day >= cutoff - 30), 0) AS wager_last_30_days,
    coalesce(sum(wager) FILTER (day >= cutoff - 90), 0) AS wager_last_90_days,
    coalesce(sum(net) FILTER (day >= cutoff - 30), 0) AS revenue_last_30_days,
    coalesce(sum(net) FILTER (day >= cutoff - 90), 0) AS revenue_last_90_days
  FROM (SELECT *, CAST(session_start AS DATE) AS day,
          (SELECT CAST(max(session_start) AS DATE) - 60 FROM f_session) AS cutoff FROM f_session) AS d
  WHERE day <= cutoff GROUP BY 1
) AS h ON h.player_id = p.player_id
LEFT JOIN (
  SELECT player_id, count(*) AS later FROM f_session
  WHERE CAST(session_start AS DATE) > (SELECT CAST(max(session_start) AS DATE) - 60 FROM f_session) GROUP BY 1
) AS f ON f.player_id = p.player_id""")
BODY["f1_player_churn"] = "SELECT * FROM churn_feature"

add("event_cutoff", "SELECT max(event_date) AS last_day, max(event_date) - 30 AS cutoff FROM f_event")
add("failure_feature", f"""
SELECT m.machine_id, location_id, manufacturer, cabinet_type, game_title, game_category, software_version,
  machine_status, theoretical_hold_pct, install_date, date_diff('day', install_date, cutoff) AS machine_age_days,
  cutoff AS observation_cutoff_date, last_day AS dataset_end_date,
  coalesce(n, 0) AS total_historical_events, coalesce(un, 0) AS unplanned_event_count,
  coalesce(cr, 0) AS critical_event_count, coalesce(hi, 0) AS high_severity_event_count,
  coalesce(dt, 0) AS total_downtime_minutes, coalesce(av, 0) AS average_downtime_minutes,
  latest AS latest_historical_event_date, date_diff('day', latest, cutoff) AS days_since_last_event,
  coalesce(n30, 0) AS events_last_30_days, coalesce(dt30, 0) AS downtime_last_30_days,
  coalesce(n90, 0) AS events_last_90_days, coalesce(dt90, 0) AS downtime_last_90_days,
  coalesce(ses, 0) AS historical_session_count, coalesce(pl, 0) AS historical_unique_players,
  coalesce(wa, 0) AS historical_total_wager, coalesce(ne, 0) AS historical_net_revenue,
  coalesce(ne30, 0) AS revenue_last_30_days, coalesce(ses30, 0) AS sessions_last_30_days,
  coalesce(later, 0) AS future_failure_count, CASE WHEN later > 0 THEN 1 ELSE 0 END AS failure_target_flag
FROM d_machine AS m CROSS JOIN event_cutoff
LEFT JOIN (
  SELECT machine_id, count(*) AS n, count(*) FILTER (planned = 0) AS un, count(*) FILTER (severity = 'Critical') AS cr,
    count(*) FILTER (severity = 'High') AS hi, sum(downtime) AS dt, {mean('downtime', 6)} AS av,
    max(event_date) AS latest, count(*) FILTER (event_date >= cutoff - 30) AS n30,
    sum(downtime) FILTER (event_date >= cutoff - 30) AS dt30, count(*) FILTER (event_date >= cutoff - 90) AS n90,
    sum(downtime) FILTER (event_date >= cutoff - 90) AS dt90
  FROM f_event CROSS JOIN event_cutoff WHERE event_date <= cutoff GROUP BY 1) AS e ON e.machine_id = m.machine_id
LEFT JOIN (
  SELECT machine_id, count(DISTINCT session_id) AS ses, count(DISTINCT player_id) AS pl, sum(wager) AS wa,
    sum(net) AS ne, sum(net) FILTER (CAST(moment AS DATE) >= cutoff - 30) AS ne30,
    count(DISTINCT session_id) FILTER (CAST(moment AS DATE) >= cutoff - 30) AS ses30
  FROM f_tx CROSS JOIN event_cutoff WHERE CAST(moment AS DATE) <= cutoff GROUP BY 1) AS r ON r.machine_id = m.machine_id
LEFT JOIN (
  SELECT machine_id, count(*) AS later FROM f_event CROSS JOIN event_cutoff
  WHERE event_date > cutoff AND planned = 0 AND severity IN ('High','Critical') GROUP BY 1) AS f
  ON f.machine_id = m.machine_id""")
BODY["f2_machine_failure"] = "SELECT * FROM failure_feature"

_periods = """
SELECT r.*, location_name, region, location_type, coalesce(event_count, 0) AS event_count,
  coalesce(downtime_minutes, 0) AS downtime_minutes, coalesce(critical_event_count, 0) AS critical_event_count
FROM (
  SELECT {tx} AS {name}, location_id, count(*) AS transaction_count, count(DISTINCT session_id) AS session_count,
    count(DISTINCT player_id) AS unique_player_count, count(DISTINCT machine_id) AS active_machine_count,
    sum(wager) AS total_wager, sum(payout) AS total_payout, sum(jackpot) AS jackpot_amount,
    sum(net) AS net_gaming_revenue FROM f_tx GROUP BY 1, 2) AS r
JOIN d_location AS l ON l.location_id = r.location_id
LEFT JOIN (
  SELECT {ev} AS {name}, location_id, count(*) AS event_count, sum(downtime) AS downtime_minutes,
    count(*) FILTER (severity = 'Critical') AS critical_event_count FROM f_event GROUP BY 1, 2) AS e
  ON e.{name} = r.{name} AND e.location_id = r.location_id"""
add("location_day", _periods.format(tx="CAST(moment AS DATE)", ev="event_date", name="activity_date"))
_sunday = "CAST({0} AS DATE) - CAST(dayofweek({0}) AS INTEGER)"
add("location_week", _periods.format(
    tx=_sunday.format("moment"), ev=_sunday.format("event_date"), name="week_start_date"))


def _before(value: str, column: str, n: int) -> str:
    return mean_over(value, f"PARTITION BY location_id ORDER BY {column} ROWS BETWEEN {n} PRECEDING AND 1 PRECEDING")


add("daily_feature", f"""
SELECT *, year(activity_date) AS activity_year, month(activity_date) AS activity_month,
  quarter(activity_date) AS activity_quarter, dayofweek(activity_date) + 1 AS day_of_week_number,
  dayname(activity_date) AS day_of_week_name,
  CASE WHEN dayname(activity_date) IN ('Saturday','Sunday') THEN 1 ELSE 0 END AS is_weekend,
  lag(net_gaming_revenue, 1) OVER w AS revenue_lag_1_day, lag(net_gaming_revenue, 7) OVER w AS revenue_lag_7_days,
  lag(net_gaming_revenue, 14) OVER w AS revenue_lag_14_days,
  {_before('net_gaming_revenue', 'activity_date', 7)} AS previous_7_day_average_revenue,
  {_before('net_gaming_revenue', 'activity_date', 30)} AS previous_30_day_average_revenue,
  {_before('session_count', 'activity_date', 7)} AS previous_7_day_average_sessions
FROM location_day WINDOW w AS (PARTITION BY location_id ORDER BY activity_date)""")
BODY["f3_daily_forecast"] = "SELECT * FROM daily_feature"

add("day_stats", """
SELECT activity_date, avg(CAST(net_gaming_revenue AS DOUBLE)) AS rm, stddev_samp(CAST(net_gaming_revenue AS DOUBLE)) AS rs,
  avg(CAST(total_wager AS DOUBLE)) AS wm, stddev_samp(CAST(total_wager AS DOUBLE)) AS ws,
  avg(CAST(downtime_minutes AS DOUBLE)) AS dm, stddev_samp(CAST(downtime_minutes AS DOUBLE)) AS ds
FROM v_daily GROUP BY 1""")
add("anomaly_feature", """
SELECT * EXCLUDE (rz, wz, dz), CAST(rz AS DECIMAL(18,4)) AS revenue_z_score, CAST(wz AS DECIMAL(18,4)) AS wager_z_score,
  CAST(dz AS DECIMAL(18,4)) AS downtime_z_score,
  CASE WHEN abs(rz) >= 3 OR abs(wz) >= 3 OR dz >= 3 OR critical_event_count > 0 THEN 1 ELSE 0 END
    AS rule_based_anomaly_flag
FROM (
  SELECT d.*, (CAST(net_gaming_revenue AS DOUBLE) - rm) / nullif(rs, 0) AS rz,
    (CAST(total_wager AS DOUBLE) - wm) / nullif(ws, 0) AS wz,
    (CAST(downtime_minutes AS DOUBLE) - dm) / nullif(ds, 0) AS dz
  FROM v_daily AS d JOIN day_stats AS s ON s.activity_date = d.activity_date) AS z""")
BODY["f4_machine_anomaly"] = "SELECT * FROM anomaly_feature"

add("weekly_feature", f"""
SELECT *, year(week_start_date) AS activity_year, quarter(week_start_date) AS activity_quarter,
  month(week_start_date) AS activity_month, weekofyear(week_start_date) AS iso_week_number,
  lag(net_gaming_revenue, 1) OVER w AS revenue_lag_1_week, lag(net_gaming_revenue, 2) OVER w AS revenue_lag_2_weeks,
  lag(net_gaming_revenue, 4) OVER w AS revenue_lag_4_weeks,
  {_before('net_gaming_revenue', 'week_start_date', 4)} AS previous_4_week_average_revenue,
  {_before('net_gaming_revenue', 'week_start_date', 8)} AS previous_8_week_average_revenue,
  {_before('session_count', 'week_start_date', 4)} AS previous_4_week_average_sessions
FROM location_week WINDOW w AS (PARTITION BY location_id ORDER BY week_start_date)""")
BODY["f5_weekly_forecast"] = "SELECT * FROM weekly_feature"


def bodies() -> dict[str, str]:
    return {key: catalog.sql(body) for key, body in BODY.items()}
