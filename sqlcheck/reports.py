"""SQL for the report queries."""

from __future__ import annotations

from sqlcheck.base import add, catalog
from sqlcheck.text import case, mean, mean_over, percent, ratio

HOLD = ratio("sum(net_gaming_revenue)", "sum(total_wager)") + " AS actual_hold_pct"
BODY: dict[str, str] = {}

# ---- views -------------------------------------------------------------------------------------
for key, view in [("v1_machine_daily", "v_daily"), ("v2_location_performance", "v_location"),
                  ("v3_player_summary", "v_player"), ("v4_machine_health", "v_health"),
                  ("v5_executive_kpis", "v_exec")]:
    BODY[key] = f"SELECT * FROM {view}"

# ---- machine performance -----------------------------------------------------------------------
BODY["m1_machine_summary"] = f"""
SELECT machine_id, manufacturer, game_title, game_category, software_version,
  sum(transaction_count) AS total_transactions, sum(session_count) AS total_sessions,
  sum(unique_player_count) AS total_unique_players, sum(total_wager) AS total_wager,
  sum(total_payout) AS total_payout, sum(jackpot_amount) AS total_jackpot_amount,
  sum(net_gaming_revenue) AS net_gaming_revenue, {HOLD}, sum(downtime_minutes) AS total_downtime_minutes,
  sum(event_count) AS total_events, sum(critical_event_count) AS critical_events,
  {mean('availability_pct', 4)} AS average_availability_pct
FROM v_daily GROUP BY 1, 2, 3, 4, 5"""
_ends = f"""
SELECT machine_id, manufacturer, game_title, game_category, sum(total_wager) AS total_wager,
  sum(net_gaming_revenue) AS net_gaming_revenue, {HOLD}, sum(session_count) AS total_sessions,
  sum(downtime_minutes) AS downtime_minutes
FROM v_daily GROUP BY 1, 2, 3, 4 ORDER BY net_gaming_revenue"""
BODY["m2_top_machines"] = _ends + " DESC, machine_id LIMIT 10"
BODY["m3_bottom_machines"] = _ends + ", machine_id LIMIT 10"
BODY["m4_machine_ranking"] = """
SELECT *, rank() OVER (ORDER BY net_gaming_revenue DESC) AS revenue_rank,
  dense_rank() OVER (ORDER BY total_sessions DESC) AS session_rank,
  ntile(4) OVER (ORDER BY net_gaming_revenue DESC, machine_id) AS performance_quartile
FROM (SELECT machine_id, manufacturer, game_title, sum(net_gaming_revenue) AS net_gaming_revenue,
    sum(total_wager) AS total_wager, sum(session_count) AS total_sessions FROM v_daily GROUP BY 1, 2, 3) AS r"""
BODY["m5_by_manufacturer"] = f"""
SELECT manufacturer, count(DISTINCT machine_id) AS machine_count, sum(transaction_count) AS total_transactions,
  sum(session_count) AS total_sessions, sum(total_wager) AS total_wager,
  sum(net_gaming_revenue) AS net_gaming_revenue, {HOLD},
  {ratio('sum(net_gaming_revenue)', 'count(DISTINCT machine_id)', 2)} AS revenue_per_machine,
  sum(downtime_minutes) AS total_downtime_minutes
FROM v_daily GROUP BY 1"""
BODY["m6_by_game_category"] = f"""
SELECT game_category, count(DISTINCT machine_id) AS machine_count, sum(session_count) AS total_sessions,
  sum(unique_player_count) AS unique_players, sum(total_wager) AS total_wager, sum(total_payout) AS total_payout,
  sum(net_gaming_revenue) AS net_gaming_revenue, {HOLD},
  {ratio('sum(net_gaming_revenue)', 'sum(session_count)', 2)} AS revenue_per_session
FROM v_daily GROUP BY 1"""
BODY["m7_highest_downtime"] = """
SELECT machine_id, location_name, manufacturer, game_title, software_version, total_event_count,
  unplanned_event_count, critical_event_count, total_downtime_minutes, average_downtime_minutes,
  investigation_count, annual_availability_pct
FROM v_health ORDER BY total_downtime_minutes DESC, machine_id LIMIT 10"""
BODY["m8_lowest_availability"] = """
SELECT machine_id, location_name, manufacturer, game_title, software_version, total_downtime_minutes,
  critical_event_count, annual_availability_pct
FROM v_health ORDER BY annual_availability_pct, total_downtime_minutes DESC, machine_id LIMIT 10"""
BODY["m9_revenue_per_available_hour"] = f"""
SELECT r.machine_id, location_name, manufacturer, game_title, session_count, total_wager, net_gaming_revenue,
  total_downtime_minutes, critical_event_count, annual_availability_pct,
  {ratio('net_gaming_revenue*60', '525600-total_downtime_minutes', 2)} AS revenue_per_available_hour
FROM (SELECT machine_id, sum(net_gaming_revenue) AS net_gaming_revenue, sum(total_wager) AS total_wager,
    sum(session_count) AS session_count FROM v_daily GROUP BY 1) AS r
JOIN v_health AS h ON h.machine_id = r.machine_id"""
BODY["m10_daily_trend"] = f"""
SELECT activity_date, sum(total_wager) AS total_wager, sum(total_payout) AS total_payout,
  sum(net_gaming_revenue) AS net_gaming_revenue, sum(session_count) AS total_sessions,
  sum(downtime_minutes) AS total_downtime_minutes, {HOLD}
FROM v_daily GROUP BY 1"""
add("day_revenue", "SELECT activity_date, sum(net_gaming_revenue) AS daily_revenue FROM v_daily GROUP BY 1")
BODY["m11_seven_day_average"] = f"""
SELECT activity_date, daily_revenue,
  {mean_over('daily_revenue', 'ORDER BY activity_date ROWS BETWEEN 6 PRECEDING AND CURRENT ROW')}
    AS seven_day_moving_average,
  sum(daily_revenue) OVER (ORDER BY activity_date ROWS UNBOUNDED PRECEDING) AS cumulative_revenue
FROM day_revenue"""
BODY["m12_day_over_day"] = f"""
SELECT *, daily_revenue - previous_day_revenue AS revenue_change,
  {ratio('daily_revenue - previous_day_revenue', 'previous_day_revenue')} AS revenue_change_pct
FROM (SELECT *, lag(daily_revenue) OVER (ORDER BY activity_date) AS previous_day_revenue FROM day_revenue) AS d"""
_version = """
SELECT software_version, count(DISTINCT machine_id) AS machine_count, sum(session_count) AS {0},
  sum(total_wager) AS total_wager, sum(net_gaming_revenue) AS net_gaming_revenue, sum(event_count) AS {1},
  sum(critical_event_count) AS {2}, sum(downtime_minutes) AS downtime_minutes, {3},
  {4} AS average_availability_pct
FROM v_daily GROUP BY 1"""
BODY["m13_by_software_version"] = _version.format(
    "total_sessions", "total_events", "critical_events", HOLD, mean("availability_pct", 4))
RISK = """CASE WHEN critical_event_count >= 8 OR total_downtime_minutes >= 5000 THEN '{0}'
  WHEN critical_event_count >= 4 OR total_downtime_minutes >= 3500 THEN '{1}' ELSE '{2}' END"""
HEALTH_RISK = RISK.format("High Risk", "Medium Risk", "Low Risk")
BODY["m14_investigation_list"] = f"""
SELECT machine_id, location_name, manufacturer, game_title, software_version, total_event_count,
  unplanned_event_count, critical_event_count, investigation_count, total_downtime_minutes,
  annual_availability_pct, {HEALTH_RISK} AS machine_risk_level
FROM v_health WHERE investigation_count > 0"""
BODY["m15_best_worst_machine"] = """
SELECT r.location_id, location_name, machine_id, net_gaming_revenue,
  CASE WHEN best = 1 THEN 'Best Machine' ELSE 'Worst Machine' END AS performance_label
FROM (
  SELECT *, row_number() OVER (PARTITION BY location_id ORDER BY net_gaming_revenue DESC, machine_id) AS best,
    row_number() OVER (PARTITION BY location_id ORDER BY net_gaming_revenue, machine_id) AS worst
  FROM (SELECT location_id, machine_id, sum(net_gaming_revenue) AS net_gaming_revenue
        FROM v_daily GROUP BY 1, 2) AS s
) AS r JOIN d_location AS l ON l.location_id = r.location_id WHERE best = 1 OR worst = 1"""

# ---- player intelligence -----------------------------------------------------------------------
BODY["p1_player_kpis"] = f"""
SELECT count(*) AS total_registered_players, count(*) FILTER (session_count > 0) AS players_with_activity,
  count(*) FILTER (session_count = 0) AS players_without_activity,
  count(*) FILTER (loyalty_tier = 'Platinum') AS platinum_players,
  sum(marketing_opt_in) AS marketing_opt_in_players,
  {percent('sum(marketing_opt_in)', 'count(*)')} AS marketing_opt_in_pct,
  {mean('session_count')} AS average_sessions_per_player, {mean('total_wager')} AS average_wager_per_player,
  {mean('player_net_revenue')} AS average_revenue_per_player
FROM v_player"""
BODY["p2_by_loyalty_tier"] = f"""
SELECT loyalty_tier, count(*) AS registered_player_count, count(*) FILTER (session_count > 0) AS active_player_count,
  sum(session_count) AS total_sessions, sum(total_wager) AS total_wager, sum(total_payout) AS total_payout,
  sum(player_net_revenue) AS player_net_revenue,
  {ratio('sum(player_net_revenue)', 'sum(session_count)', 2)} AS revenue_per_session,
  {ratio('sum(total_wager)', 'count(*)', 2)} AS wager_per_registered_player
FROM v_player GROUP BY 1"""
BODY["p3_top_by_revenue"] = """
SELECT player_id, loyalty_tier, home_region, session_count, locations_visited, machines_played, total_wager,
  total_payout, player_net_revenue, average_session_minutes, average_wager_per_session, days_since_last_session
FROM v_player WHERE session_count > 0 ORDER BY player_net_revenue DESC, player_id LIMIT 20"""
BODY["p4_top_by_wager"] = f"""
SELECT player_id, loyalty_tier, session_count, total_rounds, total_wager, average_wager_per_session,
  player_net_revenue, {ratio('player_net_revenue', 'total_wager')} AS player_hold_pct
FROM v_player WHERE session_count > 0 ORDER BY total_wager DESC, player_id LIMIT 20"""
BODY["p5_player_ranking"] = """
SELECT player_id, loyalty_tier, session_count, total_wager, player_net_revenue, average_session_minutes,
  rank() OVER (ORDER BY player_net_revenue DESC) AS revenue_rank,
  dense_rank() OVER (ORDER BY session_count DESC) AS frequency_rank,
  ntile(4) OVER (ORDER BY player_net_revenue DESC, player_id) AS revenue_quartile,
  ntile(4) OVER (ORDER BY total_wager DESC, player_id) AS wagering_quartile
FROM v_player WHERE session_count > 0"""
add("value_segment", """
SELECT * EXCLUDE (r, f), CASE WHEN r = 1 AND f = 1 THEN 'VIP' WHEN r <= 2 AND f <= 2 THEN 'High Value'
  WHEN r <= 3 THEN 'Medium Value' ELSE 'Low Value' END AS player_value_segment
FROM (
  SELECT player_id, loyalty_tier, session_count, total_wager, player_net_revenue, average_wager_per_session,
    days_since_last_session, ntile(5) OVER (ORDER BY player_net_revenue DESC, player_id) AS r,
    ntile(5) OVER (ORDER BY session_count DESC, player_id) AS f
  FROM v_player WHERE session_count > 0
) AS b""")
BODY["p6_value_segmentation"] = "SELECT * FROM value_segment"
RFM = """CASE WHEN recency_score >= 4 AND frequency_score >= 4 AND monetary_score >= 4 THEN 'Champions'
  WHEN recency_score >= 3 AND frequency_score >= 4 THEN 'Loyal Players'
  WHEN recency_score >= 4 AND frequency_score IN (2, 3) THEN 'Potential Loyalists'
  WHEN recency_score <= 2 AND frequency_score >= 3 THEN 'At Risk'
  WHEN recency_score = 1 AND frequency_score <= 2 THEN 'Lost Players' ELSE 'Regular Players' END"""
add("rfm_score", """
SELECT *, ntile(5) OVER (ORDER BY days_since_last_session NULLS FIRST, player_id) AS recency_score,
  ntile(5) OVER (ORDER BY session_count DESC, player_id) AS frequency_score,
  ntile(5) OVER (ORDER BY player_net_revenue DESC, player_id) AS monetary_score
FROM v_player WHERE session_count > 0""")
BODY["p7_rfm"] = f"""
SELECT player_id, loyalty_tier, days_since_last_session AS recency_days, session_count AS frequency,
  player_net_revenue AS monetary_value, recency_score, frequency_score, monetary_score,
  '' || recency_score || frequency_score || monetary_score AS rfm_code, {RFM} AS rfm_segment
FROM rfm_score"""
CHURN = """CASE WHEN session_count = 0 THEN 'Never Activated' WHEN days_since_last_session >= 90 THEN '{0}'
  WHEN days_since_last_session >= 60 THEN '{1}' WHEN days_since_last_session >= 30 THEN '{2}' ELSE 'Active' END"""
CHURN_RISK = CHURN.format("High Churn Risk", "Medium Churn Risk", "Low Churn Risk")
BODY["p8_churn_tiers"] = f"""
SELECT player_id, loyalty_tier, session_count, total_wager, player_net_revenue, latest_session_date,
  days_since_last_session, {CHURN_RISK} AS churn_risk_level FROM v_player"""
BODY["p9_churn_summary"] = f"""
SELECT *, {percent('player_count', 'sum(player_count) OVER ()')} AS player_pct FROM (
  SELECT {CHURN_RISK} AS churn_risk_level, count(*) AS player_count, sum(player_net_revenue) AS associated_revenue
  FROM v_player GROUP BY 1) AS g"""
SPAN = "date_diff('day', first_session_date, latest_session_date)"
BODY["p10_session_frequency"] = f"""
SELECT player_id, loyalty_tier, session_count, first_session_date, latest_session_date, {SPAN} AS active_span_days,
  {ratio('session_count', SPAN + '+1')} AS sessions_per_active_day, days_since_last_session
FROM v_player WHERE session_count > 0"""
BODY["p11_mobility"] = f"""
SELECT player_id, loyalty_tier, session_count, locations_visited, machines_played, total_wager, player_net_revenue,
  {case('locations_visited', [(5, 'Highly Mobile'), (3, 'Multi-Location'), (2, 'Dual-Location')], 'Single-Location')}
    AS mobility_segment
FROM v_player WHERE session_count > 0"""
BODY["p12_preferred_location"] = """
SELECT player_id, location_id, location_name, session_count, total_wager, player_net_revenue FROM (
  SELECT player_id, s.location_id, location_name, count(*) AS session_count, sum(wager) AS total_wager,
    sum(net) AS player_net_revenue,
    row_number() OVER (PARTITION BY player_id ORDER BY count(*) DESC, sum(wager) DESC, s.location_id) AS place
  FROM f_session AS s JOIN d_location AS l ON l.location_id = s.location_id GROUP BY 1, 2, 3) AS a
WHERE place = 1"""
BODY["p13_preferred_machine"] = """
SELECT player_id, machine_id, game_title, game_category, manufacturer, session_count, total_wager FROM (
  SELECT player_id, s.machine_id, game_title, game_category, manufacturer, count(*) AS session_count,
    sum(wager) AS total_wager,
    row_number() OVER (PARTITION BY player_id ORDER BY count(*) DESC, sum(wager) DESC, s.machine_id) AS place
  FROM f_session AS s JOIN d_machine AS m ON m.machine_id = s.machine_id GROUP BY 1, 2, 3, 4, 5) AS a
WHERE place = 1"""
_mix = f"""
SELECT {{0}}, count(DISTINCT player_id) AS unique_players, count(*) AS session_count, sum(wager) AS total_wager,
  sum(net) AS net_gaming_revenue, {mean('minutes')} AS average_session_minutes FROM f_session GROUP BY 1"""
BODY["p14_weekend_vs_weekday"] = _mix.format(
    "CASE WHEN dayname(session_start) IN ('Saturday','Sunday') THEN 'Weekend' ELSE 'Weekday' END AS day_type")
BODY["p15_time_of_day"] = _mix.format(
    "CASE WHEN hour(session_start) BETWEEN 5 AND 11 THEN 'Morning' WHEN hour(session_start) BETWEEN 12 AND 16 "
    "THEN 'Afternoon' WHEN hour(session_start) BETWEEN 17 AND 21 THEN 'Evening' ELSE 'Late Night' END AS time_of_day")
BODY["p16_monthly_activity"] = """
SELECT *, active_players - previous_month_players AS player_change,
  net_gaming_revenue - previous_month_revenue AS revenue_change
FROM (
  SELECT *, lag(active_players) OVER w AS previous_month_players, lag(net_gaming_revenue) OVER w AS previous_month_revenue
  FROM (
    SELECT CAST(date_trunc('month', session_start) AS DATE) AS activity_month,
      count(DISTINCT player_id) AS active_players, count(*) AS total_sessions, sum(wager) AS total_wager,
      sum(net) AS net_gaming_revenue
    FROM f_session GROUP BY 1) AS m
  WINDOW w AS (ORDER BY activity_month)) AS c"""
add("cohort", """
SELECT cohort_month, date_diff('month', cohort_month, CAST(date_trunc('month', session_start) AS DATE)) AS cohort_index,
  count(DISTINCT s.player_id) AS active_players
FROM f_session AS s JOIN (
  SELECT player_id, CAST(date_trunc('month', min(session_start)) AS DATE) AS cohort_month
  FROM f_session GROUP BY 1) AS f ON f.player_id = s.player_id
GROUP BY 1, 2""")
BODY["p17_cohort_retention"] = f"""
SELECT c.cohort_month, c.cohort_index, c.active_players, z.active_players AS cohort_player_count,
  {percent('c.active_players', 'z.active_players')} AS retention_pct
FROM cohort AS c JOIN cohort AS z ON z.cohort_month = c.cohort_month AND z.cohort_index = 0"""
BODY["p18_lifetime_value"] = f"""
SELECT *, {ratio('daily_revenue_rate*365', '1', 2)} AS estimated_annual_value,
  {ratio('daily_revenue_rate*1095', '1', 2)} AS estimated_three_year_ltv
FROM (
  SELECT player_id, loyalty_tier, session_count, player_net_revenue, {SPAN} + 1 AS observed_lifetime_days,
    CAST({ratio('player_net_revenue', SPAN + '+1')} AS DECIMAL(18,4)) AS daily_revenue_rate
  FROM v_player WHERE session_count > 0) AS r"""
BODY["p19_opt_in_comparison"] = f"""
SELECT CASE WHEN marketing_opt_in = 1 THEN 'Opted In' ELSE 'Not Opted In' END AS marketing_status,
  count(*) AS player_count, sum(session_count) AS session_count, sum(total_wager) AS total_wager,
  sum(player_net_revenue) AS player_net_revenue,
  {ratio('sum(player_net_revenue)', 'count(*)', 2)} AS revenue_per_player,
  {ratio('sum(session_count)', 'count(*)', 2)} AS sessions_per_player
FROM v_player GROUP BY 1"""
BODY["p20_rfm_export"] = f"""
SELECT * EXCLUDE (active_flag, first_session_date, latest_session_date),
  recency_score + frequency_score + monetary_score AS total_rfm_score, {RFM} AS rfm_segment,
  CASE WHEN days_since_last_session >= 90 THEN 1 ELSE 0 END AS churn_flag
FROM rfm_score"""

# ---- location performance ----------------------------------------------------------------------
BODY["l1_location_overall"] = "SELECT * FROM v_location"
_loc = "location_id, location_name, region, machine_count, session_count, unique_player_count, net_gaming_revenue, revenue_per_machine"
BODY["l2_location_ranking"] = f"""
SELECT {_loc}, rank() OVER (ORDER BY net_gaming_revenue DESC) AS revenue_rank,
  dense_rank() OVER (ORDER BY session_count DESC) AS session_rank,
  ntile(4) OVER (ORDER BY net_gaming_revenue DESC, location_id) AS revenue_quartile
FROM v_location"""
_run = "sum(net_gaming_revenue) OVER (ORDER BY net_gaming_revenue DESC, location_id ROWS UNBOUNDED PRECEDING)"
_all = "sum(net_gaming_revenue) OVER ()"
BODY["l3_contribution"] = f"""
SELECT location_id, location_name, region, net_gaming_revenue,
  {percent('net_gaming_revenue', _all)} AS revenue_contribution_pct, {_run} AS cumulative_revenue,
  {percent(_run, _all)} AS cumulative_revenue_pct
FROM v_location"""
BODY["l4_productivity"] = f"""
SELECT location_id, location_name, machine_count, session_count, unique_player_count, net_gaming_revenue,
  revenue_per_machine, {ratio('session_count', 'machine_count', 2)} AS sessions_per_machine,
  {ratio('unique_player_count', 'machine_count', 2)} AS players_per_machine,
  {case('revenue_per_machine', [(7000, 'High Productivity'), (6000, 'Medium Productivity')], 'Low Productivity')}
    AS machine_productivity_segment
FROM v_location"""
_roll = f"""
SELECT {{0}}, count(*) AS location_count, sum(machine_count) AS total_machines, sum(session_count) AS total_sessions,
  sum(unique_player_count) AS total_location_player_counts, sum(total_wager) AS total_wager,
  sum(net_gaming_revenue) AS net_gaming_revenue,
  {ratio('sum(net_gaming_revenue)', 'sum(machine_count)', 2)} AS revenue_per_machine,
  {ratio('sum(net_gaming_revenue)', 'sum(session_count)', 2)} AS revenue_per_session
FROM v_location GROUP BY 1"""
BODY["l5_by_region"] = _roll.format("region")
BODY["l6_by_location_type"] = _roll.format("location_type")
BODY["l7_daily_trend"] = f"""
SELECT *, {ratio('net_gaming_revenue', 'total_wager')} AS actual_hold_pct FROM (
  SELECT t.location_id, location_name, CAST(moment AS DATE) AS activity_date, count(*) AS transaction_count,
    count(DISTINCT session_id) AS session_count, count(DISTINCT player_id) AS unique_player_count,
    sum(wager) AS total_wager, sum(payout) AS total_payout, sum(net) AS net_gaming_revenue
  FROM f_tx AS t JOIN d_location AS l ON l.location_id = t.location_id GROUP BY 1, 2, 3) AS d"""
add("location_month", """
SELECT location_id, CAST(date_trunc('month', moment) AS DATE) AS activity_month, count(DISTINCT session_id) AS session_count,
  count(DISTINCT player_id) AS unique_player_count, sum(wager) AS total_wager, sum(net) AS net_gaming_revenue
FROM f_tx GROUP BY 1, 2""")
BODY["l8_monthly"] = f"""
SELECT *, net_gaming_revenue - previous_month_revenue AS revenue_change,
  {ratio('net_gaming_revenue - previous_month_revenue', 'previous_month_revenue')} AS revenue_growth_pct
FROM (
  SELECT m.*, location_name,
    lag(net_gaming_revenue) OVER (PARTITION BY m.location_id ORDER BY activity_month) AS previous_month_revenue
  FROM location_month AS m JOIN d_location AS l ON l.location_id = m.location_id) AS c"""
_months = "PARTITION BY location_id ORDER BY activity_month"
BODY["l9_three_month_average"] = f"""
SELECT location_id, activity_month, net_gaming_revenue AS monthly_revenue,
  {mean_over('net_gaming_revenue', _months + ' ROWS BETWEEN 2 PRECEDING AND CURRENT ROW')}
    AS three_month_moving_average,
  sum(net_gaming_revenue) OVER ({_months} ROWS UNBOUNDED PRECEDING) AS cumulative_location_revenue
FROM location_month"""
BODY["l10_best_worst_location"] = """
SELECT location_id, location_name, region, net_gaming_revenue, revenue_per_machine,
  CASE WHEN best = 1 THEN 'Best in Region' ELSE 'Worst in Region' END AS regional_performance_label
FROM (
  SELECT *, row_number() OVER (PARTITION BY region ORDER BY net_gaming_revenue DESC, location_id) AS best,
    row_number() OVER (PARTITION BY region ORDER BY net_gaming_revenue, location_id) AS worst FROM v_location) AS r
WHERE best = 1 OR worst = 1"""
BODY["l11_machine_mix"] = f"""
SELECT *, {percent('machine_count', 'sum(machine_count) OVER (PARTITION BY location_id)')} AS machine_mix_pct FROM (
  SELECT l.location_id, location_name, manufacturer, game_category, count(*) AS machine_count
  FROM d_location AS l JOIN d_machine AS m ON m.location_id = l.location_id GROUP BY 1, 2, 3, 4) AS x"""
BODY["l12_player_mobility"] = f"""
SELECT l.location_id, location_name, total_players, multi_location_players,
  {percent('multi_location_players', 'total_players')} AS multi_location_player_pct
FROM (
  SELECT location_id, count(DISTINCT s.player_id) AS total_players,
    count(DISTINCT CASE WHEN visited > 1 THEN s.player_id END) AS multi_location_players
  FROM f_session AS s JOIN (SELECT player_id, count(DISTINCT location_id) AS visited FROM f_session GROUP BY 1) AS v
    ON v.player_id = s.player_id GROUP BY 1) AS x
JOIN d_location AS l ON l.location_id = x.location_id"""
BODY["l13_operational_risk"] = f"""
SELECT l.location_id, location_name, count(DISTINCT machine_id) AS machines_with_events, count(*) AS total_events,
  count(*) FILTER (planned = 0) AS unplanned_events, count(*) FILTER (severity = 'Critical') AS critical_events,
  sum(downtime) AS total_downtime_minutes, {mean('downtime')} AS average_downtime_minutes,
  sum(investigate) AS investigation_count
FROM f_event AS e JOIN d_location AS l ON l.location_id = e.location_id GROUP BY 1, 2"""
add("location_downtime", """
SELECT location_id, sum(downtime) AS downtime_minutes, count(*) AS event_count,
  count(*) FILTER (severity = 'Critical') AS critical_events FROM f_event GROUP BY 1""")
_down = """coalesce(downtime_minutes, 0) AS downtime_minutes, coalesce(event_count, 0) AS event_count,
  coalesce(critical_events, 0) AS critical_events"""
_hour = ratio("net_gaming_revenue*60", "machine_count*525600 - coalesce(downtime_minutes, 0)", 2)
BODY["l14_revenue_and_downtime"] = f"""
SELECT r.location_id, location_name, session_count, total_wager, net_gaming_revenue, {_down},
  {_hour} AS revenue_per_available_machine_hour
FROM (SELECT location_id, sum(net) AS net_gaming_revenue, sum(wager) AS total_wager,
    count(DISTINCT session_id) AS session_count FROM f_tx GROUP BY 1) AS r
JOIN d_location AS l ON l.location_id = r.location_id
JOIN (SELECT location_id, count(*) AS machine_count FROM d_machine GROUP BY 1) AS m ON m.location_id = r.location_id
LEFT JOIN location_downtime AS d ON d.location_id = r.location_id"""
BODY["l15_quadrants"] = f"""
SELECT {_loc}, CASE WHEN rich AND lean THEN 'High Revenue / High Efficiency'
  WHEN rich AND NOT lean THEN 'High Revenue / Low Efficiency'
  WHEN NOT rich AND lean THEN 'Low Revenue / High Efficiency' ELSE 'Low Revenue / Low Efficiency' END
    AS performance_segment
FROM (SELECT *, net_gaming_revenue * count(*) OVER () >= sum(net_gaming_revenue) OVER () AS rich,
    revenue_per_machine * count(revenue_per_machine) OVER () >= sum(revenue_per_machine) OVER () AS lean
  FROM v_location) AS q"""

# ---- machine health ----------------------------------------------------------------------------
_fleet = f"""count(*) AS {{machines}}, sum(total_event_count) AS {{events}},
  sum(critical_event_count) AS {{critical}}, sum(total_downtime_minutes) AS {{downtime}},
  {mean('annual_availability_pct', 4)} AS {{availability}}"""
BODY["h1_fleet_summary"] = f"""
SELECT {_fleet.format(machines='total_machines', events='total_events', critical='total_critical_events',
                      downtime='total_downtime_minutes', availability='average_availability_pct')},
  sum(unplanned_event_count) AS total_unplanned_events, sum(investigation_count) AS total_investigations,
  {mean('total_downtime_minutes')} AS average_downtime_per_machine
FROM v_health"""
_named = "machine_id, location_name, manufacturer, game_title, software_version"
BODY["h2_health_ranking"] = f"""
SELECT {_named}, total_event_count, unplanned_event_count, critical_event_count, total_downtime_minutes,
  average_downtime_minutes, investigation_count, annual_availability_pct,
  rank() OVER (ORDER BY total_downtime_minutes DESC) AS downtime_rank,
  dense_rank() OVER (ORDER BY critical_event_count DESC) AS critical_event_rank,
  ntile(4) OVER (ORDER BY annual_availability_pct NULLS FIRST, machine_id) AS health_risk_quartile
FROM v_health"""
BODY["h3_top_downtime"] = """
SELECT machine_id, location_id, location_name, manufacturer, game_title, game_category, software_version,
  total_event_count, unplanned_event_count, critical_event_count, total_downtime_minutes, annual_availability_pct
FROM v_health ORDER BY total_downtime_minutes DESC, machine_id LIMIT 20"""
BODY["h4_top_critical"] = f"""
SELECT {_named}, total_event_count, critical_event_count, investigation_count, total_downtime_minutes,
  annual_availability_pct
FROM v_health WHERE critical_event_count > 0
ORDER BY critical_event_count DESC, total_downtime_minutes DESC, machine_id LIMIT 20"""
BODY["h5_event_distribution"] = f"""
SELECT event_type, severity, count(*) AS event_count, sum(downtime) AS total_downtime_minutes,
  {mean('downtime')} AS average_downtime_minutes, sum(investigate) AS investigation_count
FROM f_event GROUP BY 1, 2"""
BODY["h6_root_causes"] = f"""
SELECT *, {percent('event_count', 'sum(event_count) OVER ()')} AS event_share_pct,
  {percent('total_downtime_minutes', 'sum(total_downtime_minutes) OVER ()')} AS downtime_share_pct
FROM (SELECT event_type, count(*) AS event_count, count(*) FILTER (planned = 0) AS unplanned_event_count,
    count(*) FILTER (severity = 'Critical') AS critical_event_count, sum(downtime) AS total_downtime_minutes
  FROM f_event GROUP BY 1) AS t"""
add("mttr", f"""
SELECT machine_id, count(*) AS repair_event_count, sum(downtime) AS total_repair_minutes,
  {mean('downtime')} AS mttr_minutes FROM f_event WHERE planned = 0 AND downtime > 0 GROUP BY 1""")
add("mtbf", f"""
SELECT machine_id, count(gap) AS measured_failure_intervals, {mean('gap')} AS mtbf_minutes,
  {ratio('sum(gap)', 'count(gap)*60', 2)} AS mtbf_hours
FROM (SELECT machine_id, date_diff('minute', lag(moment) OVER (PARTITION BY machine_id ORDER BY moment), moment) AS gap
  FROM f_event WHERE planned = 0) AS g
WHERE gap IS NOT NULL GROUP BY 1""")
BODY["h7_mttr"] = "SELECT * FROM mttr"
BODY["h8_mtbf"] = "SELECT * FROM mtbf"
BODY["h9_reliability"] = f"""
SELECT h.machine_id, location_name, manufacturer, game_title, software_version, total_event_count,
  total_downtime_minutes, mttr_minutes, mtbf_minutes,
  {ratio('mtbf_minutes', 'mtbf_minutes+mttr_minutes')} AS reliability_availability_ratio
FROM v_health AS h LEFT JOIN mttr AS a ON a.machine_id = h.machine_id LEFT JOIN mtbf AS b ON b.machine_id = h.machine_id"""
_rel = f"""count(*) AS machine_count, sum(total_event_count) AS total_events,
  sum(unplanned_event_count) AS unplanned_events, sum(critical_event_count) AS critical_events,
  sum(total_downtime_minutes) AS total_downtime_minutes,
  {ratio('sum(total_downtime_minutes)', 'count(*)', 2)} AS downtime_per_machine,
  {mean('annual_availability_pct', 4)} AS average_availability_pct"""
BODY["h10_by_manufacturer"] = f"""
SELECT manufacturer, {_rel}, {ratio('sum(total_event_count)', 'count(*)', 2)} AS events_per_machine
FROM v_health GROUP BY 1"""
BODY["h11_by_software_version"] = f"SELECT software_version, {_rel} FROM v_health GROUP BY 1"
BODY["h12_daily_downtime"] = f"""
SELECT *, {mean_over('downtime_minutes', 'ORDER BY event_date ROWS BETWEEN 6 PRECEDING AND CURRENT ROW')}
    AS seven_day_downtime_moving_average,
  lag(downtime_minutes) OVER (ORDER BY event_date) AS previous_day_downtime,
  downtime_minutes - lag(downtime_minutes) OVER (ORDER BY event_date) AS downtime_change
FROM (SELECT event_date, count(*) AS event_count, sum(downtime) AS downtime_minutes,
    count(*) FILTER (severity = 'Critical') AS critical_events FROM f_event GROUP BY 1) AS d"""
BODY["h13_repeat_failures"] = """
SELECT r.machine_id, location_name, manufacturer, game_title, most_common_failure, repeated_event_count,
  event_type_downtime, total_event_count, total_downtime_minutes
FROM (
  SELECT machine_id, event_type AS most_common_failure, count(*) AS repeated_event_count,
    sum(downtime) AS event_type_downtime,
    row_number() OVER (PARTITION BY machine_id ORDER BY count(*) DESC, sum(downtime) DESC, event_type) AS place
  FROM f_event WHERE planned = 0 GROUP BY 1, 2) AS r JOIN v_health AS h ON h.machine_id = r.machine_id
WHERE place = 1 AND repeated_event_count >= 5"""
_steps = [(17, "Immediate Maintenance"), (13, "High Priority"), (9, "Medium Priority")]
BODY["h14_maintenance_priority"] = f"""
SELECT *, {case('maintenance_priority_score', _steps, 'Routine Monitoring')} AS maintenance_priority FROM (
  SELECT *, downtime_score + critical_score + failure_score + availability_risk_score AS maintenance_priority_score
  FROM (
    SELECT {_named}, total_event_count, unplanned_event_count, critical_event_count, total_downtime_minutes,
      annual_availability_pct, ntile(5) OVER (ORDER BY total_downtime_minutes DESC, machine_id) AS downtime_score,
      ntile(5) OVER (ORDER BY critical_event_count DESC, machine_id) AS critical_score,
      ntile(5) OVER (ORDER BY unplanned_event_count DESC, machine_id) AS failure_score,
      ntile(5) OVER (ORDER BY annual_availability_pct NULLS FIRST, machine_id) AS availability_risk_score
    FROM v_health) AS s) AS t"""
BODY["h15_replacement"] = f"""
SELECT * EXCLUDE (rp, dp), CASE WHEN rp <= 0.25 AND dp >= 0.75 THEN 'Replacement Candidate'
  WHEN rp <= 0.40 AND dp >= 0.60 THEN 'Review for Replacement' ELSE 'Retain' END AS replacement_recommendation
FROM (
  SELECT *, percent_rank() OVER (ORDER BY net_gaming_revenue) AS rp,
    percent_rank() OVER (ORDER BY total_downtime_minutes) AS dp
  FROM (
    SELECT h.machine_id, location_name, manufacturer, game_title, software_version,
      coalesce(total_sessions, 0) AS total_sessions, coalesce(net_gaming_revenue, 0) AS net_gaming_revenue,
      total_event_count, critical_event_count, total_downtime_minutes, annual_availability_pct
    FROM v_health AS h LEFT JOIN (
      SELECT machine_id, sum(net_gaming_revenue) AS net_gaming_revenue, sum(session_count) AS total_sessions
      FROM v_daily GROUP BY 1) AS r ON r.machine_id = h.machine_id) AS j) AS p"""
BODY["h16_health_export"] = f"""
SELECT h.machine_id, location_id, location_name, manufacturer, game_title, game_category, software_version,
  machine_status, total_event_count, unplanned_event_count, critical_event_count, total_downtime_minutes,
  average_downtime_minutes, investigation_count, annual_availability_pct, moment AS latest_event_timestamp,
  event_type AS latest_event_type, severity AS latest_event_severity, {HEALTH_RISK} AS health_risk_level,
  CASE WHEN total_downtime_minutes >= 5000 THEN 1 ELSE 0 END AS maintenance_required_flag
FROM v_health AS h LEFT JOIN (
  SELECT machine_id, moment, event_type, severity,
    row_number() OVER (PARTITION BY machine_id ORDER BY moment DESC, event_id DESC) AS place FROM f_event) AS e
  ON e.machine_id = h.machine_id AND place = 1"""

# ---- executive ---------------------------------------------------------------------------------
BODY["e1_executive_kpis"] = f"""
SELECT k.*, (SELECT count(*) FROM d_machine) AS total_registered_machines,
  (SELECT count(*) FROM d_player) AS total_registered_players, h.*
FROM v_exec AS k, (
  SELECT sum(total_downtime_minutes) AS total_downtime_minutes, sum(critical_event_count) AS total_critical_events,
    {mean('annual_availability_pct', 4)} AS average_machine_availability_pct FROM v_health) AS h"""
_activity = """
SELECT {0}, count(*) AS transaction_count, count(DISTINCT session_id) AS session_count,
  count(DISTINCT player_id) AS active_player_count, count(DISTINCT machine_id) AS active_machine_count,
  sum(wager) AS total_wager, sum(payout) AS total_payout, sum(jackpot) AS jackpot_amount,
  sum(net) AS net_gaming_revenue FROM f_tx GROUP BY 1"""
add("day_activity", _activity.format("CAST(moment AS DATE) AS activity_date"))
add("month_activity", _activity.format("CAST(date_trunc('month', moment) AS DATE) AS activity_month"))
BODY["e2_daily_trend"] = f"""
SELECT *, {ratio('net_gaming_revenue', 'total_wager')} AS actual_hold_pct,
  {mean_over('net_gaming_revenue', 'ORDER BY activity_date ROWS BETWEEN 6 PRECEDING AND CURRENT ROW')}
    AS seven_day_revenue_moving_average,
  sum(net_gaming_revenue) OVER (ORDER BY activity_date ROWS UNBOUNDED PRECEDING) AS cumulative_revenue
FROM day_activity"""
BODY["e3_monthly_performance"] = f"""
SELECT * EXCLUDE (previous_players), active_player_count - previous_players AS player_change,
  net_gaming_revenue - previous_month_revenue AS revenue_change,
  {ratio('net_gaming_revenue - previous_month_revenue', 'previous_month_revenue')} AS revenue_growth_pct
FROM (SELECT *, lag(net_gaming_revenue) OVER (ORDER BY activity_month) AS previous_month_revenue,
    lag(active_player_count) OVER (ORDER BY activity_month) AS previous_players FROM month_activity) AS m"""
BODY["e4_top_bottom_locations"] = """
SELECT location_id, location_name, city, state, region, location_type, machine_count, session_count,
  unique_player_count, net_gaming_revenue, revenue_per_machine, revenue_per_session,
  CASE WHEN best <= 5 THEN 'Top Location' ELSE 'Bottom Location' END AS performance_group
FROM (SELECT *, row_number() OVER (ORDER BY net_gaming_revenue DESC, location_id) AS best,
    row_number() OVER (ORDER BY net_gaming_revenue, location_id) AS worst FROM v_location) AS r
WHERE best <= 5 OR worst <= 5"""
BODY["e5_top_machines"] = f"""
SELECT *, rank() OVER (ORDER BY net_gaming_revenue DESC) AS revenue_rank FROM (
  SELECT machine_id, manufacturer, game_title, game_category, software_version, sum(session_count) AS session_count,
    sum(total_wager) AS total_wager, sum(net_gaming_revenue) AS net_gaming_revenue,
    sum(downtime_minutes) AS downtime_minutes, sum(critical_event_count) AS critical_event_count,
    {mean('availability_pct', 4)} AS average_availability_pct
  FROM v_daily GROUP BY 1, 2, 3, 4, 5) AS m
ORDER BY net_gaming_revenue DESC, machine_id LIMIT 20"""
BODY["e6_player_segments"] = f"""
SELECT *, {percent('player_count', 'sum(player_count) OVER ()')} AS player_distribution_pct FROM (
  SELECT player_value_segment, count(*) AS player_count, sum(session_count) AS total_sessions,
    sum(total_wager) AS total_wager, sum(player_net_revenue) AS net_gaming_revenue,
    {ratio('sum(player_net_revenue)', 'count(*)', 2)} AS revenue_per_player
  FROM value_segment GROUP BY 1) AS g"""
BODY["e7_churn_summary"] = f"""
SELECT *, {percent('player_count', 'sum(player_count) OVER ()')} AS player_pct,
  {percent('associated_revenue', 'sum(associated_revenue) OVER ()')} AS revenue_pct
FROM (SELECT {CHURN.format('High Risk', 'Medium Risk', 'Low Risk')} AS churn_status, count(*) AS player_count,
    sum(player_net_revenue) AS associated_revenue FROM v_player GROUP BY 1) AS g"""
BODY["e8_health_summary"] = f"""
SELECT *, {percent('machine_count', 'sum(machine_count) OVER ()')} AS machine_distribution_pct FROM (
  SELECT {HEALTH_RISK} AS health_risk_level, {_fleet.format(
      machines='machine_count', events='total_events', critical='critical_events',
      downtime='total_downtime_minutes', availability='average_availability_pct')}
  FROM v_health GROUP BY 1) AS g"""
BODY["e9_revenue_vs_downtime"] = f"""
SELECT l.location_id, location_name, region, machine_count, session_count, unique_player_count, net_gaming_revenue,
  revenue_per_machine, {_down}, {_hour} AS revenue_per_available_machine_hour
FROM v_location AS l LEFT JOIN location_downtime AS d ON d.location_id = l.location_id"""
BODY["e10_manufacturers"] = f"""
SELECT h.*, session_count, total_wager, net_gaming_revenue,
  {ratio('net_gaming_revenue', 'machine_count', 2)} AS revenue_per_machine,
  {ratio('downtime_minutes', 'machine_count', 2)} AS downtime_per_machine
FROM (SELECT manufacturer, {_fleet.format(machines='machine_count', events='event_count',
        critical='critical_event_count', downtime='downtime_minutes', availability='availability_pct')}
  FROM v_health GROUP BY 1) AS h
LEFT JOIN (SELECT manufacturer, sum(session_count) AS session_count, sum(total_wager) AS total_wager,
    sum(net_gaming_revenue) AS net_gaming_revenue FROM v_daily GROUP BY 1) AS r ON r.manufacturer = h.manufacturer"""
BODY["e11_software_versions"] = _version.format(
    "session_count", "event_count", "critical_event_count", HOLD, mean("availability_pct", 4))
BODY["e12_master_dataset"] = f"""
SELECT active_location_count AS active_locations, revenue_generating_machine_count AS active_machines,
  active_player_count AS active_players, total_session_count AS total_sessions,
  total_transaction_count AS total_transactions, total_wager, total_payout, total_jackpot_amount AS jackpot_amount,
  net_gaming_revenue, actual_hold_pct, revenue_per_session, revenue_per_machine AS revenue_per_active_machine,
  m.*, p.*
FROM v_exec, (
  SELECT {_fleet.format(machines='registered_machines', events='total_events', critical='critical_events',
                        downtime='downtime_minutes', availability='availability_pct')} FROM v_health) AS m, (
  SELECT count(*) AS registered_players, count(*) FILTER (session_count > 0) AS activated_players,
    count(*) FILTER (days_since_last_session >= 90) AS high_churn_risk_players,
    count(*) FILTER (loyalty_tier = 'Platinum') AS platinum_players FROM v_player) AS p"""


def bodies() -> dict[str, str]:
    return {key: catalog.sql(body) for key, body in BODY.items()}
