"""The canonical tables and base views in SQL, over the given tables."""

from __future__ import annotations

from sqlcheck.text import Catalog, mean, ratio

catalog = Catalog()
add = catalog.add

add("d_location", """
SELECT 'L' || n_nationkey AS location_id, n_name AS location_name, n_name || ' City' AS city,
  'S' || n_nationkey % 10 AS state, r_name AS region, 'RM' || n_nationkey % 4 AS route_manager,
  ['Arcade','Cruise Ship','Hotel','Lounge','Racetrack'][n_nationkey % 5 + 1] AS location_type,
  DATE '1990-01-01' + n_nationkey * 30 AS opening_date,
  CASE WHEN n_nationkey % 10 = 9 THEN 0 ELSE 1 END AS active_flag
FROM nation JOIN region ON n_regionkey = r_regionkey""")

add("d_player", """
SELECT 'P' || c_custkey AS player_id, DATE '1991-01-01' + CAST(c_custkey % 1400 AS INTEGER) AS enrollment_date,
  CASE WHEN c_custkey % 20 < 1 THEN 'Platinum' WHEN c_custkey % 20 < 4 THEN 'Gold'
       WHEN c_custkey % 20 < 9 THEN 'Silver' ELSE 'Standard' END AS loyalty_tier,
  ['21-30','31-40','41-50','51-64','65+'][c_custkey % 5 + 1] AS age_band, r_name AS home_region,
  CAST(c_custkey % 100 < 72 AS INTEGER) AS marketing_opt_in, CAST(c_custkey % 50 < 47 AS INTEGER) AS active_flag
FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""")

add("d_machine", """
SELECT 'M' || s_suppkey AS machine_id, 'L' || s_nationkey AS location_id, 'Maker ' || s_suppkey % 5 AS manufacturer,
  'Cabinet ' || s_suppkey % 4 AS cabinet_type, 'Title ' || s_suppkey % 50 AS game_title,
  'Category ' || s_suppkey % 3 AS game_category,
  DATE '1991-01-01' + CAST(s_suppkey % 1000 AS INTEGER) AS install_date,
  'v' || (s_suppkey % 4 + 1) AS software_version,
  CASE WHEN s_suppkey % 20 = 0 THEN 'Maintenance' ELSE 'Active' END AS machine_status,
  CAST(s_suppkey % 40 + 50 AS DECIMAL(12,4)) * CAST(0.001 AS DECIMAL(4,3)) AS theoretical_hold_pct
FROM supplier""")

add("f_tx", """
SELECT 'T-' || l_orderkey || '-' || l_linenumber || '-' || l_suppkey || '-' || l_partkey AS transaction_id,
  'S-' || l_orderkey || '-' || l_suppkey AS session_id, 'P' || o_custkey AS player_id, 'M' || l_suppkey AS machine_id,
  'L' || s_nationkey AS location_id,
  o_orderdate + to_minutes(CAST(o_orderkey % 1440 AS BIGINT)) AS moment, wager, net, wager - net AS payout,
  CASE WHEN l_returnflag = 'R' AND l_linenumber = 7 THEN wager ELSE 0 END AS jackpot,
  CASE WHEN l_returnflag = 'R' AND l_linenumber = 7 THEN 'Jackpot' WHEN net < 0 THEN 'Winning Round'
       ELSE 'Standard Round' END AS transaction_type,
  CAST(l_quantity AS BIGINT) AS rounds
FROM (
  SELECT *, CAST(wager * (CAST(l_discount AS DECIMAL(4,2)) - CAST(0.02 AS DECIMAL(4,2))) AS DECIMAL(18,2)) AS net
  FROM (
    SELECT *, CAST(CAST(l_extendedprice AS DECIMAL(18,2)) * CAST(0.0067 AS DECIMAL(6,4)) AS DECIMAL(18,2)) AS wager
    FROM lineitem
  ) AS priced
) AS valued JOIN orders ON l_orderkey = o_orderkey JOIN supplier ON l_suppkey = s_suppkey""")

add("f_session", """
SELECT *, session_start + to_minutes(minutes) AS session_end
FROM (
  SELECT session_id, player_id, machine_id, location_id, moment AS session_start, 5 + sum(rounds)::BIGINT % 115 AS minutes,
    sum(rounds) AS rounds, sum(wager) AS wager, sum(payout) AS payout, sum(net) AS net
  FROM f_tx GROUP BY ALL
) AS grouped""")

add("f_event", """
SELECT event_id, 'M' || asset AS machine_id, 'L' || s_nationkey AS location_id, moment, event_type,
  CASE WHEN value >= 150 THEN 'Critical' WHEN value >= 80 THEN 'High' WHEN value >= 30 THEN 'Medium' ELSE 'Low' END
    AS severity,
  CAST(floor(value) AS INTEGER) AS downtime, 'v' || (asset % 4 + 1) AS software_version,
  'E' || event_id % 100 AS error_code, CAST(moment AS DATE) AS event_date,
  CAST(value >= 80 AS INTEGER) AS investigate, CAST(event_type IN ('signup','view') AS INTEGER) AS planned
FROM (
  SELECT *, user_id % (SELECT count(*) FROM supplier) AS asset,
    ts - to_days(CAST(event_id % 80 * 30 + 8217 AS INTEGER)) AS moment
  FROM events
) AS placed JOIN supplier ON asset = s_suppkey""")

add("v_daily", f"""
SELECT t.*, manufacturer, game_title, game_category, software_version,
  {ratio('net_gaming_revenue', 'total_wager')} AS actual_hold_pct,
  coalesce(e.event_count, 0) AS event_count, coalesce(e.downtime_minutes, 0) AS downtime_minutes,
  coalesce(e.critical_event_count, 0) AS critical_event_count,
  coalesce(e.investigation_count, 0) AS investigation_count,
  greatest(1440 - coalesce(e.downtime_minutes, 0), 0) AS active_minutes,
  CAST({ratio('greatest(1440 - coalesce(e.downtime_minutes, 0), 0)', '1440')} AS DECIMAL(10,4)) AS availability_pct,
  {ratio('net_gaming_revenue*60', 'greatest(1440 - coalesce(e.downtime_minutes, 0), 0)', 2)} AS revenue_per_active_hour
FROM (
  SELECT CAST(moment AS DATE) AS activity_date, machine_id, location_id, count(*) AS transaction_count,
    count(DISTINCT session_id) AS session_count, count(DISTINCT player_id) AS unique_player_count,
    sum(wager) AS total_wager, sum(payout) AS total_payout, sum(jackpot) AS jackpot_amount,
    sum(net) AS net_gaming_revenue
  FROM f_tx GROUP BY 1, 2, 3
) AS t
JOIN d_machine AS m ON m.machine_id = t.machine_id
LEFT JOIN (
  SELECT event_date, machine_id, location_id, count(*) AS event_count, sum(downtime) AS downtime_minutes,
    count(*) FILTER (severity = 'Critical') AS critical_event_count, sum(investigate) AS investigation_count
  FROM f_event GROUP BY 1, 2, 3
) AS e ON e.event_date = t.activity_date AND e.machine_id = t.machine_id AND e.location_id = t.location_id""")

add("v_location", f"""
SELECT location_id, location_name, city, state, region, location_type, machine_count, session_count,
  unique_player_count, total_rounds, total_wager, total_payout, net_gaming_revenue,
  {ratio('net_gaming_revenue', 'total_wager')} AS actual_hold_pct,
  CAST({ratio('net_gaming_revenue', 'session_count', 2)} AS DECIMAL(18,2)) AS revenue_per_session,
  CAST({ratio('net_gaming_revenue', 'machine_count', 2)} AS DECIMAL(18,2)) AS revenue_per_machine
FROM (
  SELECT l.location_id, location_name, city, state, region, location_type,
    count(DISTINCT m.machine_id) AS machine_count, count(DISTINCT session_id) AS session_count,
    count(DISTINCT player_id) AS unique_player_count, coalesce(sum(rounds), 0) AS total_rounds,
    coalesce(sum(wager), 0) AS total_wager, coalesce(sum(payout), 0) AS total_payout,
    coalesce(sum(net), 0) AS net_gaming_revenue
  FROM d_location AS l LEFT JOIN d_machine AS m ON m.location_id = l.location_id
  LEFT JOIN f_session AS s ON s.location_id = l.location_id AND s.machine_id = m.machine_id
  GROUP BY 1, 2, 3, 4, 5, 6
) AS totals""")

add("v_player", f"""
SELECT p.player_id, loyalty_tier, age_band, home_region, marketing_opt_in, active_flag,
  min(session_start) AS first_session_date, max(session_start) AS latest_session_date,
  count(DISTINCT session_id) AS session_count, count(DISTINCT s.location_id) AS locations_visited,
  count(DISTINCT machine_id) AS machines_played, coalesce(sum(minutes), 0) AS total_session_minutes,
  coalesce(sum(rounds), 0) AS total_rounds, coalesce(sum(wager), 0) AS total_wager,
  coalesce(sum(payout), 0) AS total_payout, coalesce(sum(net), 0) AS player_net_revenue,
  {mean('minutes')} AS average_session_minutes,
  {ratio('sum(wager)', 'count(DISTINCT session_id)', 2)} AS average_wager_per_session,
  date_diff('day', max(session_start), (SELECT max(session_start) FROM f_session)) AS days_since_last_session
FROM d_player AS p LEFT JOIN f_session AS s ON s.player_id = p.player_id
GROUP BY 1, 2, 3, 4, 5, 6""")

add("v_health", f"""
SELECT m.machine_id, m.location_id, location_name, manufacturer, game_title, game_category, m.software_version,
  machine_status, count(event_id) AS total_event_count, count(*) FILTER (planned = 0) AS unplanned_event_count,
  count(*) FILTER (severity = 'Critical') AS critical_event_count, coalesce(sum(downtime), 0) AS total_downtime_minutes,
  {mean('downtime')} AS average_downtime_minutes, coalesce(sum(investigate), 0) AS investigation_count,
  CAST({ratio('greatest(525600 - coalesce(sum(downtime), 0), 0)', '525600')} AS DECIMAL(10,4))
    AS annual_availability_pct
FROM d_machine AS m JOIN d_location AS l ON l.location_id = m.location_id
LEFT JOIN f_event AS e ON e.machine_id = m.machine_id
GROUP BY 1, 2, 3, 4, 5, 6, 7, 8""")

add("v_exec", f"""
SELECT *, {ratio('net_gaming_revenue', 'total_wager')} AS actual_hold_pct,
  {ratio('net_gaming_revenue', 'total_session_count', 2)} AS revenue_per_session,
  {ratio('net_gaming_revenue', 'revenue_generating_machine_count', 2)} AS revenue_per_machine
FROM (
  SELECT count(DISTINCT location_id) AS active_location_count,
    count(DISTINCT machine_id) AS revenue_generating_machine_count, count(DISTINCT player_id) AS active_player_count,
    count(DISTINCT session_id) AS total_session_count, count(*) AS total_transaction_count,
    sum(wager) AS total_wager, sum(payout) AS total_payout, sum(jackpot) AS total_jackpot_amount,
    sum(net) AS net_gaming_revenue
  FROM f_tx
) AS totals""")
