"""SQL for the data-quality checks."""

from __future__ import annotations

from sqlcheck.base import catalog

BODY: dict[str, str] = {}
KEYS = {"location": ("d_location", "location_id"), "player": ("d_player", "player_id"),
        "machine": ("d_machine", "machine_id"), "session": ("f_session", "session_id"),
        "transaction": ("f_tx", "transaction_id"), "event": ("f_event", "event_id")}


def union(rows: list[tuple[str, str]]) -> str:
    """(rule, FROM clause and condition counted) pairs as one table."""
    return "\nUNION ALL ".join(
        f"SELECT '{rule}' AS rule, (SELECT count(*) FROM {source}) AS violations" for rule, source in rows)


BODY["q1_primary_keys"] = union(
    [(f"{t} key null", f"{s} WHERE {k} IS NULL") for t, (s, k) in KEYS.items()]
    + [(f"{t} key repeated", f"(SELECT {k} FROM {s} WHERE {k} IS NOT NULL GROUP BY 1 HAVING count(*) > 1) AS r")
       for t, (s, k) in KEYS.items()])
_links = [("machine", "location"), ("session", "location"), ("session", "machine"), ("session", "player"),
          ("transaction", "session"), ("transaction", "machine"), ("transaction", "player"), ("event", "machine")]
BODY["q2_orphans"] = union([
    (f"{c} without {p}", f"{KEYS[c][0]} WHERE {KEYS[p][1]} IS NULL OR {KEYS[p][1]} NOT IN "
                         f"(SELECT {KEYS[p][1]} FROM {KEYS[p][0]})") for c, p in _links])
BODY["q3_location_agreement"] = union([
    (f"{t} away from machine", f"{s} AS x LEFT JOIN d_machine AS m ON m.machine_id = x.machine_id "
                               "WHERE x.location_id IS DISTINCT FROM m.location_id")
    for t, s in (("session", "f_session"), ("event", "f_event"))])
BODY["q4_negative_amounts"] = union([
    ("session total_wager negative", "f_session WHERE wager < 0"),
    ("session total_payout negative", "f_session WHERE payout < 0"),
    ("transaction wager_amount negative", "f_tx WHERE wager < 0"),
    ("transaction payout_amount negative", "f_tx WHERE payout < 0"),
    ("transaction jackpot_amount negative", "f_tx WHERE jackpot < 0")])
BODY["q5_revenue_arithmetic"] = union([
    ("session revenue off", "f_session WHERE abs(wager - payout - net) > 0.02"),
    ("transaction revenue off", "f_tx WHERE abs(wager - payout - net) > 0.02")])
BODY["q6_reconciliation"] = """
SELECT *, abs(session_revenue - transaction_revenue) AS difference,
  CASE WHEN abs(session_revenue - transaction_revenue) > 5 THEN 1 ELSE 0 END AS violations
FROM (SELECT (SELECT sum(net) FROM f_session) AS session_revenue, (SELECT sum(net) FROM f_tx) AS transaction_revenue) AS t"""
BODY["q7_timestamps"] = union([
    ("session end not after start", "f_session WHERE session_end <= session_start"),
    ("transaction outside session", "f_tx AS t JOIN f_session AS s ON s.session_id = t.session_id "
                                    "WHERE moment < session_start OR moment > session_end")])
_measures = [(f"{t} rows", f"SELECT count(*) FROM {s}") for t, (s, _) in KEYS.items()] + [
    ("session revenue", "SELECT sum(net) FROM f_session"), ("transaction revenue", "SELECT sum(net) FROM f_tx"),
    ("downtime minutes", "SELECT sum(downtime) FROM f_event"),
    ("critical events", "SELECT count(*) FROM f_event WHERE severity = 'Critical'"),
    ("events to investigate", "SELECT sum(investigate) FROM f_event")]
BODY["q8_summary"] = "\nUNION ALL ".join(
    f"SELECT '{m}' AS measure, CAST(({q}) AS DOUBLE) AS value" for m, q in _measures)
BODY["q9_relationship_agreement"] = union([
    (f"transaction {c} differs", f"f_tx AS t JOIN f_session AS s ON s.session_id = t.session_id "
                                 f"WHERE t.{c} IS DISTINCT FROM s.{c}")
    for c in ("player_id", "machine_id", "location_id")])
BODY["q10_severity_domain"] = union([
    ("event severity unknown", "f_event WHERE severity IS NULL OR severity NOT IN ('Low','Medium','High','Critical')"),
    ("event investigation flag off", "f_event WHERE investigate IS DISTINCT FROM "
                                     "CAST(severity IN ('High','Critical') AS INTEGER)")])
BODY["q11_completeness"] = union(
    [(f"{t} row with null", f"(SELECT * FROM {s}) AS x WHERE NOT (COLUMNS(*) IS NOT NULL)") for t, (s, _) in KEYS.items()]
    + [("session duration not positive", "f_session WHERE minutes <= 0"),
       ("session rounds not positive", "f_session WHERE rounds <= 0")])
BODY["q12_declared_constraints"] = union([
    ("location active_flag not 0 or 1", "d_location WHERE active_flag NOT IN (0, 1)"),
    ("player marketing_opt_in not 0 or 1", "d_player WHERE marketing_opt_in NOT IN (0, 1)"),
    ("player active_flag not 0 or 1", "d_player WHERE active_flag NOT IN (0, 1)"),
    ("machine hold not between 0 and 1", "d_machine WHERE theoretical_hold_pct NOT BETWEEN 0 AND 1"),
    ("event requires_investigation not 0 or 1", "f_event WHERE investigate NOT IN (0, 1)"),
    ("event planned_event_flag not 0 or 1", "f_event WHERE planned NOT IN (0, 1)"),
    ("event downtime negative", "f_event WHERE downtime < 0")])


def bodies() -> dict[str, str]:
    return {key: catalog.sql(body) for key, body in BODY.items()}
