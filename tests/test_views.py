import datetime as dt
from decimal import Decimal as D

import pytest

from floorlens.operators import features, views
from floorlens.operators.reports import health, location, machine, player
from tests.fixtures import make_floor, rows


def test_daily_view_edges(spark):
    floor = make_floor(
        spark,
        location=[{}], machine=[{}, {"machine_id": "M2"}],
        transaction=[
            {}, {"session_id": "S9", "player_id": "P2"},
            {"machine_id": "M2", "wager_amount": "0.00", "payout_amount": "0.00", "net_gaming_revenue": "0.00"},
            {"machine_id": "M9"},
        ],
        event=[
            {"downtime_minutes": 1000, "severity": "Critical", "requires_investigation": 1},
            {"downtime_minutes": 600},
            {"event_timestamp": "2024-01-02 09:00:00"},  # a day without transactions
        ],
    )
    got = {r["machine_id"]: r for r in rows(views.machine_daily(floor))}
    assert set(got) == {"M1", "M2"}  # unknown machines and event-only days are left out
    one, two = got["M1"], got["M2"]
    assert (one["transaction_count"], one["session_count"], one["unique_player_count"]) == (2, 2, 2)
    assert (one["event_count"], one["downtime_minutes"], one["critical_event_count"]) == (2, 1600, 1)
    assert one["active_minutes"] == 0 and one["availability_pct"] == 0
    assert one["revenue_per_active_hour"] is None and one["actual_hold_pct"] == D("0.1000")
    assert two["actual_hold_pct"] is None and two["downtime_minutes"] == 0 and two["availability_pct"] == 1


def test_daily_view_counts_what_sessions_and_players_share(spark):
    given = [("S1", "P1"), ("S1", "P1"), ("S1", "P2"), ("S2", "P1"), (None, "P3"), (None, None), ("S3", None), ("S4", "P2")]
    floor = make_floor(
        spark, location=[{}, {"location_id": "L2"}], machine=[{}],
        transaction=[
            *[{"session_id": s, "player_id": p} for s, p in given],
            {"session_id": "S1", "transaction_timestamp": "2024-01-02 00:00:00"},
            {"session_id": "S1", "location_id": "L2"},
        ],
    )
    got = {(str(r["activity_date"]), r["location_id"]): r for r in rows(views.machine_daily(floor))}
    counts = {k: (r["transaction_count"], r["session_count"], r["unique_player_count"]) for k, r in got.items()}
    assert counts == {("2024-01-01", "L1"): (8, 4, 3), ("2024-01-02", "L1"): (1, 1, 1), ("2024-01-01", "L2"): (1, 1, 1)}
    assert got["2024-01-01", "L1"]["total_wager"] == 800


def test_location_view_drops_sessions_away_from_home(spark):
    floor = make_floor(
        spark, location=[{}, {"location_id": "L2"}], machine=[{}],
        session=[{}, {"location_id": "L2"}],
    )
    got = {r["location_id"]: r for r in rows(views.location_performance(floor))}
    assert got["L1"]["session_count"] == 1
    assert got["L2"]["session_count"] == 0 and got["L2"]["machine_count"] == 0
    assert got["L2"]["net_gaming_revenue"] == 0 and got["L2"]["revenue_per_machine"] is None


def test_player_view_counts_midnights_and_keeps_idle_players(spark):
    floor = make_floor(
        spark, player=[{}, {"player_id": "P2"}, {"player_id": "P3"}],
        session=[
            {"session_start": "2024-01-01 23:59:00"},
            {"player_id": "P2", "session_start": "2024-01-02 00:01:00"},
        ],
    )
    got = {r["player_id"]: r for r in rows(views.player_summary(floor))}
    assert got["P1"]["days_since_last_session"] == 1 and got["P2"]["days_since_last_session"] == 0
    assert got["P3"]["session_count"] == 0 and got["P3"]["days_since_last_session"] is None
    assert got["P3"]["average_session_minutes"] is None
    labels = {r["player_id"]: r["churn_risk_level"] for r in rows(player.churn_tiers(floor))}
    assert labels == {"P1": "Active", "P2": "Active", "P3": "Never Activated"}


def test_health_view_without_events(spark):
    floor = make_floor(spark, location=[{}], machine=[{}])
    (got,) = rows(views.machine_health(floor))
    assert got["total_event_count"] == 0 and got["average_downtime_minutes"] is None
    assert got["annual_availability_pct"] == 1


def test_time_between_failures_counts_minute_boundaries(spark):
    floor = make_floor(
        spark, location=[{}], machine=[{}],
        event=[
            {"event_timestamp": "2024-01-01 00:00:59"}, {"event_timestamp": "2024-01-01 00:01:00"},
            {"event_timestamp": "2024-01-01 00:03:30"},
            {"event_timestamp": "2024-01-01 09:00:00", "planned_event_flag": 1},
            {"machine_id": "M2", "event_timestamp": "2024-01-01 00:00:00"},
        ],
    )
    (got,) = rows(health.mean_time_between_failures(floor))
    assert (got["machine_id"], got["measured_failure_intervals"]) == ("M1", 2)
    assert got["mtbf_minutes"] == D("1.50") and got["mtbf_hours"] == D("0.03")


def test_cohorts_count_month_boundaries(spark):
    floor = make_floor(
        spark,
        session=[
            {"session_start": "2024-01-31 10:00:00"}, {"session_start": "2024-02-01 10:00:00"},
            {"session_start": "2024-02-02 10:00:00"}, {"player_id": "P2", "session_start": "2024-01-05 10:00:00"},
        ],
    )
    got = [(r["cohort_index"], r["active_players"], r["retention_pct"]) for r in rows(player.cohort_retention(floor))]
    assert got == [(0, 2, D("100.00")), (1, 1, D("50.00"))]


def test_lone_machine_is_best(spark):
    floor = make_floor(
        spark, location=[{}, {"location_id": "L2", "location_name": "Two"}],
        machine=[{}, {"machine_id": "M2"}, {"machine_id": "M3"}, {"machine_id": "M4", "location_id": "L2"}],
        transaction=[
            {"net_gaming_revenue": "5.00"}, {"machine_id": "M2", "net_gaming_revenue": "5.00"},
            {"machine_id": "M3", "net_gaming_revenue": "-2.00"},
            {"machine_id": "M4", "location_id": "L2"},
        ],
    )
    got = [(r["location_id"], r["machine_id"], r["performance_label"]) for r in rows(machine.best_worst_machine_per_location(floor))]
    assert got == [("L1", "M1", "Best Machine"), ("L1", "M3", "Worst Machine"), ("L2", "M4", "Best Machine")]


def test_lags_are_rows_not_days(spark):
    days = ["2024-01-01", "2024-01-05", "2024-01-06"]
    floor = make_floor(
        spark, location=[{}],
        transaction=[{"transaction_timestamp": f"{d} 10:00:00", "net_gaming_revenue": f"{i}.00"} for i, d in enumerate(days, 1)],
    )
    got = {str(r["activity_date"]): r for r in rows(features.daily_forecast(floor))}
    assert got["2024-01-05"]["revenue_lag_1_day"] == 1 and got["2024-01-06"]["revenue_lag_1_day"] == 2
    assert got["2024-01-06"]["previous_7_day_average_revenue"] == D("1.50")
    assert got["2024-01-06"]["is_weekend"] == 1 and got["2024-01-06"]["day_of_week_name"] == "Saturday"


def test_weeks_start_on_sunday(spark):
    floor = make_floor(
        spark, location=[{}],
        transaction=[{"transaction_timestamp": f"{d} 10:00:00"} for d in ("2024-01-06", "2024-01-07", "2024-01-13")],
    )
    got = {str(r["week_start_date"]): r["transaction_count"] for r in rows(features.weekly_forecast(floor))}
    assert got == {"2023-12-31": 1, "2024-01-07": 2}


def test_anomaly_needs_more_than_one_machine_for_a_score(spark):
    floor = make_floor(spark, location=[{}], machine=[{}], transaction=[{}], event=[{"severity": "Critical"}])
    (got,) = rows(features.machine_anomaly(floor))
    assert got["revenue_z_score"] is None and got["rule_based_anomaly_flag"] == 1


def test_churn_window_borders(spark):
    floor = make_floor(
        spark, player=[{}, {"player_id": "P2"}, {"player_id": "P3"}],
        session=[
            {"session_start": "2024-03-01 23:00:00", "player_id": "P2"},
            {"session_start": "2024-01-01 23:59:00"},  # on the cutoff: history
            {"session_start": "2024-01-02 00:00:00", "player_id": "P3"},  # after it: no history
            {"session_start": "2023-12-02 00:00:00", "player_id": "P2"},  # 30 days before the cutoff
        ],
    )
    got = {r["player_id"]: r for r in rows(features.player_churn(floor))}
    assert set(got) == {"P1", "P2"}
    assert str(got["P1"]["observation_cutoff_date"]) == "2024-01-01"
    assert got["P1"]["churn_flag"] == 1 and got["P1"]["days_since_last_session"] == 0
    assert got["P2"]["churn_flag"] == 0 and got["P2"]["sessions_last_30_days"] == 1


def test_failure_counts_only_serious_unplanned_events_after_the_cutoff(spark):
    late = {"event_timestamp": "2024-03-15 10:00:00"}
    floor = make_floor(
        spark, location=[{}], machine=[{}, {"machine_id": "M2"}, {"machine_id": "M3"}],
        event=[
            {"event_timestamp": "2024-01-10 10:00:00"}, {**late, "severity": "High"},
            {**late, "machine_id": "M2", "severity": "Critical", "planned_event_flag": 1},
        ],
    )
    got = {r["machine_id"]: r for r in rows(features.machine_failure(floor))}
    assert [got[m]["failure_target_flag"] for m in ("M1", "M2", "M3")] == [1, 0, 0]
    assert got["M3"]["days_since_last_event"] is None and got["M3"]["total_downtime_minutes"] == 0


@pytest.mark.parametrize("value,label", [("7000.00", "High Productivity"), ("6999.99", "Medium Productivity"),
                                         ("6000.00", "Medium Productivity"), ("5999.99", "Low Productivity")])
def test_productivity_steps(spark, value, label):
    floor = make_floor(spark, location=[{}], machine=[{}], session=[{"net_gaming_revenue": value}])
    (got,) = rows(location.productivity(floor))
    assert got["machine_productivity_segment"] == label


def test_churn_counts_places_of_the_past_alone(spark):
    given = [("L1", "M1", 1), ("L1", "M2", 2), ("L2", "M2", 3), (None, "M3", 3), ("L1", None, 4), ("L3", "M4", 200), ("L1", "M1", 200)]
    floor = make_floor(
        spark, player=[{}, {"player_id": "P2"}],
        session=[
            *[{"location_id": l, "machine_id": m, "session_start": str(dt.datetime(2024, 1, 1) + dt.timedelta(days=d))} for l, m, d in given],
            {"player_id": "P2", "session_start": "2024-01-05 10:00:00"},
        ],
    )
    got = {r["player_id"]: r for r in rows(features.player_churn(floor))}
    one = got["P1"]
    assert (one["total_historical_sessions"], one["future_session_count"]) == (5, 2)
    assert (one["locations_visited"], one["machines_played"]) == (2, 3)
    assert (got["P2"]["locations_visited"], got["P2"]["churn_flag"]) == (1, 1)
