from floorlens.operators import quality
from tests.fixtures import make_floor, rows


def _violations(df):
    return {r["rule"]: r["violations"] for r in rows(df) if r["violations"]}


def test_each_rule_finds_its_violation(spark):
    floor = make_floor(
        spark,
        location=[{"active_flag": 2}],
        player=[{}],
        machine=[{"theoretical_hold_pct": "1.2000"}, {"machine_id": "M2", "location_id": "L9"}],
        session=[
            {"session_id": "A"},
            {"session_id": "A", "player_id": "P9", "session_end": "2024-01-01 10:00:00", "total_wager": "-1.00"},
            {"session_id": "B", "net_gaming_revenue": "10.03", "total_rounds": 0, "location_id": "L9"},
        ],
        transaction=[
            {"session_id": "B", "machine_id": "M9", "transaction_timestamp": "2024-01-01 11:00:00"},
            {"session_id": "Z", "jackpot_amount": "-1.00", "net_gaming_revenue": "99.00"},
        ],
        event=[
            {"severity": "Odd"}, {"severity": "High"}, {"machine_id": None, "downtime_minutes": -1, "planned_event_flag": 3},
        ],
    )
    assert _violations(quality.primary_keys(floor)) == {"session key repeated": 1}
    assert _violations(quality.orphans(floor)) == {
        "machine without location": 1, "session without location": 1, "session without player": 1,
        "transaction without session": 1, "transaction without machine": 1, "event without machine": 1,
    }
    assert _violations(quality.location_agreement(floor)) == {"session away from machine": 1, "event away from machine": 1}
    assert _violations(quality.negative_amounts(floor)) == {
        "session total_wager negative": 1, "transaction jackpot_amount negative": 1,
    }
    assert _violations(quality.revenue_arithmetic(floor)) == {"session revenue off": 2, "transaction revenue off": 1}
    assert rows(quality.revenue_reconciliation(floor))[0]["violations"] == 1
    assert _violations(quality.timestamps(floor)) == {"session end not after start": 1, "transaction outside session": 1}
    assert _violations(quality.relationship_agreement(floor)) == {
        "transaction machine_id differs": 1, "transaction location_id differs": 1,
    }
    assert _violations(quality.severity_domain(floor)) == {"event severity unknown": 1, "event investigation flag off": 1}
    assert _violations(quality.completeness(floor, {"event": 5})) == {
        "event row with null": 1, "event row count off": 2, "session rounds not positive": 1,
    }
    assert _violations(quality.declared_constraints(floor)) == {
        "location active_flag not 0 or 1": 1, "machine hold not between 0 and 1": 1, "event downtime negative": 1,
        "event planned_event_flag not 0 or 1": 1,
    }


def test_clean_floor_has_none(spark):
    floor = make_floor(spark, location=[{}], player=[{}], machine=[{}], session=[{"session_id": "A"}],
                       transaction=[{"session_id": "A"}], event=[{}])
    for check in (quality.primary_keys, quality.orphans, quality.location_agreement, quality.timestamps,
                  quality.completeness, quality.declared_constraints, quality.severity_domain):
        assert _violations(check(floor)) == {}
