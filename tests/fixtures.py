"""Small hand-made floors: give only the columns that matter, the rest take defaults."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

from floorlens.sources.bind import Floor
from floorlens.sources.schemas import TABLES

DEFAULTS = {
    "location": dict(location_id="L1", location_name="One", city="C", state="S", region="R", route_manager="RM",
                     location_type="Hotel", opening_date="2020-01-01", active_flag=1),
    "player": dict(player_id="P1", enrollment_date="2020-01-01", loyalty_tier="Gold", age_band="21-30",
                   home_region="R", marketing_opt_in=1, active_flag=1),
    "machine": dict(machine_id="M1", location_id="L1", manufacturer="A", cabinet_type="C", game_title="G",
                    game_category="K", install_date="2020-01-01", software_version="v1", machine_status="Active",
                    theoretical_hold_pct="0.0800"),
    "session": dict(session_id="S1", player_id="P1", machine_id="M1", location_id="L1",
                    session_start="2024-01-01 10:00:00", session_end="2024-01-01 10:30:00",
                    session_duration_minutes=30, total_rounds=10, total_wager="100.00", total_payout="90.00",
                    net_gaming_revenue="10.00"),
    "transaction": dict(transaction_id="T1", session_id="S1", player_id="P1", machine_id="M1", location_id="L1",
                        transaction_timestamp="2024-01-01 10:05:00", wager_amount="100.00", payout_amount="90.00",
                        jackpot_amount="0.00", net_gaming_revenue="10.00", transaction_type="Standard Round"),
    "event": dict(event_id=1, machine_id="M1", location_id="L1", event_timestamp="2024-01-01 12:00:00",
                  event_type="Jam", severity="Low", downtime_minutes=10, software_version="v1", error_code="E1",
                  event_date=None, requires_investigation=0, planned_event_flag=0),
}


def _typed(value, kind: str):
    if value is None:
        return None
    if kind == "date":
        return dt.date.fromisoformat(value)
    if kind == "timestamp_ntz":
        return dt.datetime.fromisoformat(value)
    return Decimal(value) if kind.startswith("decimal") else value


def make_floor(spark, **tables) -> Floor:
    frames = {}
    for name, (_, schema, key, _) in TABLES.items():
        rows = []
        for i, given in enumerate(tables.get(name, []), 1):
            row = {**DEFAULTS[name], **given}
            if key not in given and name not in ("location", "machine", "player"):
                row[key] = i if name == "event" else f"{name[0].upper()}{i}"
            if name == "event" and row["event_date"] is None:
                row["event_date"] = row["event_timestamp"][:10]
            rows.append(tuple(_typed(row[f.name], f.dataType.simpleString()) for f in schema))
        frames[name] = spark.createDataFrame(rows, schema)
    return Floor(**frames)


def rows(df) -> list[dict]:
    return [r.asDict() for r in df.collect()]
