"""Column types of the six canonical tables."""

from __future__ import annotations

from pyspark.sql import types as T

_MONEY = T.DecimalType(18, 2)


def _schema(spec: str) -> T.StructType:
    types = {
        "str": T.StringType(), "date": T.DateType(), "ts": T.TimestampNTZType(), "int": T.IntegerType(),
        "long": T.LongType(), "money": _MONEY, "hold": T.DecimalType(8, 4),
    }
    fields = (item.split(":") for item in spec.split())
    return T.StructType([T.StructField(name, types[kind]) for name, kind in fields])


DIM_LOCATION = _schema(
    "location_id:str location_name:str city:str state:str region:str route_manager:str "
    "location_type:str opening_date:date active_flag:int"
)
DIM_PLAYER = _schema(
    "player_id:str enrollment_date:date loyalty_tier:str age_band:str home_region:str "
    "marketing_opt_in:int active_flag:int"
)
DIM_MACHINE = _schema(
    "machine_id:str location_id:str manufacturer:str cabinet_type:str game_title:str game_category:str "
    "install_date:date software_version:str machine_status:str theoretical_hold_pct:hold"
)
FACT_SESSION = _schema(
    "session_id:str player_id:str machine_id:str location_id:str session_start:ts session_end:ts "
    "session_duration_minutes:int total_rounds:int total_wager:money total_payout:money "
    "net_gaming_revenue:money"
)
FACT_TRANSACTION = _schema(
    "transaction_id:str session_id:str player_id:str machine_id:str location_id:str "
    "transaction_timestamp:ts wager_amount:money payout_amount:money jackpot_amount:money "
    "net_gaming_revenue:money transaction_type:str"
)
FACT_EVENT = _schema(
    "event_id:long machine_id:str location_id:str event_timestamp:ts event_type:str severity:str "
    "downtime_minutes:int software_version:str error_code:str event_date:date "
    "requires_investigation:int planned_event_flag:int"
)

# table name -> (CSV file stem, schema, key, date column a warehouse copy is partitioned by)
TABLES = {
    "location": ("locations", DIM_LOCATION, "location_id", None),
    "player": ("players", DIM_PLAYER, "player_id", None),
    "machine": ("machines", DIM_MACHINE, "machine_id", None),
    "session": ("player_sessions", FACT_SESSION, "session_id", "session_start"),
    "transaction": ("gaming_transactions", FACT_TRANSACTION, "transaction_id", "transaction_timestamp"),
    "event": ("machine_events", FACT_EVENT, "event_id", "event_date"),
}
