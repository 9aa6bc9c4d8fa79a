"""Feature tables for the predictive operators. Features use only data up to a cutoff."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from floorlens.functions.calendar import is_weekend, week_start
from floorlens.functions.exact import count_if, mean, mean_over, ratio, sum_if, zero_if_null
from floorlens.operators.views import machine_daily
from floorlens.session import pin
from floorlens.sources.bind import Floor


def _window_dates(df: DataFrame, day: Column, holdout_days: int) -> DataFrame:
    """One row: last day of the data and the last day features may use."""
    last = F.max(day)
    return F.broadcast(
        df.agg(
            last.alias("dataset_end_date"), F.date_sub(last, holdout_days).alias("observation_cutoff_date")
        )
    )


def player_churn(floor: Floor, holdout_days: int = 60) -> DataFrame:
    """Player history up to the cutoff; the flag says whether no session followed.

    History and outcome come from one aggregate over the sessions: a session is history up to
    the cutoff and future after it. Sessions are shuffled once, by player; each place's first past row there is
    counted, where plain distinct counts would shuffle every session three times.
    """
    day = F.to_date("session_start")
    dates = _window_dates(floor.session, day, holdout_days)
    cutoff = F.col("observation_cutoff_date")
    past = day <= cutoff
    recent = lambda days: past & (day >= F.date_sub(cutoff, days))
    only = lambda name: F.when(past, F.col(name))

    def first(name: str) -> Column:
        """1 on one past row of each value of a player, nothing where it is null."""
        place = F.row_number().over(Window.partitionBy("player_id", "_past", name).orderBy(name))
        return F.when(F.col("_past") & F.col(name).isNotNull() & (place == 1), 1)

    history = (
        floor.session.repartition("player_id")
        .crossJoin(dates)
        .withColumn("_past", past)
        .withColumn("_location", first("location_id"))
        .withColumn("_machine", first("machine_id"))
        .groupBy("player_id", "observation_cutoff_date", "dataset_end_date")
        .agg(
            F.min(F.when(past, day)).alias("first_session_date"),
            F.max(F.when(past, day)).alias("latest_historical_session_date"),
            count_if(past).alias("total_historical_sessions"),
            count_if(recent(30)).alias("sessions_last_30_days"),
            count_if(recent(90)).alias("sessions_last_90_days"),
            F.count("_location").alias("locations_visited"),
            F.count("_machine").alias("machines_played"),
            F.sum(only("session_duration_minutes")).alias("total_session_minutes"),
            mean(only("session_duration_minutes"), 6).alias("average_session_minutes"),
            F.sum(only("total_rounds")).alias("total_rounds"),
            F.sum(only("total_wager")).alias("total_wager"),
            F.sum(only("total_payout")).alias("total_payout"),
            F.sum(only("net_gaming_revenue")).alias("player_net_revenue"),
            mean(only("total_wager"), 6).alias("average_wager_per_session"),
            sum_if(recent(30), "total_wager").alias("wager_last_30_days"),
            sum_if(recent(90), "total_wager").alias("wager_last_90_days"),
            sum_if(recent(30), "net_gaming_revenue").alias("revenue_last_30_days"),
            sum_if(recent(90), "net_gaming_revenue").alias("revenue_last_90_days"),
            count_if(~past).alias("future_session_count"),
        )
        .where("total_historical_sessions > 0")
    )
    lifetime = F.datediff("observation_cutoff_date", "first_session_date") + 1
    return floor.player.join(history, "player_id").select(
        "player_id", "loyalty_tier", "age_band", "home_region", "marketing_opt_in",
        F.col("active_flag").alias("registered_active_flag"), "observation_cutoff_date", "dataset_end_date",
        "first_session_date", "latest_historical_session_date",
        F.datediff("observation_cutoff_date", "latest_historical_session_date").alias("days_since_last_session"),
        lifetime.alias("observed_player_lifetime_days"),
        "total_historical_sessions", "sessions_last_30_days", "sessions_last_90_days", "locations_visited",
        "machines_played", "total_session_minutes", "average_session_minutes", "total_rounds", "total_wager",
        "total_payout", "player_net_revenue", "average_wager_per_session", "wager_last_30_days",
        "wager_last_90_days", "revenue_last_30_days", "revenue_last_90_days",
        ratio("total_historical_sessions", lifetime).alias("sessions_per_observed_day"),
        "future_session_count",
        F.when(F.col("future_session_count") == 0, 1).otherwise(0).alias("churn_flag"),
    )


def machine_failure(floor: Floor, holdout_days: int = 30) -> DataFrame:
    """Machine history up to the event cutoff; the flag marks a High or Critical unplanned event after it."""
    dates = _window_dates(floor.event, F.col("event_date"), holdout_days)
    cutoff = F.col("observation_cutoff_date")
    past = F.col("event_date") <= cutoff
    recent = lambda days: past & (F.col("event_date") >= F.date_sub(cutoff, days))
    serious = F.col("severity").isin("High", "Critical") & (F.col("planned_event_flag") == 0)
    events = (
        floor.event.crossJoin(dates)
        .groupBy("machine_id")
        .agg(
            count_if(past).alias("total_historical_events"),
            count_if(past & (F.col("planned_event_flag") == 0)).alias("unplanned_event_count"),
            count_if(past & (F.col("severity") == "Critical")).alias("critical_event_count"),
            count_if(past & (F.col("severity") == "High")).alias("high_severity_event_count"),
            sum_if(past, "downtime_minutes").alias("total_downtime_minutes"),
            mean(F.when(past, F.col("downtime_minutes")), 6).alias("average_downtime_minutes"),
            F.max(F.when(past, F.col("event_date"))).alias("latest_historical_event_date"),
            count_if(recent(30)).alias("events_last_30_days"),
            sum_if(recent(30), "downtime_minutes").alias("downtime_last_30_days"),
            count_if(recent(90)).alias("events_last_90_days"),
            sum_if(recent(90), "downtime_minutes").alias("downtime_last_90_days"),
            count_if(~past & serious).alias("future_failure_count"),
        )
    )
    day = F.to_date("transaction_timestamp")
    in_month = day >= F.date_sub(cutoff, 30)
    revenue = (
        floor.transaction.crossJoin(dates)
        .where(day <= cutoff)
        .groupBy("machine_id")
        .agg(
            F.countDistinct("session_id").alias("historical_session_count"),
            F.countDistinct("player_id").alias("historical_unique_players"),
            F.sum("wager_amount").alias("historical_total_wager"),
            F.sum("net_gaming_revenue").alias("historical_net_revenue"),
            sum_if(in_month, "net_gaming_revenue").alias("revenue_last_30_days"),
            F.countDistinct(F.when(in_month, F.col("session_id"))).alias("sessions_last_30_days"),
        )
    )
    zeros = [c for c in events.columns + revenue.columns if c not in ("machine_id", "latest_historical_event_date")]
    return (
        floor.machine.crossJoin(dates)
        .join(events, "machine_id", "left")
        .join(revenue, "machine_id", "left")
        .withColumns({name: zero_if_null(name) for name in zeros})
        .select(
            "machine_id", "location_id", "manufacturer", "cabinet_type", "game_title", "game_category",
            "software_version", "machine_status", "theoretical_hold_pct", "install_date",
            F.datediff(cutoff, "install_date").alias("machine_age_days"),
            "observation_cutoff_date", "dataset_end_date", "total_historical_events", "unplanned_event_count",
            "critical_event_count", "high_severity_event_count", "total_downtime_minutes",
            "average_downtime_minutes", "latest_historical_event_date",
            F.datediff(cutoff, "latest_historical_event_date").alias("days_since_last_event"),
            "events_last_30_days", "downtime_last_30_days", "events_last_90_days", "downtime_last_90_days",
            "historical_session_count", "historical_unique_players", "historical_total_wager",
            "historical_net_revenue", "revenue_last_30_days", "sessions_last_30_days", "future_failure_count",
            F.when(F.col("future_failure_count") > 0, 1).otherwise(0).alias("failure_target_flag"),
        )
    )


def _location_periods(floor: Floor, period, name: str) -> DataFrame:
    """Revenue per location and calendar period, with that period's events."""
    revenue = floor.transaction.groupBy(period("transaction_timestamp").alias(name), "location_id").agg(
        F.count("*").alias("transaction_count"),
        F.countDistinct("session_id").alias("session_count"),
        F.countDistinct("player_id").alias("unique_player_count"),
        F.countDistinct("machine_id").alias("active_machine_count"),
        F.sum("wager_amount").alias("total_wager"),
        F.sum("payout_amount").alias("total_payout"),
        F.sum("jackpot_amount").alias("jackpot_amount"),
        F.sum("net_gaming_revenue").alias("net_gaming_revenue"),
    )
    events = floor.event.groupBy(period("event_date").alias(name), "location_id").agg(
        F.count("*").alias("event_count"),
        F.sum("downtime_minutes").alias("downtime_minutes"),
        count_if(F.col("severity") == "Critical").alias("critical_event_count"),
    )
    places = floor.location.select("location_id", "location_name", "region", "location_type")
    counts = ["event_count", "downtime_minutes", "critical_event_count"]
    return (
        revenue.join(places, "location_id")
        .join(events, [name, "location_id"], "left")
        .withColumns({c: zero_if_null(c) for c in counts})
    )


_MEASURES = [
    "transaction_count", "session_count", "unique_player_count", "active_machine_count", "total_wager",
    "total_payout", "jackpot_amount", "net_gaming_revenue", "event_count", "downtime_minutes",
    "critical_event_count",
]


def daily_forecast(floor: Floor) -> DataFrame:
    """Location-days with lags counted in rows, so a missing day shifts them."""
    day = "activity_date"
    history = Window.partitionBy("location_id").orderBy(day)
    lag = lambda n: F.lag("net_gaming_revenue", n).over(history)
    before = lambda column, n: mean_over(column, history.rowsBetween(-n, -1))
    return _location_periods(floor, F.to_date, day).select(
        day, "location_id", "location_name", "region", "location_type",
        F.year(day).alias("activity_year"),
        F.month(day).alias("activity_month"),
        F.quarter(day).alias("activity_quarter"),
        F.dayofweek(day).alias("day_of_week_number"),
        F.date_format(day, "EEEE").alias("day_of_week_name"),
        F.when(is_weekend(day), 1).otherwise(0).alias("is_weekend"),
        *_MEASURES,
        lag(1).alias("revenue_lag_1_day"),
        lag(7).alias("revenue_lag_7_days"),
        lag(14).alias("revenue_lag_14_days"),
        before("net_gaming_revenue", 7).alias("previous_7_day_average_revenue"),
        before("net_gaming_revenue", 30).alias("previous_30_day_average_revenue"),
        before("session_count", 7).alias("previous_7_day_average_sessions"),
    )


def weekly_forecast(floor: Floor) -> DataFrame:
    """Location-weeks starting on Sunday."""
    week = "week_start_date"
    history = Window.partitionBy("location_id").orderBy(week)
    lag = lambda n: F.lag("net_gaming_revenue", n).over(history)
    before = lambda column, n: mean_over(column, history.rowsBetween(-n, -1))
    return _location_periods(floor, week_start, week).select(
        week, "location_id", "location_name", "region", "location_type",
        F.year(week).alias("activity_year"),
        F.quarter(week).alias("activity_quarter"),
        F.month(week).alias("activity_month"),
        F.weekofyear(week).alias("iso_week_number"),
        *_MEASURES,
        lag(1).alias("revenue_lag_1_week"),
        lag(2).alias("revenue_lag_2_weeks"),
        lag(4).alias("revenue_lag_4_weeks"),
        before("net_gaming_revenue", 4).alias("previous_4_week_average_revenue"),
        before("net_gaming_revenue", 8).alias("previous_8_week_average_revenue"),
        before("session_count", 4).alias("previous_4_week_average_sessions"),
    )


ANOMALY_LIMIT = 3


def machine_anomaly(floor: Floor, limit: float = ANOMALY_LIMIT) -> DataFrame:
    """Machine-days scored against all machines of the same day.

    Day statistics are aggregates joined back (one row per calendar day), not a window that would
    gather every machine of a day into one task. Machine-days are written once for both sides: no side joins and
    shuffles the transactions again.
    """
    return with_anomalies(pin(machine_daily(floor)), limit)


def with_anomalies(daily: DataFrame, limit: float = ANOMALY_LIMIT) -> DataFrame:
    """Machine-days, which are read twice, with z-scores and flag."""
    measures = {"revenue": "net_gaming_revenue", "wager": "total_wager", "downtime": "downtime_minutes"}
    stats = []
    for name, column in measures.items():
        value = F.col(column).cast("double")
        stats += [F.avg(value).alias(f"_{name}_mean"), F.stddev_samp(value).alias(f"_{name}_sd")]
    per_day = daily.groupBy("activity_date").agg(*stats)

    def z(name: str) -> Column:
        distance = F.col(measures[name]).cast("double") - F.col(f"_{name}_mean")
        return distance / F.nullif(F.col(f"_{name}_sd"), F.lit(0.0))

    unusual = (
        (F.abs(z("revenue")) >= limit)
        | (F.abs(z("wager")) >= limit)
        | (z("downtime") >= limit)
        | (F.col("critical_event_count") > 0)
    )
    return (
        daily.join(F.broadcast(per_day), "activity_date")
        .withColumns({f"{name}_z_score": z(name).cast("decimal(18,4)") for name in measures})
        .withColumn("rule_based_anomaly_flag", F.when(unusual, 1).otherwise(0))
        .select(*daily.columns, *[f"{name}_z_score" for name in measures], "rule_based_anomaly_flag")
    )
