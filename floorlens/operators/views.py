"""The five base views every report is built on."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from floorlens.functions.exact import count_if, mean, ratio, zero_if_null
from floorlens.sources.bind import Floor

DAY_MINUTES = 1440
YEAR_MINUTES = 525_600


def _share_up(downtime: Column, minutes: int) -> Column:
    """Share of ``minutes`` not lost to downtime, never below zero."""
    return ratio(F.greatest(F.lit(minutes) - downtime, F.lit(0)), F.lit(minutes), 4)


def machine_daily(floor: Floor) -> DataFrame:
    """Revenue and events per machine, location and day with at least one transaction.

    Facts are reduced to machine-days on both sides before they meet. Days that have events
    but no transactions are left out; missing events count as zero.

    Transactions are shuffled once, by machine-day. Distinct counts take each session's and each player's first row
    there, where plain ones would shuffle every transaction three times, each time with all its ids.
    """
    day = ["activity_date", "machine_id", "location_id"]

    def first(name: str) -> Column:
        """1 on one row of each value within its machine-day, nothing where it is null."""
        place = F.row_number().over(Window.partitionBy(*day, name).orderBy(name))
        return F.when(F.col(name).isNotNull() & (place == 1), 1)

    revenue = (
        floor.transaction.withColumn("activity_date", F.to_date("transaction_timestamp"))
        .repartition(*day)
        .withColumn("_session", first("session_id"))
        .withColumn("_player", first("player_id"))
        .groupBy(*day)
        .agg(
            F.count("*").alias("transaction_count"),
            F.count("_session").alias("session_count"),
            F.count("_player").alias("unique_player_count"),
            F.sum("wager_amount").alias("total_wager"),
            F.sum("payout_amount").alias("total_payout"),
            F.sum("jackpot_amount").alias("jackpot_amount"),
            F.sum("net_gaming_revenue").alias("net_gaming_revenue"),
        )
    )
    events = (
        floor.event.withColumnRenamed("event_date", "activity_date")
        .groupBy(*day)
        .agg(
            F.count("*").alias("event_count"),
            F.sum("downtime_minutes").alias("downtime_minutes"),
            count_if(F.col("severity") == "Critical").alias("critical_event_count"),
            F.sum("requires_investigation").alias("investigation_count"),
        )
    )
    attributes = floor.machine.select(
        "machine_id", "manufacturer", "game_title", "game_category", "software_version"
    )
    counts = ["event_count", "downtime_minutes", "critical_event_count", "investigation_count"]
    active = F.greatest(F.lit(DAY_MINUTES) - F.col("downtime_minutes"), F.lit(0))
    return (
        revenue.join(events, day, "left")
        .join(attributes, "machine_id")
        .withColumns({name: zero_if_null(name) for name in counts})
        .select(
            *day, "manufacturer", "game_title", "game_category", "software_version",
            "transaction_count", "session_count", "unique_player_count",
            "total_wager", "total_payout", "jackpot_amount", "net_gaming_revenue",
            ratio("net_gaming_revenue", "total_wager").alias("actual_hold_pct"),
            *counts,
            active.alias("active_minutes"),
            _share_up(F.col("downtime_minutes"), DAY_MINUTES).alias("availability_pct"),
            ratio(F.col("net_gaming_revenue") * 60, active, 2).alias("revenue_per_active_hour"),
        )
    )


def location_performance(floor: Floor) -> DataFrame:
    """Totals per location over sessions played on that location's own machines."""
    machines = floor.machine.groupBy("location_id").agg(F.count("machine_id").alias("machine_count"))
    homes = floor.machine.select("machine_id", "location_id")
    played = (
        floor.session.join(homes, ["machine_id", "location_id"])
        .groupBy("location_id")
        .agg(
            F.count("session_id").alias("session_count"),
            F.countDistinct("player_id").alias("unique_player_count"),
            F.sum("total_rounds").alias("total_rounds"),
            F.sum("total_wager").alias("total_wager"),
            F.sum("total_payout").alias("total_payout"),
            F.sum("net_gaming_revenue").alias("net_gaming_revenue"),
        )
    )
    totals = [
        "machine_count", "session_count", "unique_player_count", "total_rounds",
        "total_wager", "total_payout", "net_gaming_revenue",
    ]
    return (
        floor.location.join(machines, "location_id", "left")
        .join(played, "location_id", "left")
        .withColumns({name: zero_if_null(name) for name in totals})
        .select(
            "location_id", "location_name", "city", "state", "region", "location_type", *totals,
            ratio("net_gaming_revenue", "total_wager").alias("actual_hold_pct"),
            ratio("net_gaming_revenue", "session_count", 2).alias("revenue_per_session"),
            ratio("net_gaming_revenue", "machine_count", 2).alias("revenue_per_machine"),
        )
    )


def player_summary(floor: Floor) -> DataFrame:
    """One row per registered player; players without sessions keep zero totals."""
    last_day = floor.session.agg(F.max("session_start").alias("last_session_anywhere"))
    played = floor.session.groupBy("player_id").agg(
        F.min("session_start").alias("first_session_date"),
        F.max("session_start").alias("latest_session_date"),
        F.count("session_id").alias("session_count"),
        F.countDistinct("location_id").alias("locations_visited"),
        F.countDistinct("machine_id").alias("machines_played"),
        F.sum("session_duration_minutes").alias("total_session_minutes"),
        F.sum("total_rounds").alias("total_rounds"),
        F.sum("total_wager").alias("total_wager"),
        F.sum("total_payout").alias("total_payout"),
        F.sum("net_gaming_revenue").alias("player_net_revenue"),
        mean("session_duration_minutes").alias("average_session_minutes"),
    )
    totals = [
        "session_count", "locations_visited", "machines_played", "total_session_minutes", "total_rounds",
        "total_wager", "total_payout", "player_net_revenue",
    ]
    return (
        floor.player.join(played, "player_id", "left")
        .crossJoin(F.broadcast(last_day))
        .withColumns({name: zero_if_null(name) for name in totals})
        .select(
            "player_id", "loyalty_tier", "age_band", "home_region", "marketing_opt_in", "active_flag",
            "first_session_date", "latest_session_date", *totals, "average_session_minutes",
            ratio("total_wager", "session_count", 2).alias("average_wager_per_session"),
            F.datediff("last_session_anywhere", "latest_session_date").alias("days_since_last_session"),
        )
    )


def machine_health(floor: Floor) -> DataFrame:
    """Event history per machine; machines without events keep zero counts and a NULL mean."""
    history = floor.event.groupBy("machine_id").agg(
        F.count("event_id").alias("total_event_count"),
        count_if(F.col("planned_event_flag") == 0).alias("unplanned_event_count"),
        count_if(F.col("severity") == "Critical").alias("critical_event_count"),
        F.sum("downtime_minutes").alias("total_downtime_minutes"),
        mean("downtime_minutes").alias("average_downtime_minutes"),
        F.sum("requires_investigation").alias("investigation_count"),
    )
    counts = [
        "total_event_count", "unplanned_event_count", "critical_event_count",
        "total_downtime_minutes", "investigation_count",
    ]
    return (
        floor.machine.join(floor.location.select("location_id", "location_name"), "location_id")
        .join(history, "machine_id", "left")
        .withColumns({name: zero_if_null(name) for name in counts})
        .select(
            "machine_id", "location_id", "location_name", "manufacturer", "game_title", "game_category",
            "software_version", "machine_status", *counts, "average_downtime_minutes",
            _share_up(F.col("total_downtime_minutes"), YEAR_MINUTES).alias("annual_availability_pct"),
        )
    )


def executive_kpis(floor: Floor) -> DataFrame:
    """One row over all transactions."""
    totals = floor.transaction.agg(
        F.countDistinct("location_id").alias("active_location_count"),
        F.countDistinct("machine_id").alias("revenue_generating_machine_count"),
        F.countDistinct("player_id").alias("active_player_count"),
        F.countDistinct("session_id").alias("total_session_count"),
        F.count("*").alias("total_transaction_count"),
        F.sum("wager_amount").alias("total_wager"),
        F.sum("payout_amount").alias("total_payout"),
        F.sum("jackpot_amount").alias("total_jackpot_amount"),
        F.sum("net_gaming_revenue").alias("net_gaming_revenue"),
    )
    return totals.select(
        "*",
        ratio("net_gaming_revenue", "total_wager").alias("actual_hold_pct"),
        ratio("net_gaming_revenue", "total_session_count", 2).alias("revenue_per_session"),
        ratio("net_gaming_revenue", "revenue_generating_machine_count", 2).alias("revenue_per_machine"),
    )
