"""Executive dashboard datasets."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from floorlens.functions.calendar import month_start
from floorlens.functions.exact import count_if, mean, mean_over, percent, ratio
from floorlens.operators import tiers
from floorlens.operators.ranks import Ranking, with_global_ranks
from floorlens.operators.reports.location import efficiency_by_location as revenue_vs_downtime  # noqa: F401
from floorlens.operators.reports.machine import by_software_version as _machine_versions
from floorlens.operators.reports.machine import machine_totals
from floorlens.operators.reports.player import share_of_all, value_segments
from floorlens.operators.views import executive_kpis, location_performance, machine_health, player_summary
from floorlens.sources.bind import Floor


def _one_row(df: DataFrame, *others: DataFrame) -> DataFrame:
    """Put single-row aggregates side by side."""
    for other in others:
        df = df.crossJoin(F.broadcast(other))
    return df


def kpi_summary(floor: Floor) -> DataFrame:
    machines = floor.machine.agg(F.count("*").alias("total_registered_machines"))
    players = floor.player.agg(F.count("*").alias("total_registered_players"))
    health = machine_health(floor).agg(
        F.sum("total_downtime_minutes").alias("total_downtime_minutes"),
        F.sum("critical_event_count").alias("total_critical_events"),
        mean("annual_availability_pct", 4).alias("average_machine_availability_pct"),
    )
    return _one_row(executive_kpis(floor), machines, players, health)


def activity(floor: Floor, period, name: str) -> DataFrame:
    """Transactions summed per calendar period."""
    return floor.transaction.groupBy(period.alias(name)).agg(
        F.count("*").alias("transaction_count"),
        F.countDistinct("session_id").alias("session_count"),
        F.countDistinct("player_id").alias("active_player_count"),
        F.countDistinct("machine_id").alias("active_machine_count"),
        F.sum("wager_amount").alias("total_wager"),
        F.sum("payout_amount").alias("total_payout"),
        F.sum("jackpot_amount").alias("jackpot_amount"),
        F.sum("net_gaming_revenue").alias("net_gaming_revenue"),
    )


def daily_activity(floor: Floor) -> DataFrame:
    return activity(floor, F.to_date("transaction_timestamp"), "activity_date")


def daily_trend(floor: Floor) -> DataFrame:
    days = Window.orderBy("activity_date")
    return (
        daily_activity(floor)
        .withColumn("actual_hold_pct", ratio("net_gaming_revenue", "total_wager"))
        .withColumn(
            "seven_day_revenue_moving_average", mean_over("net_gaming_revenue", days.rowsBetween(-6, 0))
        )
        .withColumn(
            "cumulative_revenue",
            F.sum("net_gaming_revenue").over(days.rowsBetween(Window.unboundedPreceding, 0)),
        )
        .orderBy("activity_date")
    )


def monthly_performance(floor: Floor) -> DataFrame:
    months = Window.orderBy("activity_month")
    previous_players = F.lag("active_player_count").over(months)
    return (
        activity(floor, month_start("transaction_timestamp"), "activity_month")
        .withColumn("previous_month_revenue", F.lag("net_gaming_revenue").over(months))
        .withColumn("player_change", F.col("active_player_count") - previous_players)
        .withColumn("revenue_change", F.col("net_gaming_revenue") - F.col("previous_month_revenue"))
        .withColumn("revenue_growth_pct", ratio("revenue_change", "previous_month_revenue"))
        .orderBy("activity_month")
    )


def top_and_bottom_locations(floor: Floor, n: int = 5) -> DataFrame:
    """The windows run over one row per location."""
    best = F.row_number().over(Window.orderBy(F.desc("net_gaming_revenue"), "location_id"))
    worst = F.row_number().over(Window.orderBy("net_gaming_revenue", "location_id"))
    return (
        location_performance(floor)
        .select(
            "location_id", "location_name", "city", "state", "region", "location_type", "machine_count",
            "session_count", "unique_player_count", "net_gaming_revenue", "revenue_per_machine",
            "revenue_per_session", best.alias("_best"), worst.alias("_worst"),
        )
        .where((F.col("_best") <= n) | (F.col("_worst") <= n))
        .withColumn("performance_group", F.when(F.col("_best") <= n, "Top Location").otherwise("Bottom Location"))
        .drop("_best", "_worst")
        .orderBy(F.desc("net_gaming_revenue"), "location_id")
    )


def top_machines(floor: Floor, n: int = 20) -> DataFrame:
    """Only the first n are kept before ranking, so the ranking window sees n rows and ties."""
    keys = ["machine_id", "manufacturer", "game_title", "game_category", "software_version"]
    first = (
        machine_totals(floor, keys)
        .select(
            *keys, F.col("total_sessions").alias("session_count"), "total_wager", "net_gaming_revenue",
            F.col("total_downtime_minutes").alias("downtime_minutes"),
            F.col("critical_events").alias("critical_event_count"), "average_availability_pct",
        )
        .orderBy(F.desc("net_gaming_revenue"), "machine_id")
        .limit(n)
    )
    rank = F.rank().over(Window.orderBy(F.desc("net_gaming_revenue")))
    return first.withColumn("revenue_rank", rank).orderBy(F.desc("net_gaming_revenue"), "machine_id")


def player_segments(floor: Floor) -> DataFrame:
    return (
        value_segments(floor)
        .groupBy("player_value_segment")
        .agg(
            F.count("*").alias("player_count"),
            F.sum("session_count").alias("total_sessions"),
            F.sum("total_wager").alias("total_wager"),
            F.sum("player_net_revenue").alias("net_gaming_revenue"),
            ratio(F.sum("player_net_revenue"), F.count("*"), 2).alias("revenue_per_player"),
        )
        .withColumn("player_distribution_pct", share_of_all("player_count"))
        .orderBy(F.desc("net_gaming_revenue"), "player_value_segment")
    )


def churn_summary(floor: Floor) -> DataFrame:
    labels = ("High Risk", "Medium Risk", "Low Risk")
    everything = Window.partitionBy()  # one row per status
    return (
        player_summary(floor)
        .groupBy(tiers.inactivity(labels).alias("churn_status"))
        .agg(F.count("*").alias("player_count"), F.sum("player_net_revenue").alias("associated_revenue"))
        .withColumn("player_pct", share_of_all("player_count"))
        .withColumn("revenue_pct", percent("associated_revenue", F.sum("associated_revenue").over(everything)))
        .orderBy(tiers.position(F.col("churn_status"), [*labels, "Active"]))
    )


def health_summary(floor: Floor) -> DataFrame:
    return (
        machine_health(floor)
        .groupBy(tiers.health_risk().alias("health_risk_level"))
        .agg(
            F.count("*").alias("machine_count"),
            F.sum("total_event_count").alias("total_events"),
            F.sum("critical_event_count").alias("critical_events"),
            F.sum("total_downtime_minutes").alias("total_downtime_minutes"),
            mean("annual_availability_pct", 4).alias("average_availability_pct"),
        )
        .withColumn("machine_distribution_pct", share_of_all("machine_count"))
        .orderBy(tiers.position(F.col("health_risk_level"), ["High Risk", "Medium Risk", "Low Risk"]))
    )


def manufacturers(floor: Floor) -> DataFrame:
    revenue = machine_totals(floor, ["manufacturer"]).select(
        "manufacturer", F.col("total_sessions").alias("session_count"), "total_wager", "net_gaming_revenue"
    )
    health = machine_health(floor).groupBy("manufacturer").agg(
        F.count("*").alias("machine_count"),
        F.sum("total_event_count").alias("event_count"),
        F.sum("critical_event_count").alias("critical_event_count"),
        F.sum("total_downtime_minutes").alias("downtime_minutes"),
        mean("annual_availability_pct", 4).alias("availability_pct"),
    )
    return (
        health.join(revenue, "manufacturer", "left")
        .withColumn("revenue_per_machine", ratio("net_gaming_revenue", "machine_count", 2))
        .withColumn("downtime_per_machine", ratio("downtime_minutes", "machine_count", 2))
        .orderBy(F.desc("net_gaming_revenue"), "manufacturer")
    )


def software_versions(floor: Floor) -> DataFrame:
    return _machine_versions(floor).withColumnsRenamed(
        {"total_sessions": "session_count", "total_events": "event_count", "critical_events": "critical_event_count"}
    )


def master_dataset(floor: Floor) -> DataFrame:
    revenue = executive_kpis(floor).select(
        F.col("active_location_count").alias("active_locations"),
        F.col("revenue_generating_machine_count").alias("active_machines"),
        F.col("active_player_count").alias("active_players"),
        F.col("total_session_count").alias("total_sessions"),
        F.col("total_transaction_count").alias("total_transactions"),
        "total_wager", "total_payout",
        F.col("total_jackpot_amount").alias("jackpot_amount"),
        "net_gaming_revenue", "actual_hold_pct", "revenue_per_session",
        F.col("revenue_per_machine").alias("revenue_per_active_machine"),
    )
    machines = machine_health(floor).agg(
        F.count("*").alias("registered_machines"),
        F.sum("total_event_count").alias("total_events"),
        F.sum("critical_event_count").alias("critical_events"),
        F.sum("total_downtime_minutes").alias("downtime_minutes"),
        mean("annual_availability_pct", 4).alias("availability_pct"),
    )
    players = player_summary(floor).agg(
        F.count("*").alias("registered_players"),
        count_if(F.col("session_count") > 0).alias("activated_players"),
        count_if(F.col("days_since_last_session") >= tiers.CHURN_DAYS[0]).alias("high_churn_risk_players"),
        count_if(F.col("loyalty_tier") == "Platinum").alias("platinum_players"),
    )
    return _one_row(revenue, machines, players)
