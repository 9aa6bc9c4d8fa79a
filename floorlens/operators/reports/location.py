"""Location performance. Windows here run over one row per location or per location and month."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from floorlens.functions.calendar import month_start
from floorlens.functions.exact import count_if, mean, mean_over, percent, ratio, zero_if_null
from floorlens.operators import tiers
from floorlens.operators.reports.machine import HOURS_PER_YEAR, best_and_worst
from floorlens.operators.views import location_performance
from floorlens.sources.bind import Floor

def _all():
    return Window.partitionBy()


def _by_revenue():
    return [F.desc("net_gaming_revenue"), F.asc("location_id")]


def overall(floor: Floor) -> DataFrame:
    return location_performance(floor).orderBy(*_by_revenue())


def ranking(floor: Floor) -> DataFrame:
    by_revenue = Window.orderBy(F.desc("net_gaming_revenue"))
    return (
        location_performance(floor)
        .select(
            "location_id", "location_name", "region", "machine_count", "session_count", "unique_player_count",
            "net_gaming_revenue", "revenue_per_machine",
            F.rank().over(by_revenue).alias("revenue_rank"),
            F.dense_rank().over(Window.orderBy(F.desc("session_count"))).alias("session_rank"),
            F.ntile(4).over(Window.orderBy(*_by_revenue())).alias("revenue_quartile"),
        )
        .orderBy("revenue_rank", "location_id")
    )


def contribution(floor: Floor) -> DataFrame:
    so_far = Window.orderBy(*_by_revenue()).rowsBetween(Window.unboundedPreceding, 0)
    everything = F.sum("net_gaming_revenue").over(_all())
    return (
        location_performance(floor)
        .select(
            "location_id", "location_name", "region", "net_gaming_revenue",
            percent("net_gaming_revenue", everything).alias("revenue_contribution_pct"),
            F.sum("net_gaming_revenue").over(so_far).alias("cumulative_revenue"),
            percent(F.sum("net_gaming_revenue").over(so_far), everything).alias("cumulative_revenue_pct"),
        )
        .orderBy(*_by_revenue())
    )


def productivity(floor: Floor, cuts: tuple[int, int] = tiers.PRODUCTIVITY) -> DataFrame:
    steps = list(zip(cuts, ("High Productivity", "Medium Productivity")))
    return (
        location_performance(floor)
        .select(
            "location_id", "location_name", "machine_count", "session_count", "unique_player_count",
            "net_gaming_revenue", "revenue_per_machine",
            ratio("session_count", "machine_count", 2).alias("sessions_per_machine"),
            ratio("unique_player_count", "machine_count", 2).alias("players_per_machine"),
            tiers.ladder(F.col("revenue_per_machine"), steps, "Low Productivity").alias(
                "machine_productivity_segment"
            ),
        )
        .orderBy(F.desc("revenue_per_machine"), "location_id")
    )


def _rollup(floor: Floor, key: str) -> DataFrame:
    return (
        location_performance(floor)
        .groupBy(key)
        .agg(
            F.count("*").alias("location_count"),
            F.sum("machine_count").alias("total_machines"),
            F.sum("session_count").alias("total_sessions"),
            F.sum("unique_player_count").alias("total_location_player_counts"),
            F.sum("total_wager").alias("total_wager"),
            F.sum("net_gaming_revenue").alias("net_gaming_revenue"),
            ratio(F.sum("net_gaming_revenue"), F.sum("machine_count"), 2).alias("revenue_per_machine"),
            ratio(F.sum("net_gaming_revenue"), F.sum("session_count"), 2).alias("revenue_per_session"),
        )
        .orderBy(F.desc("net_gaming_revenue"), key)
    )


def by_region(floor: Floor) -> DataFrame:
    return _rollup(floor, "region")


def by_location_type(floor: Floor) -> DataFrame:
    return _rollup(floor, "location_type")


def daily_trend(floor: Floor) -> DataFrame:
    daily = floor.transaction.groupBy(
        "location_id", F.to_date("transaction_timestamp").alias("activity_date")
    ).agg(
        F.count("*").alias("transaction_count"),
        F.countDistinct("session_id").alias("session_count"),
        F.countDistinct("player_id").alias("unique_player_count"),
        F.sum("wager_amount").alias("total_wager"),
        F.sum("payout_amount").alias("total_payout"),
        F.sum("net_gaming_revenue").alias("net_gaming_revenue"),
    )
    return (
        daily.join(floor.location.select("location_id", "location_name"), "location_id")
        .withColumn("actual_hold_pct", ratio("net_gaming_revenue", "total_wager"))
        .orderBy("activity_date", *_by_revenue())
    )


def monthly(floor: Floor) -> DataFrame:
    per_month = floor.transaction.groupBy(
        "location_id", month_start("transaction_timestamp").alias("activity_month")
    ).agg(
        F.countDistinct("session_id").alias("session_count"),
        F.countDistinct("player_id").alias("unique_player_count"),
        F.sum("wager_amount").alias("total_wager"),
        F.sum("net_gaming_revenue").alias("net_gaming_revenue"),
    )
    previous = F.lag("net_gaming_revenue").over(Window.partitionBy("location_id").orderBy("activity_month"))
    return (
        per_month.join(floor.location.select("location_id", "location_name"), "location_id")
        .withColumn("previous_month_revenue", previous)
        .withColumn("revenue_change", F.col("net_gaming_revenue") - F.col("previous_month_revenue"))
        .withColumn("revenue_growth_pct", ratio("revenue_change", "previous_month_revenue"))
        .orderBy("location_id", "activity_month")
    )


def three_month_average(floor: Floor) -> DataFrame:
    per_month = floor.transaction.groupBy(
        "location_id", month_start("transaction_timestamp").alias("activity_month")
    ).agg(F.sum("net_gaming_revenue").alias("monthly_revenue"))
    months = Window.partitionBy("location_id").orderBy("activity_month")
    running = F.sum("monthly_revenue").over(months.rowsBetween(Window.unboundedPreceding, 0))
    return (
        per_month.withColumn(
            "three_month_moving_average", mean_over("monthly_revenue", months.rowsBetween(-2, 0))
        )
        .withColumn("cumulative_location_revenue", running)
        .orderBy("location_id", "activity_month")
    )


def best_worst_per_region(floor: Floor) -> DataFrame:
    labels = {"best": "Best in Region", "worst": "Worst in Region", "as": "regional_performance_label"}
    keep = ["location_name", "revenue_per_machine"]
    return best_and_worst(
        location_performance(floor), "region", "location_id", "net_gaming_revenue", keep, labels
    ).orderBy("region", "regional_performance_label")


def machine_mix(floor: Floor) -> DataFrame:
    mix = (
        floor.machine.groupBy("location_id", "manufacturer", "game_category")
        .agg(F.count("*").alias("machine_count"))
        .join(floor.location.select("location_id", "location_name"), "location_id")
    )
    at_location = F.sum("machine_count").over(Window.partitionBy("location_id"))
    return mix.withColumn("machine_mix_pct", percent("machine_count", at_location)).orderBy(
        "location_id", F.desc("machine_count"), "manufacturer", "game_category"
    )


def player_mobility(floor: Floor) -> DataFrame:
    """Pairs are deduplicated first, so a player's window holds at most one row per location."""
    pairs = floor.session.select("player_id", "location_id").distinct()
    visited = F.count("*").over(Window.partitionBy("player_id"))
    return (
        pairs.withColumn("visited", visited)
        .groupBy("location_id")
        .agg(F.count("*").alias("total_players"), count_if(F.col("visited") > 1).alias("multi_location_players"))
        .join(floor.location.select("location_id", "location_name"), "location_id")
        .withColumn("multi_location_player_pct", percent("multi_location_players", "total_players"))
        .orderBy(F.desc("multi_location_player_pct"), "location_id")
    )


def operational_risk(floor: Floor) -> DataFrame:
    events = floor.event.groupBy("location_id").agg(
        F.countDistinct("machine_id").alias("machines_with_events"),
        F.count("*").alias("total_events"),
        count_if(F.col("planned_event_flag") == 0).alias("unplanned_events"),
        count_if(F.col("severity") == "Critical").alias("critical_events"),
        F.sum("downtime_minutes").alias("total_downtime_minutes"),
        mean("downtime_minutes").alias("average_downtime_minutes"),
        F.sum("requires_investigation").alias("investigation_count"),
    )
    return events.join(floor.location.select("location_id", "location_name"), "location_id").orderBy(
        F.desc("total_downtime_minutes"), "location_id"
    )


def location_downtime(floor: Floor) -> DataFrame:
    return floor.event.groupBy("location_id").agg(
        F.sum("downtime_minutes").alias("downtime_minutes"),
        F.count("*").alias("event_count"),
        count_if(F.col("severity") == "Critical").alias("critical_events"),
    )


def per_available_machine_hour():
    """Net revenue per machine hour of a year, less the hours lost at the location."""
    up_minutes = F.col("machine_count") * (HOURS_PER_YEAR * 60) - F.col("downtime_minutes")
    return ratio(F.col("net_gaming_revenue") * 60, up_minutes, 2).alias("revenue_per_available_machine_hour")


def _with_downtime(df: DataFrame, floor: Floor) -> DataFrame:
    names = ["downtime_minutes", "event_count", "critical_events"]
    return df.join(location_downtime(floor), "location_id", "left").withColumns(
        {name: zero_if_null(name) for name in names}
    )


def revenue_and_downtime(floor: Floor) -> DataFrame:
    revenue = floor.transaction.groupBy("location_id").agg(
        F.countDistinct("session_id").alias("session_count"),
        F.sum("wager_amount").alias("total_wager"),
        F.sum("net_gaming_revenue").alias("net_gaming_revenue"),
    )
    machines = floor.machine.groupBy("location_id").agg(F.count("machine_id").alias("machine_count"))
    named = revenue.join(floor.location.select("location_id", "location_name"), "location_id")
    return (
        _with_downtime(named.join(machines, "location_id"), floor)
        .select(
            "location_id", "location_name", "session_count", "total_wager", "net_gaming_revenue",
            "downtime_minutes", "event_count", "critical_events", per_available_machine_hour(),
        )
        .orderBy(F.desc("revenue_per_available_machine_hour"), "location_id")
    )


def efficiency_by_location(floor: Floor) -> DataFrame:
    return (
        _with_downtime(location_performance(floor), floor)
        .select(
            "location_id", "location_name", "region", "machine_count", "session_count", "unique_player_count",
            "net_gaming_revenue", "revenue_per_machine", "downtime_minutes", "event_count", "critical_events",
            per_available_machine_hour(),
        )
        .orderBy(F.desc("revenue_per_available_machine_hour"), "location_id")
    )


def quadrants(floor: Floor) -> DataFrame:
    """Each location against the mean of all; compared as value * n >= sum, which needs no rounding."""

    def at_least_mean(name: str):
        return F.col(name) * F.count(name).over(_all()) >= F.sum(name).over(_all())

    revenue = F.when(F.col("_rich"), "High Revenue").otherwise("Low Revenue")
    efficiency = F.when(F.col("_lean"), "High Efficiency").otherwise("Low Efficiency")
    return (
        location_performance(floor)
        .withColumn("_rich", at_least_mean("net_gaming_revenue"))
        .withColumn("_lean", at_least_mean("revenue_per_machine"))
        .select(
            "location_id", "location_name", "region", "machine_count", "session_count", "unique_player_count",
            "net_gaming_revenue", "revenue_per_machine",
            F.when(F.col("revenue_per_machine").isNull(), "Low Revenue / Low Efficiency")
            .otherwise(F.concat_ws(" / ", revenue, efficiency))
            .alias("performance_segment"),
        )
        .orderBy(*_by_revenue())
    )
