"""Machine performance."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from floorlens.functions.exact import mean, mean_over, ratio
from floorlens.operators import tiers
from floorlens.operators.ranks import Ranking, with_global_ranks
from floorlens.operators.views import machine_daily, machine_health
from floorlens.sources.bind import Floor

HOURS_PER_YEAR = 8760


def total(name: str, alias: str | None = None):
    return F.sum(name).alias(alias or name)


def hold():
    return ratio(F.sum("net_gaming_revenue"), F.sum("total_wager")).alias("actual_hold_pct")


def machine_totals(floor: Floor, keys: list[str]) -> DataFrame:
    """Daily rows summed to the given grain."""
    return machine_daily(floor).groupBy(*keys).agg(
        total("transaction_count", "total_transactions"),
        total("session_count", "total_sessions"),
        total("unique_player_count", "total_unique_players"),
        total("total_wager"),
        total("total_payout"),
        total("jackpot_amount", "total_jackpot_amount"),
        total("net_gaming_revenue"),
        hold(),
        total("downtime_minutes", "total_downtime_minutes"),
        total("event_count", "total_events"),
        total("critical_event_count", "critical_events"),
        mean("availability_pct", 4).alias("average_availability_pct"),
        F.countDistinct("machine_id").alias("machine_count"),
    )


_MACHINE = ["machine_id", "manufacturer", "game_title", "game_category", "software_version"]


def machine_revenue_summary(floor: Floor) -> DataFrame:
    return (
        machine_totals(floor, _MACHINE).drop("machine_count").orderBy(F.desc("net_gaming_revenue"), "machine_id")
    )


def _extremes(floor: Floor, best: bool, n: int) -> DataFrame:
    by = F.desc("net_gaming_revenue") if best else F.asc("net_gaming_revenue")
    return (
        machine_totals(floor, _MACHINE[:4])
        .select(
            *_MACHINE[:4], "total_wager", "net_gaming_revenue", "actual_hold_pct", "total_sessions",
            F.col("total_downtime_minutes").alias("downtime_minutes"),
        )
        .orderBy(by, "machine_id")
        .limit(n)
    )


def top_machines(floor: Floor, n: int = 10) -> DataFrame:
    return _extremes(floor, True, n)


def bottom_machines(floor: Floor, n: int = 10) -> DataFrame:
    return _extremes(floor, False, n)


def machine_ranking(floor: Floor) -> DataFrame:
    base = machine_totals(floor, _MACHINE[:3]).select(
        *_MACHINE[:3], "net_gaming_revenue", "total_wager", "total_sessions"
    )
    ranked = with_global_ranks(
        base,
        [
            Ranking("net_gaming_revenue", {"revenue_rank": "rank", "performance_quartile": "ntile:4"}, True),
            Ranking("total_sessions", {"session_rank": "dense_rank"}, True),
        ],
        ["machine_id"],
    )
    return ranked.orderBy("revenue_rank", "machine_id")


def by_manufacturer(floor: Floor) -> DataFrame:
    return (
        machine_totals(floor, ["manufacturer"])
        .select(
            "manufacturer", "machine_count", "total_transactions", "total_sessions", "total_wager",
            "net_gaming_revenue", "actual_hold_pct",
            ratio("net_gaming_revenue", "machine_count", 2).alias("revenue_per_machine"),
            "total_downtime_minutes",
        )
        .orderBy(F.desc("net_gaming_revenue"), "manufacturer")
    )


def by_game_category(floor: Floor) -> DataFrame:
    return (
        machine_totals(floor, ["game_category"])
        .select(
            "game_category", "machine_count", "total_sessions",
            F.col("total_unique_players").alias("unique_players"), "total_wager", "total_payout",
            "net_gaming_revenue", "actual_hold_pct",
            ratio("net_gaming_revenue", "total_sessions", 2).alias("revenue_per_session"),
        )
        .orderBy(F.desc("net_gaming_revenue"), "game_category")
    )


def highest_downtime(floor: Floor, n: int = 10) -> DataFrame:
    return (
        machine_health(floor)
        .select(
            "machine_id", "location_name", "manufacturer", "game_title", "software_version",
            "total_event_count", "unplanned_event_count", "critical_event_count", "total_downtime_minutes",
            "average_downtime_minutes", "investigation_count", "annual_availability_pct",
        )
        .orderBy(F.desc("total_downtime_minutes"), "machine_id")
        .limit(n)
    )


def lowest_availability(floor: Floor, n: int = 10) -> DataFrame:
    return (
        machine_health(floor)
        .select(
            "machine_id", "location_name", "manufacturer", "game_title", "software_version",
            "total_downtime_minutes", "critical_event_count", "annual_availability_pct",
        )
        .orderBy("annual_availability_pct", F.desc("total_downtime_minutes"), "machine_id")
        .limit(n)
    )


def revenue_per_available_hour(floor: Floor) -> DataFrame:
    """Net revenue over the hours of one year that were not lost to downtime."""
    revenue = machine_totals(floor, ["machine_id"]).select(
        "machine_id", F.col("total_sessions").alias("session_count"), "total_wager", "net_gaming_revenue"
    )
    up_minutes = F.lit(HOURS_PER_YEAR * 60) - F.col("total_downtime_minutes")
    return (
        revenue.join(machine_health(floor), "machine_id")
        .select(
            "machine_id", "location_name", "manufacturer", "game_title", "session_count", "total_wager",
            "net_gaming_revenue", "total_downtime_minutes", "critical_event_count", "annual_availability_pct",
            ratio(F.col("net_gaming_revenue") * 60, up_minutes, 2).alias("revenue_per_available_hour"),
        )
        .orderBy(F.desc("revenue_per_available_hour"), "machine_id")
    )


def daily_trend(floor: Floor) -> DataFrame:
    return (
        machine_totals(floor, ["activity_date"])
        .select(
            "activity_date", "total_wager", "total_payout", "net_gaming_revenue", "total_sessions",
            "total_downtime_minutes", "actual_hold_pct",
        )
        .orderBy("activity_date")
    )


def _daily_revenue(floor: Floor) -> DataFrame:
    """One row per calendar day: small enough for windows over the whole calendar."""
    return machine_daily(floor).groupBy("activity_date").agg(total("net_gaming_revenue", "daily_revenue"))


def seven_day_average(floor: Floor) -> DataFrame:
    days = Window.orderBy("activity_date")
    return (
        _daily_revenue(floor)
        .select(
            "activity_date", "daily_revenue",
            mean_over("daily_revenue", days.rowsBetween(-6, 0)).alias("seven_day_moving_average"),
            F.sum("daily_revenue").over(days.rowsBetween(Window.unboundedPreceding, 0)).alias("cumulative_revenue"),
        )
        .orderBy("activity_date")
    )


def day_over_day(floor: Floor) -> DataFrame:
    previous = F.lag("daily_revenue").over(Window.orderBy("activity_date"))
    change = F.col("daily_revenue") - F.col("previous_day_revenue")
    return (
        _daily_revenue(floor)
        .withColumn("previous_day_revenue", previous)
        .withColumn("revenue_change", change)
        .withColumn("revenue_change_pct", ratio(change, "previous_day_revenue"))
        .orderBy("activity_date")
    )


def by_software_version(floor: Floor) -> DataFrame:
    return (
        machine_totals(floor, ["software_version"])
        .select(
            "software_version", "machine_count", "total_sessions", "total_wager", "net_gaming_revenue",
            "total_events", "critical_events", F.col("total_downtime_minutes").alias("downtime_minutes"),
            "actual_hold_pct", "average_availability_pct",
        )
        .orderBy(F.desc("net_gaming_revenue"), "software_version")
    )


def investigation_list(floor: Floor) -> DataFrame:
    labels = ["High Risk", "Medium Risk", "Low Risk"]
    return (
        machine_health(floor)
        .where("investigation_count > 0")
        .select(
            "machine_id", "location_name", "manufacturer", "game_title", "software_version",
            "total_event_count", "unplanned_event_count", "critical_event_count", "investigation_count",
            "total_downtime_minutes", "annual_availability_pct",
            tiers.health_risk(tuple(labels)).alias("machine_risk_level"),
        )
        .orderBy(
            tiers.position(F.col("machine_risk_level"), labels), F.desc("total_downtime_minutes"), "machine_id"
        )
    )


def best_and_worst(df: DataFrame, group: str, member: str, value: str, keep: list[str], labels: dict) -> DataFrame:
    """First and last member of each group by ``value``, as aggregates: no group is gathered.

    A group with one member yields only the best row, as does a tie of both places.
    """
    cols = [F.col(c) for c in keep]
    best = F.min(F.struct((-F.col(value)).alias("_v"), F.col(member), F.col(value), *cols)).alias("best")
    worst = F.min(F.struct(F.col(value).alias("_v"), F.col(member), F.col(value), *cols)).alias("worst")
    ends = df.groupBy(group).agg(best, worst)
    fields = [member, value, *keep]
    as_row = lambda side, label: F.struct(*[F.col(f"{side}.{f}").alias(f) for f in fields], F.lit(label).alias(labels["as"]))
    rows = F.array(as_row("best", labels["best"]), as_row("worst", labels["worst"]))
    lone = F.col(f"best.{member}") == F.col(f"worst.{member}")
    return ends.select(group, F.explode(F.when(lone, F.slice(rows, 1, 1)).otherwise(rows)).alias("r")).select(
        group, "r.*"
    )


def best_worst_machine_per_location(floor: Floor) -> DataFrame:
    revenue = machine_daily(floor).groupBy("location_id", "machine_id").agg(total("net_gaming_revenue"))
    labels = {"best": "Best Machine", "worst": "Worst Machine", "as": "performance_label"}
    return (
        best_and_worst(revenue, "location_id", "machine_id", "net_gaming_revenue", [], labels)
        .join(floor.location.select("location_id", "location_name"), "location_id")
        .select("location_id", "location_name", "machine_id", "net_gaming_revenue", "performance_label")
        .orderBy("location_id", "performance_label")
    )
