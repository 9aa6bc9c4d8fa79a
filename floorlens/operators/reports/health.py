"""Machine health and reliability."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from floorlens.functions.calendar import minute_index
from floorlens.functions.exact import count_if, mean, mean_over, percent, ratio, zero_if_null
from floorlens.operators import tiers
from floorlens.operators.ranks import Ranking, with_global_ranks
from floorlens.operators.views import machine_daily, machine_health
from floorlens.sources.bind import Floor

_NAMES = ["machine_id", "location_name", "manufacturer", "game_title", "software_version"]


def unplanned(floor: Floor) -> DataFrame:
    return floor.event.where("planned_event_flag = 0")


def fleet_summary(floor: Floor) -> DataFrame:
    return machine_health(floor).agg(
        F.count("*").alias("total_machines"),
        F.sum("total_event_count").alias("total_events"),
        F.sum("unplanned_event_count").alias("total_unplanned_events"),
        F.sum("critical_event_count").alias("total_critical_events"),
        F.sum("total_downtime_minutes").alias("total_downtime_minutes"),
        mean("total_downtime_minutes").alias("average_downtime_per_machine"),
        mean("annual_availability_pct", 4).alias("average_availability_pct"),
        F.sum("investigation_count").alias("total_investigations"),
    )


def ranking(floor: Floor) -> DataFrame:
    base = machine_health(floor).select(
        *_NAMES, "total_event_count", "unplanned_event_count", "critical_event_count", "total_downtime_minutes",
        "average_downtime_minutes", "investigation_count", "annual_availability_pct",
    )
    ranked = with_global_ranks(
        base,
        [
            Ranking("total_downtime_minutes", {"downtime_rank": "rank"}, True),
            Ranking("critical_event_count", {"critical_event_rank": "dense_rank"}, True),
            Ranking("annual_availability_pct", {"health_risk_quartile": "ntile:4"}),
        ],
        ["machine_id"],
    )
    return ranked.orderBy("downtime_rank", "machine_id")


def top_downtime(floor: Floor, n: int = 20) -> DataFrame:
    return (
        machine_health(floor)
        .select(
            "machine_id", "location_id", "location_name", "manufacturer", "game_title", "game_category",
            "software_version", "total_event_count", "unplanned_event_count", "critical_event_count",
            "total_downtime_minutes", "annual_availability_pct",
        )
        .orderBy(F.desc("total_downtime_minutes"), "machine_id")
        .limit(n)
    )


def top_critical(floor: Floor, n: int = 20) -> DataFrame:
    return (
        machine_health(floor)
        .where("critical_event_count > 0")
        .select(
            *_NAMES, "total_event_count", "critical_event_count", "investigation_count", "total_downtime_minutes",
            "annual_availability_pct",
        )
        .orderBy(F.desc("critical_event_count"), F.desc("total_downtime_minutes"), "machine_id")
        .limit(n)
    )


def event_distribution(floor: Floor) -> DataFrame:
    return (
        floor.event.groupBy("event_type", "severity")
        .agg(
            F.count("*").alias("event_count"),
            F.sum("downtime_minutes").alias("total_downtime_minutes"),
            mean("downtime_minutes").alias("average_downtime_minutes"),
            F.sum("requires_investigation").alias("investigation_count"),
        )
        .orderBy(F.desc("total_downtime_minutes"), "event_type", "severity")
    )


def root_causes(floor: Floor) -> DataFrame:
    everything = Window.partitionBy()  # one row per event type
    return (
        floor.event.groupBy("event_type")
        .agg(
            F.count("*").alias("event_count"),
            count_if(F.col("planned_event_flag") == 0).alias("unplanned_event_count"),
            count_if(F.col("severity") == "Critical").alias("critical_event_count"),
            F.sum("downtime_minutes").alias("total_downtime_minutes"),
        )
        .withColumn("event_share_pct", percent("event_count", F.sum("event_count").over(everything)))
        .withColumn(
            "downtime_share_pct",
            percent("total_downtime_minutes", F.sum("total_downtime_minutes").over(everything)),
        )
        .orderBy(F.desc("total_downtime_minutes"), "event_type")
    )


def mean_time_to_repair(floor: Floor) -> DataFrame:
    return (
        unplanned(floor)
        .where("downtime_minutes > 0")
        .groupBy("machine_id")
        .agg(
            F.count("*").alias("repair_event_count"),
            F.sum("downtime_minutes").alias("total_repair_minutes"),
            mean("downtime_minutes").alias("mttr_minutes"),
        )
        .orderBy(F.desc("mttr_minutes"), "machine_id")
    )


def mean_time_between_failures(floor: Floor) -> DataFrame:
    """Gaps between consecutive failures add up to last minus first, so no window is needed:
    the mean gap is that span over the number of gaps, however many events one machine has."""
    at = minute_index("event_timestamp")
    span, gaps = F.max(at) - F.min(at), F.count("*") - 1
    return (
        unplanned(floor)
        .groupBy("machine_id")
        .agg(
            gaps.alias("measured_failure_intervals"),
            ratio(span, gaps, 2).alias("mtbf_minutes"),
            ratio(span, gaps * 60, 2).alias("mtbf_hours"),
        )
        .where("measured_failure_intervals > 0")
        .orderBy("mtbf_minutes", "machine_id")
    )


def reliability(floor: Floor) -> DataFrame:
    repair = mean_time_to_repair(floor).select("machine_id", "mttr_minutes")
    between = mean_time_between_failures(floor).select("machine_id", "mtbf_minutes")
    up = ratio("mtbf_minutes", F.col("mtbf_minutes") + F.col("mttr_minutes"))
    return (
        machine_health(floor)
        .join(repair, "machine_id", "left")
        .join(between, "machine_id", "left")
        .select(
            *_NAMES, "total_event_count", "total_downtime_minutes", "mttr_minutes", "mtbf_minutes",
            up.alias("reliability_availability_ratio"),
        )
        .orderBy("reliability_availability_ratio", "machine_id")
    )


def _health_rollup(floor: Floor, key: str) -> DataFrame:
    return machine_health(floor).groupBy(key).agg(
        F.count("*").alias("machine_count"),
        F.sum("total_event_count").alias("total_events"),
        F.sum("unplanned_event_count").alias("unplanned_events"),
        F.sum("critical_event_count").alias("critical_events"),
        F.sum("total_downtime_minutes").alias("total_downtime_minutes"),
        ratio(F.sum("total_downtime_minutes"), F.count("*"), 2).alias("downtime_per_machine"),
        ratio(F.sum("total_event_count"), F.count("*"), 2).alias("events_per_machine"),
        mean("annual_availability_pct", 4).alias("average_availability_pct"),
    )


def by_manufacturer(floor: Floor) -> DataFrame:
    return _health_rollup(floor, "manufacturer").orderBy("average_availability_pct", "manufacturer")


def by_software_version(floor: Floor) -> DataFrame:
    return (
        _health_rollup(floor, "software_version")
        .drop("events_per_machine")
        .orderBy(F.desc("total_downtime_minutes"), "software_version")
    )


def daily_downtime(floor: Floor) -> DataFrame:
    days = Window.orderBy("event_date")  # one row per calendar day
    return (
        floor.event.groupBy("event_date")
        .agg(
            F.count("*").alias("event_count"),
            F.sum("downtime_minutes").alias("downtime_minutes"),
            count_if(F.col("severity") == "Critical").alias("critical_events"),
        )
        .withColumn("seven_day_downtime_moving_average", mean_over("downtime_minutes", days.rowsBetween(-6, 0)))
        .withColumn("previous_day_downtime", F.lag("downtime_minutes").over(days))
        .withColumn("downtime_change", F.col("downtime_minutes") - F.col("previous_day_downtime"))
        .orderBy("event_date")
    )


def repeat_failures(floor: Floor, minimum: int = 5) -> DataFrame:
    order = Window.partitionBy("machine_id").orderBy(
        F.desc("repeated_event_count"), F.desc("event_type_downtime"), "most_common_failure"
    )
    worst = (
        unplanned(floor)
        .groupBy("machine_id", F.col("event_type").alias("most_common_failure"))
        .agg(F.count("*").alias("repeated_event_count"), F.sum("downtime_minutes").alias("event_type_downtime"))
        .withColumn("_place", F.row_number().over(order))
        .where((F.col("_place") == 1) & (F.col("repeated_event_count") >= minimum))
    )
    return (
        worst.join(machine_health(floor), "machine_id")
        .select(
            "machine_id", "location_name", "manufacturer", "game_title", "most_common_failure",
            "repeated_event_count", "event_type_downtime", "total_event_count", "total_downtime_minutes",
        )
        .orderBy(F.desc("repeated_event_count"), F.desc("event_type_downtime"), "machine_id")
    )


def maintenance_priority(floor: Floor) -> DataFrame:
    base = machine_health(floor).select(
        *_NAMES, "total_event_count", "unplanned_event_count", "critical_event_count", "total_downtime_minutes",
        "annual_availability_pct",
    )
    scored = with_global_ranks(
        base,
        [
            Ranking("total_downtime_minutes", {"downtime_score": "ntile:5"}, True),
            Ranking("critical_event_count", {"critical_score": "ntile:5"}, True),
            Ranking("unplanned_event_count", {"failure_score": "ntile:5"}, True),
            Ranking("annual_availability_pct", {"availability_risk_score": "ntile:5"}),
        ],
        ["machine_id"],
    )
    parts = ["downtime_score", "critical_score", "failure_score", "availability_risk_score"]
    score = sum((F.col(p) for p in parts[1:]), F.col(parts[0]))
    steps = [(17, "Immediate Maintenance"), (13, "High Priority"), (9, "Medium Priority")]
    return (
        scored.withColumn("maintenance_priority_score", score)
        .withColumn(
            "maintenance_priority",
            tiers.ladder(F.col("maintenance_priority_score"), steps, "Routine Monitoring"),
        )
        .orderBy(F.desc("maintenance_priority_score"), F.desc("total_downtime_minutes"), "machine_id")
    )


def replacement_candidates(floor: Floor) -> DataFrame:
    revenue = machine_daily(floor).groupBy("machine_id").agg(
        F.sum("net_gaming_revenue").alias("net_gaming_revenue"), F.sum("session_count").alias("total_sessions")
    )
    base = (
        machine_health(floor)
        .join(revenue, "machine_id", "left")
        .withColumns({n: zero_if_null(n) for n in ("net_gaming_revenue", "total_sessions")})
        .select(
            *_NAMES, "total_sessions", "net_gaming_revenue", "total_event_count", "critical_event_count",
            "total_downtime_minutes", "annual_availability_pct",
        )
    )
    ranked = with_global_ranks(
        base,
        [
            Ranking("net_gaming_revenue", {"_revenue": "percent_rank"}),
            Ranking("total_downtime_minutes", {"_downtime": "percent_rank"}),
        ],
        ["machine_id"],
    )
    labels = ["Replacement Candidate", "Review for Replacement", "Retain"]
    revenue_at, downtime_at = F.col("_revenue"), F.col("_downtime")
    advice = (
        F.when((revenue_at <= 0.25) & (downtime_at >= 0.75), labels[0])
        .when((revenue_at <= 0.40) & (downtime_at >= 0.60), labels[1])
        .otherwise(labels[2])
    )
    return (
        ranked.withColumn("replacement_recommendation", advice)
        .drop("_revenue", "_downtime")
        .orderBy(
            tiers.position(F.col("replacement_recommendation"), labels), F.desc("total_downtime_minutes"),
            "machine_id",
        )
    )


def health_export(floor: Floor) -> DataFrame:
    """Health per machine with its latest event, found as a maximum so no machine's log is gathered."""
    latest = floor.event.groupBy("machine_id").agg(
        F.max(F.struct("event_timestamp", "event_id", "event_type", "severity")).alias("latest")
    )
    return (
        machine_health(floor)
        .join(latest, "machine_id", "left")
        .select(
            "machine_id", "location_id", "location_name", "manufacturer", "game_title", "game_category",
            "software_version", "machine_status", "total_event_count", "unplanned_event_count",
            "critical_event_count", "total_downtime_minutes", "average_downtime_minutes", "investigation_count",
            "annual_availability_pct",
            F.col("latest.event_timestamp").alias("latest_event_timestamp"),
            F.col("latest.event_type").alias("latest_event_type"),
            F.col("latest.severity").alias("latest_event_severity"),
            tiers.health_risk().alias("health_risk_level"),
            F.when(F.col("total_downtime_minutes") >= tiers.HEALTH_HIGH[1], 1)
            .otherwise(0)
            .alias("maintenance_required_flag"),
        )
    )
