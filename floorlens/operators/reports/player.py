"""Player intelligence."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from floorlens.functions.calendar import daypart, is_weekend, month_start, months_between_starts
from floorlens.functions.exact import count_if, mean, percent, ratio
from floorlens.operators import tiers
from floorlens.operators.ranks import Ranking, with_global_ranks
from floorlens.operators.views import player_summary
from floorlens.sources.bind import Floor


def active_players(floor: Floor) -> DataFrame:
    return player_summary(floor).where("session_count > 0")


def kpis(floor: Floor) -> DataFrame:
    opted = count_if(F.col("marketing_opt_in") == 1)
    return player_summary(floor).agg(
        F.count("*").alias("total_registered_players"),
        count_if(F.col("session_count") > 0).alias("players_with_activity"),
        count_if(F.col("session_count") == 0).alias("players_without_activity"),
        count_if(F.col("loyalty_tier") == "Platinum").alias("platinum_players"),
        opted.alias("marketing_opt_in_players"),
        percent(opted, F.count("*")).alias("marketing_opt_in_pct"),
        mean("session_count").alias("average_sessions_per_player"),
        mean("total_wager").alias("average_wager_per_player"),
        mean("player_net_revenue").alias("average_revenue_per_player"),
    )


def by_loyalty_tier(floor: Floor) -> DataFrame:
    return (
        player_summary(floor)
        .groupBy("loyalty_tier")
        .agg(
            F.count("*").alias("registered_player_count"),
            count_if(F.col("session_count") > 0).alias("active_player_count"),
            F.sum("session_count").alias("total_sessions"),
            F.sum("total_wager").alias("total_wager"),
            F.sum("total_payout").alias("total_payout"),
            F.sum("player_net_revenue").alias("player_net_revenue"),
            ratio(F.sum("player_net_revenue"), F.sum("session_count"), 2).alias("revenue_per_session"),
            ratio(F.sum("total_wager"), F.count("*"), 2).alias("wager_per_registered_player"),
        )
        .orderBy(F.desc("player_net_revenue"), "loyalty_tier")
    )


def top_by_revenue(floor: Floor, n: int = 20) -> DataFrame:
    return (
        active_players(floor)
        .select(
            "player_id", "loyalty_tier", "home_region", "session_count", "locations_visited", "machines_played",
            "total_wager", "total_payout", "player_net_revenue", "average_session_minutes",
            "average_wager_per_session", "days_since_last_session",
        )
        .orderBy(F.desc("player_net_revenue"), "player_id")
        .limit(n)
    )


def top_by_wager(floor: Floor, n: int = 20) -> DataFrame:
    return (
        active_players(floor)
        .select(
            "player_id", "loyalty_tier", "session_count", "total_rounds", "total_wager",
            "average_wager_per_session", "player_net_revenue",
            ratio("player_net_revenue", "total_wager").alias("player_hold_pct"),
        )
        .orderBy(F.desc("total_wager"), "player_id")
        .limit(n)
    )


def ranking(floor: Floor) -> DataFrame:
    base = active_players(floor).select(
        "player_id", "loyalty_tier", "session_count", "total_wager", "player_net_revenue", "average_session_minutes"
    )
    ranked = with_global_ranks(
        base,
        [
            Ranking("player_net_revenue", {"revenue_rank": "rank", "revenue_quartile": "ntile:4"}, True),
            Ranking("session_count", {"frequency_rank": "dense_rank"}, True),
            Ranking("total_wager", {"wagering_quartile": "ntile:4"}, True),
        ],
        ["player_id"],
    )
    return ranked.orderBy("revenue_rank", "player_id")


def value_segments(floor: Floor) -> DataFrame:
    base = active_players(floor).select(
        "player_id", "loyalty_tier", "session_count", "total_wager", "player_net_revenue",
        "average_wager_per_session", "days_since_last_session",
    )
    scored = with_global_ranks(
        base,
        [
            Ranking("player_net_revenue", {"revenue_bucket": "ntile:5"}, True),
            Ranking("session_count", {"frequency_bucket": "ntile:5"}, True),
        ],
        ["player_id"],
    )
    return scored.withColumn("player_value_segment", tiers.value_segment()).drop(
        "revenue_bucket", "frequency_bucket"
    )


def value_segmentation(floor: Floor) -> DataFrame:
    return value_segments(floor).orderBy(F.desc("player_net_revenue"), "player_id")


def _rfm_scores(base: DataFrame, recency: str, frequency: str, monetary: str) -> DataFrame:
    return with_global_ranks(
        base,
        [
            Ranking(recency, {"recency_score": "ntile:5"}),
            Ranking(frequency, {"frequency_score": "ntile:5"}, True),
            Ranking(monetary, {"monetary_score": "ntile:5"}, True),
        ],
        ["player_id"],
    )


def rfm(floor: Floor) -> DataFrame:
    base = active_players(floor).select(
        "player_id", "loyalty_tier", F.col("days_since_last_session").alias("recency_days"),
        F.col("session_count").alias("frequency"), F.col("player_net_revenue").alias("monetary_value"),
    )
    return (
        _rfm_scores(base, "recency_days", "frequency", "monetary_value")
        .withColumn("rfm_code", F.concat("recency_score", "frequency_score", "monetary_score"))
        .withColumn("rfm_segment", tiers.rfm_segment())
        .orderBy(F.desc("monetary_value"), "player_id")
    )


_CHURN_ORDER = ["Never Activated", "High Churn Risk", "Medium Churn Risk", "Low Churn Risk", "Active"]


def churn_tiers(floor: Floor) -> DataFrame:
    return (
        player_summary(floor)
        .select(
            "player_id", "loyalty_tier", "session_count", "total_wager", "player_net_revenue",
            "latest_session_date", "days_since_last_session", tiers.churn_risk().alias("churn_risk_level"),
        )
        .orderBy(
            tiers.position(F.col("churn_risk_level"), _CHURN_ORDER), F.desc("days_since_last_session"), "player_id"
        )
    )


def share_of_all(count: str) -> Column:
    """Share of a column's total; only for frames already aggregated to a handful of rows."""
    return percent(count, F.sum(count).over(Window.partitionBy()))


def churn_summary(floor: Floor) -> DataFrame:
    return (
        player_summary(floor)
        .groupBy(tiers.churn_risk().alias("churn_risk_level"))
        .agg(F.count("*").alias("player_count"), F.sum("player_net_revenue").alias("associated_revenue"))
        .withColumn("player_pct", share_of_all("player_count"))
        .orderBy(F.desc("player_count"), "churn_risk_level")
    )


def _span_days() -> Column:
    return F.datediff("latest_session_date", "first_session_date")


def session_frequency(floor: Floor) -> DataFrame:
    return (
        active_players(floor)
        .select(
            "player_id", "loyalty_tier", "session_count", "first_session_date", "latest_session_date",
            _span_days().alias("active_span_days"),
            ratio("session_count", _span_days() + 1).alias("sessions_per_active_day"),
            "days_since_last_session",
        )
        .orderBy(F.desc("session_count"), "player_id")
    )


def mobility(floor: Floor) -> DataFrame:
    steps = [(5, "Highly Mobile"), (3, "Multi-Location"), (2, "Dual-Location")]
    return (
        active_players(floor)
        .select(
            "player_id", "loyalty_tier", "session_count", "locations_visited", "machines_played", "total_wager",
            "player_net_revenue",
            tiers.ladder(F.col("locations_visited"), steps, "Single-Location").alias("mobility_segment"),
        )
        .orderBy(F.desc("locations_visited"), F.desc("player_net_revenue"), "player_id")
    )


def _favourite(activity: DataFrame, item: str) -> DataFrame:
    """Most visited item per player. Spark trims each map task to one row per player before shuffling."""
    order = Window.partitionBy("player_id").orderBy(F.desc("session_count"), F.desc("total_wager"), item)
    return activity.withColumn("_place", F.row_number().over(order)).where("_place = 1").drop("_place")


def preferred_location(floor: Floor) -> DataFrame:
    activity = floor.session.groupBy("player_id", "location_id").agg(
        F.count("*").alias("session_count"),
        F.sum("total_wager").alias("total_wager"),
        F.sum("net_gaming_revenue").alias("player_net_revenue"),
    )
    known = activity.join(floor.location.select("location_id", "location_name"), "location_id")
    return (
        _favourite(known, "location_id")
        .select("player_id", "location_id", "location_name", "session_count", "total_wager", "player_net_revenue")
        .orderBy("player_id")
    )


def preferred_machine(floor: Floor) -> DataFrame:
    activity = floor.session.groupBy("player_id", "machine_id").agg(
        F.count("*").alias("session_count"), F.sum("total_wager").alias("total_wager")
    )
    games = floor.machine.select("machine_id", "game_title", "game_category", "manufacturer")
    return (
        _favourite(activity.join(games, "machine_id"), "machine_id")
        .select(
            "player_id", "machine_id", "game_title", "game_category", "manufacturer", "session_count", "total_wager"
        )
        .orderBy("player_id")
    )


def _session_mix(floor: Floor, label: Column) -> DataFrame:
    return floor.session.groupBy(label).agg(
        F.countDistinct("player_id").alias("unique_players"),
        F.count("*").alias("session_count"),
        F.sum("total_wager").alias("total_wager"),
        F.sum("net_gaming_revenue").alias("net_gaming_revenue"),
        mean("session_duration_minutes").alias("average_session_minutes"),
    )


def weekend_vs_weekday(floor: Floor) -> DataFrame:
    label = F.when(is_weekend("session_start"), "Weekend").otherwise("Weekday")
    return _session_mix(floor, label.alias("day_type"))


def time_of_day(floor: Floor) -> DataFrame:
    mix = _session_mix(floor, daypart("session_start").alias("time_of_day"))
    return mix.orderBy(F.desc("session_count"), "time_of_day")


def monthly_activity(floor: Floor) -> DataFrame:
    monthly = floor.session.groupBy(month_start("session_start").alias("activity_month")).agg(
        F.countDistinct("player_id").alias("active_players"),
        F.count("*").alias("total_sessions"),
        F.sum("total_wager").alias("total_wager"),
        F.sum("net_gaming_revenue").alias("net_gaming_revenue"),
    )
    months = Window.orderBy("activity_month")
    return (
        monthly.withColumn("previous_month_players", F.lag("active_players").over(months))
        .withColumn("player_change", F.col("active_players") - F.col("previous_month_players"))
        .withColumn("previous_month_revenue", F.lag("net_gaming_revenue").over(months))
        .withColumn("revenue_change", F.col("net_gaming_revenue") - F.col("previous_month_revenue"))
        .orderBy("activity_month")
    )


def cohort_retention(floor: Floor) -> DataFrame:
    """Months are gathered per player as a set, at most one entry per calendar month, so one
    shuffle gives both the cohort and the distinct player-months."""
    month = month_start("session_start")
    activity = (
        floor.session.groupBy("player_id")
        .agg(F.min(month).alias("cohort_month"), F.collect_set(month).alias("months"))
        .select("cohort_month", F.explode("months").alias("month"))
        .groupBy("cohort_month", months_between_starts(F.col("cohort_month"), F.col("month")).alias("cohort_index"))
        .agg(F.count("*").alias("active_players"))
    )
    start = Window.partitionBy("cohort_month")
    size = F.max(F.when(F.col("cohort_index") == 0, F.col("active_players"))).over(start)
    return (
        activity.withColumn("cohort_player_count", size)
        .withColumn("retention_pct", percent("active_players", "cohort_player_count"))
        .orderBy("cohort_month", "cohort_index")
    )


def lifetime_value(floor: Floor) -> DataFrame:
    """The daily rate is rounded before it is projected to one and three years."""
    rate = F.col("daily_revenue_rate")
    return (
        active_players(floor)
        .withColumn("observed_lifetime_days", _span_days() + 1)
        .withColumn("daily_revenue_rate", ratio("player_net_revenue", "observed_lifetime_days"))
        .select(
            "player_id", "loyalty_tier", "session_count", "player_net_revenue", "observed_lifetime_days",
            "daily_revenue_rate",
            (rate * 365).cast("decimal(18,2)").alias("estimated_annual_value"),
            (rate * 1095).cast("decimal(18,2)").alias("estimated_three_year_ltv"),
        )
        .orderBy(F.desc("estimated_three_year_ltv"), "player_id")
    )


def opt_in_comparison(floor: Floor) -> DataFrame:
    status = F.when(F.col("marketing_opt_in") == 1, "Opted In").otherwise("Not Opted In")
    return (
        player_summary(floor)
        .groupBy(status.alias("marketing_status"))
        .agg(
            F.count("*").alias("player_count"),
            F.sum("session_count").alias("session_count"),
            F.sum("total_wager").alias("total_wager"),
            F.sum("player_net_revenue").alias("player_net_revenue"),
            ratio(F.sum("player_net_revenue"), F.count("*"), 2).alias("revenue_per_player"),
            ratio(F.sum("session_count"), F.count("*"), 2).alias("sessions_per_player"),
        )
    )


def rfm_export(floor: Floor) -> DataFrame:
    base = active_players(floor).select(
        "player_id", "loyalty_tier", "age_band", "home_region", "marketing_opt_in", "session_count",
        "locations_visited", "machines_played", "total_session_minutes", "total_rounds", "total_wager",
        "total_payout", "player_net_revenue", "average_session_minutes", "average_wager_per_session",
        "days_since_last_session",
    )
    scored = _rfm_scores(base, "days_since_last_session", "session_count", "player_net_revenue")
    return (
        scored.withColumn(
            "total_rfm_score", F.col("recency_score") + F.col("frequency_score") + F.col("monetary_score")
        )
        .withColumn("rfm_segment", tiers.rfm_segment())
        .withColumn("churn_flag", F.when(F.col("days_since_last_session") >= tiers.CHURN_DAYS[0], 1).otherwise(0))
    )
