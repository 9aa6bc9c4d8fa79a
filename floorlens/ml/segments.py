"""Names, strategies and values of player clusters."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from floorlens.functions.exact import near

# Segment names in order of assignment, and what to do about each.
NAMED = ["VIP High Value", "At-Risk Players", "Loyal Regulars", "Casual Players"]
SPARE = ["Emerging High Value", "Multi-Location Explorers", "Moderate Engagement", "Dormant Low Value"]
ACTIONS = {
    "VIP High Value": (
        "Protect high-value relationships",
        "Offer exclusive rewards, VIP support, and personalized premium promotions",
    ),
    "Loyal Regulars": (
        "Increase wallet share and loyalty",
        "Provide frequency-based rewards and cross-location loyalty incentives",
    ),
    "At-Risk Players": (
        "Reduce churn and reactivate engagement",
        "Launch targeted retention outreach and time-sensitive return offers",
    ),
    "Casual Players": (
        "Increase visit frequency",
        "Use low-cost promotional offers and beginner-friendly engagement campaigns",
    ),
    "Emerging High Value": (
        "Accelerate movement toward VIP status",
        "Offer tier-up incentives and personalized high-value promotions",
    ),
    "Multi-Location Explorers": (
        "Strengthen cross-location loyalty",
        "Recommend nearby locations and portable loyalty rewards",
    ),
    "Moderate Engagement": (
        "Increase engagement consistency",
        "Use personalized reminders and recurring visit incentives",
    ),
    "Dormant Low Value": (
        "Evaluate economical reactivation",
        "Use low-cost automated win-back messaging",
    ),
}
OTHER_ACTION = ("Monitor player behavior", "Apply segment-specific engagement strategy")


def cluster_profiles(players: DataFrame) -> DataFrame:
    """Average behaviour per ``cluster_id``; at most a handful of rows from here on."""
    means = {
        "average_sessions": "session_count", "average_locations_visited": "locations_visited",
        "average_machines_played": "machines_played", "average_session_minutes": "average_session_minutes",
        "average_wager_per_session": "average_wager_per_session", "average_total_wager": "total_wager",
        "average_player_revenue": "player_net_revenue",
        "average_days_since_last_session": "days_since_last_session",
    }
    profiles = players.groupBy("cluster_id").agg(
        F.count("player_id").alias("player_count"),
        *[F.avg(F.col(column).cast("double")).alias(name) for name, column in means.items()],
        F.sum("player_net_revenue").cast("double").alias("total_segment_revenue"),
    )
    everyone = Window.partitionBy()
    share = lambda c: F.col(c) / F.nullif(F.sum(c).over(everyone).cast("double"), F.lit(0.0)) * 100
    return profiles.withColumn("player_distribution_pct", share("player_count")).withColumn(
        "revenue_contribution_pct", share("total_segment_revenue")
    )


def cluster_scores(profiles: DataFrame) -> DataFrame:
    """Dense ranks, 1 = highest, and scores counted from the other end."""
    ranks = {
        "value_rank": "average_player_revenue", "wager_rank": "average_total_wager",
        "engagement_rank": "average_sessions", "recency_risk_rank": "average_days_since_last_session",
    }
    out = profiles.withColumns(
        {name: F.dense_rank().over(Window.orderBy(F.desc(column))) for name, column in ranks.items()}
    )
    clusters = F.count("*").over(Window.partitionBy())
    scores = {"value_score": "value_rank", "engagement_score": "engagement_rank", "risk_score": "recency_risk_rank"}
    return out.withColumns({name: clusters - F.col(rank) + 1 for name, rank in scores.items()})


def segment_names(profiles: DataFrame) -> dict[int, str]:
    """Give each cluster a name: one extreme after the other takes its name, the rest spare names."""
    left = {r["cluster_id"]: r for r in profiles.orderBy("cluster_id").collect()}  # one row per cluster
    if not left:
        raise ValueError("there are no clusters to name")
    choosers = [
        lambda r: (r.average_player_revenue, r.average_total_wager, r.average_sessions),
        lambda r: (r.average_days_since_last_session, -r.average_sessions),
        lambda r: (r.average_sessions, -r.average_days_since_last_session),
        lambda r: (-r.average_sessions, -r.average_total_wager),
    ]
    names: dict[int, str] = {}
    for name, key in zip(NAMED, choosers):
        if left:
            chosen = max(left, key=lambda c: key(left[c]))
            names[chosen] = name
            del left[chosen]
    for place, cluster in enumerate(sorted(left)):
        names[cluster] = SPARE[place] if place < len(SPARE) else f"Player Segment {cluster + 1}"
    return names


def _with_names(df: DataFrame, names: dict[int, str]) -> DataFrame:
    rows = [(c, n, *ACTIONS.get(n, OTHER_ACTION)) for c, n in names.items()]
    table = df.sparkSession.createDataFrame(
        rows, "cluster_id int, player_segment string, segment_strategy string, recommended_action string"
    )
    return df.join(F.broadcast(table), "cluster_id", "left")  # one row per cluster


def player_output(players: DataFrame, names: dict[int, str]) -> DataFrame:
    busiest = players.agg(F.max("session_count").alias("_most_sessions"))
    weight = F.lit(1.0) + F.col("session_count") / F.col("_most_sessions")
    value = near(F.greatest(F.col("player_net_revenue").cast("double"), F.lit(0.0)) * weight)
    return (
        _with_names(players, names)
        .crossJoin(F.broadcast(busiest))
        .withColumn("estimated_player_value", value)
        .drop("_most_sessions")
        .orderBy("player_segment", F.desc("estimated_player_value"), "player_id")
    )


def segment_profiles(scored: DataFrame, names: dict[int, str]) -> DataFrame:
    return _with_names(scored, names).orderBy(F.desc("average_player_revenue"), "cluster_id")
