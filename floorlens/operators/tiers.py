"""Business labels. Cut points are arguments; defaults are the published ones."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Labels and cut points that results must carry exactly.
HEALTH_HIGH = (8, 5000)  # critical events, downtime minutes
HEALTH_MEDIUM = (4, 3500)
CHURN_DAYS = (90, 60, 30)
PRODUCTIVITY = (7000, 6000)
PROBABILITY_CUTS = (0.30, 0.60, 0.80)
PROBABILITY_TIERS = ("Low", "Medium", "High", "Critical")


def ladder(value: Column, steps: list[tuple[object, str]], otherwise: str) -> Column:
    """Label of the first lower bound the value reaches; steps run from high to low."""
    label = None
    for bound, name in steps:
        reached = value >= F.lit(bound)
        label = F.when(reached, name) if label is None else label.when(reached, name)
    return label.otherwise(otherwise)


def position(label: Column, order: list[str]) -> Column:
    """1-based place of the label in ``order``; unknown labels come last."""
    place = F.array_position(F.array(*[F.lit(x) for x in order]), label)
    return F.when(place > 0, place).otherwise(len(order) + 1)


def health_risk(labels=("High Risk", "Medium Risk", "Low Risk"), high=HEALTH_HIGH, medium=HEALTH_MEDIUM) -> Column:
    critical, downtime = F.col("critical_event_count"), F.col("total_downtime_minutes")
    return (
        F.when((critical >= high[0]) | (downtime >= high[1]), labels[0])
        .when((critical >= medium[0]) | (downtime >= medium[1]), labels[1])
        .otherwise(labels[2])
    )


def inactivity(labels: tuple[str, str, str], days=CHURN_DAYS) -> Column:
    """Never Activated / three inactivity labels / Active."""
    return F.when(F.col("session_count") == 0, "Never Activated").otherwise(
        ladder(F.col("days_since_last_session"), list(zip(days, labels)), "Active")
    )


def churn_risk() -> Column:
    return inactivity(("High Churn Risk", "Medium Churn Risk", "Low Churn Risk"))


def value_segment() -> Column:
    revenue, frequency = F.col("revenue_bucket"), F.col("frequency_bucket")
    return (
        F.when((revenue == 1) & (frequency == 1), "VIP")
        .when((revenue <= 2) & (frequency <= 2), "High Value")
        .when(revenue <= 3, "Medium Value")
        .otherwise("Low Value")
    )


def rfm_segment() -> Column:
    """Scores count from 1 = most recent, most frequent, highest spend; first match wins."""
    r, f, m = F.col("recency_score"), F.col("frequency_score"), F.col("monetary_score")
    return (
        F.when((r >= 4) & (f >= 4) & (m >= 4), "Champions")
        .when((r >= 3) & (f >= 4), "Loyal Players")
        .when((r >= 4) & f.between(2, 3), "Potential Loyalists")
        .when((r <= 2) & (f >= 3), "At Risk")
        .when((r == 1) & (f <= 2), "Lost Players")
        .otherwise("Regular Players")
    )


def probability_tier(probability: Column, cuts=PROBABILITY_CUTS, tiers=PROBABILITY_TIERS) -> Column:
    """Right-closed bands: a probability equal to a cut belongs to the band below it."""
    label = F.when(probability <= cuts[0], tiers[0])
    for cut, tier in zip(cuts[1:], tiers[1:]):
        label = label.when(probability <= cut, tier)
    return F.when(probability.isNotNull(), label.otherwise(tiers[-1]))


def probability_action(probability: Column, actions: list[str], cuts=PROBABILITY_CUTS) -> Column:
    """Left-closed counterpart of the tiers: an equal probability takes the stronger action."""
    return ladder(probability, list(zip(reversed(cuts), actions)), actions[-1])
