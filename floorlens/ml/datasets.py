"""Model inputs: columns, checks before training, cleaning and chronological splits."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from floorlens.functions.exact import count_if
from floorlens.operators.quantiles import exact_quantile

# The columns each model may see.
CHURN_CATEGORICAL = ["loyalty_tier", "age_band", "home_region"]
CHURN_NUMERIC = [
    "marketing_opt_in", "registered_active_flag", "days_since_last_session", "observed_player_lifetime_days",
    "total_historical_sessions", "sessions_last_30_days", "sessions_last_90_days", "locations_visited",
    "machines_played", "total_session_minutes", "average_session_minutes", "total_rounds", "total_wager",
    "total_payout", "player_net_revenue", "average_wager_per_session", "wager_last_30_days",
    "wager_last_90_days", "revenue_last_30_days", "revenue_last_90_days", "sessions_per_observed_day",
]
FAILURE_CATEGORICAL = ["manufacturer", "cabinet_type", "game_category", "software_version", "machine_status"]
FAILURE_NUMERIC = [
    "theoretical_hold_pct", "machine_age_days", "total_historical_events", "unplanned_event_count",
    "critical_event_count", "high_severity_event_count", "total_downtime_minutes", "average_downtime_minutes",
    "days_since_last_event", "events_last_30_days", "downtime_last_30_days", "events_last_90_days",
    "downtime_last_90_days", "historical_session_count", "historical_unique_players", "historical_total_wager",
    "historical_net_revenue", "revenue_last_30_days", "sessions_last_30_days",
]
ANOMALY_NUMERIC = [
    "transaction_count", "session_count", "unique_player_count", "total_wager", "total_payout", "jackpot_amount",
    "net_gaming_revenue", "actual_hold_pct", "event_count", "downtime_minutes", "critical_event_count",
    "investigation_count", "active_minutes", "availability_pct", "revenue_per_active_hour", "revenue_z_score",
    "wager_z_score", "downtime_z_score",
]
SEGMENT_NUMERIC = [
    "session_count", "locations_visited", "machines_played", "total_session_minutes", "total_rounds", "total_wager",
    "player_net_revenue", "average_session_minutes", "average_wager_per_session", "days_since_last_session",
]
DAILY_CATEGORICAL = ["location_id", "region", "location_type", "day_of_week_name"]
DAILY_LAGS = [
    "revenue_lag_1_day", "revenue_lag_7_days", "revenue_lag_14_days", "previous_7_day_average_revenue",
    "previous_30_day_average_revenue", "previous_7_day_average_sessions",
]
DAILY_NUMERIC = [
    "activity_year", "activity_month", "activity_quarter", "day_of_week_number", "is_weekend", *DAILY_LAGS,
]
WEEKLY_CATEGORICAL = ["location_id", "region", "location_type"]
WEEKLY_LAGS = [
    "revenue_lag_1_week", "revenue_lag_2_weeks", "revenue_lag_4_weeks", "previous_4_week_average_revenue",
    "previous_8_week_average_revenue", "previous_4_week_average_sessions",
]
WEEKLY_NUMERIC = ["activity_year", "activity_quarter", "activity_month", "iso_week_number", *WEEKLY_LAGS]


@dataclass(frozen=True)
class Dataset:
    """What a training set must look like."""

    name: str
    key: list[str]
    features: list[str]
    target: str | None = None
    binary: bool = False
    minimum_rows: int = 0
    period: str | None = None
    minimum_periods: int = 0
    lags: list[str] = field(default_factory=list)


CHURN = Dataset("player churn", ["player_id"], CHURN_CATEGORICAL + CHURN_NUMERIC, "churn_flag", True)
FAILURE = Dataset(
    "machine failure", ["machine_id"], FAILURE_CATEGORICAL + FAILURE_NUMERIC, "failure_target_flag", True
)
ANOMALY = Dataset("machine anomaly", ["activity_date", "machine_id"], ANOMALY_NUMERIC, "rule_based_anomaly_flag")
SEGMENTS = Dataset("player segments", ["player_id"], SEGMENT_NUMERIC, minimum_rows=100)
DAILY = Dataset(
    "daily forecast", ["activity_date", "location_id"], DAILY_CATEGORICAL + DAILY_NUMERIC, "net_gaming_revenue",
    minimum_rows=100, period="activity_date", lags=DAILY_LAGS,
)
WEEKLY = Dataset(
    "weekly forecast", ["week_start_date", "location_id"], WEEKLY_CATEGORICAL + WEEKLY_NUMERIC,
    "net_gaming_revenue", minimum_rows=100, period="week_start_date", minimum_periods=10, lags=WEEKLY_LAGS,
)


def problems(df: DataFrame, spec: Dataset) -> DataFrame:
    """One row per check with the number of violations, found in one pass over the key groups."""
    rules: dict[str, Column] = {
        "key repeated": F.coalesce(F.sum(F.when(F.col("_rows") > 1, F.col("_rows") - 1)), F.lit(0)),
        "rows missing": F.greatest(F.lit(spec.minimum_rows) - F.coalesce(F.sum("_rows"), F.lit(0)), F.lit(0)),
    }
    aggregates = [F.count("*").alias("_rows")]
    if spec.target:
        aggregates.append(count_if(F.col(spec.target).isNull()).alias("_null"))
        rules["target null"] = F.coalesce(F.sum("_null"), F.lit(0))
    if spec.target and spec.target.endswith("_flag"):
        value = F.col(spec.target)
        aggregates += [count_if(value == c).alias(f"_is_{c}") for c in (0, 1)]
        rules["target not 0 or 1"] = F.coalesce(F.sum(F.col("_rows") - F.col("_null") - F.col("_is_0") - F.col("_is_1")), F.lit(0))
        if spec.binary:
            rules["class missing"] = sum(
                (F.when(F.coalesce(F.sum(f"_is_{c}"), F.lit(0)) == 0, 1).otherwise(0) for c in (0, 1)), F.lit(0)
            )
    grouped = df.groupBy(*spec.key).agg(*aggregates)
    counted = grouped.agg(*[c.cast("long").alias(n) for n, c in rules.items()])
    return counted.unpivot([], list(rules), "rule", "violations").orderBy("rule")


def validate(df: DataFrame, spec: Dataset) -> DataFrame:
    """Raise unless the frame can be trained on."""
    wanted = [*spec.key, *spec.features, *([spec.target] if spec.target else [])]
    missing = sorted(set(wanted) - set(df.columns))
    if missing:
        raise ValueError(f"{spec.name}: columns missing: {', '.join(missing)}")
    broken = [f"{r['rule']} ({r['violations']})" for r in problems(df, spec).collect() if r["violations"]]
    if broken:
        raise ValueError(f"{spec.name}: {'; '.join(broken)}")
    return df


def numeric(df: DataFrame, columns: list[str]) -> DataFrame:
    """Cast to DOUBLE; text that is no number, NaN and infinities become NULL."""

    def clean(name: str) -> Column:
        value = F.col(name).try_cast("double")
        usable = ~F.isnan(value) & (F.abs(value) != F.lit(float("inf")))
        return F.when(usable, value)

    return df.withColumns({c: clean(c) for c in columns})


def fill_medians(df: DataFrame, columns: list[str]) -> DataFrame:
    """Replace NULLs by the exact median of the column; columns without NULLs are left alone."""
    gaps = df.agg(*[count_if(F.col(c).isNull()).alias(c) for c in columns]).first()
    medians = {c: exact_quantile(df, c, 0.5) for c in columns if gaps[c]}
    return df.fillna({c: m for c, m in medians.items() if m is not None})


def forecast_rows(df: DataFrame, spec: Dataset) -> DataFrame:
    """Rows whose lags and target are all known."""
    return df.dropna(subset=[*spec.lags, spec.target])


def chronological_split(df: DataFrame, period: str, test_fraction: float = 0.20) -> DataFrame:
    """Add ``is_test``: the last share of the distinct periods, whole periods only.

    The cutoff comes from the distinct periods (at most one row per calendar day), as one row.
    """
    periods = df.select(period).distinct()
    place = F.row_number().over(Window.orderBy(period)) - 1
    size = F.count("*").over(Window.partitionBy())
    first_test = F.greatest(F.lit(1), F.least(F.floor(size * F.lit(1 - test_fraction)), size - 1))
    cutoff = (
        periods.select(F.col(period).alias("_cutoff"), place.alias("_place"), first_test.alias("_first"))
        .where("_place = _first")
        .select("_cutoff")
    )
    return (
        df.crossJoin(F.broadcast(cutoff))
        .withColumn("is_test", (F.col(period) >= F.col("_cutoff")).cast("int"))
        .drop("_cutoff")
    )
