"""Parameterised look-ups over views and scored outputs: filter, order, page."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from floorlens.functions.exact import count_if, ratio
from floorlens.operators import tiers
from floorlens.operators.reports.executive import daily_activity, kpi_summary
from floorlens.operators.views import machine_health
from floorlens.sources.bind import Floor

# Band edges, orders and limits the look-ups use.
PROBABILITY_BANDS = {"Low Risk": (0.0, 0.40), "Medium Risk": (0.40, 0.70), "High Risk": (0.70, 0.90),
                     "Critical Risk": (0.90, 1.01)}
SEVERITY_ORDER = ["Critical", "High", "Medium", "Low"]
SLA_WARNING_MINUTES = 30


# ---- paging ------------------------------------------------------------------------------------

def page_of(df: DataFrame, order: list[str], page: int = 1, page_size: int = 20, after: dict | None = None) -> DataFrame:
    """One page of an ordered result; Spark keeps only the first page * page_size rows per task.

    With ``after``, the last row of the page before as a dict (further keys are ignored), the page is the first behind that
    row: a task keeps page_size rows however deep the page lies. ``order`` is as for ``_by`` and ends with an id.
    """
    if page < 1 or page_size < 1:
        raise ValueError("page and page_size start at 1")
    if after is not None:
        return df.where(behind(df, order, after)).orderBy(*_by(*order)).limit(page_size)
    return df.orderBy(*_by(*order)).offset((page - 1) * page_size).limit(page_size)


def behind(df: DataFrame, order: list[str], row: dict) -> Column:
    """Whether a row comes after ``row`` in the order; nulls are lowest, as Spark sorts them."""
    found, tied = F.lit(False), F.lit(True)
    for name in order:
        key = name.removeprefix("+")
        value, own = F.lit(row[key]).cast(df.schema[key].dataType), F.col(key)
        if name.startswith("+"):
            later = own.isNotNull() if row[key] is None else F.coalesce(own > value, F.lit(False))
        else:
            later = F.lit(False) if row[key] is None else F.coalesce(own < value, F.lit(True))
        found, tied = found | (tied & later), tied & own.eqNullSafe(value)
    return found


def envelope(df: DataFrame, page: int = 1, page_size: int = 20) -> DataFrame:
    """page, page_size, total_records and total_pages as one row."""
    total = F.col("total_records")
    return df.agg(F.count("*").alias("total_records")).select(
        F.lit(page).alias("page"), F.lit(page_size).alias("page_size"), total,
        F.ceil(total / F.lit(page_size)).alias("total_pages"),
    )


def matching(
    df: DataFrame,
    equal: dict[str, str | None] | None = None,
    contains: dict[str, str | None] | None = None,
    at_least: dict[str, float | None] | None = None,
    between: tuple[str, str | None, str | None] | None = None,
) -> DataFrame:
    """Apply the filters that are set. Text compares without case; dates are inclusive."""
    for name, wanted in (equal or {}).items():
        if wanted and name in df.columns:
            df = df.where(F.lower(name) == wanted.lower())
    for name, part in (contains or {}).items():
        if part:
            df = df.where(F.lower(name).contains(part.lower()))
    for name, bound in (at_least or {}).items():
        if bound is not None:
            df = df.where(F.col(name) >= bound)
    if between:
        name, start, end = between
        if start and end and start > end:
            raise ValueError("the start date is after the end date")
        if start:
            df = df.where(F.col(name) >= F.lit(start).cast("date"))
        if end:
            df = df.where(F.col(name) <= F.lit(end).cast("date"))
    return df


def _by(*names: str) -> list[Column]:
    """Descending order by name; a leading + means ascending."""
    return [F.asc(n[1:]) if n.startswith("+") else F.desc(n) for n in names]


# ---- executive ---------------------------------------------------------------------------------

def executive_kpis(floor: Floor) -> DataFrame:
    """The KPI row with the mean availability as a float, unrounded."""
    health = machine_health(floor).agg(
        F.avg(F.col("annual_availability_pct").cast("double")).alias("average_machine_availability_pct")
    )
    kpis = kpi_summary(floor).drop("average_machine_availability_pct", "total_jackpot_amount")
    return kpis.crossJoin(F.broadcast(health)).withColumnsRenamed(
        {
            "revenue_generating_machine_count": "active_machine_count",
            "total_registered_machines": "registered_machine_count",
            "total_registered_players": "registered_player_count",
        }
    )


def revenue_trend(floor: Floor, days: int = 30) -> DataFrame:
    """The latest activity dates, oldest first. The window runs over one row per calendar day."""
    if not 1 <= days <= 365:
        raise ValueError("days must be between 1 and 365")
    place = F.dense_rank().over(Window.orderBy(F.desc("activity_date")))
    return (
        daily_activity(floor)
        .drop("jackpot_amount")
        .withColumn("actual_hold_pct", ratio("net_gaming_revenue", "total_wager"))
        .withColumn("_place", place)
        .where(F.col("_place") <= days)
        .drop("_place")
        .orderBy("activity_date")
    )


def high_risk(floor: Floor) -> DataFrame:
    limits = tiers.HEALTH_MEDIUM
    risky = (F.col("critical_event_count") >= limits[0]) | (F.col("total_downtime_minutes") >= limits[1])
    return machine_health(floor).where(risky).select(
        "machine_id", "location_id", "location_name", "manufacturer", "game_title", "game_category",
        "software_version", "total_event_count", "unplanned_event_count", "critical_event_count",
        "total_downtime_minutes", "annual_availability_pct",
        tiers.health_risk(("Critical", "High", "Medium")).alias("health_risk_level"),
    )


def high_risk_machines(floor: Floor, page: int = 1, page_size: int = 20, after: dict | None = None) -> DataFrame:
    order = ["critical_event_count", "total_downtime_minutes", "+machine_id"]
    return page_of(high_risk(floor), order, page, page_size)


# ---- players -----------------------------------------------------------------------------------

def _risk_counts(level: str) -> tuple[Column, Column]:
    return count_if(F.col(level).isin("High", "Critical")), count_if(F.col(level) == "Critical")


def player_kpis(churn: DataFrame, segments: DataFrame) -> DataFrame:
    high, critical = _risk_counts("risk_level")
    at_risk = F.greatest(F.col("player_net_revenue").cast("double"), F.lit(0.0)) * F.col("churn_probability")
    scored = churn.agg(
        F.countDistinct("player_id").alias("total_players_scored"),
        high.alias("high_and_critical_risk_players"),
        critical.alias("critical_risk_players"),
        F.round(F.avg("churn_probability"), 4).alias("average_churn_probability"),
        F.round(F.sum(at_risk), 2).alias("estimated_revenue_at_risk"),
    )
    grouped = segments.agg(
        count_if(F.col("player_segment") == "VIP High Value").alias("vip_players"),
        count_if(F.col("player_segment") == "At-Risk Players").alias("at_risk_segment_players"),
    )
    return scored.crossJoin(F.broadcast(grouped))


def segment_distribution(segments: DataFrame) -> DataFrame:
    return segments.groupBy("player_segment").agg(F.count("*").alias("player_count")).orderBy(
        F.desc("player_count"), "player_segment"
    )


def churn_risk(
    churn: DataFrame, risk_level: str | None = None, loyalty_tier: str | None = None,
    home_region: str | None = None, minimum_probability: float = 0.0, search: str | None = None,
    page: int = 1, page_size: int = 20, after: dict | None = None,
) -> DataFrame:
    found = matching(
        churn,
        equal={"risk_level": risk_level, "loyalty_tier": loyalty_tier, "home_region": home_region},
        contains={"player_id": search},
        at_least={"churn_probability": minimum_probability},
    )
    return page_of(found, ["churn_probability", "player_net_revenue", "+player_id"], page, page_size, after)


def player_segments(
    segments: DataFrame, segment: str | None = None, loyalty_tier: str | None = None, search: str | None = None,
    page: int = 1, page_size: int = 20, after: dict | None = None,
) -> DataFrame:
    found = matching(
        segments, equal={"player_segment": segment, "loyalty_tier": loyalty_tier}, contains={"player_id": search}
    )
    order = ["estimated_player_value", "player_net_revenue", "total_wager", "+player_id"]
    return page_of(found, order, page, page_size, after)


def is_one(key: str, value: str) -> Column:
    return F.upper(key) == value.upper()


def one(df: DataFrame, key: str, value: str) -> DataFrame:
    return df.where(is_one(key, value))


def player_detail(churn: DataFrame, segments: DataFrame, player_id: str) -> DataFrame:
    """Churn and segment profile of one player, either of which may be absent."""
    segment_columns = ["cluster_id", "player_segment", "segment_strategy", "estimated_player_value"]
    return one(churn, "player_id", player_id).join(
        one(segments, "player_id", player_id).select("player_id", *segment_columns), "player_id", "full"
    )


# ---- machines ----------------------------------------------------------------------------------

def machine_kpis(failure: DataFrame, anomalies: DataFrame) -> DataFrame:
    high, critical = _risk_counts("failure_risk_level")
    total = lambda c: F.coalesce(F.sum(c), F.lit(0))
    scored = failure.agg(
        F.countDistinct("machine_id").alias("total_machines_scored"),
        high.alias("high_and_critical_failure_risk_machines"),
        critical.alias("critical_failure_risk_machines"),
        F.round(F.avg("failure_probability"), 4).alias("average_failure_probability"),
        F.round(total("revenue_at_risk"), 2).alias("failure_revenue_at_risk"),
    )
    days = anomalies.agg(
        total("isolation_forest_anomaly_flag").alias("detected_anomalous_machine_days"),
        count_if(F.col("anomaly_risk_level") == "Critical").alias("critical_anomaly_days"),
        F.round(total("revenue_exposure"), 2).alias("anomaly_revenue_exposure"),
    )
    return scored.crossJoin(F.broadcast(days))


def failure_risk(
    failure: DataFrame, risk_level: str | None = None, manufacturer: str | None = None,
    location_id: str | None = None, minimum_probability: float = 0.0, search: str | None = None,
    page: int = 1, page_size: int = 20, after: dict | None = None,
) -> DataFrame:
    found = matching(
        failure,
        equal={"failure_risk_level": risk_level, "manufacturer": manufacturer, "location_id": location_id},
        contains={"machine_id": search},
        at_least={"failure_probability": minimum_probability},
    )
    order = ["failure_probability", "revenue_at_risk", "total_downtime_minutes", "+machine_id"]
    return page_of(found, order, page, page_size, after)


def anomalies(
    output: DataFrame, risk_level: str | None = None, manufacturer: str | None = None,
    machine_id: str | None = None, anomaly_only: bool = True, page: int = 1, page_size: int = 20, after: dict | None = None,
) -> DataFrame:
    found = output.where("isolation_forest_anomaly_flag = 1") if anomaly_only else output
    found = matching(
        found, equal={"anomaly_risk_level": risk_level, "manufacturer": manufacturer, "machine_id": machine_id}
    )
    order = ["anomaly_score", "revenue_exposure", "+activity_date", "+machine_id"]
    return page_of(found, order, page, page_size, after)


def maintenance_ranking(priority: DataFrame, page: int = 1, page_size: int = 20, after: dict | None = None) -> DataFrame:
    order = ["+maintenance_priority_rank", "failure_probability", "+machine_id"]
    return page_of(priority, order, page, page_size, after)


def anomaly_ranking(summary: DataFrame, page: int = 1, page_size: int = 20, after: dict | None = None) -> DataFrame:
    return page_of(summary, ["+priority_rank", "operational_priority_score", "+machine_id"], page, page_size, after)


def machine_detail(
    failure: DataFrame, maintenance: DataFrame, summary: DataFrame, machine_id: str
) -> DataFrame:
    """Failure, maintenance and anomaly profile of one machine side by side."""
    ranks = one(maintenance, "machine_id", machine_id).select(
        "machine_id", "maintenance_priority_score", "maintenance_priority_rank"
    )
    days = one(summary, "machine_id", machine_id).select(
        "machine_id", "machine_day_count", "anomaly_day_count", "anomaly_rate", "maximum_anomaly_score",
        "operational_priority_score", "priority_rank",
    )
    return one(failure, "machine_id", machine_id).join(ranks, "machine_id", "full").join(days, "machine_id", "full")


def machine_top_anomalies(output: DataFrame, machine_id: str, n: int = 20) -> DataFrame:
    return one(output, "machine_id", machine_id).orderBy(*_by("anomaly_score", "+activity_date")).limit(n)


def maintenance_queue(
    failure: DataFrame, minimum_probability: float = 0.0, location_id: str | None = None,
    game_category: str | None = None,
) -> DataFrame:
    found = matching(
        failure, equal={"location_id": location_id, "game_category": game_category},
        at_least={"failure_probability": minimum_probability},
    )
    return found.orderBy(
        *_by("failure_probability", "critical_event_count", "total_downtime_minutes", "+machine_id")
    )


# ---- forecasts ---------------------------------------------------------------------------------

def forecast_accuracy(df: DataFrame, actual: str, predicted: str) -> DataFrame:
    """Totals and errors of saved predictions over rows where both values are known."""
    y, p = F.col(actual).cast("double"), F.col(predicted).cast("double")
    error = y - p
    rounded = lambda c: F.round(F.coalesce(c, F.lit(0.0)), 2)
    return df.where(y.isNotNull() & p.isNotNull()).agg(
        F.count("*").alias("record_count"),
        rounded(F.sum(y)).alias("actual_revenue"),
        rounded(F.sum(p)).alias("predicted_revenue"),
        rounded(F.avg(F.abs(error))).alias("average_absolute_error"),
        rounded(F.sqrt(F.avg(error * error))).alias("root_mean_squared_error"),
        rounded(F.sum(F.abs(error)) / F.nullif(F.sum(F.abs(y)), F.lit(0.0)) * 100).alias(
            "weighted_absolute_percentage_error"
        ),
    )


def best_model(metrics: DataFrame) -> DataFrame:
    return metrics.where(F.col("rmse").isNotNull()).orderBy("rmse", "model").limit(1)


def forecast_summary(daily: DataFrame, weekly: DataFrame, daily_metrics: DataFrame, weekly_metrics: DataFrame) -> DataFrame:
    """One row per horizon: accuracy of what was shipped next to the best evaluated model."""
    rows = []
    for horizon, output, predicted, metrics in (
        ("daily", daily, "predicted_revenue", daily_metrics),
        ("weekly", weekly, "selected_predicted_revenue", weekly_metrics),
    ):
        best = best_model(metrics).select(
            F.col("model").alias("best_evaluated_model"),
            *[F.col(c).alias(f"saved_{c}") for c in ("mae", "rmse", "mape_pct", "wape_pct", "r2_score")],
        )
        shipped = forecast_accuracy(output, "net_gaming_revenue", predicted)
        rows.append(shipped.crossJoin(F.broadcast(best)).select(F.lit(horizon).alias("horizon"), "*"))
    return rows[0].unionByName(rows[1])


def forecast_list(
    output: DataFrame, period: str, location_id: str | None = None, region: str | None = None,
    forecast_status: str | None = None, start_date: str | None = None, end_date: str | None = None,
    page: int = 1, page_size: int = 50, after: dict | None = None,
) -> DataFrame:
    """Latest periods first; ``period`` is activity_date or week_start_date."""
    found = matching(
        output.where(F.col(period).isNotNull()),
        equal={"location_id": location_id, "region": region, "forecast_status": forecast_status},
        between=(period, start_date, end_date),
    )
    return page_of(found, [period, "+location_id"], page, page_size, after)


def location_errors(summary: DataFrame) -> DataFrame:
    """Locations by the mean error of the weekly forecast that was shipped, unknown errors last."""
    return summary.orderBy(F.asc_nulls_last("average_selected_absolute_error"), "location_id")


def model_comparison(daily_metrics: DataFrame, weekly_metrics: DataFrame) -> DataFrame:
    tagged = [
        m.select(F.lit(h).alias("horizon"), *m.columns) for h, m in (("daily", daily_metrics), ("weekly", weekly_metrics))
    ]
    return tagged[0].unionByName(tagged[1]).orderBy("horizon", F.asc_nulls_last("rmse"))


def location_forecast(daily: DataFrame, weekly: DataFrame, location_id: str, days: int = 30, weeks: int = 12) -> DataFrame:
    """The latest daily and weekly forecasts of one location in one shape."""
    parts = []
    for horizon, df, period, predicted, n in (
        ("daily", daily, "activity_date", "predicted_revenue", days),
        ("weekly", weekly, "week_start_date", "selected_predicted_revenue", weeks),
    ):
        rows = one(df, "location_id", location_id).select(
            F.lit(horizon).alias("horizon"), "location_id", "location_name", F.col(period).alias("period"),
            "net_gaming_revenue", F.col(predicted).alias("predicted_revenue"), "forecast_status",
        )
        parts.append(rows.orderBy(F.desc("period")).limit(n))
    return parts[0].unionByName(parts[1])


def location_forecast_summary(daily: DataFrame, weekly: DataFrame, location_id: str) -> DataFrame:
    parts = []
    for horizon, df, predicted in (("daily", daily, "predicted_revenue"), ("weekly", weekly, "selected_predicted_revenue")):
        summary = forecast_accuracy(one(df, "location_id", location_id), "net_gaming_revenue", predicted)
        parts.append(summary.select(F.lit(horizon).alias("horizon"), "*"))
    return parts[0].unionByName(parts[1])


def revenue_peaks(days: DataFrame) -> DataFrame:
    """Total, mean and peak of a run of days; the earliest day wins a tie."""
    value = "net_gaming_revenue"
    return days.agg(
        F.sum(value).alias("total_revenue"),
        ratio(F.sum(value), F.count(value), 2).alias("average_daily_revenue"),
        F.max(value).alias("peak_revenue"),
        F.max_by("activity_date", F.struct(F.col(value), -F.unix_date("activity_date"))).alias("peak_date"),
    )


# ---- operations --------------------------------------------------------------------------------

def service_queue(tickets: DataFrame, severity: str = "severity", target: str = "sla_target_minutes", age: str = "age_minutes") -> DataFrame:
    """Open tickets by severity, least remaining time first."""
    left = F.col(target) - F.col(age)
    status = (
        F.when(left < 0, "Breached").when(left <= SLA_WARNING_MINUTES, "At Risk").otherwise("Within SLA")
    )
    return (
        tickets.withColumn("sla_remaining_minutes", left)
        .withColumn("sla_status", status)
        .orderBy(tiers.position(F.col(severity), SEVERITY_ORDER), "sla_remaining_minutes", F.desc(age))
    )


def probability_band(df: DataFrame, probability: str, band: str) -> DataFrame:
    """Rows of one band, lower edge included."""
    low, high = PROBABILITY_BANDS[band]
    return df.where((F.col(probability) >= low) & (F.col(probability) < high))


def by_severity(df: DataFrame, column: str, *then: Column) -> DataFrame:
    """Most severe first, unknown labels last."""
    return df.orderBy(tiers.position(F.col(column), SEVERITY_ORDER), *then)
