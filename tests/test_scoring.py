import pytest
from pyspark.sql import functions as F

from floorlens.ml import datasets, evaluation, scoring, segments
from floorlens.operators import lookups, tiers
from floorlens.plans import scored
from floorlens.sources.bind import bind
from tests.fixtures import rows


@pytest.mark.parametrize(
    "p,tier,action",
    [
        (0.29, "Low", "Routine monitoring"), (0.30, "Low", "Increase monitoring frequency"),
        (0.60, "Medium", "Schedule preventive maintenance"), (0.80, "High", "Immediate maintenance inspection"),
        (0.81, "Critical", "Immediate maintenance inspection"),
    ],
)
def test_equal_probability_takes_lower_tier_and_stronger_action(spark, p, tier, action):
    df = spark.createDataFrame([(p,)], "p double").select(
        tiers.probability_tier(F.col("p")).alias("t"), tiers.probability_action(F.col("p"), scoring.FAILURE_ACTIONS).alias("a")
    )
    assert rows(df) == [{"t": tier, "a": action}]


# Published rows of the failure output and its maintenance ranking.
PUBLISHED = [
    # probability, net revenue, downtime, critical events, revenue at risk, priority score, rank
    (0.999, 2600.59, 7330, 10, 2597.99, 219.18, 1),
    (0.998, 2620.47, 6705, 10, 2615.23, 213.00, 2),
]


def test_published_maintenance_rows(spark):
    df = spark.createDataFrame(
        [(f"M{i}", p, net, down, critical) for i, (p, net, down, critical, *_) in enumerate(PUBLISHED)],
        "machine_id string, failure_probability double, historical_net_revenue double, total_downtime_minutes int, "
        "critical_event_count int",
    ).withColumn("revenue_at_risk", scoring.exposure("historical_net_revenue", "failure_probability"))
    got = {r["machine_id"]: r for r in rows(scoring.maintenance_priority(df))}
    for i, (*_, at_risk, score, rank) in enumerate(PUBLISHED):
        row = got[f"M{i}"]
        assert (row["revenue_at_risk"], row["maintenance_priority_score"], row["maintenance_priority_rank"]) == (at_risk, score, rank)


def test_negative_revenue_carries_no_risk(spark):
    df = spark.createDataFrame([(-5.0, 0.9)], "net double, p double").select(scoring.exposure("net", "p").alias("x"))
    assert rows(df) == [{"x": 0.0}]


def test_forecast_status_edges(spark):
    cases = [("100", 90.0, "High Accuracy"), ("100", 75.0, "Acceptable"), ("100", 74.0, "Review"), ("1", 1.0, "Review")]
    columns = ["location_name", "region", "location_type", "session_count", "unique_player_count", "active_machine_count",
               "total_wager", "event_count", "downtime_minutes", "critical_event_count"]
    df = spark.createDataFrame([(str(i), a, p) for i, (a, p, _) in enumerate(cases)], "location_id string, net_gaming_revenue string, p double")
    df = df.withColumns({c: F.lit(1) for c in columns}).withColumn("activity_date", F.lit("2024-01-01")).withColumn("revenue_lag_1_day", F.lit(0))
    got = {r["location_id"]: r for r in rows(scoring.daily_forecast_output(df, "p"))}
    assert [got[str(i)]["forecast_status"] for i in range(4)] == [c[2] for c in cases]
    assert got["3"]["absolute_percentage_error"] is None  # within one unit of zero


def test_metrics_against_hand_calculation(spark):
    df = spark.createDataFrame([(10.0, 8.0), (0.5, 1.5), (-20.0, -15.0)], "net_gaming_revenue double, p double")
    (m,) = rows(scoring.forecast_metrics(df, {"a": "p"}))
    assert m["mae"] == pytest.approx(8 / 3) and m["rmse"] == pytest.approx((30 / 3) ** 0.5)
    assert m["mape_pct"] == pytest.approx((0.2 + 0.25) / 2 * 100) and m["wape_pct"] == pytest.approx(8 / 30.5 * 100)


def _auc(pairs):
    pos = [s for y, s in pairs if y]
    neg = [s for y, s in pairs if not y]
    return sum((p > n) + (p == n) / 2 for p in pos for n in neg) / (len(pos) * len(neg))


def test_auc_and_curves_against_all_pairs(spark):
    import random

    rng = random.Random(3)
    pairs = [(int(rng.random() < 0.4), round(rng.random(), 2)) for _ in range(400)]
    pairs += [(i % 2, 0.37) for i in range(200)]  # one score held by a third of all rows
    df = spark.createDataFrame(pairs, "y int, s double")
    assert evaluation.roc_auc(df, "y", "s").first()[0] == pytest.approx(_auc(pairs))
    positives = sum(y for y, _ in pairs)
    start, *points = rows(evaluation.roc_points(df, "y", "s"))
    assert start["threshold"] is None and start["true_positive_rate"] == start["false_positive_rate"] == 0
    for r in points:
        tp = sum(1 for y, s in pairs if y and s >= r["threshold"])
        fp = sum(1 for y, s in pairs if not y and s >= r["threshold"])
        assert r["true_positive_rate"] == pytest.approx(tp / positives)
        assert r["false_positive_rate"] == pytest.approx(fp / (len(pairs) - positives))


def test_best_threshold_prefers_recall_on_equal_f1(spark):
    sweep = spark.createDataFrame([(0.3, 0.8, 0.7, 0.9), (0.5, 0.8, 0.9, 0.7)], "threshold double, f1_score double, recall double, precision double")
    assert evaluation.best_threshold(sweep) == 0.5


def test_folds_and_split_keep_class_shares(spark):
    df = spark.range(1000).select(F.col("id").cast("string").alias("id"), F.when(F.col("id") % 10 == 0, 1).otherwise(0).alias("y"))
    folds = rows(evaluation.stratified_folds(df, "y", "id").groupBy("fold", "y").count())
    assert {(r["y"], r["count"]) for r in folds} == {(0, 180), (1, 20)} and len(folds) == 10
    split = rows(evaluation.stratified_split(df, "y", "id", 0.25).groupBy("is_test", "y").count())
    assert {(r["is_test"], r["y"]): r["count"] for r in split} == {(1, 0): 225, (0, 0): 675, (1, 1): 25, (0, 1): 75}


def test_fold_spread_sample_and_population(spark):
    folds = spark.createDataFrame([(1, 0.0), (2, 1.0)], "fold int, validation_f1 double")
    assert rows(evaluation.summarise_folds(folds))[0]["standard_deviation"] == pytest.approx(0.5**0.5)
    assert rows(evaluation.summarise_folds(folds, population=True))[0]["standard_deviation"] == 0.5


def test_segment_names_in_order_then_spare(spark):
    data = [(i, float(rev), float(rev), float(ses), float(days)) for i, rev, ses, days in [
        (0, 100, 5, 10), (1, 10, 2, 300), (2, 20, 9, 20), (3, 5, 1, 50), (4, 15, 3, 40), (5, 14, 4, 40)]]
    profiles = spark.createDataFrame(data, "cluster_id int, average_player_revenue double, average_total_wager double, average_sessions double, average_days_since_last_session double")
    assert segments.segment_names(profiles) == {
        0: "VIP High Value", 1: "At-Risk Players", 2: "Loyal Regulars", 3: "Casual Players",
        4: "Emerging High Value", 5: "Multi-Location Explorers",
    }


def test_chronological_split_uses_whole_periods(spark):
    df = spark.createDataFrame([(f"2024-01-{d:02d}", i) for d in range(1, 11) for i in range(d)], "day string, i int")
    got = datasets.chronological_split(df, "day").where("is_test = 1").select("day").distinct()
    assert sorted(r["day"] for r in rows(got)) == ["2024-01-09", "2024-01-10"]


def test_dataset_problems_and_cleaning(spark):
    df = spark.createDataFrame([("a", 1), ("a", 1), ("b", None), ("c", 7)], "player_id string, churn_flag int")
    spec = datasets.Dataset("t", ["player_id"], [], "churn_flag", True, minimum_rows=10)
    got = {r["rule"]: r["violations"] for r in rows(datasets.problems(df, spec))}
    assert got == {"class missing": 1, "key repeated": 1, "rows missing": 6, "target not 0 or 1": 1, "target null": 1}
    with pytest.raises(ValueError):
        datasets.validate(df, spec)
    dirty = spark.createDataFrame([("1",), ("x",), ("inf",), ("NaN",), ("4",)], "v string")
    filled = datasets.fill_medians(datasets.numeric(dirty, ["v"]), ["v"])
    assert sorted(r["v"] for r in rows(filled)) == [1.0, 2.5, 2.5, 2.5, 4.0]


def test_lookup_filters_and_pages(spark):
    df = spark.createDataFrame([(f"P{i}", i / 10, "High" if i > 5 else "Low", float(i)) for i in range(10)],
                               "player_id string, churn_probability double, risk_level string, player_net_revenue double")
    got = rows(lookups.churn_risk(df, risk_level="HIGH", page=2, page_size=3))
    assert [r["player_id"] for r in got] == ["P6"]
    assert [r["player_id"] for r in rows(lookups.churn_risk(df, search="p3"))] == ["P3"]
    assert rows(lookups.envelope(df, 1, 3)) == [{"page": 1, "page_size": 3, "total_records": 10, "total_pages": 4}]
    assert rows(lookups.envelope(df.limit(0)))[0]["total_pages"] == 0
    band = lookups.probability_band(df, "churn_probability", "Medium Risk")
    assert sorted(r["churn_probability"] for r in rows(band)) == [0.4, 0.5, 0.6]
    with pytest.raises(ValueError):
        lookups.matching(df, between=("player_id", "2024-02-01", "2024-01-01"))


def test_service_queue_order(spark):
    df = spark.createDataFrame([(1, "Low", 60, 10), (2, "Critical", 60, 61), (3, "Critical", 60, 30), (4, "Odd", 60, 1)],
                               "id int, severity string, sla_target_minutes int, age_minutes int")
    got = [(r["id"], r["sla_status"]) for r in rows(lookups.service_queue(df))]
    assert got == [(2, "Breached"), (3, "At Risk"), (1, "Within SLA"), (4, "Within SLA")]


def test_less_of_an_anomaly_output_is_the_same(spark):
    """Before, the machine summary and one machine's days carried every column of every machine-day through the ranking."""
    found = scored.anomaly(bind(spark, "/root/testdata/sf0.001")).cache()
    whole = scoring.anomaly_output(found).cache()
    of_one = scoring.anomaly_output(found, only=lookups.is_one("machine_id", "m7"))
    assert of_one.columns == whole.columns and of_one.count() > 5
    assert of_one.exceptAll(lookups.one(whole, "machine_id", "m7")).count() == 0
    assert of_one.count() == lookups.one(whole, "machine_id", "m7").count()
    less = scoring.anomaly_output(found, drop=scoring.NOT_SUMMARISED)
    assert not set(scoring.NOT_SUMMARISED) & set(less.columns)
    assert scoring.anomaly_machine_summary(less).exceptAll(scoring.anomaly_machine_summary(whole)).count() == 0
