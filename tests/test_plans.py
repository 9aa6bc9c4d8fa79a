"""The shape of plans that must hold at scale."""

import re

import pytest

from floorlens.operators import features, ranks, views
from floorlens.operators.ranks import Ranking, with_global_ranks
from floorlens.operators.reports import health, machine, player
from floorlens.sources.bind import bind

SF = "/root/testdata/sf0.001"


def _plan(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


def _single_task_windows(plan: str) -> list[str]:
    """Window nodes without a partition: their argument list ends with the order alone."""
    return [line for line in plan.splitlines() if re.search(r"^[\s:+-]*Window \[", line) and line.count("[") < 3]


@pytest.mark.parametrize("query", [
    machine.machine_ranking, player.ranking, player.value_segmentation, player.rfm, player.rfm_export,
    health.ranking, health.maintenance_priority, health.replacement_candidates,
])
def test_entity_rankings_have_no_single_task_window(spark, query, monkeypatch):
    """Beyond one range; below it a count has shown that one task holds all rows."""
    monkeypatch.setattr(ranks, "ROWS_PER_RANGE", 60 if query.__module__.endswith("player") else 4)
    plan = _plan(query(bind(spark, SF)))
    assert "Window" in plan and _single_task_windows(plan) == []


def test_the_check_above_sees_a_single_task_window(spark):
    from pyspark.sql import Window
    from pyspark.sql import functions as F

    df = spark.range(5).select("id", F.rank().over(Window.orderBy("id")).alias("r"))
    assert _single_task_windows(_plan(df))


def test_only_needed_columns_are_read(spark):
    plan = bind(spark, SF).session.select("session_id")._jdf.queryExecution().executedPlan().toString()
    assert "l_extendedprice" not in plan and "l_tax" not in plan


def test_failure_gaps_need_no_window(spark):
    assert "Window" not in _plan(health.mean_time_between_failures(bind(spark, SF)))


def test_day_statistics_are_joined_not_windowed(spark):
    assert "Window" not in _plan(features.machine_anomaly(bind(spark, SF)))


def test_anomalies_derive_machine_days_once(spark):
    """Before, the day statistics joined and shuffled the transactions a second time."""
    assert "l_orderkey" not in _plan(features.machine_anomaly(bind(spark, SF)))


def test_machine_days_shuffle_transactions_once(spark):
    """Before, two distinct counts tripled the transactions and shuffled them, ids and all, twice."""
    plan = views.machine_daily(bind(spark, SF))._jdf.queryExecution().executedPlan().toString()
    assert "Expand" not in plan and "distinct" not in plan
    assert len(re.findall(r"Exchange hashpartitioning\(activity_date", plan)) == 2  # transactions and events


def test_churn_features_shuffle_sessions_once_by_player(spark):
    """Before, two distinct counts tripled the sessions and shuffled them by player and place, then by player."""
    plan = features.player_churn(bind(spark, SF))._jdf.queryExecution().executedPlan().toString()
    assert "Expand" not in plan
    assert len(re.findall(r"Exchange hashpartitioning\(player_id#\d+, \d", plan)) == 2  # sessions and players


def test_favourites_are_trimmed_before_the_shuffle(spark):
    assert "WindowGroupLimit" in _plan(player.preferred_location(bind(spark, SF)))


def test_views_have_no_cartesian_product(spark):
    floor = bind(spark, SF)
    for view in (views.machine_daily, views.location_performance, views.machine_health):
        assert "CartesianProduct" not in view(floor)._jdf.queryExecution().executedPlan().toString()


def test_ranks_survive_many_ranges_with_few_keys(spark):
    from pyspark.sql import functions as F

    df = spark.range(5000).select(F.col("id"), (F.col("id") % 2).alias("k"))
    got = with_global_ranks(df, [Ranking("k", {"d": "dense_rank", "r": "rank"})], ["id"], rows_per_range=10)
    assert {(r["k"], r["d"], r["r"]) for r in got.select("k", "d", "r").distinct().collect()} == {(0, 1, 1), (1, 2, 2501)}
