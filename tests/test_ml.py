import datetime as dt

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from floorlens.ml import clustering, datasets, isolation, pipelines, training
from tests.fixtures import rows


def _points(spark, n=2000):
    rng = np.random.default_rng(1)
    data = rng.normal(size=(n, 3))
    data[:5] += 9
    return spark.createDataFrame([(i, *map(float, r)) for i, r in enumerate(data)], "id long, a double, b double, c double")


def test_isolation_forest_puts_outliers_on_top(spark):
    ready = isolation.standardised(_points(spark), ["a", "b", "c"])
    forest = isolation.fit(ready, ["id"], trees=60, sample=128)
    sizes = rows(forest.where("node = 1").select("tree", "size"))
    assert len(sizes) == 60 and all(60 < s["size"] <= 128 for s in sizes)
    scored = isolation.score(ready, forest)
    top = [r["id"] for r in scored.orderBy(F.desc("anomaly_score")).limit(5).collect()]
    assert sorted(top) == [0, 1, 2, 3, 4]
    low, high = scored.agg(F.min("anomaly_score"), F.max("anomaly_score")).first()
    assert 0 < low < high < 1
    assert isolation.flag(scored, 0.05).agg(F.sum("isolation_forest_anomaly_flag")).first()[0] == 100


def test_isolation_samples_do_not_depend_on_layout(spark):
    ready = isolation.standardised(_points(spark, 500), ["a", "b", "c"])
    draw = lambda df: sorted((r["tree"], r["_order"]) for r in isolation.sample_trees(df, ["id"], 500, 20, 64, 42).collect())
    assert draw(ready.repartition(3)) == draw(ready.repartition(11, "a"))


def test_average_path_small_cases():
    assert list(isolation.average_path([0, 1, 2])) == [0.0, 0.0, 1.0]
    assert isolation.average_path(256) == pytest.approx(10.24, abs=0.01)


def test_contamination_is_kept_within_bounds(spark):
    df = spark.createDataFrame([(1,)] * 9 + [(0,)], "rule_based_anomaly_flag int")
    assert isolation.contamination(df) == 0.20
    assert isolation.contamination(df.where("rule_based_anomaly_flag = 0")) == 0.02


def _players(spark, n=240):
    rng = np.random.default_rng(2)
    data = []
    for i in range(n):
        y, gone = i % 2, float(rng.normal(60 if i % 2 else 10, 5))
        values = [float(rng.normal()) for _ in datasets.CHURN_NUMERIC]
        values[datasets.CHURN_NUMERIC.index("days_since_last_session")] = gone
        data.append((f"P{i:03d}", y, None if i == 3 else "Gold", "21-30", "R", *values))
    names = ["player_id", "churn_flag", *datasets.CHURN_CATEGORICAL, *datasets.CHURN_NUMERIC]
    return spark.createDataFrame(data, names)


def test_churn_training_finds_the_signal(spark):
    trained = training.train_churn(_players(spark), pipelines.Forest(8, 4, 2))
    metrics = {r["model"]: r for r in rows(trained.metrics)}
    assert set(metrics) == {training.LOGISTIC, training.FOREST}
    assert all(m["roc_auc"] > 0.95 for m in metrics.values())
    assert sum(metrics[training.LOGISTIC][c] for c in ("true_negative", "false_positive", "false_negative", "true_positive")) == 48
    assert trained.scored.where("churn_probability between 0 and 1").count() == 240
    assert pipelines.importance(trained.model, trained.scored).first()["feature"] == "days_since_last_session"


def test_unseen_category_scores(spark):
    df = _players(spark)
    trained = training.train_churn(df, pipelines.Forest(5, 3, 2))
    new = pipelines.prepare(df.limit(1).withColumn("home_region", F.lit("elsewhere")), datasets.CHURN_NUMERIC, datasets.CHURN_CATEGORICAL)
    assert pipelines.probability(trained.model, new, "p").first()["p"] is not None


def test_cluster_count_prefers_smaller_on_tie(spark):
    evaluated = spark.createDataFrame([(4, 0.5, 1.0), (2, 0.5, 3.0), (3, 0.4, 2.0)], "cluster_count int, silhouette_score double, inertia double")
    assert clustering.choose(evaluated) == 2


def test_scores_follow_the_paths_of_the_trees(spark):
    """A row's length is its leaf's depth and average path, in trees whose leaves lie at any depth."""
    rng = np.random.default_rng(4)
    x = rng.normal(size=(5000, 3))
    groups = [pd.DataFrame({"tree": t, "_order": range(90), "_x": list(x[rng.integers(0, 5000, 90)])}) for t in range(8)]
    grown = [isolation._grow(7)((t,), g) for t, g in enumerate(groups)]
    trees = [tuple(g[c].to_numpy() for c in ("node", "feature", "cut", "size")) for g in grown]
    want = np.zeros(len(x))
    for node, feature, cut, size in trees:
        held = {n: (f, c, s) for n, f, c, s in zip(node.tolist(), feature.tolist(), cut.tolist(), size.tolist())}
        for i, row in enumerate(x):
            at, depth = 1, 0
            while held[at][0] >= 0:
                at, depth = 2 * at + int(row[held[at][0]] > held[at][1]), depth + 1
            want[i] += depth + float(isolation.average_path(held[at][2]))
    assert np.allclose(isolation.path_lengths(x, [isolation.levelled(*t) for t in trees]), want, rtol=1e-12)


def test_machine_days_are_computed_once(spark, monkeypatch):
    """Detection reads its input once, however many passes follow; before, each pass computed it again."""
    read = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            read.add(len(batch))
            yield batch

    rng = np.random.default_rng(6)
    data = [(dt.date(2024, 1, 1 + i % 28), f"M{i // 28}", "L1", i % 9 == 0, *map(float, rng.normal(size=len(datasets.ANOMALY_NUMERIC)))) for i in range(560)]
    names = ["activity_date", "machine_id", "location_id", "flagged", *datasets.ANOMALY_NUMERIC]
    days = spark.createDataFrame(data, names).withColumn("rule_based_anomaly_flag", F.col("flagged").cast("int")).drop("flagged")
    found = isolation.detect(days.mapInPandas(counted, days.schema), trees=5, sample=32)
    assert found.count() == 560 and read.value == 560


def test_detection_writes_machine_days_and_scores_alone(spark, monkeypatch):
    """Before, the standardised values were written and shuffled too, and scores joined to machine-days, which lost null locations."""
    rng = np.random.default_rng(7)
    data = [(dt.date(2024, 1, 1 + i % 28), f"M{i // 28}", "L1" if i else None, i % 9 == 0, *map(float, rng.normal(size=len(datasets.ANOMALY_NUMERIC)))) for i in range(560)]
    names = ["activity_date", "machine_id", "location_id", "flagged", *datasets.ANOMALY_NUMERIC]
    days = spark.createDataFrame(data, names).withColumn("rule_based_anomaly_flag", F.col("flagged").cast("int")).drop("flagged")
    written, pin = [], isolation.pin
    monkeypatch.setattr(isolation, "pin", lambda df: written.append(df.columns) or pin(df))
    found = isolation.detect(days, trees=5, sample=32)
    assert written == [days.columns, [*days.columns, "anomaly_score"]]
    assert found.count() == 560 and found.select(days.columns).exceptAll(days).count() == 0
    kept = pin(days)
    assert isolation.detect(kept, trees=5, sample=32).exceptAll(found).count() == 0 and len(written) == 3 and kept.count() == 560
