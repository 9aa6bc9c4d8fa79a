import tempfile

import pytest
from pyspark.sql import functions as F

from floorlens.ml import model_store, pipelines, training
from floorlens.plans import trained
from tests.fixtures import rows
from tests.test_ml import _players


def test_fingerprint_knows_rows_not_layout(spark):
    df = spark.createDataFrame([(1, None, "a"), (2, 3.0, None), (2, 3.0, None)], "k int, x double, t string")
    own = model_store.fingerprint(df, 5)
    assert own == model_store.fingerprint(df.repartition(3).select("t", "x", "k"), 5)
    changed = [df.dropDuplicates(), df.withColumn("x", F.coalesce("x", F.lit(0.0))), df.withColumn("k", F.col("k").cast("long")), df.limit(0)]
    assert len({own, model_store.fingerprint(df, 6), *[model_store.fingerprint(c, 5) for c in changed]}) == 6


def test_nulls_in_other_columns_are_other_rows(spark):
    df = spark.createDataFrame([(None, 1)], "a int, b int")
    assert model_store.fingerprint(df) != model_store.fingerprint(df.select(F.col("b").alias("a"), F.col("a").alias("b")))


def test_a_run_is_fitted_once_and_read_back(spark):
    df, root, calls = _players(spark), tempfile.mkdtemp(), []

    def train(held, forest):
        calls.append(forest)
        return training.train_churn(held, forest)

    fitted = lambda rows_, size: model_store.fitted_once("churn", rows_, train, size, root=root)
    first, again = fitted(df, pipelines.Forest(5, 3, 2)), fitted(df.repartition(3), pipelines.Forest(5, 3, 2))
    assert len(calls) == 1 and first.name == again.name and first.folds is None
    order = lambda t: sorted((r["player_id"], r["churn_probability"]) for r in rows(t.scored))
    assert order(first) == order(again)
    # The loaded model scores as the kept rows were scored.
    anew = pipelines.probability(again.model, again.scored.drop("churn_probability"), "p")
    assert sorted((r["player_id"], r["p"]) for r in rows(anew)) == order(first)
    assert [r["model"] for r in rows(first.metrics.orderBy("model"))] == [training.LOGISTIC, training.FOREST]
    fitted(df.limit(200), pipelines.Forest(5, 3, 2)), fitted(df, pipelines.Forest(6, 3, 2))
    assert len(calls) == 3


def test_an_unpublished_run_is_not_read(spark):
    run = training.train_churn(_players(spark), pipelines.Forest(5, 3, 2))
    key = tempfile.mkdtemp()
    run.model.write().save(f"{key}/run-0/model")  # a driver lost before it published
    assert model_store.load(spark, key) is None
    model_store.save(run, key)
    model_store.save(run, key)  # two drivers publish: all read the same one
    assert model_store.load(spark, key).name == run.name
    assert rows(spark.read.json(f"{key}/published").agg(F.count("*").alias("n")))[0]["n"] == 2


def test_churn_folds_refit_and_drivers_have_a_direction(spark):
    run = training.validate_churn(_players(spark), training.LOGISTIC)
    folds = rows(run.folds.orderBy("fold"))
    assert [f["fold"] for f in folds] == [1, 2, 3, 4, 5]
    assert all(f["validation_roc_auc"] > 0.9 and f["train_accuracy"] > 0.9 for f in folds)
    top = pipelines.importance(run.model, run.scored, "Higher churn risk", "Lower churn risk").first()
    assert top["feature"] == "days_since_last_session" and top["effect_direction"] == "Higher churn risk"
    assert top["importance_type"] == "coefficient" and top["value"] == pytest.approx(top["absolute_importance"])


def test_boosting_survives_the_store(spark):
    df = spark.range(300).select((F.col("id") % 17).cast("double").alias("x"), (F.col("id") % 17 * 2.0 + F.col("id") % 2).alias("y"))
    model = pipelines.fit(df, ["x"], [], pipelines.boosting_regressor("y", pipelines.Boosting(4, 0.3, 2, 4, 8)))
    forest = pipelines.fit(df, ["x"], [], pipelines.forest_regressor("y", pipelines.Forest(30, 3, 2)))
    for own in (model, forest):
        scored = pipelines.prediction(own, df, "p")
        run = training.Trained("b", own, df.limit(1), scored)
        key = tempfile.mkdtemp()
        model_store.save(run, key)
        kept = model_store.load(spark, key)
        assert scored.exceptAll(pipelines.prediction(kept.model, df, "p")).count() == 0


def test_churn_validation_reads_its_features_and_scores_each_row_once(spark, monkeypatch):
    """Before, both runs computed the features, and measures and stores predicted the same rows again and again."""
    made, scored, predicted = [], [], pipelines.probability
    monkeypatch.setattr(trained.features, "player_churn", lambda floor: made.append(1) or _players(spark))
    monkeypatch.setattr(pipelines, "CHURN_FOREST", pipelines.Forest(4, 3, 2))
    monkeypatch.setattr(pipelines, "probability", lambda *a: scored.append(1) or predicted(*a))
    assert trained.churn_validation(None).count() == 5
    # Two candidates, five folds and the model of all rows.
    assert len(made) == 1 and len(scored) == 8
