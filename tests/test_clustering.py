"""K-Means of many starts in one pass against plain rounds, MLlib's silhouette, and a layout of one or many parts."""

import numpy as np
import pytest
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.linalg import Vectors

from floorlens.ml import clustering


def frame(spark, x, parts):
    return spark.createDataFrame([(f"P{i:04d}", Vectors.dense(r)) for i, r in enumerate(x.tolist())], ["player_id", "features"]).repartition(parts)


def sample(n=400, seed=4):
    rng = np.random.default_rng(seed)
    centres = np.array([[0, 0, 0], [6, 0, 0], [0, 7, 1]])
    return (centres[rng.integers(0, 3, n)] + rng.normal(size=(n, 3))).round(3)


def lloyd(x, centres, limit):
    for _ in range(clustering.ROUNDS):
        label = ((x[:, None] - centres) ** 2).sum(axis=2).argmin(axis=1)
        moved = np.stack([x[label == c].mean(axis=0) if (label == c).any() else centres[c] for c in range(len(centres))])
        done = ((moved - centres) ** 2).sum() <= limit
        centres = moved
        if done:
            break
    return centres, ((x[:, None] - centres) ** 2).sum(axis=2).min(axis=1).sum()


def test_all_starts_equal_fits_one_by_one(spark):
    x = sample()
    data, n, width = clustering._blocks(frame(spark, x, 3), "player_id")
    runs = [clustering.Start(k, s) for k in (2, 3, 5) for s in range(4)]
    clustering.seed(data, runs, width)
    seeded = [r.centres.copy() for r in runs]
    assert all(len(c) == r.k for c, r in zip(seeded, runs))
    clustering.move(data, runs, width, n)
    limit = clustering.TOLERANCE * x.var(axis=0).mean()
    for run, first in zip(runs, seeded):
        centres, cost = lloyd(x, first, limit)
        assert np.allclose(run.centres, centres, atol=1e-6) and run.cost == pytest.approx(cost, rel=1e-6)


def test_layout_makes_no_difference(spark):
    x = sample(300, 8)
    fits = [clustering.fit(frame(spark, x, parts), [2, 4], 3)[0] for parts in (1, 6)]
    for a, b in zip(*fits):
        assert np.allclose(a.centres, b.centres, atol=1e-9) and a.cost == pytest.approx(b.cost)


def test_silhouette_is_that_of_mllib_and_three_groups_win(spark):
    rows = frame(spark, sample(), 2)
    evaluated = clustering.evaluate(rows, 2, 5, 6)
    assert clustering.choose(evaluated) == 3
    best, data, width = clustering.fit(rows, [3, 4], 6)
    scores = clustering.silhouettes(data, [b.centres for b in best], width)
    for b, score in zip(best, scores):
        centres = b.centres
        label = lambda v: int(((v.toArray() - centres) ** 2).sum(axis=1).argmin())
        marked = spark.createDataFrame([(r.features, label(r.features)) for r in rows.collect()], ["features", "prediction"])
        want = ClusteringEvaluator(featuresCol="features", distanceMeasure="squaredEuclidean").evaluate(marked)
        assert score == pytest.approx(want, abs=1e-6)
    assigned = clustering.assign(rows, 3, 6)
    assert sorted(r["count"] for r in assigned.groupBy("cluster_id").count().collect()) == sorted(
        np.bincount([int(((v - best[0].centres) ** 2).sum(axis=1).argmin()) for v in sample()]).tolist()
    )


def test_equal_rows_and_few_rows(spark):
    same = np.ones((20, 3))
    (best,), _, _ = clustering.fit(frame(spark, same, 2), [3], 2)
    assert best.cost == 0 and len(best.centres) == 1
    with pytest.raises(ValueError):
        clustering.fit(frame(spark, same, 1).limit(0), [2], 1)
