"""Huber boosting against a plain version, under any layout, saved and loaded; exact selection in few brackets."""

import numpy as np
import pytest
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import VectorAssembler

from floorlens.ml import boosting


def plain(codes, y, rounds, step, depth, leaf, split, quantile, widths):
    """Start value, predictions and splits, by scanning all rows for every candidate."""
    start = np.percentile(y, 50)
    predicted, splits = np.zeros(len(y)), []
    for _ in range(rounds):
        residual = y - start - predicted
        clip = np.percentile(np.abs(residual), 100 * quantile)
        target = boosting.clipped(residual, clip).astype(float)
        at = np.zeros(len(y), int)
        for level in range(depth):
            for node in np.unique(at):
                rows = np.flatnonzero(at == node)
                if node < 2**level - 1 or len(rows) < split:
                    continue
                best = None
                for f in range(codes.shape[1]):
                    for cut in range(widths[f] - 1):
                        left = codes[rows, f] <= cut
                        n, m = left.sum(), (~left).sum()
                        if n >= leaf and m >= leaf:
                            a, b = target[rows][left].sum(), target[rows][~left].sum()
                            gain = a * a / n + b * b / m - (a + b) ** 2 / (n + m)
                            if gain > (best[0] * (1 + 1e-12) if best else 1e-9 * boosting.UNIT):
                                best = (gain, f, cut)
                if best:
                    splits.append((int(node), *best[1:]))
                    at[rows] = 2 * node + 1 + (codes[rows, best[1]] > best[2])
        for node in np.unique(at):
            rows = at == node
            median = np.percentile(residual[rows], 50)
            parts = boosting.clipped(residual[rows] - median, clip)
            predicted[rows] += step * (median + clip * (parts.sum() / boosting.UNIT) / rows.sum())
    return start, start + predicted, splits


def sample(n=700, seed=5):
    rng = np.random.default_rng(seed)
    x = np.stack([rng.integers(0, 12, n), rng.normal(size=n).round(1), rng.integers(0, 2, n), np.zeros(n)], axis=1)
    y = x[:, 0] * 2 + 5 * (x[:, 1] > 0.3) * x[:, 2] + rng.standard_t(2, n)
    return x, np.where(rng.random(n) < 0.02, y * 40, y)


def frame(spark, x, y, parts):
    rows = spark.createDataFrame([(i, *map(float, r), float(t)) for i, (r, t) in enumerate(zip(x, y))], "id long, a double, b double, c double, d double, y double")
    return rows.repartition(parts)


def test_equals_a_plain_version_under_any_layout(spark, monkeypatch):
    monkeypatch.setattr(boosting, "REBASE", 3)
    x, y = sample()
    fits = []
    for parts in (1, 5):
        rows = frame(spark, x, y, parts)
        estimator = boosting.HuberBoosting(labelCol="y", rounds=8, step=0.3, depth=3, leaf=4, split=8)
        model = Pipeline(stages=[VectorAssembler(inputCols=list("abcd"), outputCol="features"), estimator]).fit(rows)
        fits.append(dict(model.transform(rows).select("id", "prediction").collect()))
        arrays = rows.selectExpr("array(a, b, c, d) AS x", "y")
    borders = boosting.thresholds(arrays, 4, 128)
    codes = np.stack([np.searchsorted(b, x[:, f]) for f, b in enumerate(borders)], axis=1)
    _, want, splits = plain(codes, y, 8, 0.3, 3, 4, 8, 0.9, [len(b) + 1 for b in borders])
    assert len(splits) > 30
    for got in fits:
        assert np.allclose([got[i] for i in range(len(y))], want, rtol=0, atol=1e-9)
    assert fits[0] == fits[1]


def test_outliers_move_it_less_than_they_move_a_mean(spark):
    x, y = sample(400, 1)
    rows = frame(spark, x, np.where(np.arange(400) == 7, 1e6, y), 2)
    estimator = boosting.HuberBoosting(labelCol="y", rounds=20, step=0.2, depth=2, leaf=4)
    model = Pipeline(stages=[VectorAssembler(inputCols=list("abcd"), outputCol="features"), estimator]).fit(rows)
    got = [r["prediction"] for r in model.transform(rows).collect()]
    assert max(got) < 200
    importance = model.stages[-1].featureImportances
    assert importance[0] == max(importance) and importance[3] == 0 and sum(importance) == pytest.approx(1)


def test_saved_and_loaded(spark, tmp_path):
    x, y = sample(200, 2)
    rows = frame(spark, x, y, 2)
    model = Pipeline(stages=[VectorAssembler(inputCols=list("abcd"), outputCol="features"), boosting.HuberBoosting(labelCol="y", rounds=3)]).fit(rows)
    model.write().overwrite().save(str(tmp_path / "m"))
    again = PipelineModel.load(str(tmp_path / "m"))
    assert model.transform(rows).select("id", "prediction").collect() == again.transform(rows).select("id", "prediction").collect()


@pytest.mark.parametrize("parts", [2, 2048])
def test_selection_is_exact(spark, monkeypatch, parts):
    monkeypatch.setattr(boosting, "BRACKETS", parts)
    rng = np.random.default_rng(9)
    y = np.concatenate([rng.normal(size=300).round(1), [3.5] * 200, [-1e9, 1e9], np.zeros(1)])
    rows = spark.createDataFrame([([0.0], float(v)) for v in y], "x array<double>, y double").repartition(3)
    data = boosting.blocks(rows, [[]]).rdd
    own = lambda b: (b[1], (b[1] > 0).astype(np.int64))
    for share in (0.0, 0.25, 0.5, 0.9, 1.0):
        for bracket in ([0.0, 0.0], [-5.0, 5.0], [1e12, 1e13]):
            got = boosting.select(data, own, share, np.array([bracket, bracket, bracket]))
            want = [np.percentile(y[y <= 0], 100 * share), np.percentile(y[y > 0], 100 * share)]
            assert got[:2].tolist() == pytest.approx(want, rel=1e-15) and np.isnan(got[2])


def test_no_rows_is_an_error(spark):
    rows = frame(spark, *sample(3), 1).limit(0)
    assembled = VectorAssembler(inputCols=list("abcd"), outputCol="features").transform(rows)
    with pytest.raises(ValueError):
        boosting.HuberBoosting(labelCol="y").fit(assembled)
