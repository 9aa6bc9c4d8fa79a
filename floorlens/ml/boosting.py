"""Gradient boosting with Huber loss as an estimator for MLlib pipelines.

Each round fits a small tree to the residuals, clipped at the round's ``quantile`` of their sizes; a leaf's value is
the median of its residuals plus the mean of the clipped differences from it (Friedman 2001). Features are cut into
at most ``bins`` bins once; rows are kept as blocks of bytes.

Every step is one pass of partial sums that are combined as a tree: a histogram of clipped residuals by node,
feature and bin for each level, counts by bracket for the quantile of all rows and for the medians of all leaves
together. Brackets are narrowed until the wanted positions are single values, so quantiles are exact at any size. Sums
are of integers (residuals over their clip, times ``UNIT``), so the same trees come out under any partitioning. The
driver holds histograms and trees, whose size does not depend on the rows. Every ``REBASE`` rounds the predictions
so far are written beside the blocks, which bounds what a lost task has to do again.
"""

from __future__ import annotations

import json
import uuid
from collections import OrderedDict
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import DenseVector
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasFeaturesCol, HasLabelCol, HasPredictionCol
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.rdd import RDD
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from floorlens.ml.passes import combined, dealt
from floorlens.session import pin

UNIT = 1 << 26
ROWS = 1 << 16
BRACKETS = 2048
REBASE = 50
#: Blocks whose predictions a worker keeps.
KEPT = 64


def thresholds(rows: DataFrame, width: int, bins: int) -> list[list[float]]:
    """Upper borders of the bins of each feature but the last bin's: approximate quantiles, each once.

    Features that take few values get a border at every value but the largest.
    """
    columns = [f"x{i}" for i in range(width)]
    split = rows.select(*[F.col("x")[i].alias(c) for i, c in enumerate(columns)])
    levels = [i / bins for i in range(1, bins)]
    found = split.approxQuantile(columns, [0.0, *levels, 1.0], 1 / (8 * bins)) if width else []
    return [sorted(set(values[:-1]) - {values[-1]}) if values else [] for values in found]


def blocks(rows: DataFrame, borders: list[list[float]]) -> DataFrame:
    """Rows ``x``, ``y`` as blocks: a ``name``, ``codes`` (a byte per feature and row), ``y`` and the predictions so far."""
    cuts = [np.array(b) for b in borders]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, ROWS):
                batch = whole.slice(at, ROWS)
                x = batch.column(0).flatten().to_numpy().reshape(batch.num_rows, len(cuts))
                codes = np.stack([np.searchsorted(c, x[:, f]) for f, c in enumerate(cuts)]).astype(np.uint8)
                y = batch.column(1).to_numpy().astype(float)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([uuid.uuid4().hex]), pa.array([codes.tobytes()]), pa.array([y.tobytes()]), pa.array([np.zeros(len(y)).tobytes()])],
                    ["name", "codes", "y", "base"])

    return pin(rows.select("x", "y").mapInArrow(run, "name string, codes binary, y binary, base binary"))


class Tree:
    """A binary tree in heap order: split feature (-1: leaf), last code to the left, gain and value by node."""

    def __init__(self, depth: int):
        size = 2 ** (depth + 1) - 1
        self.feature, self.cut = np.full(size, -1, np.int64), np.zeros(size, np.int64)
        self.gain, self.value, self.depth = np.zeros(size), np.zeros(size), depth

    def places(self, codes: np.ndarray) -> np.ndarray:
        """Leaf of each column of ``codes`` (features by rows)."""
        at, own = np.zeros(codes.shape[1], np.int64), np.arange(codes.shape[1])
        for _ in range(self.depth):
            feature = self.feature[at]
            right = codes[np.maximum(feature, 0), own] > self.cut[at]
            at = np.where(feature < 0, at, 2 * at + 1 + right)
        return at


def _block(row) -> tuple[np.ndarray, np.ndarray, np.ndarray, str]:
    y = np.frombuffer(row["y"])
    return np.frombuffer(row["codes"], np.uint8).reshape(-1, len(y)), y, np.frombuffer(row["base"]), row["name"]


_KEPT: OrderedDict[tuple, tuple[int, np.ndarray]] = OrderedDict()


def _predicted(block: tuple, trees: list[Tree], step: float) -> np.ndarray:
    """What the trees add to the written predictions. A worker keeps what it knows of its last blocks; another one starts anew."""
    codes, _, out, name = block
    known, kept = _KEPT.get(name, (0, out))
    if known > len(trees):
        known, kept = 0, out
    for tree in trees[known:]:
        kept = kept + step * tree.value[tree.places(codes)]
    _KEPT[name] = (len(trees), kept)
    _KEPT.move_to_end(name)
    while len(_KEPT) > KEPT:
        _KEPT.popitem(last=False)
    return kept


def _passed(data: RDD, make: Callable[[tuple], list[np.ndarray]], joins: list[Callable]) -> list[np.ndarray]:
    return combined(data, lambda row: make(_block(row)), joins)


def _counted(values: np.ndarray, groups: np.ndarray, brackets: np.ndarray) -> list[np.ndarray]:
    """Per group: values below its bracket, and count, least and largest value in each part of the bracket."""
    many = len(brackets)
    low, high = brackets[groups].T
    inside = (values >= low) & (values <= high)
    wide = np.where(high > low, high - low, 1.0)
    part = np.minimum(((values - low) / wide * BRACKETS), BRACKETS - 1)[inside].astype(np.int64)
    place = groups[inside] * BRACKETS + part
    least, most = np.full(many * BRACKETS, np.inf), np.full(many * BRACKETS, -np.inf)
    np.minimum.at(least, place, values[inside])
    np.maximum.at(most, place, values[inside])
    ends = np.full((many, 2), np.inf)
    np.minimum.at(ends[:, 0], groups, values)
    np.minimum.at(ends[:, 1], groups, -values)
    shape = (many, BRACKETS)
    return [
        np.bincount(groups, minlength=many), np.bincount(groups[values < low], minlength=many),
        np.bincount(place, minlength=many * BRACKETS).reshape(shape), least.reshape(shape), most.reshape(shape), ends,
    ]


_JOINS = [np.add, np.add, np.add, np.minimum, np.maximum, np.minimum]


def select(data: RDD, values: Callable[[tuple], tuple[np.ndarray, np.ndarray]], share: float, brackets: np.ndarray) -> np.ndarray:
    """The ``share`` quantile of each group, exact and interpolated; NaN for a group without values.

    ``values`` gives values and group of a block's rows; ``brackets`` is where each quantile is looked for first.
    """
    brackets = brackets.copy()
    out = np.full(len(brackets), np.nan)
    while True:
        counts, below, inside, least, most, ends = _passed(data, lambda b: _counted(*values(b), brackets), _JOINS)
        going = False
        for g in np.flatnonzero(np.isnan(out) & (counts > 0)):
            place = (counts[g] - 1) * share
            found, open_ = [], []
            upto = below[g] + np.cumsum(inside[g])
            for k in {int(np.floor(place)), int(np.ceil(place))}:
                if k < below[g]:
                    open_.append((ends[g, 0], brackets[g, 0]))
                elif k >= upto[-1]:
                    open_.append((brackets[g, 1], -ends[g, 1]))
                else:
                    part = int(np.searchsorted(upto, k, side="right"))
                    first, last = least[g, part], most[g, part]
                    own = k - (upto[part] - inside[g, part])
                    if own == 0 or first == last:
                        found.append(first)
                    elif own == inside[g, part] - 1:
                        found.append(last)
                    else:
                        open_.append((first, last))
            if open_:
                going = True
                # What is known already stays inside, so both positions are found in the end.
                brackets[g] = min([lo for lo, _ in open_] + found), max([hi for _, hi in open_] + found)
            else:
                lower, upper = min(found), max(found)
                out[g] = lower + (upper - lower) * (place - np.floor(place))
        if not going:
            return out


def _histogram(block: tuple, residual: np.ndarray, clip: float, tree: Tree, slots: np.ndarray, offsets: np.ndarray) -> list[np.ndarray]:
    """Rows and summed clipped residuals of the open nodes by feature and bin."""
    codes = block[0]
    slot = slots[tree.places(codes)]
    held = slot >= 0
    many, total = slots.max() + 1, offsets[-1]
    place = (codes[:, held] + (offsets[:-1, None] + slot[held] * total)).ravel()
    weights = np.broadcast_to(clipped(residual[held], clip).astype(float), (len(codes), int(held.sum()))).ravel()
    top = many * total
    out = np.stack([np.bincount(place, minlength=top), np.bincount(place, weights, top).astype(np.int64)])
    return [out.reshape(2, many, total)]


def clipped(residual: np.ndarray, clip: float) -> np.ndarray:
    """Residuals within -clip and clip, as integers of ``UNIT`` to the clip."""
    if clip <= 0:
        return np.zeros(len(residual), np.int64)
    return np.rint(np.clip(residual / clip, -1, 1) * UNIT).astype(np.int64)


def best_split(counts: np.ndarray, sums: np.ndarray, offsets: np.ndarray, leaf: int) -> tuple[int, int, float]:
    """Feature, last bin to the left and gain of a node's best split; feature -1 if none gains anything."""
    best = (-1, 0, 0.0)
    for f in range(len(offsets) - 1):
        n, g = (np.cumsum(v[offsets[f] : offsets[f + 1]]).astype(float) for v in (counts, sums))
        all_n, all_g, n, g = n[-1], g[-1], n[:-1], g[:-1]
        allowed = np.flatnonzero((n >= leaf) & (all_n - n >= leaf))
        if len(allowed):
            n, g = n[allowed], g[allowed]
            gain = g**2 / n + (all_g - g) ** 2 / (all_n - n) - all_g**2 / all_n
            at = int(gain.argmax())
            if gain[at] > best[2] * (1 + 1e-12) and gain[at] > 1e-9 * UNIT:
                best = (f, int(allowed[at]), float(gain[at]))
    return best


def grow(data: RDD, residual: Callable[[tuple], np.ndarray], clip: float, depth: int, leaf: int, split: int, offsets: np.ndarray) -> Tree:
    """A tree on the clipped residuals, level by level."""
    tree, open_ = Tree(depth), [0]
    for level in range(depth):
        slots = np.full(len(tree.feature), -1, np.int64)
        slots[open_] = np.arange(len(open_))
        if not open_:
            break
        (found,) = _passed(data, lambda b: _histogram(b, residual(b), clip, tree, slots, offsets), [np.add])
        more = []
        for i, node in enumerate(open_):
            counts, sums = found[:, i]
            if counts[: offsets[1]].sum() >= split:
                feature, cut, gain = best_split(counts, sums, offsets, leaf)
                if feature >= 0:
                    tree.feature[node], tree.cut[node], tree.gain[node] = feature, cut, gain
                    more += [2 * node + 1, 2 * node + 2]
        open_ = more
    return tree


def leaf_values(data: RDD, residual: Callable[[tuple], np.ndarray], clip: float, tree: Tree) -> np.ndarray:
    """Median of each leaf's residuals plus the mean of their differences from it, clipped."""
    size = len(tree.feature)
    medians = select(data, lambda b: (residual(b), tree.places(b[0])), 0.5, np.tile([-clip, clip], (size, 1)).astype(float))

    def sums(block: tuple) -> list[np.ndarray]:
        places = tree.places(block[0])
        parts = clipped(residual(block) - medians[places], clip).astype(float)
        return [np.bincount(places, minlength=size), np.bincount(places, parts, size).astype(np.int64)]

    counts, totals = _passed(data, sums, [np.add, np.add])
    return np.where(counts > 0, np.nan_to_num(medians) + clip * (totals / UNIT) / np.maximum(counts, 1), 0.0)


def boost(rows: DataFrame, borders: list[list[float]], rounds: int, step: float, depth: int, leaf: int, split: int, quantile: float) -> tuple[float, list[Tree]]:
    """Start value and trees, from rows ``x`` (array) and ``y``."""
    offsets = np.cumsum([0, *[len(b) + 1 for b in borders]])
    table, size = blocks(rows, borders), rows.count()
    data = dealt(table, size)
    everyone = lambda b, v: (v, np.zeros(len(v), np.int64))
    start = select(data, lambda b: everyone(b, b[1]), 0.5, np.array([[0.0, 0.0]]))[0]
    if np.isnan(start):
        raise ValueError("there are no rows to fit")
    trees: list[Tree] = []
    recent: list[Tree] = []
    clip = 0.0
    for at in range(rounds):
        if len(recent) == REBASE:
            data, recent = _rebased(data, table, recent, step, size), []
        held = list(recent)
        residual = lambda b: b[1] - start - _predicted(b, held, step)
        clip = select(data, lambda b: everyone(b, np.abs(residual(b))), quantile, np.array([[0.8 * clip, 1.1 * clip]]))[0]
        tree = grow(data, residual, clip, depth, leaf, split, offsets)
        tree.value = leaf_values(data, residual, clip, tree)
        trees.append(tree)
        recent.append(tree)
    data.unpersist()
    return float(start), trees


def _rebased(data: RDD, table: DataFrame, trees: list[Tree], step: float, size: int) -> RDD:
    """The blocks with what the trees add, written out."""
    moved = data.map(lambda r: (uuid.uuid4().hex, bytes(r["codes"]), bytes(r["y"]), _predicted(_block(r), trees, step).tobytes()))
    out = dealt(pin(table.sparkSession.createDataFrame(moved, table.schema)), size)
    data.unpersist()
    return out


class HuberBoosting(Estimator, HasFeaturesCol, HasLabelCol, HasPredictionCol, DefaultParamsWritable, DefaultParamsReadable):
    """Boosted trees with Huber loss."""

    rounds = Param(Params._dummy(), "rounds", "number of trees", TypeConverters.toInt)
    step = Param(Params._dummy(), "step", "share of each tree that is added", TypeConverters.toFloat)
    depth = Param(Params._dummy(), "depth", "levels of splits", TypeConverters.toInt)
    leaf = Param(Params._dummy(), "leaf", "least rows of a leaf", TypeConverters.toInt)
    split = Param(Params._dummy(), "split", "least rows of a node that is split", TypeConverters.toInt)
    quantile = Param(Params._dummy(), "quantile", "share of residuals that are not clipped", TypeConverters.toFloat)
    bins = Param(Params._dummy(), "bins", "most bins of a feature, 256 at most", TypeConverters.toInt)

    @keyword_only
    def __init__(self, *, featuresCol="features", labelCol="label", predictionCol="prediction", rounds=100, step=0.1, depth=3, leaf=1, split=2, quantile=0.9, bins=128):
        super().__init__()
        self._setDefault(rounds=100, step=0.1, depth=3, leaf=1, split=2, quantile=0.9, bins=128)
        self._set(**self._input_kwargs)
        if not 2 <= self.getOrDefault("bins") <= 256:
            raise ValueError("bins must be 2 to 256")

    def _fit(self, dataset: DataFrame) -> HuberBoostingModel:
        value = self.getOrDefault
        rows = pin(dataset.select(vector_to_array(self.getFeaturesCol()).alias("x"), F.col(self.getLabelCol()).cast("double").alias("y")))
        first = rows.select(F.size("x")).first()
        borders = thresholds(rows, first[0] if first else 0, value("bins"))
        start, trees = boost(rows, borders, *(value(p) for p in ("rounds", "step", "depth", "leaf", "split", "quantile")))
        forest = {
            "start": start, "step": value("step"), "width": len(borders),
            "trees": [{
                "feature": t.feature.tolist(), "gain": t.gain.tolist(), "value": t.value.tolist(),
                "border": [borders[f][c] if f >= 0 else 0.0 for f, c in zip(t.feature, t.cut)],
            } for t in trees],
        }
        model = HuberBoostingModel(forest=json.dumps(forest))
        return self._copyValues(model)


class HuberBoostingModel(Model, HasFeaturesCol, HasLabelCol, HasPredictionCol, DefaultParamsWritable, DefaultParamsReadable):
    """Trees with borders in the features' own units, kept as JSON so that the model is saved with its parameters."""

    forest = Param(Params._dummy(), "forest", "start value and trees", TypeConverters.toString)
    rounds, step, depth, leaf, split, quantile, bins = (
        getattr(HuberBoosting, p) for p in ("rounds", "step", "depth", "leaf", "split", "quantile", "bins")
    )

    def __init__(self, forest: str | None = None):
        super().__init__()
        if forest is not None:
            self._set(forest=forest)

    def predict(self, x: np.ndarray) -> np.ndarray:
        """Predictions for rows of features."""
        forest = json.loads(self.getOrDefault("forest"))
        out, own = np.full(len(x), forest["start"]), np.arange(len(x))
        for tree in forest["trees"]:
            feature, border, value = (np.array(tree[k]) for k in ("feature", "border", "value"))
            at = np.zeros(len(x), np.int64)
            for _ in range(len(feature).bit_length() - 1):
                f = feature[at]
                at = np.where(f < 0, at, 2 * at + 1 + (x[own, np.maximum(f, 0)] > border[at]))
            out = out + forest["step"] * value[at]
        return out

    @property
    def featureImportances(self) -> DenseVector:
        """Share of each feature in the gains, a mean over trees that split at all."""
        forest = json.loads(self.getOrDefault("forest"))
        total = np.zeros(forest["width"])
        for tree in forest["trees"]:
            feature, gain = np.array(tree["feature"]), np.array(tree["gain"])
            own = np.bincount(feature[feature >= 0], gain[feature >= 0], forest["width"])
            total += own / own.sum() if own.sum() else 0.0
        return DenseVector(total / total.sum() if total.sum() else total)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        model = self

        @F.pandas_udf("double")
        def predicted(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
            for rows in batches:
                yield pd.Series(model.predict(np.stack(rows.to_numpy())) if len(rows) else np.empty(0))

        return dataset.withColumn(self.getPredictionCol(), predicted(vector_to_array(self.getFeaturesCol())))
