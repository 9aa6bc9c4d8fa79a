"""Player clusters: K-Means over standardised behaviour, K chosen by silhouette.

All starts of all cluster counts move together: a pass over the rows gives counts and sums by start and cluster, by
matrix products over all starts of one cluster count, and starts that have settled drop out. Starts are seeded by k-means|| (Bahmani et al. 2012), also together: rows
are drawn by hashes of their key, so a task that runs again draws the same rows. Sums are of integers, so the same
centres come out under any partitioning. The driver holds centres and candidates, whose number does not depend on the rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml import Pipeline
from pyspark.ml.feature import Imputer, StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.rdd import RDD
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from floorlens.ml import datasets
from floorlens.ml.passes import combined, dealt
from floorlens.session import pin

SEED = 42
UNIT = 1 << 24
ROWS, CHUNK, STRIP = 1 << 16, 1 << 12, 1 << 8
STEPS, ROUNDS, TOLERANCE = 2, 500, 1e-4


def scaled(players: DataFrame) -> DataFrame:
    """Active players with standardised features, written once for the many passes that follow.

    The players are written first, as the checks, the medians and the deviations read them too.
    """
    players = pin(players)
    checked = datasets.numeric(datasets.validate(players, datasets.SEGMENTS), datasets.SEGMENT_NUMERIC)
    filled = [f"{c}_filled" for c in datasets.SEGMENT_NUMERIC]
    stages = [
        Imputer(inputCols=datasets.SEGMENT_NUMERIC, outputCols=filled, strategy="median", relativeError=0.0001),
        VectorAssembler(inputCols=filled, outputCol="numbers"),
        StandardScaler(inputCol="numbers", outputCol="features", withMean=True, withStd=True),
    ]
    return pin(Pipeline(stages=stages).fit(checked).transform(checked).select(*players.columns, "features"))


@dataclass
class Start:
    """One run: its number of clusters and seed, and what it has reached."""

    k: int
    seed: int
    centres: np.ndarray | None = None
    cost: float = np.inf


def _blocks(rows: DataFrame, key: str) -> tuple[RDD, int, int]:
    """Marks and features of the rows as blocks of bytes; the number of rows and features."""
    points = pin(rows.select(F.xxhash64(key).alias("mark"), vector_to_array("features").alias("x")))
    first = points.select(F.size("x")).first()
    width = first[0] if first else 0

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, ROWS):
                batch = whole.slice(at, ROWS)
                cells = np.rint(batch.column(1).flatten().to_numpy() * UNIT).astype(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array([batch.column(0).to_numpy().tobytes()]), pa.array([cells.tobytes()])], ["marks", "cells"])

    return dealt(pin(points.mapInArrow(run, "marks binary, cells binary")), points.count()), points.count(), width


def _chunks(row, width: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Marks and integer cells, ``CHUNK`` rows at a time."""
    marks = np.frombuffer(row["marks"], np.int64)
    cells = np.frombuffer(row["cells"], np.int64).reshape(-1, width)
    for at in range(0, len(marks), CHUNK):
        yield marks[at : at + CHUNK], cells[at : at + CHUNK]


def _drawn(marks: np.ndarray, seed: int, step: int) -> np.ndarray:
    """A number in [0, 1) for each row, by its key, the seed and the step."""
    x = marks.astype(np.uint64) + np.uint64((seed * 1000 + step + 1) * 0x9E3779B97F4A7C15 % 2**64)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return ((x ^ (x >> np.uint64(31))) >> np.uint64(11)).astype(float) / 2**53


def _nearest(x: np.ndarray, centres: np.ndarray, squares: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Nearest centre of each row (the first on a tie) and its squared distance; ``squares`` are the rows' own, if known."""
    squares = (x**2).sum(axis=1) if squares is None else squares
    far = squares[:, None] - 2 * x @ centres.T + (centres**2).sum(axis=1)
    best = far.argmin(axis=1)
    return best, np.maximum(far[np.arange(len(x)), best], 0.0)


def _all_nearest(cells: np.ndarray, centres: list[np.ndarray]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """``_nearest`` of the rows for each of the starts."""
    x = cells / UNIT
    squares = (x**2).sum(axis=1)
    return (_nearest(x, c, squares) for c in centres)


def stacked(centres: list[np.ndarray]) -> list[tuple[int, list[int], np.ndarray]]:
    """The starts by number of clusters: that number, their places, and all their centres as factors of a row and 1.

    The product with (x, 1) is the squared distance less the row's own square, by cluster and then by start.
    """
    places: dict[int, list[int]] = {}
    for i, c in enumerate(centres):
        places.setdefault(len(c), []).append(i)
    out = []
    for k, own in places.items():
        c = np.stack([centres[i] for i in own], axis=1).reshape(k * len(own), -1)
        out.append((k, own, np.concatenate([-2 * c, (c**2).sum(axis=1)[:, None]], axis=1)))
    return out


def assigned_sums(cells: np.ndarray, groups: list[tuple[int, list[int], np.ndarray]]) -> list[np.ndarray]:
    """For each start the sums of the rows' cells by nearest centre (the first on a tie), then the rows of each centre.

    All starts of one number of clusters are two products. Sums of ``CHUNK`` rows are integers that a double holds exactly.
    """
    width = cells.shape[1]
    totals = [np.zeros((len(factors), width + 1)) for _, _, factors in groups]
    for at in range(0, len(cells), STRIP):
        part = cells[at : at + STRIP].astype(float)
        one = np.ones((len(part), 1))
        rows, columns = np.concatenate([part, one], axis=1), np.concatenate([part / UNIT, one], axis=1).T
        for total, (k, own, factors) in zip(totals, groups):
            far = (factors @ columns).reshape(k, -1)
            hit = far == far.min(axis=0)
            if np.count_nonzero(hit) > far.shape[1]:
                hit &= np.cumsum(hit, axis=0) == 1
            total += hit.reshape(len(factors), -1).astype(float) @ rows
    out = [np.empty(0)] * sum(len(own) for _, own, _ in groups)
    for total, (k, own, _) in zip(totals, groups):
        by_start = total.astype(np.int64).reshape(k, len(own), width + 1)
        for j, i in enumerate(own):
            out[i] = np.concatenate([by_start[:, j, :width].ravel(), by_start[:, j, width]])
    return out


def _sum(chunks: Iterator, make: Callable, joins: list[Callable]) -> list:
    out = None
    for marks, cells in chunks:
        own = make(marks, cells)
        out = own if out is None else [join(a, b) for join, a, b in zip(joins, out, own)]
    return out


def _first_rows(data: RDD, starts: list[Start], width: int) -> list[np.ndarray]:
    """For each start the row of the least number drawn."""

    def least(marks: np.ndarray, cells: np.ndarray) -> list:
        drawn = np.stack([_drawn(marks, s.seed, 0) for s in starts])
        at = drawn.argmin(axis=1)
        return [np.concatenate([drawn[np.arange(len(starts)), at][:, None], cells[at] / UNIT], axis=1)]

    lower = lambda a, b: np.where(a[:, :1] <= b[:, :1], a, b)
    (found,) = combined(data, lambda row: _sum(_chunks(row, width), least, [lower]), [lower])
    return [r[None, 1:] for r in found]


def seed(data: RDD, starts: list[Start], width: int) -> None:
    """Centres of all starts by k-means||: each step draws rows by their distance, twice as many as clusters on average."""
    held = _first_rows(data, starts, width)
    joined = lambda a, b: [x + y for x, y in zip(a, b)]
    for step in range(1, STEPS + 1):
        costs = lambda marks, cells: [np.array([far.sum() for _, far in _all_nearest(cells, held)])]
        (total,) = combined(data, lambda row: _sum(_chunks(row, width), costs, [np.add]), [np.add])

        def draw(marks: np.ndarray, cells: np.ndarray) -> list:
            out = []
            for s, cost, (_, far) in zip(starts, total, _all_nearest(cells, held)):
                out.append([tuple(r) for r in cells[_drawn(marks, s.seed, step) * cost < 2 * s.k * far].tolist()])
            return [out]

        (found,) = combined(data, lambda row: _sum(_chunks(row, width), draw, [joined]), [joined])
        held = [np.concatenate([c, np.array(sorted(set(f)), float).reshape(-1, width) / UNIT]) for c, f in zip(held, found)]
    weigh = lambda marks, cells: [[np.bincount(label, minlength=len(c)) for c, (label, _) in zip(held, _all_nearest(cells, held))]]
    (weights,) = combined(data, lambda row: _sum(_chunks(row, width), weigh, [joined]), [joined])
    for s, candidates, weight in zip(starts, held, weights):
        s.centres = reduced(candidates, weight, s.k, s.seed)


def reduced(candidates: np.ndarray, weights: np.ndarray, k: int, seed_: int) -> np.ndarray:
    """At most k of the weighted candidates, by k-means++ and some rounds among them."""
    distinct, place = np.unique(candidates, axis=0, return_inverse=True)
    weights = np.bincount(place.ravel(), weights, len(distinct))
    if len(distinct) <= k:
        return distinct
    draw = np.random.default_rng(seed_)
    chosen = [int(draw.choice(len(distinct), p=weights / weights.sum()))]
    while len(chosen) < k:
        share = weights * _nearest(distinct, distinct[chosen])[1]
        share[chosen] = 0
        if not share.sum():
            share = np.where(np.isin(np.arange(len(distinct)), chosen), 0.0, 1.0)
        chosen.append(int(draw.choice(len(distinct), p=share / share.sum())))
    centres = distinct[chosen]
    for _ in range(30):
        label = _nearest(distinct, centres)[0]
        moved = np.stack([
            np.average(distinct[label == c], axis=0, weights=weights[label == c]) if weights[label == c].sum() else centres[c] for c in range(k)
        ])
        if np.array_equal(moved, centres):
            break
        centres = moved
    return centres


def move(data: RDD, starts: list[Start], width: int, n: int, rounds: int = ROUNDS, tolerance: float = TOLERANCE) -> None:
    """Lloyd rounds of all starts at once, until their centres move by less than ``tolerance`` of the mean variance."""
    squares = lambda marks, cells: [(cells / UNIT).sum(axis=0), ((cells / UNIT) ** 2).sum(axis=0)]
    total, square = combined(data, lambda row: _sum(_chunks(row, width), squares, [np.add, np.add]), [np.add, np.add])
    limit = tolerance * float(np.mean(square / n - (total / n) ** 2))
    going = list(starts)
    for _ in range(rounds):
        groups = stacked([s.centres for s in going])
        joins = [np.add] * len(going)
        found = combined(data, lambda row: _sum(_chunks(row, width), lambda marks, cells: assigned_sums(cells, groups), joins), joins)
        still = []
        for s, own in zip(going, found):
            k = len(s.centres)
            counts = own[k * width :]
            means = own[: k * width].reshape(k, width) / UNIT / np.maximum(counts, 1)[:, None]
            moved = np.where(counts[:, None] > 0, means, s.centres)
            if ((moved - s.centres) ** 2).sum() > limit:
                still.append(s)
            s.centres = moved
        going = still
        if not going:
            break
    costs = lambda marks, cells: [np.array([far.sum() for _, far in _all_nearest(cells, [s.centres for s in starts])])]
    (cost,) = combined(data, lambda row: _sum(_chunks(row, width), costs, [np.add]), [np.add])
    for s, c in zip(starts, cost):
        s.cost = float(c)


def silhouettes(data: RDD, centres: list[np.ndarray], width: int) -> list[float]:
    """Mean silhouette by squared distance of each clustering, from counts, sums and squared sums by cluster; 0 for a lone row."""

    def sums(marks: np.ndarray, cells: np.ndarray) -> list:
        x, out = cells / UNIT, []
        for c in centres:
            label = _nearest(x, c)[0]
            place = (label[:, None] * width + np.arange(width)).ravel()
            out.append(np.concatenate([
                np.bincount(place, x.ravel(), len(c) * width), np.bincount(label, (x**2).sum(axis=1), len(c)), np.bincount(label, minlength=len(c)),
            ]))
        return out

    joins = [np.add] * len(centres)
    found = combined(data, lambda row: _sum(_chunks(row, width), sums, joins), joins)
    parts = [(f[: -2 * len(c)].reshape(len(c), width), f[-2 * len(c) : -len(c)], f[-len(c) :]) for c, f in zip(centres, found)]

    def widths(marks: np.ndarray, cells: np.ndarray) -> list:
        x, out = cells / UNIT, []
        own = np.arange(len(x))
        for c, (total, square, n) in zip(centres, parts):
            label = _nearest(x, c)[0]
            among = (x**2).sum(axis=1)[:, None] * n - 2 * x @ total.T + square
            inner = among[own, label] / np.maximum(n[label] - 1, 1)
            outer = np.where(n > 0, among / np.maximum(n, 1), np.inf)
            outer[own, label] = np.inf
            outer = outer.min(axis=1)
            most = np.maximum(inner, outer)
            ratio = np.where((most > 0) & np.isfinite(most), (outer - inner) / np.where(most > 0, most, 1.0), 0.0)
            out.append(np.array([np.where(n[label] > 1, ratio, 0.0).sum()]))
        return out

    total = combined(data, lambda row: _sum(_chunks(row, width), widths, joins), joins)
    return [float(t[0] / n.sum()) for t, (_, _, n) in zip(total, parts)]


def fit(rows: DataFrame, counts: list[int], starts: int, key: str = "player_id") -> tuple[list[Start], RDD, int]:
    """The start of least cost for each number of clusters, all fitted together; the blocks and their width."""
    data, n, width = _blocks(rows, key)
    if not n:
        raise ValueError("there are no rows to cluster")
    runs = [Start(k, SEED + i) for k in counts for i in range(starts)]
    seed(data, runs, width)
    move(data, runs, width, n)
    best = [min((r for r in runs if r.k == k), key=lambda r: (r.cost, r.seed)) for k in counts]
    return best, data, width


def evaluate(rows: DataFrame, low: int = 2, high: int = 8, starts: int = 30) -> DataFrame:
    """Silhouette and inertia for each K."""
    best, data, width = fit(rows, list(range(low, high + 1)), starts)
    scores = silhouettes(data, [b.centres for b in best], width)
    data.unpersist()
    records = [(b.k, score, b.cost) for b, score in zip(best, scores)]
    return rows.sparkSession.createDataFrame(records, "cluster_count int, silhouette_score double, inertia double")


def choose(evaluated: DataFrame) -> int:
    """Highest silhouette; the smaller K on a tie."""
    return evaluated.orderBy(F.desc("silhouette_score"), "cluster_count").first()["cluster_count"]


def assign(rows: DataFrame, k: int, starts: int = 50) -> DataFrame:
    """Rows with the cluster of the best of several starts."""
    (best,), data, _ = fit(rows, [k], starts)
    data.unpersist()
    x = vector_to_array("features")
    far = lambda centre: F.aggregate(F.zip_with(x, F.lit(centre), lambda a, b: (a - b) * (a - b)), F.lit(0.0), lambda s, v: s + v)
    distances = F.array(*[far([float(v) for v in c]) for c in best.centres])
    nearest = F.array_position(distances, F.array_min(distances)) - 1
    return rows.withColumn("cluster_id", nearest.cast("int")).drop("features")
