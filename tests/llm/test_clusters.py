"""Centroid clusters against plain integer rounds; the curve, the boxes and odd vectors."""

import hashlib
import itertools
import math

import numpy as np
import pytest

from floorlens.llm import curve_clusters


def plain(rows, clusters, rounds, width, scale=64):
    kept = [
        (i, tuple(math.floor(scale * x) for x in v)) for i, v in rows
        if v is not None and len(v) == width and all(x is not None and math.isfinite(x) for x in v)
    ]
    mark = lambda r: ("~" if r[0] is None else hashlib.sha256(f"1:{r[0]}".encode()).hexdigest(), r[1])
    centroids = [v for _, v in sorted(kept, key=mark)[:clusters]]
    far = lambda v, c: sum((a - b) ** 2 for a, b in zip(v, c))
    nearest = lambda v: min((far(v, c), n) for n, c in enumerate(centroids))
    for _ in range(rounds):
        own = [[v for _, v in kept if nearest(v)[1] == n] for n in range(len(centroids))]
        centroids = [tuple(sum(x) // len(o) for x in zip(*o)) if o else c for o, c in zip(own, centroids)]
    return sorted((str(i), *nearest(v)[::-1]) for i, v in kept), centroids


def clustered(spark, vectors, **kinds):
    df = spark.createDataFrame([(i, v, 1, "x") for i, v in vectors], "vec_id long, embedding array<float>, cells int, place string")
    found, centroids = curve_clusters.clustered(df, **kinds)
    whole = curve_clusters.with_inertia(found, centroids).collect()
    return whole, sorted((str(r.vec_id), r.cluster, r.distance) for r in whole), [tuple(c) for c in centroids.tolist()]


@pytest.mark.parametrize("bits,width", [(1, 3), (2, 2), (3, 2), (2, 3), (2, 4)])
def test_curve_visits_neighbours(bits, width):
    cells = np.array(list(itertools.product(range(1 << bits), repeat=width)))
    keys = [k.tobytes() for k in curve_clusters.hilbert_keys(cells, bits)]
    walk = cells[sorted(range(len(keys)), key=keys.__getitem__)]
    assert len(set(keys)) == len(cells) and (np.abs(np.diff(walk, axis=0)).sum(axis=1) == 1).all()


def test_boxes_leave_out_no_nearest_centroid():
    rng = np.random.default_rng(5)
    centroids = rng.integers(-100, 100, (40, 6))
    left = 0
    for _ in range(200):
        x = rng.integers(-100, 100, 6) + rng.integers(-9, 9, (30, 6))
        numbers = curve_clusters.candidates(x.min(axis=0), x.max(axis=0), centroids)
        left += 40 - len(numbers)
        every = curve_clusters.nearest(x, np.arange(40), centroids)
        assert all((a == b).all() for a, b in zip(curve_clusters.nearest(x, numbers, centroids), every))
    assert left > 4000


def test_clusters_equal_plain_rounds(spark):
    rng = np.random.default_rng(3)
    rows = [(i, [float(x) for x in np.round(rng.normal(i % 5, 0.5, 8) * 8) / 8]) for i in range(400)]
    rows += [(9, rows[9][1])] * 150 + [(None, rows[4][1]), (500, [0.0] * 8), (501, [-0.0] * 8)]
    rows += [(600, None), (601, []), (602, [1.0] * 7), (603, [None] * 8), (604, [math.nan] * 8), (605, [math.inf] * 8)]
    whole, got, centroids = clustered(spark, rows, clusters=7, rounds=4, dimensions=8, rows=16)
    want, means = plain(rows, 7, 4, 8)
    assert got == want and centroids == means
    assert any(r.candidates < 7 for r in whole)
    inertia = sum(d for _, _, d in want)
    for r in whole:
        assert r.inertia == inertia and r.cluster_inertia == sum(d for _, c, d in want if c == r.cluster)
        assert r.centroid_sha256 == hashlib.sha256(",".join(map(str, means[r.cluster])).encode()).hexdigest()


def test_few_and_no_vectors(spark):
    few = [(1, [0.5, 1.0]), (2, [-0.5, 3.0]), (3, None)]
    assert clustered(spark, few, dimensions=2)[1:] == plain(few, 16, 3, 2)
    assert clustered(spark, [(3, None)], dimensions=2)[0] == []
    with pytest.raises(Exception, match="beyond"):
        clustered(spark, [(1, [1e30, 0.0])], dimensions=2)
