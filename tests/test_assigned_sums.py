"""Sums by nearest centre for all starts at once."""

import numpy as np

from floorlens.ml import clustering


def one_by_one(cells, centres):
    out = []
    for c in centres:
        label = clustering._nearest(cells / clustering.UNIT, c)[0]
        sums = [cells[label == j].sum(axis=0) for j in range(len(c))]
        out.append(np.concatenate([*sums, np.bincount(label, minlength=len(c))]))
    return out


def test_all_starts_equal_those_one_by_one():
    draw = np.random.default_rng(1)
    cells = np.rint(draw.normal(size=(1000, 4)) ** 3 * clustering.UNIT).astype(np.int64)
    centres = [draw.normal(size=(k, 4)) for k in (3, 1, 5, 3, 8)]
    got = clustering.assigned_sums(cells, clustering.stacked(centres))
    assert all((a == b).all() for a, b in zip(got, one_by_one(cells, centres)))


def test_a_tie_goes_to_the_first_centre():
    cells = np.array([[0, 0], [2, 2], [4, 4]]) * clustering.UNIT
    centres = [np.array([[1.0, 1.0], [3.0, 3.0], [1.0, 1.0]]), np.array([[9.0, 9.0]])]
    got = clustering.assigned_sums(cells, clustering.stacked(centres))
    assert got[0][-3:].tolist() == [2, 1, 0] and got[1][-1] == 3
    assert (got[0][:2] == 2 * clustering.UNIT).all() and (got[0][2:4] == 4 * clustering.UNIT).all()


def test_players_are_made_once(spark):
    made = spark.sparkContext.accumulator(0)

    def count(rows):
        for batch in rows:
            made.add(len(batch))
            yield batch

    draw = np.random.default_rng(3)
    names = clustering.datasets.SEGMENT_NUMERIC
    cells = draw.normal(size=(150, len(names))).tolist()
    rows = spark.createDataFrame([(f"P{i}", *r) for i, r in enumerate(cells)], ["player_id", *names])
    assert clustering.scaled(rows.mapInPandas(count, rows.schema)).count() == 150
    assert made.value == 150
