"""Links of the LSH forest: later trees link what the first ones have joined."""

import numpy as np

from floorlens.llm import lsh_forest


def test_a_group_of_near_copies_has_links_of_the_first_trees_only(spark, monkeypatch):
    draw = np.random.default_rng(3)
    x = np.tile(draw.integers(0, 2**16, (1, lsh_forest.TREES, lsh_forest.DEPTH)), (200, 1, 1))
    x[:, :, -1] = draw.integers(0, 2**16, (200, lsh_forest.TREES))
    apart = draw.integers(0, 2**16, (2, lsh_forest.TREES, lsh_forest.DEPTH))
    apart[:, -1, : lsh_forest.SHALLOW] = 7
    rows = [(i, bytearray(v.astype(np.uint16).tobytes())) for i, v in enumerate([*x, *apart])]
    counts, plain = [], lsh_forest.components
    monkeypatch.setattr(lsh_forest, "components", lambda edges: counts.append(edges.count()) or plain(edges))
    monkeypatch.setattr(lsh_forest, "similar", lambda tasks: tasks.select("task", "item"))
    monkeypatch.setattr(lsh_forest, "REGION", 1000)
    tasks, _ = lsh_forest.compared(spark.createDataFrame(rows, "item long, signature binary"))
    found = {}
    for r in tasks.collect():
        found.setdefault(r.task, set()).add(r.item)
    assert sorted(found.values(), key=len) == [{200, 201}, set(range(200))]
    assert sum(counts) <= (lsh_forest.FIRST + 1) * len(rows)
