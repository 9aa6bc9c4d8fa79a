"""Large groups: balls of vectors, groups of near copies, and the whole pipeline on the smallest tables."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from floorlens.llm import flat_graph, lsh_forest, url_rules

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("spread", [0.01, 1e-9])
def test_a_ball_of_vectors_keeps_all_its_links(spark, monkeypatch, spread):
    monkeypatch.setattr(flat_graph, "SHARD", 60)
    draw = np.random.default_rng(2)
    ball = draw.normal(size=16) + draw.normal(scale=spread, size=(100, 16))
    x = np.concatenate([ball, draw.normal(size=(80, 16))])
    rows = spark.createDataFrame([(i, v.tolist(), 1) for i, v in enumerate(x)], "vec_id long, embedding array<double>, label int")
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    want = (unit @ unit.T >= 0.93).sum(axis=1) - 1
    got = {r.vec_id: r for r in flat_graph.near_duplicates(rows).collect()}
    assert len(got) == len(x)
    assert all(got[i].n_links == want[i] for i in range(100))
    assert {got[i].component_id for i in range(100)} == {0}


def test_a_large_group_of_near_copies_is_one_component(spark, monkeypatch):
    monkeypatch.setattr(lsh_forest, "REGION", 8)
    words = [f"w{i}" for i in range(200)]
    texts = [" ".join(words[:i] + [f"x{i}"] + words[i + 1 :]) for i in range(0, 200, 4)]
    texts += [" ".join(f"{i}-{j}" for j in range(30)) for i in range(5)]
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r.component_id for r in lsh_forest.near_duplicates(rows).collect()}
    assert got == {i: 0 if i < 50 else i for i in range(55)}


def test_the_pipeline_ends_and_packs_only_what_each_stage_keeps(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = corpus_pipeline.run(spark, SF).toPandas()
    assert len(out) and set(out.doc_id) <= {r.doc_id for r in docs.select("doc_id").collect()}
    assert (out.groupby("sequence_id").length.sum() <= 2048).all()
    whole = out.groupby("doc_id").agg(got=("length", "sum"), want=("doc_tokens", "first"))
    assert (whole.got == whole.want).all()
    kept = docs.where(F.col("doc_id").isin(out.doc_id.unique().tolist()))
    assert kept.select("text").distinct().count() == kept.count()


def brute_force(x):
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    return (unit @ unit.T >= 0.93).sum(axis=1) - 1


def test_a_ball_with_stray_vectors_keeps_all_its_links(spark, monkeypatch):
    monkeypatch.setattr(flat_graph, "SHARD", 60)
    monkeypatch.setattr(flat_graph, "OVERLAP", 12)
    monkeypatch.setattr(flat_graph, "LEAST_RECALL", 0)
    draw = np.random.default_rng(5)
    ball = draw.normal(size=16) + draw.normal(scale=0.15, size=(900, 16))
    x = np.concatenate([ball, draw.normal(size=(100, 16))])
    rows = spark.createDataFrame([(i, v.tolist(), 1) for i, v in enumerate(x)], "vec_id long, embedding array<double>, label int")
    got = {r.vec_id: r.n_links for r in flat_graph.near_duplicates(rows).collect()}
    want = brute_force(x)
    assert sum(got.values()) >= 0.995 * want.sum()


def test_links_the_graph_misses_are_compared_exactly(spark, monkeypatch):
    monkeypatch.setattr(flat_graph, "BLOCK", 50, raising=False)
    monkeypatch.setattr(flat_graph, "search", lambda *given: given[0].select(F.col("item").alias("a"), F.col("item").alias("b")).limit(0))
    draw = np.random.default_rng(6)
    base = draw.normal(size=(100, 16))
    x = np.concatenate([base, base + draw.normal(scale=0.05, size=base.shape)])
    rows = spark.createDataFrame([(i, v.tolist(), i % 2) for i, v in enumerate(x)], "vec_id long, embedding array<double>, label int")
    got = {r.vec_id: r.n_links for r in flat_graph.near_duplicates(rows).collect()}
    assert got == dict(enumerate(brute_force(x))) and set(got.values()) == {1}


def test_united_edges_lead_out_of_a_shard(spark, monkeypatch):
    angles = np.radians([0, 10, 20, 90])
    x = np.stack([np.cos(angles), np.sin(angles)], axis=1).tolist()
    rows = [("s", 0), ("s", 1), ("t", 1), ("t", 2), ("t", 3)]
    members = spark.createDataFrame([(s, i, x[i], True) for s, i in rows], "shard string, item long, vector array<double>, core boolean")
    classes = spark.createDataFrame([(i, "1", v) for i, v in enumerate(x)], "item long, label string, vector array<double>")
    monkeypatch.setattr(flat_graph, "shards", lambda *given: members)
    given = (classes, 3) if flat_graph.search.__code__.co_argcount == 3 else (members,)
    assert sorted(map(tuple, flat_graph.search(*given, 0.93).collect())) == [(0, 1), (0, 2), (1, 2)]


def test_accept_works_on_rows_that_share_an_id_or_have_none(spark):
    one, two, three = (" ".join(f"{w}{i}" for i in range(40)) for w in "abc")
    near = one.replace("a39", "x")
    rows = [(1, one, "s"), (1, two, "s"), (1, two, "r"), (2, near, "s"), (None, one, "s"), (None, three, "s"), (None, three, "s"), (3, "", "s"), (4, None, "s")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = lsh_forest.accept(docs)
    assert got.columns == docs.columns
    want = [(1, one, "s"), (1, two, "r"), (None, three, "s"), (3, "", "s"), (4, None, "s")]
    assert sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, want))


def test_signatures_of_large_unrelated_sets_differ():
    draw = np.random.default_rng(7)
    one, two = (lsh_forest.signature(draw.integers(0, 2**63, 20_000, np.uint64) * np.uint64(2)) for _ in range(2))
    assert (one == two).sum() <= 1


def test_large_clusters_keep_regions_of_shallow_values(spark, monkeypatch):
    monkeypatch.setattr(lsh_forest, "REGION", 2)
    x = np.random.default_rng(8).integers(0, 2**16, (4, lsh_forest.TREES, lsh_forest.DEPTH)).astype(np.uint16)
    x[:, 0, : lsh_forest.SHALLOW] = 5
    rows = [(i, bytearray(v.tobytes())) for i, v in enumerate(x)]
    _, regions = lsh_forest.compared(spark.createDataFrame(rows, "item long, signature binary"))
    assert regions.groupBy("region").count().where("count = 4").count() == 1


def test_a_rule_needs_a_number_of_pages_not_a_share(spark):
    urls = [f"http://spam.net/win/{i}" for i in range(20)] + [f"http://fine{i % 50}.net/a/{i}" for i in range(6000)]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    labels = spark.createDataFrame([(i, int(i >= 20), 0) for i in range(len(urls))], "doc_id long, quality int, toxic int")
    got = url_rules.judge(pages, labels).groupBy("verdict").count().collect()
    assert {r["verdict"]: r["count"] for r in got} == {"block": 20, "allow": 6000}


def _plain_groups(rows, width=5):
    """Smallest id of each row's group: links of similar sets, and rows that share an id together."""
    sets = []
    for _, text in rows:
        words = (text or "").lower().split()
        sets.append({tuple(words[i : i + width]) for i in range(max(len(words) - width + 1, 1))} if words else set())
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            same = rows[i][0] is not None and rows[i][0] == rows[j][0] and sets[i] and sets[j]
            near = None not in (rows[i][0], rows[j][0]) and sets[i] and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j])
            if same or near:
                root[find(i)] = find(j)
    ids = {}
    for i, (key, _) in enumerate(rows):
        if key is not None:
            ids[find(i)] = min(ids.get(find(i), key), key)
    return sorted((str(key), text or "", None if key is None else ids[find(i)]) for i, (key, text) in enumerate(rows))


def test_ids_with_several_texts(spark):
    a, b = (" ".join(f"{c}{i}" for i in range(40)) for c in "ab")
    near = b.replace("b20", "other")
    rows = [(5, a), (5, b), (9, near), (None, near), (11, a + " more"), (12, None), (12, ""), (13, "x y"), (14, "x y")]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("text2", F.col("text"))
    got = lsh_forest.near_duplicates(df).collect()
    assert sorted((str(r.doc_id), r.component_id) for r in got) == sorted((k, c) for k, _, c in _plain_groups(rows))


def test_large_region_with_many_components(spark, monkeypatch):
    monkeypatch.setattr(lsh_forest, "REGION", 8)
    monkeypatch.setattr(lsh_forest, "SIDE", 16)
    draw = np.random.default_rng(6)
    base = [f"w{i}" for i in range(60)]
    rows = []
    for i in range(150):
        words = list(base)
        for at in draw.choice(60, int(draw.choice([0, 1, 2, 9])), replace=False):
            words[at] = f"v{i}x{at}"
        rows.append((i, " ".join(words)))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = lsh_forest.near_duplicates(df).collect()
    assert sorted((str(r.doc_id), r.component_id) for r in got) == sorted((k, c) for k, _, c in _plain_groups(rows))


def test_accept_keeps_columns_of_any_name(spark):
    text = " ".join(f"t{i}" for i in range(30))
    rows = [(3, text, "a", 1), (3, text, "a", 1), (2, text + " end", "b", 2), (None, text, "c", 3), (None, None, "d", 4), (7, "", "e", 5), (7, "", "e", 5)]
    for names in (["of", "own"], ["_node", "_of"], ["item", "body"], ["row", "mark"], ["component", "least"], ["signature", "key"]):
        df = spark.createDataFrame(rows, f"doc_id long, text string, {names[0]} string, {names[1]} int")
        got = lsh_forest.accept(df)
        assert got.columns == df.columns
        assert sorted(map(str, got.collect())) == sorted(
            f"Row(doc_id={d!r}, text={t!r}, {names[0]}={x!r}, {names[1]}={y})" for d, t, x, y in rows[2:3] + rows[4:]
        )


def test_vectors_that_share_an_id(spark):
    """Rows of one id hold their components together, also across labels; each row keeps its own links."""
    a, b, c = [1.0, 0.0, 0.0], [0.0, 1.0, 0.0], [0.0, 0.0, 1.0]
    rows = [(5, a, 1), (5, b, 1), (9, [0.01, 1.0, 0.0], 1), (7, [1.0, 0.01, 0.0], 1), (8, c, 2), (5, c, 2), (3, c, 2), (4, c, 1), (6, None, 1)]
    df = spark.createDataFrame([(i, v, n) for i, v, n in rows], "vec_id long, embedding array<double>, label long")
    got = sorted((r.vec_id, r.n_links, r.component_id, r.kept) for r in flat_graph.near_duplicates(df).collect())
    assert got == [
        (3, 2, 3, True), (4, 0, 4, True), (5, 1, 3, False), (5, 1, 3, False), (5, 2, 3, False),
        (6, 0, 6, True), (7, 1, 3, False), (8, 2, 3, False), (9, 1, 3, False),
    ]
