import random
from datetime import date

import pytest
from pyspark.sql import functions as F

from floorlens.ml import evaluation
from floorlens.operators import lookups
from floorlens.operators.running import sums_before
from tests.fixtures import rows


@pytest.mark.parametrize("ranges", [None, 1, 3, 40])
def test_sums_before_do_not_depend_on_ranges(spark, ranges):
    rng = random.Random(7)
    data = [("hot" if i % 3 else rng.choice(["a", None]), i, rng.choice([None, 1, 2, 5])) for i in range(600)]
    df = spark.createDataFrame(data, "g string, k long, v long").repartition(5)
    got = {(r["g"], r["k"]): r["before"] for r in rows(sums_before(df, ["k"], {"before": "v"}, ["g"], ranges))}
    held = {}
    for g, k, v in sorted(data, key=lambda r: r[1]):
        assert got.pop((g, k)) == held.get(g, 0)
        held[g] = held.get(g, 0) + (v or 0)
    assert not got


def test_sums_before_of_whole_table_null_key_first(spark):
    df = spark.createDataFrame([(3, 1), (None, 7), (1, 2)], "k int, v int")
    assert {r["k"]: r["s"] for r in rows(sums_before(df, ["k"], {"s": "v"}, ranges=2))} == {None: 0, 1: 7, 3: 9}
    assert rows(sums_before(df.limit(0), ["k"], {"s": "v"})) == []


def test_curves_have_their_end_points(spark):
    df = spark.createDataFrame([(1, 0.9), (0, 0.2)], "y int, s double")
    roc = [tuple(r.asDict().values()) if hasattr(r, "asDict") else tuple(r.values()) for r in rows(evaluation.roc_points(df, "y", "s"))]
    assert roc == [(None, 0.0, 0.0), (0.9, 0.0, 1.0), (0.2, 1.0, 1.0)]
    last = rows(evaluation.precision_recall_points(df, "y", "s"))[0]
    assert (last["threshold"], last["precision"], last["recall"]) == (None, 1.0, 0.0)


def test_report_averages(spark):
    df = spark.createDataFrame([(1, 1), (1, 0), (0, 0), (0, 0), (0, 1)], "y int, p int")
    found = {r["average"]: r for r in rows(evaluation.report_averages(evaluation.class_report(df, "y", "p")))}
    assert found["accuracy"]["precision"] == pytest.approx(3 / 5) and found["accuracy"]["support"] == 5
    assert found["macro avg"]["recall"] == pytest.approx((1 / 2 + 2 / 3) / 2)
    assert found["weighted avg"]["precision"] == pytest.approx((2 * 1 / 2 + 3 * 2 / 3) / 5)


@pytest.mark.parametrize("order", [["score", "+day", "+id"], ["+score", "day", "id"]])
def test_pages_by_key_equal_pages_by_offset(spark, order):
    rng = random.Random(11)
    days = [None, *[date(2000, 1, d) for d in (1, 2, 3)]]
    data = [(i, rng.choice([None, 0.5, 0.5, 1.5]), rng.choice(days), i) for i in range(83)]  # many ties, nulls
    df = spark.createDataFrame(data, "id int, score double, day date, other int").repartition(4)
    after, page = None, 1
    while True:
        by_offset = [r.asDict() for r in lookups.page_of(df, order, page, 10).collect()]
        by_key = by_offset if after is None else [r.asDict() for r in lookups.page_of(df, order, page_size=10, after=after).collect()]
        assert by_key == by_offset
        if not by_offset:
            break
        after, page = by_offset[-1], page + 1
    assert page == 10


def test_a_page_by_key_sorts_one_page_per_task(spark):
    df = spark.range(1000).withColumn("score", F.col("id") % 7)
    plan = lookups.page_of(df, ["score", "+id"], page_size=5, after={"score": 3, "id": 500})._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject(limit=5" in plan
