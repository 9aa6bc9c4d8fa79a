import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from floorlens.operators.ranks import Ranking, with_global_ranks

KINDS = ["row_number", "rank", "dense_rank", "percent_rank", "average_pct", "ntile:4", "ntile:7"]
SHAPES = {
    "ties": lambda rng, i: rng.randrange(40),
    "hot": lambda rng, i: 7 if i % 3 else rng.randrange(1000),
    "nulls": lambda rng, i: None if i % 4 == 0 else rng.randrange(60),
    "mostly_null": lambda rng, i: None if i % 3 else i,
    "single": lambda rng, i: i * 7919 % 100_003,
    "constant": lambda rng, i: 1,
}


def _frame(spark, n=2500):
    rng = random.Random(5)
    rows = [(f"e{rng.random():.6f}{i}", *(draw(rng, i) for draw in SHAPES.values())) for i in range(n)]
    return spark.createDataFrame(rows, "id string, " + ", ".join(f"{s} long" for s in SHAPES))


def _plain(shape, descending):
    """The same ranks by windows over all rows."""
    by = F.col(shape).desc() if descending else F.col(shape).asc()
    full, keyed, everything = Window.orderBy(by, "id"), Window.orderBy(by), Window.partitionBy(F.lit(1))
    ties = F.count("*").over(Window.partitionBy(shape))
    return {
        "row_number": F.row_number().over(full), "rank": F.rank().over(keyed), "dense_rank": F.dense_rank().over(keyed),
        "percent_rank": F.percent_rank().over(keyed), "ntile:4": F.ntile(4).over(full), "ntile:7": F.ntile(7).over(full),
        "average_pct": (F.rank().over(keyed) + (ties - 1) / 2) / F.count("*").over(everything),
    }


def _sorted(df):
    rows = sorted(df.collect(), key=lambda r: r["id"])
    return [tuple(round(x, 9) if isinstance(x, float) else x for x in r) for r in rows]


@pytest.mark.parametrize("descending", [False, True])
@pytest.mark.parametrize("per_range", [100, 1_000_000])
def test_matches_plain_windows(spark, descending, per_range):
    df = _frame(spark)
    names = {s: {f"{s} {k}": k for k in KINDS} for s in SHAPES}
    got = with_global_ranks(df, [Ranking(s, names[s], descending) for s in SHAPES], ["id"], rows_per_range=per_range)
    want = df.select("*", *[_plain(s, descending)[k].alias(n) for s in SHAPES for n, k in names[s].items()])
    got_rows, want_rows = _sorted(got), _sorted(want.select(*got.columns))
    assert got_rows == want_rows


def test_composite_tie_break(spark):
    df = spark.createDataFrame([(1.0, f"d{i % 7}", f"m{i}") for i in range(500)], "v double, day string, machine string")
    got = with_global_ranks(df, [Ranking("v", {"n": "row_number"})], ["day", "machine"], rows_per_range=40)
    ordered = [(r["day"], r["machine"]) for r in got.orderBy("n").collect()]
    assert ordered == sorted(ordered) and got.agg(F.max("n")).first()[0] == 500


def test_fewer_rows_than_buckets(spark):
    df = spark.createDataFrame([("a", 3), ("b", 1)], "id string, v long")
    got = with_global_ranks(df, [Ranking("v", {"n": "ntile:5"})], ["id"])
    assert {r["id"]: r["n"] for r in got.collect()} == {"b": 1, "a": 2}


def test_empty_input(spark):
    df = spark.createDataFrame([], "id string, v long")
    assert with_global_ranks(df, [Ranking("v", {"n": "ntile:5", "r": "rank"})], ["id"]).count() == 0
