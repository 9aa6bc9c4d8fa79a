"""Prefix trees of conversations against a plain tree."""

import collections
import hashlib
import math
import random
import zlib

from pyspark.sql import functions as F

from floorlens.llm import prefix_trie

KIND = "conv_id long, turn long, role string, text string, id int, pos int, block string, level string, p1 string, conv string"


def frame(spark, rows):
    return spark.createDataFrame([(*r, 1, 2, "b", "l", "p", "c") for r in rows], KIND)


def content(row):
    role, text = row[2] or "", row[3] or ""
    return hashlib.md5(f"{len(role)}:{role}{text}".encode()).hexdigest() + f":{len(text)}"


def plain(rows):
    own = collections.defaultdict(list)
    for r in rows:
        if r[0] is not None:
            own[r[0]].append(((r[1] is not None, r[1] or 0, content(r)), content(r)))
    own = {c: [t for _, t in sorted(turns)] for c, turns in own.items()}
    paths = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        paths[c] = tuple(own.get(c - int(math.fmod(c, 100)), [])[:h] + turns[h:])
    members = collections.defaultdict(list)
    for c in sorted(paths):
        for d in range(len(paths[c]) + 1):
            members[paths[c][:d]].append(c)
    children, saved, leaves = collections.Counter(p[:-1] for p in members if p), collections.Counter(), collections.Counter()
    for p, ids in members.items():
        for d in range(len(p) + 1):
            saved[p[:d]] += (len(ids) - 1) * int(p[-1].split(":")[1]) if p else 0
            leaves[p[:d]] += not children[p]
    return sorted(
        (ids[0], len(p), members[p[:-1]][0] if p else -1, len(ids), children[p], leaves[p], saved[p],
         hashlib.sha256(",".join(str(c) for c in ids if len(paths[c]) == len(p)).encode()).hexdigest())
        for p, ids in members.items()
    )


def found(df):
    turns = prefix_trie.placed(prefix_trie.turn_ids(df))
    got = prefix_trie.trie(*prefix_trie.rebuilt(turns)).drop("k1", "k2", "q1", "q2")
    assert got.columns == ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    return sorted(tuple(-1 if v is None else v for v in r) for r in got.collect())


def test_branches_over_several_blocks(spark, monkeypatch):
    monkeypatch.setattr(prefix_trie, "STRETCH", 3)
    rng, rows = random.Random(8), []
    for c in list(range(0, 60)) + list(range(150, 170)) + [700, 705, 1_000_003]:
        kind, long = rng.randrange(3), rng.choice([1, 3, 8, 9, 16, 17, 26])
        for t in range(long):
            word = "ü" * (t % 5) if rng.random() < 0.97 else f"own {c}"
            rows.append((c, t, "user" if t % 2 else "bot", f"{kind if t else 0} {word}"))
    assert found(frame(spark, rows)) == plain(rows)


def test_odd_rows(spark):
    rows = [
        (100, 1, "a", "x"), (100, None, None, None), (100, 0, "a", ""), (101, 1, "a", "x"), (101, 1, "a", "x"), (101, 1, "b", "y"),
        (None, 0, "a", "lost"), (205, 0, "u", "alone"), (312, 3, "u", "z"), (399, 0, "", None), (-7, 0, "u", "below"),
        *[(500 + i, t, "u", "same") for i in range(40) for t in range(9)],
    ]
    # The remainder of a negative id is negative in SQL: -7 belongs to the hundred of 0.
    assert found(frame(spark, rows)) == plain(rows)
    assert found(frame(spark, rows).where(F.lit(False))) == []
    assert found(frame(spark, [(None, 1, "a", "b")])) == []


def test_one_conversation_with_most_turns(spark, monkeypatch):
    monkeypatch.setattr(prefix_trie, "STRETCH", 4)
    rows = [(0, t, "u", str(t % 3)) for t in range(300)] + [(c, t, "u", str(t % 3)) for c in range(1, 5) for t in range(290)]
    assert found(frame(spark, rows)) == plain(rows)


def test_hash_of_many_ids(spark):
    ends = spark.range(1000).select(F.lit(1).alias("k1"), F.col("id").alias("conv"), (F.col("id") % 3).alias("k2"))
    ends = ends.select(F.col("k1").cast("long"), "k2", "conv")
    got = {(r.k1, r.k2): r.ends_sha256 for r in prefix_trie.end_hashes(ends, at_once=7).collect()}
    assert got == {(1, k): hashlib.sha256(",".join(str(c) for c in range(k, 1000, 3)).encode()).hexdigest() for k in range(3)}
