"""Prefix tree of conversations by Spark SQL's ROLLUP over columns of turn ids.

A conversation is a sequence of turns; each distinct sequence of its first turns is a node. Sequences are cut into
blocks of ``WIDTH`` positions, one row each with a column per position, keyed by the node the blocks before lead to.
One ``ROLLUP`` over the columns, within block and key, gives every prefix of every block its members and
their smallest id; long conversations simply have more blocks. A node is named by two 64-bit numbers, the exclusive or of
the hashes of its turns and places, so the name of a block's key is a running aggregate and all blocks go
through one plan.

Sums over subtrees need no recursion: each node is owned by its smallest member, whose nodes form the lower end of
its path. A second ``ROLLUP`` adds what the members of a prefix own; the owner counts from the node downwards.

Skew: turns are ranked within ranges of complete sort positions, running sums within stretches of ``STRETCH`` places,
so one conversation may hold any share of the turns; what ``ROLLUP`` groups is combined before the shuffle. Ids
of conversations that end at a node are joined into texts of at most ``IDS`` ids in parallel, and the hash streams over these.

Defined cases: rows without conversation id are left out; null roles and texts are empty ones; turns come in the
order of ``turn`` (null first), ties by a hash of their content; equal turns stay; an empty table gives no nodes. Further
columns are not read. Turns are told apart by 128 bits of hash.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from floorlens.session import pin

WIDTH = 8
STRETCH = 512
IDS = 1 << 14
HEAD, GROUP = 6, 100
COLUMNS = [f"t{i}" for i in range(WIDTH)]
EMPTY = hashlib.sha256(b"").hexdigest()


def turn_ids(conversations: DataFrame) -> DataFrame:
    """``conv``, ``turn`` and ``id``: hash and code points of the text."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    mark = F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text))
    return conversations.where("conv_id IS NOT NULL").select(
        F.col("conv_id").alias("conv"), "turn", F.concat(mark, F.lit(":"), F.length(text).cast("string")).alias("id")
    )


def placed(turns: DataFrame) -> DataFrame:
    """``conv``, ``pos`` (from 0) and ``id``: turns ranked by range, with those of the ranges before added."""
    parts = int(turns.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = ["turn", "id", "row"]
    rows = turns.withColumn("row", F.monotonically_increasing_id()).repartitionByRange(parts, "conv", *order)
    rows = pin(rows.withColumn("part", F.spark_partition_id()))
    counts = rows.groupBy("conv", "part").agg(F.count("*").alias("n"))
    earlier = Window.partitionBy("conv").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    before = counts.select("conv", "part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    rank = F.row_number().over(Window.partitionBy("conv", "part").orderBy(*order))
    ranked = rows.withColumn("rank", rank).join(before, ["conv", "part"])
    return pin(ranked.select("conv", (F.col("before") + F.col("rank") - 1).cast("long").alias("pos"), "id"))


def rebuilt(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Conversations whose first turns are those of the first conversation of their hundred: turns, and all ids.

    As many first turns are exchanged as the checksum of the id says, below ``HEAD``.
    """
    many = F.crc32(F.col("conv").cast("string").cast("binary")) % HEAD
    heads = turns.where(F.col("pos") < HEAD - 1).groupBy("conv").agg(
        F.sort_array(F.collect_list(F.struct("pos", "id"))).alias("head")
    )
    convs = turns.groupBy("conv").agg(F.lit(0).alias("_")).select("conv", many.alias("h"))
    base = (F.col("conv") - F.col("conv") % GROUP).alias("base")
    given = convs.select("conv", "h", base).join(heads.select(F.col("conv").alias("base"), "head"), "base", "left")
    given = pin(given.select("conv", "h", F.coalesce(F.slice("head", 1, F.col("h").cast("int")), F.array()).alias("head")))
    first = given.select("conv", F.inline("head"))
    sizes = given.select("conv", "h", F.size("head").alias("size"))
    rest = turns.join(sizes, "conv").where("pos >= h").select("conv", (F.col("pos") - F.col("h") + F.col("size")).alias("pos"), "id")
    return first.union(rest), given.select("conv")


def _running(rows: DataFrame, key: str, place: str, sums: dict[str, str]) -> DataFrame:
    """The exclusive or (``x_before``) or sum (``s_before``) of columns over the rows before, within ``key``.

    Rows are dealt by key and stretch of places; totals of the stretches before are added.
    """
    gather = {"xor": F.bit_xor, "sum": F.sum}
    stretch = F.floor(F.col(place) / STRETCH).cast("long")
    rows = rows.withColumn("stretch", stretch)
    zero = F.lit(0).cast("long")
    totals = rows.groupBy(key, "stretch").agg(*[gather[how](c).alias(f"{c}_own") for c, how in sums.items()])
    earlier = Window.partitionBy(key).orderBy("stretch").rowsBetween(Window.unboundedPreceding, -1)
    totals = totals.select(
        key, "stretch", *[F.coalesce(gather[how](f"{c}_own").over(earlier), zero).alias(f"{c}_far") for c, how in sums.items()]
    )
    within = Window.partitionBy(key, "stretch").orderBy(place).rowsBetween(Window.unboundedPreceding, -1)
    out = rows.withColumns({f"{c}_near": F.coalesce(gather[how](c).over(within), zero) for c, how in sums.items()})
    out = out.join(totals, [key, "stretch"])
    joined = {"xor": lambda a, b: a.bitwiseXOR(b), "sum": lambda a, b: a + b}
    return out.select(
        *[c for c in rows.columns if c != "stretch"],
        *[joined[how](F.col(f"{c}_near"), F.col(f"{c}_far")).alias(f"{c}_before") for c, how in sums.items()],
    )


def _hash(pos: Column, turn: Column, salt: int) -> Column:
    return F.xxhash64(F.lit(salt), pos, turn)


def _key(salt: int, parent: bool = False) -> Column:
    """Name of the node of a row of ``ROLLUP``: that of the block, and the hashes of its own turns."""
    out = F.col(f"p{salt}")
    for i, c in enumerate(COLUMNS):
        inside = F.col("level") > (i + 1 if parent else i)
        own = _hash(F.col("block") * WIDTH + i, F.col(c), salt)
        out = out.bitwiseXOR(F.when(inside, own).otherwise(F.lit(0).cast("long")))
    return out


def blocks(turns: DataFrame, convs: DataFrame) -> DataFrame:
    """One row per conversation and block: turn ids by position, and the name ``p1``, ``p2`` of the block's key."""
    pos = F.col("pos").cast("long")
    rows = turns.select("conv", pos.alias("pos"), "id").union(convs.select("conv", F.lit(0).cast("long"), F.lit(None).cast("string")))
    there = F.col("id").isNotNull()
    own = rows.withColumn("block", F.floor(F.col("pos") / WIDTH).cast("long")).groupBy("conv", "block").agg(
        F.sort_array(F.collect_list(F.when(there, F.struct("pos", "id")))).alias("own"),
        *[F.coalesce(F.bit_xor(F.when(there, _hash(F.col("pos"), F.col("id"), s))), F.lit(0).cast("long")).alias(f"b{s}") for s in (1, 2)],
    )
    own = own.select("conv", "block", "b1", "b2", *[F.get("own", F.lit(i))["id"].alias(c) for i, c in enumerate(COLUMNS)])
    keyed = _running(own, "conv", "block", {"b1": "xor", "b2": "xor"})
    return pin(keyed.withColumnsRenamed({"b1_before": "p1", "b2_before": "p2"}))


def _rolled(rows: DataFrame, sums: str) -> DataFrame:
    """One row per prefix within each block: ``level`` turns of the block and the aggregates.

    A conversation that ends inside the block has nulls behind its last turn; those groups are no prefixes, and
    the whole of a later block is the last node of the block before.
    """
    names = ", ".join(COLUMNS)
    grouped = rows.sparkSession.sql(
        f"SELECT block, p1, p2, {names}, CAST({WIDTH} - bit_count(grouping_id()) AS INT) AS level, {sums} "
        f"FROM {{rows}} GROUP BY block, p1, p2, ROLLUP ({names})",
        rows=rows,
    )
    last = F.get(F.array(*COLUMNS), F.col("level") - 1)
    return grouped.where(F.when(F.col("level") == 0, F.col("block") == 0).otherwise(last.isNotNull())).withColumn("last", last)


def end_hashes(ends: DataFrame, at_once: int = IDS) -> DataFrame:
    """``k1``, ``k2`` and the SHA-256 of the ids that end there, in ascending order, joined by commas.

    Runs of ids become texts where they lie; a node's hash then reads its texts one after the other.
    """
    parts = int(ends.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b = (batch.column(i).to_numpy() for i in (0, 1))
            new = np.flatnonzero(np.concatenate([[True], (a[1:] != a[:-1]) | (b[1:] != b[:-1])])) if len(a) else np.empty(0, int)
            stops = np.append(new[1:], len(a)) if len(a) else new
            cuts = np.array([c for low, high in zip(new.tolist(), stops.tolist()) for c in range(low, high, at_once)], np.int64)
            bounds = pa.array(np.append(cuts, len(a)).astype(np.int32))
            joined = pc.binary_join(pa.ListArray.from_arrays(bounds, pc.cast(batch.column(2), pa.string())), ",")
            first = [batch.column(i).take(pa.array(cuts)) for i in range(3)]
            yield pa.RecordBatch.from_arrays([*first, joined], ["k1", "k2", "first", "ids"])

    def hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, state = None, None
        schema = pa.schema([("k1", pa.int64()), ("k2", pa.int64()), ("ends_sha256", pa.string())])
        for batch in batches:
            out = []
            for a, b, _, ids in zip(*(c.to_pylist() for c in batch.columns)):
                if (a, b) != key:
                    if key is not None:
                        out.append((*key, state.hexdigest()))
                    key, state = (a, b), hashlib.sha256()
                else:
                    state.update(b",")
                state.update(ids.encode())
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out)], schema=schema)
        if key is not None:
            yield pa.RecordBatch.from_arrays([pa.array([v]) for v in (*key, state.hexdigest())], schema=schema)

    kind = ends.schema["conv"].dataType.simpleString()
    order = ["k1", "k2", "conv"]
    chunks = ends.select(*order).repartitionByRange(parts, *order).sortWithinPartitions(*order).mapInArrow(
        texts, f"k1 long, k2 long, first {kind}, ids string"
    )
    by_node = chunks.repartition(parts, "k1", "k2").sortWithinPartitions("k1", "k2", "first")
    return by_node.mapInArrow(hashes, "k1 long, k2 long, ends_sha256 string")


def trie(turns: DataFrame, convs: DataFrame) -> DataFrame:
    """One row per node of the sequences ``conv``, ``pos``, ``id``; ``convs`` lists all ids, turnless ones too.

    ``k1``, ``k2`` name the node, ``q1``, ``q2`` its parent.
    """
    rows = blocks(turns, convs)
    found = _rolled(rows, "count(*) AS n_convs, min(conv) AS conv")
    depth = F.col("block") * WIDTH + F.col("level")
    length = F.substring_index("last", ":", -1).cast("long")
    nodes = pin(found.select(
        _key(1).alias("k1"), _key(2).alias("k2"), _key(1, True).alias("q1"), _key(2, True).alias("q2"),
        depth.alias("depth"), "conv", "n_convs",
        F.coalesce((F.col("n_convs") - 1) * length, F.lit(0)).cast("long").alias("saved"),
    ))
    ends = rows.groupBy("conv").agg(F.bit_xor("b1").alias("k1"), F.bit_xor("b2").alias("k2"))
    below = nodes.where("depth > 0").groupBy(F.col("q1").alias("k1"), F.col("q2").alias("k2")).agg(F.count("*").alias("n_children"))
    parents = nodes.select(F.col("k1").alias("q1"), F.col("k2").alias("q2"), F.col("conv").alias("parent_conv"))
    upper = F.col("depth") > 0
    whole = nodes.join(below, ["k1", "k2"], "left").join(end_hashes(ends), ["k1", "k2"], "left").join(parents, ["q1", "q2"], "left")
    whole = pin(whole.withColumns({
        "parent_conv": F.when(upper, F.col("parent_conv")), "n_children": F.coalesce("n_children", F.lit(0)),
        "leaf": F.col("n_children").isNull().cast("long"), "ends_sha256": F.coalesce("ends_sha256", F.lit(EMPTY)),
    }))
    owned = whole.groupBy("conv").agg(F.sum("saved").alias("all_saved"), F.sum("leaf").alias("all_leaves"))
    none = F.lit(0).cast("long")
    weighted = rows.join(owned, "conv", "left").withColumns({c: F.coalesce(c, none) for c in ("all_saved", "all_leaves")})
    sums = _rolled(weighted, "sum(all_saved) AS members_saved, sum(all_leaves) AS members_leaves")
    sums = sums.select(_key(1).alias("k1"), _key(2).alias("k2"), "members_saved", "members_leaves")
    # The owner of a node owns all below on its own path; what it owns above the node does not belong to the subtree.
    return _running(whole, "conv", "depth", {"saved": "sum", "leaf": "sum"}).join(sums, ["k1", "k2"]).select(
        F.col("conv").alias("conv_id"), F.col("depth").cast("long").alias("depth"), F.col("parent_conv").alias("parent_conv_id"),
        "n_convs", "n_children", (F.col("members_leaves") - F.col("leaf_before")).alias("n_leaves"),
        (F.col("members_saved") - F.col("saved_before")).alias("saved_tokens"), "ends_sha256", "k1", "k2", "q1", "q2",
    )
