"""Near-duplicate vectors by a flat, robustly pruned neighbour graph.

Equal vectors of a label are one class. Classes are dealt into overlapping cluster shards of at most about
``SHARD`` members: centroids fitted on a bounded sample of a group split it, each vector goes to its ``overlap``
nearest ones, and shards that are still too large are split again, with less overlap each time but two at least. A ball of nearly equal vectors cannot be split by centroids, also where it is only a
part of its group: its core is dealt into blocks with all vectors that can link with it, and each pair of blocks that
holds one of the core is a shard, as many as its own links need. In every shard a graph of nearest
neighbours is built and pruned: a neighbour is left out if one kept before it is closer to it by ``ALPHA``.
Adjacency lists of all shards are united. Then every vector walks greedily from its shards' medoids; from its own
node and each one found within the radius, less ``SLACK``, the search goes on to their neighbours until none is
new. The search then follows united edges out of the shards: what leads from a row found to one that has no shard in
common with the query is joined with the vectors, round by round, until nothing new lies within the radius, less
``SLACK``. What is found is checked by the cosine in double precision, so no link below the radius is given.

Recall is audited against brute force: a bounded sample of queries against all classes, averaged per query, so that a
group of many links does not hide the others. Labels below ``LEAST_RECALL`` (all, if the whole sample is below) are
searched again with twice the overlap, up to ``MOST_OVERLAP``, then compared exactly, every block with every block.

Defined cases: vectors that are null, zero or hold null or non-finite components, and rows without label, link
with nothing; vectors of different length are not compared; rows that share an id are rows of their own with one
component; a null id is linked with nothing; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from floorlens.llm.components import components
from floorlens.session import pin

RADIUS = 0.93
SHARD = 1536
SAMPLE = 4096
CENTROIDS = 128
#: Vectors this close to their mean are a ball, if at least ``LEAST_BALL`` of the sample are and they fill a shard.
TIGHT, LEAST_BALL = 0.9, 32
OVERLAP, MOST_OVERLAP = 3, 12
CANDIDATES, DEGREE, ALPHA = 48, 24, 1.2
SLACK = 0.03
STEP = 1024
PAIRS = 1 << 16
AUDIT = 200
LEAST_RECALL = 0.97
#: Vectors in a block of the exact comparison.
BLOCK = 2048


def _unit(lists: pa.ListArray | pa.ChunkedArray) -> np.ndarray:
    """Vectors of one length, scaled to length 1 in double precision; the largest component first, so none overflows."""
    lists = lists.combine_chunks() if isinstance(lists, pa.ChunkedArray) else lists
    x = lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(lists), -1)
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def fit_centroids(x: np.ndarray, kinds: int) -> np.ndarray:
    """Spherical k-means with a fixed start."""
    centres = x[np.linspace(0, len(x) - 1, kinds).astype(int)]
    for _ in range(8):
        own = (x @ centres.T).argmax(axis=1)
        sums = np.zeros_like(centres)
        np.add.at(sums, own, x)
        norms = np.linalg.norm(sums, axis=1, keepdims=True)
        centres = np.where(norms > 0, sums / np.maximum(norms, 1e-300), centres)
    return centres


def balls(x: np.ndarray, least: float) -> np.ndarray:
    """Centres of balls that hold at least ``least`` rows each, the densest first."""
    out, rough = [], x.astype(np.float32)
    while len(rough) >= least:
        met = np.concatenate([(rough[at : at + 512] @ rough.T >= TIGHT).sum(axis=1) for at in range(0, len(rough), 512)])
        centre = rough[rough @ rough[met.argmax()] >= TIGHT].mean(axis=0)
        centre /= max(np.linalg.norm(centre), 1e-30)
        inside = rough @ centre >= TIGHT
        if inside.sum() < least:
            break
        out.append(centre)
        rough = rough[~inside]
    return np.array(out, np.float64).reshape(len(out), x.shape[1])


def dealt_to_balls(x: np.ndarray, centres: np.ndarray, radius: float) -> tuple[np.ndarray, np.ndarray]:
    """The ball in whose core each row is, or -1, and ``halo[row, ball]``: outside the core, but may link with it.

    Two cores meet in the halo of the first.
    """
    sims = x @ centres.T
    own = np.where(sims.max(axis=1) >= TIGHT, sims.argmax(axis=1), -1)
    halo = sims >= np.cos(min(np.arccos(TIGHT) + np.arccos(radius), np.pi)) - 1e-9
    return own, halo & ((own < 0)[:, None] | (np.arange(len(centres)) < own[:, None]))


def shards(classes: DataFrame, overlap: int, radius: float = RADIUS) -> DataFrame:
    """``shard``, ``item``, ``vector`` and ``core``: each class in at least one shard, in several where they overlap.

    Shards of a ball end with ``!``; ``core`` is false for rows of its halo, which do not all meet each other.
    """
    kind = classes.schema["item"].dataType.simpleString()
    numbers = classes.schema["vector"].dataType.simpleString()
    open_ = classes.select(F.concat_ws(":", "label", F.size("vector")).alias("shard"), "item", "vector", F.lit(True).alias("core"))
    done, rounds = [], 0
    while True:
        open_ = pin(open_)
        sizes = pin(open_.groupBy("shard").agg(F.count("*").alias("n")))
        fits = (F.col("n") <= SHARD) | F.endswith("shard", F.lit("!"))
        large = sizes.where(~fits)
        if rounds == 12 or not large.limit(1).count():
            done.append(open_)
            break
        rest = sizes.where(fits).select("shard")
        done.append(open_.join(rest, "shard", "left_semi"))
        first = F.row_number().over(Window.partitionBy("shard").orderBy(F.xxhash64("item"), "item"))
        drawn = open_.withColumn("rank", first).where(F.col("rank") <= SAMPLE).join(large, "shard")

        share = max(2, overlap >> rounds)

        def centres(group: pa.Table) -> pa.Table:
            n = group.column("n")[0].as_py()
            x = _unit(group.column("vector"))
            found = balls(x, max(min(LEAST_BALL, SHARD), SHARD * len(x) / n))
            cores, halos = [], []
            if len(found):
                own, halo = dealt_to_balls(x, found, radius)
                blocks = lambda rows: int(-(-3 * n * rows // (SHARD * len(x))))
                cores = [max(2, blocks((own == k).sum())) for k in range(len(found))]
                halos = [max(1, blocks(halo[:, k].sum())) for k in range(len(found))]
            else:
                # More shards than the mean size asks for, as their sizes differ.
                found = fit_centroids(x, min(CENTROIDS, max(2 * share, -(-8 * share * n // (5 * SHARD))), len(x)))
            return pa.table({
                "shard": group.column("shard")[:1], "cores": pa.array([cores], pa.list_(pa.int64())),
                "halos": pa.array([halos], pa.list_(pa.int64())),
                "centres": pa.array([found.ravel()], pa.list_(pa.float64())),
            })

        table = pin(
            drawn.select("shard", "n", "vector").groupBy("shard").applyInArrow(
                centres, "shard string, cores array<long>, halos array<long>, centres array<double>"
            )
        )

        def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                names = batch.column("shard").to_numpy(zero_copy_only=False)
                for name in dict.fromkeys(names.tolist()):
                    at = np.flatnonzero(names == name)
                    part = batch.take(pa.array(at))
                    cores, halos = (np.array(part.column(c)[0].as_py(), np.int64) for c in ("cores", "halos"))
                    x = _unit(part.column("vector"))
                    c = np.array(part.column("centres")[0].as_py()).reshape(-1, x.shape[1])
                    if len(cores):
                        own, halo = dealt_to_balls(x, c, radius)
                        mark, rows, near = part.column("mark").to_numpy(), [], []
                        for i in np.flatnonzero(own >= 0).tolist():
                            k = own[i]
                            block = mark[i] % cores[k]
                            names_ = [f"{k}={min(block, j)}-{max(block, j)}!" for j in range(cores[k]) if j != block]
                            names_ += [f"{k}={block}~{j}!" for j in range(halos[k])]
                            rows += [i] * len(names_)
                            near += names_
                        full = len(rows)
                        for i, k in zip(*(v.tolist() for v in np.nonzero(halo))):
                            rows += [i] * cores[k]
                            near += [f"{k}={j}~{mark[i] % halos[k]}!" for j in range(cores[k])]
                        rest = np.flatnonzero(own < 0).tolist()
                        flags = [True] * full + [False] * (len(rows) - full) + [True] * len(rest)
                        rows, near = pa.array(rows + rest, pa.int64()), near + ["rest"] * len(rest)
                    else:
                        picks = np.argsort(-(x @ c.T), axis=1)[:, : min(share, max(1, len(c) // 2))]
                        rows, near = pa.array(np.repeat(np.arange(len(at)), picks.shape[1])), picks.ravel().tolist()
                        flags = [True] * len(near)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([f"{name}/{k}" for k in near]), part.column("item").take(rows), part.column("vector").take(rows), pa.array(flags, pa.bool_())],
                        ["shard", "item", "vector", "core"])

        dealt = open_.drop("core").join(table, "shard").withColumn("mark", F.xxhash64("item"))
        open_ = dealt.mapInArrow(deal, f"shard string, item {kind}, vector {numbers}, core boolean")
        # A vector reaches one shard by several ways only through different parents, whose names differ.
        rounds += 1
    out = done[0]
    for part in done[1:]:
        out = out.union(part)
    return pin(out)


def pruned(x: np.ndarray) -> np.ndarray:
    """The closest row before each row, then its neighbours by robust pruning; -1 where there are none."""
    n = len(x)
    many = min(CANDIDATES, n - 1)
    if many < 1:
        return np.full((n, 2), -1)
    sims = x @ x.T
    np.fill_diagonal(sims, -np.inf)
    near = np.argpartition(-sims, many - 1, axis=1)[:, :many]
    order = np.argsort(-np.take_along_axis(sims, near, 1), axis=1)
    near = np.take_along_axis(near, order, 1)
    gaps = 1 - np.take_along_axis(sims, near, 1)
    alive, out, rows = np.ones(near.shape, bool), np.full((n, min(DEGREE, many)), -1), np.arange(n)
    for k in range(out.shape[1]):
        some, pick = alive.any(axis=1), alive.argmax(axis=1)
        chosen = near[rows, pick]
        out[some, k] = chosen[some]
        between = 1 - sims[chosen[:, None], near]
        alive &= ALPHA * between > gaps
        alive[rows, pick] = False
    # In a ball of nearly equal vectors few edges are left and most lead to the same rows. An edge to the closest row
    # before each one, the last of equal ones, makes a tree of all rows.
    sims[np.triu_indices(n)] = -np.inf
    before = np.where(rows > 0, n - 1 - sims[:, ::-1].argmax(axis=1), -1)
    return np.column_stack([before, out])


def adjacency(group: pa.Table) -> pa.Table:
    """``item`` and ``near`` of one shard; tree edges lead both ways, of the others at most DEGREE lead back."""
    x, items = _unit(group.column("vector")), group.column("item").combine_chunks()
    out = pruned(x)
    a = np.repeat(np.arange(len(x)), out.shape[1])
    b = out.ravel()
    tree = (np.arange(len(b)) % out.shape[1] == 0)[b >= 0]
    a, b = a[b >= 0], b[b >= 0]
    sims = np.einsum("ij,ij->i", x[a], x[b])
    # own edges first, then those that lead here, the closest ones
    order = np.lexsort((-sims, b))
    place = np.arange(len(b)) - np.searchsorted(b[order], b[order])
    extra = order[(place < DEGREE) | tree[order]]
    pairs = np.unique(np.concatenate([a * len(x) + b, b[extra] * len(x) + a[extra]]))
    owner, other = pairs // len(x), pairs % len(x)
    bounds = np.searchsorted(owner, np.arange(len(x) + 1))
    lists = pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), items.take(pa.array(other)))
    return pa.table({"item": items, "near": lists})


def found_links(x: np.ndarray, near: list[np.ndarray], radius: float) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (query, row) found within the radius, every row being a query, from the medoid of the shard."""
    n = len(x)
    width = max([len(a) for a in near] + [1])
    table = np.full((n, width), -1)
    for i, a in enumerate(near):
        table[i, : len(a)] = a
    rough, loose = x.astype(np.float32), radius - SLACK
    medoid = int((x @ x.mean(axis=0)).argmax())
    seen = np.zeros(n * n, bool)
    seen[np.arange(n) * n + medoid] = True
    seen[np.arange(n) * (n + 1)] = True

    def opened(rows: np.ndarray, nodes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Unseen neighbours of the nodes for their queries, with their similarities."""
        queries, others, sims = [], [], []
        for at in range(0, len(rows), STEP):
            new = table[nodes[at : at + STEP]]
            keys = (rows[at : at + STEP, None] * n + new)[new >= 0]
            keys = np.unique(keys[~seen[keys]])
            seen[keys] = True
            a, b = keys // n, keys % n
            queries.append(a)
            others.append(b)
            sims.append(np.einsum("ij,ij->i", rough[a], rough[b]))
        return np.concatenate(queries), np.concatenate(others), np.concatenate(sims)

    own = np.arange(n)
    best = rough @ rough[medoid]
    place, going = np.full(n, medoid), own
    start = own[(best >= loose) & (own != medoid)]
    hits = [(own, own), (start, np.full(len(start), medoid))]
    while len(going):
        a, b, sims = opened(going, place[going])
        close = sims >= loose
        hits.append((a[close], b[close]))
        order = np.lexsort((sims, a))
        a, b, sims = a[order], b[order], sims[order]
        last = np.flatnonzero(np.append(a[1:] != a[:-1], True)) if len(a) else np.empty(0, np.int64)
        last = last[sims[last] > best[a[last]]]
        going = a[last]
        place[going], best[going] = b[last], sims[last]
    pairs = [(np.concatenate([h[0] for h in hits]), np.concatenate([h[1] for h in hits]))]
    while len(pairs[-1][0]):
        a, b, sims = opened(*pairs[-1])
        close = sims >= loose
        pairs.append((a[close], b[close]))
    a, b = np.concatenate([p[0] for p in pairs]), np.concatenate([p[1] for p in pairs])
    sure = a != b
    for at in range(0, len(a), PAIRS):
        part = slice(at, at + PAIRS)
        sure[part] &= np.einsum("ij,ij->i", x[a[part]], x[b[part]]) >= radius
    return a[sure], b[sure]


def across(classes: DataFrame, members: DataFrame, united: DataFrame, links: DataFrame, radius: float) -> DataFrame:
    """Links ``a`` < ``b`` between classes without a common shard, along united edges from the ``links`` of the shards."""
    kind = members.schema["item"].dataType.simpleString()
    # All pairs of blocks with one of the core are shards, so a ball counts as one place for its core.
    place = F.xxhash64(F.regexp_replace("shard", "=[^/]*$", ""))
    places = pin(members.groupBy("item").agg(
        F.collect_set(F.when(F.col("core"), place)).alias("full"), F.collect_set(F.when(~F.col("core"), place)).alias("halo")
    ))
    named = lambda name: places.select(F.col("item").alias(name), *[F.col(c).alias(f"{name}_{c}") for c in ("full", "halo")])
    edges = united.select(F.col("item").alias("via"), F.explode("near").alias("to"))
    edges = pin(edges.join(named("via"), "via").join(named("to"), "to"))
    # Where each place of a row holds the row an edge leads to, so does the one by which the query found it.
    leaving = F.size(F.array_except(F.array_union("via_full", "via_halo"), "to_full")) > 0
    edges = edges.withColumn("leaving", leaving).drop("via_full", "via_halo")
    met = F.expr("arrays_overlap(query_full, to_full) OR arrays_overlap(query_full, to_halo) OR arrays_overlap(query_halo, to_full)")
    vectors = classes.select("item", "vector")

    def cosines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = pc.list_value_length(batch.column("v")).to_numpy(zero_copy_only=False)
            for n in np.unique(sizes).tolist():
                part = batch.take(pa.array(np.flatnonzero(sizes == n)))
                sims = np.einsum("ij,ij->i", _unit(part.column("v")), _unit(part.column("w")))
                near = part.select(["a", "b"]).append_column("sim", pa.array(sims))
                yield near.filter(pa.array(sims >= radius - SLACK))

    both = lambda pairs: pairs.select(F.col("a").alias("query"), F.col("b").alias("via")).union(pairs.select("b", "a"))
    frontier, out, tried, usable = both(links), None, None, edges.where("leaving")
    while True:
        ways = frontier.join(usable, "via").join(named("query"), "query").where("query <> to").where(~met)
        pairs = ways.select(F.least("query", "to").alias("a"), F.greatest("query", "to").alias("b")).distinct()
        if tried is not None:
            pairs = pairs.join(tried, ["a", "b"], "left_anti")
        pairs = pin(pairs)
        rows = pairs.join(vectors.select(F.col("item").alias("a"), F.col("vector").alias("v")), "a")
        rows = rows.join(vectors.select(F.col("item").alias("b"), F.col("vector").alias("w")), "b").select("a", "b", "v", "w")
        close = pin(rows.mapInArrow(cosines, f"a {kind}, b {kind}, sim double"))
        fresh = close.where(F.col("sim") >= radius).select("a", "b")
        out = fresh if out is None else out.union(fresh)
        if not close.limit(1).count():
            return out
        tried = pairs if tried is None else pin(tried.union(pairs))
        # Rows found this way have no shard in common with the query: each of their edges may lead further.
        frontier, usable = both(close), edges


def search(classes: DataFrame, overlap: int, radius: float) -> DataFrame:
    """Links ``a`` < ``b`` between classes, from the shards and the united adjacency lists."""
    members = shards(classes, overlap, radius)
    kind = members.schema["item"].dataType.simpleString()
    lists = members.groupBy("shard").applyInArrow(
        lambda g: adjacency(g.select(["item", "vector"])), f"item {kind}, near array<{kind}>"
    )
    united = pin(pin(lists).groupBy("item").agg(F.array_distinct(F.flatten(F.collect_list("near"))).alias("near")))

    def run(group: pa.Table) -> pa.Table:
        x, items = _unit(group.column("vector")), group.column("item").combine_chunks()
        lists = group.column("near").combine_chunks()
        places = pd.Index(items.to_pandas()).get_indexer(lists.flatten().to_pandas())
        ends = np.cumsum(pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False))
        near = [own[own >= 0] for own in np.split(places, ends[:-1])]
        a, b = found_links(x, near, radius)
        keys = np.unique(np.minimum(a, b) * len(x) + np.maximum(a, b))
        one, two = items.take(pa.array(keys // len(x))), items.take(pa.array(keys % len(x)))
        return pa.table({"a": pc.min_element_wise(one, two), "b": pc.max_element_wise(one, two)})

    rows = members.join(united, "item", "left").select("shard", "item", "vector", "near")
    links = pin(rows.groupBy("shard").applyInArrow(run, f"a {kind}, b {kind}").distinct())
    return pin(links.union(across(classes, members, united, links, radius)))


def exact(classes: DataFrame, radius: float) -> DataFrame:
    """All links ``a`` < ``b``: the classes of a label are dealt into blocks, and each pair of blocks is compared."""
    kind = classes.schema["item"].dataType.simpleString()
    rows = classes.select(F.concat_ws(":", "label", F.size("vector")).alias("shard"), "item", "vector")
    sizes = pin(rows.groupBy("shard").agg(F.ceil(F.count("*") / BLOCK).alias("blocks")))
    rows = rows.join(sizes, "shard").withColumn("block", F.pmod(F.xxhash64("item"), F.col("blocks")))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    rows = rows.select(
        "shard", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"), "block", "item", "vector"
    )

    def run(group: pa.Table) -> pa.Table:
        x, items = _unit(group.column("vector")), group.column("item").combine_chunks()
        first = group.column("block").to_numpy() == group.column("low")[0].as_py()
        left, right = np.flatnonzero(first), np.flatnonzero(~first)
        same = group.column("low")[0].as_py() == group.column("high")[0].as_py()
        right = left if same else right
        one, two = [], []
        for at in range(0, len(left), STEP):
            q, r = np.nonzero(x[left[at : at + STEP]] @ x[right].T >= radius)
            q = q + at
            one.append(left[q[q < r]] if same else left[q])
            two.append(right[r[q < r]] if same else right[r])
        none = [np.empty(0, np.int64)]
        one, two = (items.take(pa.array(np.concatenate(none + v))) for v in (one, two))
        return pa.table({"a": pc.min_element_wise(one, two), "b": pc.max_element_wise(one, two)})

    return pin(rows.groupBy("shard", "low", "high").applyInArrow(run, f"a {kind}, b {kind}"))


def audit(classes: DataFrame, links: DataFrame, radius: float) -> list[tuple[str, float]]:
    """Of at most ``AUDIT`` sampled classes that brute force finds links of: the label, and the share of them in ``links``."""
    drawn = classes.orderBy(F.xxhash64("item"), "item").limit(AUDIT).select("label", "item", "vector").collect()
    if not drawn:
        return []
    by_label: dict = {}
    for r in drawn:
        by_label.setdefault((r["label"], len(r["vector"])), []).append(r)
    known = {
        k: ([r["item"] for r in rows], _unit(pa.array([r["vector"] for r in rows], pa.list_(pa.float64()))))
        for k, rows in by_label.items()
    }
    kind = classes.schema["item"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = list(zip(batch.column("label").to_pylist(), batch.column("dims").to_pylist()))
            for k in dict.fromkeys(keys):
                if k not in known:
                    continue
                part = batch.take(pa.array([i for i, own in enumerate(keys) if own == k]))
                items, x = known[k]
                q, r = np.nonzero(x @ _unit(part.column("vector")).T >= radius)
                queries = pa.array([items[i] for i in q.tolist()], part.schema.field("item").type)
                yield pa.RecordBatch.from_arrays([queries, part.column("item").take(pa.array(r))], ["a", "b"])

    rows = classes.withColumn("dims", F.size("vector")).select("label", "dims", "item", "vector")
    truth = pin(rows.mapInArrow(run, f"a {kind}, b {kind}").where("a <> b").select(
        F.col("a").alias("query"), F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")
    ))
    met = truth.join(links.select("a", "b", F.lit(1).alias("met")), ["a", "b"], "left")
    shares = met.groupBy("query").agg((F.count("met") / F.count("*")).alias("share")).collect()
    labels = {r["item"]: r["label"] for r in drawn}
    return [(labels[r["query"]], r["share"]) for r in shares]


def audited(classes: DataFrame, radius: float = RADIUS) -> tuple[DataFrame, float]:
    """Links between classes and their mean recall per query on the audited sample."""
    overlap, links, open_ = OVERLAP, None, classes
    while True:
        fresh = search(open_, overlap, radius) if overlap <= MOST_OVERLAP else exact(open_, radius)
        links = fresh if links is None else pin(links.union(fresh).distinct())
        found = audit(classes, links, radius)
        recall = float(np.mean([share for _, share in found])) if found else 1.0
        by_label = pd.DataFrame(found, columns=["label", "share"]).groupby("label").share.mean()
        low = by_label.index[by_label < LEAST_RECALL].tolist()
        if not low or overlap > MOST_OVERLAP:
            return links, recall
        # A low mean speaks of labels without sampled links, too.
        open_ = classes if recall < LEAST_RECALL else classes.where(F.col("label").isin(low))
        overlap *= 2


def marked(vectors: DataFrame, key: str, vector: str, label: str) -> DataFrame:
    """``item``, ``label``, ``vector`` and ``mark``, the vector's bytes; the mark of a vector that cannot be compared is null."""
    rows = vectors.select(
        F.col(key).alias("item"), F.col(label).cast("string").alias("label"), F.col(vector).alias("vector")
    )
    if rows.schema["vector"].dataType.simpleString() != "array<float>":
        rows = rows.withColumn("vector", F.col("vector").cast("array<double>"))
    numbers = rows.schema["vector"].dataType.simpleString()
    kind = rows.schema["item"].dataType.simpleString()

    def mark(values: list | None) -> bytes | None:
        x = np.array(values or [], np.float64)  # a null component becomes NaN
        return (x + 0.0).tobytes() if len(x) and np.isfinite(x).all() and x.any() else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            marks = [mark(v) for v in batch.column("vector").to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(marks, pa.binary())], ["item", "label", "vector", "mark"])

    return rows.mapInArrow(run, f"item {kind}, label string, vector {numbers}, mark binary")


def one_id(good: DataFrame, classes: DataFrame) -> DataFrame:
    """Pairs ``a``, ``b`` that hold together the classes whose rows share an id, by the smallest class of the id."""
    often = good.groupBy("item").agg(F.count("*").alias("rows")).where("rows > 1")
    rows = good.select("label", "mark", "item").join(often, "item", "left_semi").withColumnRenamed("item", "id")
    members = rows.join(classes.select("label", "mark", "item"), ["label", "mark"]).select("id", "item").distinct()
    first = members.groupBy("id").agg(F.min("item").alias("a"))
    return members.join(first, "id").where("a <> item").select("a", F.col("item").alias("b"))


def near_duplicates(
    vectors: DataFrame, radius: float = RADIUS, key: str = "vec_id", vector: str = "embedding", label: str = "label"
) -> DataFrame:
    """Per row: key, ``n_links`` (other rows linked directly), ``component_id`` and ``kept``."""
    rows = marked(vectors, key, vector, label)
    good = rows.where("item IS NOT NULL AND label IS NOT NULL AND mark IS NOT NULL")
    classes = pin(
        good.groupBy("label", "mark").agg(F.min("item").alias("id"), F.first("vector").alias("vector"), F.count("*").alias("n"))
        .withColumn("item", F.monotonically_increasing_id())  # a class is searched by a number of its own
    )
    links, _ = audited(classes, radius)
    both = links.union(links.select("b", "a"))
    counts = both.join(classes.select(F.col("item").alias("b"), "n"), "b").groupBy("a").agg(F.sum("n").alias("others"))
    found = components(links.union(one_id(good, classes)))
    joined = pin(
        classes.join(counts, F.col("item") == F.col("a"), "left").join(found, F.col("item") == F.col("node"), "left")
        .select("label", "mark", "id", (F.coalesce("others", F.lit(0)) + F.col("n") - 1).alias("n_links"),
                F.coalesce("component", "item").alias("of"))
    )
    least = joined.groupBy("of").agg(F.min("id").alias("component"))
    known = pin(joined.join(least, "of").select("label", "mark", "n_links", "component"))
    # Rows without class have a null label, mark or item, so the left join leaves them alone.
    out = rows.withColumn("label", F.when(F.col("item").isNotNull(), F.col("label"))).join(known, ["label", "mark"], "left")
    component = F.coalesce("component", "item")
    return out.select(
        F.col("item").alias(key), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"), F.col("item").eqNullSafe(component).alias("kept"),
    )
