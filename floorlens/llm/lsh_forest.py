"""Near-duplicate documents by an LSH forest over MinHash signatures, confirmed on full sets.

A document's set are the hashes of its distinct shingles of ``width`` words. Documents with equal sets are one
class, whatever their ids. A forest of ``TREES`` trees orders the classes by ``DEPTH`` signature
values each, and every order is sorted across the cluster by complete sort positions, so no prefix, however
common, lies in one task. Neighbours in an order that share a prefix of ``SHALLOW`` values are joined into
candidate clusters: a pair of similarity 0.8 shares one with probability 1 - (1 - 0.8^4)^20 > 0.9999.

The depth adapts to the region. A cluster of up to ``REGION`` classes is compared as a whole, without classes whose
signature agrees with no other in ``LEAST`` of its values (a pair of similarity 0.8 stays below with a probability
under 1e-6). A larger one is cut into its regions of ``SHALLOW`` equal values in each tree, so a pair meets in a
region as surely as it shares a cluster, in two rounds. The first compares, in ``FIRST`` trees, each class
within its block of at most about ``REGION``. The second compares, in the regions of all trees that still hold more
than one component, the classes outside the largest component with all others whose signature is like theirs; classes
already connected need no further link. All comparisons are exact, on the full sets, and give a spanning forest of
the confirmed links, from which components are found.

The plan is the same at every size: texts are read once more, in one sort-merge join with the classes to compare.

Defined cases: a text without words, or null, has an empty set and is linked with nothing; a shorter text than
``width`` words has its whole sequence as its one shingle; a null id is linked with nothing and kept; rows that
share an id are one node with all their sets; an empty table gives no rows. Further columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from floorlens.llm.components import components
from floorlens.llm.words import Memo, strings, text_batches, words_of
from floorlens.session import pin, unpin

TREES, DEPTH, SHALLOW = 20, 6, 4
REGION, SIDE = 128, 1024
FIRST = 3
STAR = 64
LEAST = 0.6
PERCENT = 80
CHUNK = 1 << 12
_draw = np.random.default_rng(99)
MULTIPLIERS = _draw.integers(0, 2**63, TREES * DEPTH, np.uint64) * np.uint64(2) + np.uint64(1)
OFFSETS = _draw.integers(0, 2**63, TREES * DEPTH, np.uint64)
PLACES = _draw.integers(0, 2**63, 64, np.uint64) * np.uint64(2) + np.uint64(1)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _hash_words(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    hashes = np.fromiter((xxhash.xxh3_64_intdigest(w) for w in words), np.uint64, len(words))
    return np.ones(len(words), np.int64), hashes


def shingle_sets(texts: pa.Array, width: int, memo: Memo) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    offsets, codes, names = words_of(texts, lower=True)
    places = memo.places(strings(names))
    hashes = memo.values[memo.starts[places]][codes]
    many = max(len(hashes) - width + 1, 0)
    windows = np.full(many, width, np.uint64)
    for j in range(width):
        windows += hashes[j : j + many] * PLACES[j]
    windows = _mixed(windows)
    for low, high in zip(offsets.tolist(), offsets[1:].tolist()):
        if high - low >= width:
            yield np.unique(windows[low : high - width + 1])
        else:
            own = hashes[low:high]
            yield _mixed(np.array([len(own) + int((own * PLACES[: len(own)]).sum())], np.uint64)) if len(own) else own


def signature(shingles: np.ndarray) -> np.ndarray:
    out = np.full(TREES * DEPTH, 2**64 - 1, np.uint64)
    for at in range(0, len(shingles), CHUNK):
        part = np.multiply.outer(MULTIPLIERS, shingles[at : at + CHUNK])
        part += OFFSETS[:, None]
        np.minimum(out, part.min(axis=1), out=out)
    # The high bits of the minimum of a large set are all zeros, so bits of its mixture are kept.
    return (_mixed(out) & np.uint64(0xFFFF)).astype(np.uint16)


def signatures(rows: DataFrame, width: int) -> DataFrame:
    """The columns beside ``body``, ``n_shingles``, ``mark`` (of the set) and ``signature``; nulls for an empty set."""
    carried = [c for c in rows.columns if c != "body"]
    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema if f.name != "body")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo = Memo(_hash_words)
        for batch in batches:
            for part in text_batches(batch, "body"):
                sizes, marks, rows = [], [], []
                for own in shingle_sets(part.column("body"), width, memo):
                    sizes.append(len(own))
                    marks.append(xxhash.xxh3_128_digest(own.tobytes()) if len(own) else None)
                    rows.append(signature(own).tobytes() if len(own) else None)
                yield pa.RecordBatch.from_arrays(
                    [*[part.column(c) for c in carried], pa.array(sizes, pa.int64()), pa.array(marks, pa.binary()), pa.array(rows, pa.binary())],
                    [*carried, "n_shingles", "mark", "signature"])

    return rows.mapInArrow(run, f"{kinds}, n_shingles long, mark binary, signature binary")


VALUES = [f"v{i}" for i in range(DEPTH)]


def orders(classes: DataFrame, trees: range = range(TREES)) -> DataFrame:
    """One row per class and tree with the tree's signature values and the class's ``label``."""
    kind = classes.schema["item"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 5000):
                part = batch.slice(at, 5000)
                matrix = np.frombuffer(b"".join(part.column(1).to_pylist()), np.int16).reshape(part.num_rows, TREES, DEPTH)
                for tree in trees:
                    own = np.ascontiguousarray(matrix[:, tree].T)
                    yield pa.RecordBatch.from_arrays(
                        [part.column(0), part.column(2), pa.array(np.full(part.num_rows, tree, np.int32)), *map(pa.array, own)],
                        ["item", "label", "tree", *VALUES])

    return classes.select("item", "signature", "label").mapInArrow(run, f"item {kind}, label {kind}, tree int, " + ", ".join(f"{v} short" for v in VALUES))


def neighbours(rows: DataFrame) -> DataFrame:
    """``a`` and ``b``: links between the labels of neighbours in an order with a common prefix of ``SHALLOW`` values or more.

    Neighbours of one label need no link. A run of such neighbours is linked as stars of up to ``STAR`` rows, centre to
    centre, so paths are short and no row has many links. Each task links the rows it holds; its first and last row are
    linked with those of the tasks beside it in a second step over these alone.
    """
    kind = rows.schema["item"].dataType.simpleString()
    carried = ["item", "label", "tree", *VALUES]
    names = ["a", "b", *carried]
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = None
        for batch in batches:
            if not batch.num_rows:
                continue
            held = pa.Table.from_batches(([last] if last is not None else []) + [batch]).combine_chunks().to_batches()[0]
            keys = np.stack([held.column(n).to_numpy() for n in ["tree", *VALUES]])
            linked = (keys[: SHALLOW + 1, 1:] == keys[: SHALLOW + 1, :-1]).all(axis=0)
            hit = np.flatnonzero(linked)
            labels = held.column("label")
            none = lambda n: [pa.nulls(n, held.schema.field(c).type) for c in carried]
            if len(hit):
                first = np.maximum.accumulate(np.where(np.insert(linked, 0, False), 0, np.arange(len(linked) + 1)))
                centre = first[hit] + (hit - first[hit]) // STAR * STAR
                links_ = pa.RecordBatch.from_arrays([labels.take(pa.array(centre)), labels.take(pa.array(hit + 1)), *none(len(hit))], names)
                yield links_.filter(pc.not_equal(links_.column(0), links_.column(1)))
            edge = lambda row: pa.RecordBatch.from_arrays(
                [pa.nulls(1, labels.type), pa.nulls(1, labels.type), *[row.column(c) for c in carried]], names)
            if last is None:
                yield edge(held.slice(0, 1))
            last = held.slice(held.num_rows - 1, 1)
        if last is not None:
            yield edge(last)

    order = ["tree", *VALUES, "item"]
    found = pin(
        rows.repartitionByRange(parts, *order).sortWithinPartitions(*order).mapInArrow(
            run, f"a {kind}, b {kind}, item {kind}, label {kind}, tree int, " + ", ".join(f"{v} short" for v in VALUES)
        )
    )
    before = Window.partitionBy("tree").orderBy(*VALUES, "item")
    equal = F.lit(True)
    for v in VALUES[:SHALLOW]:
        equal = equal & (F.col(v) == F.lag(v).over(before))
    edges = found.where("tree IS NOT NULL").select(F.lag("label").over(before).alias("a"), F.col("label").alias("b"), equal.alias("equal"))
    return found.where("tree IS NULL").select("a", "b").union(edges.where("equal AND a <> b").select("a", "b"))


def similar(tasks: DataFrame) -> DataFrame:
    """``task`` and ``item``: the members of tasks whose ``signature`` is like that of a member of another ``component``."""

    def run(group: pa.Table) -> pa.Table:
        x = np.frombuffer(b"".join(group.column("signature").to_pylist()), np.uint16).reshape(group.num_rows, -1)
        side = group.column("component").to_numpy()
        near = np.zeros(len(x), bool)
        for i in range(len(x)):
            hit = ((x[i] == x).mean(axis=1) >= LEAST) & (side != side[i])
            near |= hit
            near[i] |= hit.any()
        return group.select(["task", "item"]).filter(pa.array(near))

    rows = tasks.select("task", "item", "component", "signature")
    return rows.groupBy("task").applyInArrow(run, "task string, item long")


def clustered(classes: DataFrame) -> DataFrame:
    """``item`` and ``component``: the candidate cluster of each class.

    The first ``FIRST`` trees are linked by class. The others link what these have joined, so a class that all trees place in
    one cluster counts with the links of the first trees only, and not with those of all.
    """
    def joined(labels: DataFrame, trees: range) -> DataFrame:
        links_ = pin(neighbours(orders(labels, trees)))
        found = components(links_)
        out = pin(labels.join(found, F.col("label") == F.col("node"), "left").select("item", F.coalesce("component", "label").alias("label")))
        unpin(links_)
        return out

    signed = classes.select("item", "signature")
    first = joined(signed.withColumn("label", F.col("item")), range(FIRST))
    return joined(signed.join(first, "item"), range(FIRST, TREES)).withColumnRenamed("label", "component")


def compared(classes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``task`` and ``item``: which classes are compared with each other first, and ``item`` and ``region`` of large clusters."""
    clusters = clustered(classes)
    sizes = pin(clusters.groupBy("component").agg(F.count("*").alias("n")))
    clusters = clusters.join(sizes.where("n > 1"), "component")
    small = clusters.where(F.col("n") <= REGION).select(F.concat(F.lit("c"), F.col("component").cast("string")).alias("task"), "item")
    small = similar(small.withColumn("component", F.col("item")).join(classes.select("item", "signature"), "item"))
    large = pin(clusters.where(F.col("n") > REGION).select("item"))
    regions = pin(orders(classes.join(large, "item", "left_semi").withColumn("label", F.col("item"))).select("item", "tree", F.concat_ws(".", "tree", *VALUES[:SHALLOW]).alias("region")))
    own = blocks(regions.where(F.col("tree") < FIRST))
    first = own.select(F.concat_ws("/", F.concat(F.lit("r"), F.col("region")), "block").alias("task"), "item")
    tasks = pin(small.union(first))
    unpin(sizes, large)
    return tasks, regions.select("item", "region")


def blocks(regions: DataFrame) -> DataFrame:
    """The regions of several classes, each class with the number of ``blocks`` and its own ``block``."""
    sizes = pin(regions.groupBy("region").agg(F.count("*").alias("n")).where("n > 1"))
    out = regions.join(sizes, "region").withColumn("blocks", F.ceil(F.col("n") / REGION))
    return out.withColumn("block", F.pmod(F.xxhash64("item"), F.col("blocks")))


def still_open(regions: DataFrame, found: DataFrame, classes: DataFrame) -> DataFrame:
    """``task`` and ``item``: what is still to compare in the regions that hold more than one component.

    The largest component of a region is one side, all others are the rest. Members of one component need no further
    link, so the rest is compared with the largest and with itself, in blocks of ``SIDE``, and the members of the
    largest are never compared with each other. Members whose signature is like none of another component drop out.
    """
    known = pin(
        regions.join(found, F.col("item") == F.col("node"), "left")
        .select("item", "region", F.coalesce("component", "item").alias("component"))
    )
    counts = known.groupBy("region", "component").agg(F.count("*").alias("n"))
    sides = counts.groupBy("region").agg(F.max(F.struct("n", "component")).alias("top"), F.sum("n").alias("all"), F.count("*").alias("several"))
    many = lambda n: F.greatest(F.ceil(n / SIDE), F.lit(1)).cast("int")
    sides = pin(sides.where("several > 1").select(
        "region", F.col("top.component").alias("largest"), many(F.col("top.n")).alias("upper"), many(F.col("all") - F.col("top.n")).alias("lower"), "all"
    ))
    rows = known.join(sides, "region").withColumn("inside", F.col("component") == F.col("largest"))
    block = F.pmod(F.xxhash64("item"), F.when(F.col("inside"), F.col("upper")).otherwise(F.col("lower"))).cast("int")
    rows = rows.withColumn("block", block)
    number = lambda of: F.sequence(F.lit(0), F.col(of) - 1)
    with_rest = F.transform(number("lower"), lambda i: F.concat_ws("/", F.lit("u"), F.col("block"), i))
    with_largest = F.transform(number("upper"), lambda i: F.concat_ws("/", F.lit("u"), i, F.col("block")))
    among = F.transform(number("lower"), lambda i: F.concat_ws("/", F.lit("l"), F.least(i, F.col("block")), F.greatest(i, F.col("block"))))
    pairs = F.when(F.col("all") <= SIDE, F.array(F.lit("all"))).when(F.col("inside"), with_rest).otherwise(F.concat(with_largest, among))
    tasks = rows.select("region", "item", "component", F.explode(pairs).alias("pair"))
    tasks = tasks.select(F.concat_ws("/", F.concat(F.lit("r"), F.col("region")), "pair").alias("task"), "item", "component")
    return pin(similar(tasks.join(classes.select("item", "signature"), "item")))


def confirmed(items: list, sets: list[np.ndarray], percent: int) -> list[tuple]:
    """A spanning forest of the links between sets: pairs of items."""
    n = len(items)
    sizes = np.array([len(s) for s in sets])
    if n == 2:
        both = len(np.intersect1d(*sets, assume_unique=True))
        common = np.array([[sizes[0], both], [both, sizes[1]]])
    else:
        distinct, codes, met = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
        place = np.cumsum(met > 1) - 1
        owner, keep = np.repeat(np.arange(n), sizes), met[codes] > 1
        owner, codes = owner[keep], place[codes[keep]]
        order = np.argsort(codes, kind="stable")
        owner, codes = owner[order], codes[order]
        common = np.zeros((n, n))
        for low in range(0, int(codes[-1]) + 1 if len(codes) else 0, CHUNK):
            a, b = np.searchsorted(codes, [low, low + CHUNK])
            grid = np.zeros((n, CHUNK), np.float32)
            grid[owner[a:b], codes[a:b] - low] = 1
            common += grid @ grid.T
    linked = 100 * common >= percent * (sizes[:, None] + sizes - common)
    out, open_ = [], np.ones(n, bool)
    for i in range(n):
        if open_[i]:
            open_[i] = False
            todo = [i]
            while todo:
                j = todo.pop()
                more = np.flatnonzero(linked[j] & open_)
                open_[more] = False
                out += [(items[j], items[k]) for k in more]
                todo += more.tolist()
    return out


def links(tasks: DataFrame, texts: DataFrame, width: int, percent: int) -> DataFrame:
    """Confirmed links ``a``, ``b`` between the classes of each task, from their ``body``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo = Memo(_hash_words)
        task, items, sets = None, [], []

        def done() -> list[tuple]:
            return confirmed(items, sets, percent) if len(items) > 1 else []

        for batch in batches:
            out = []
            for part in text_batches(batch, "body"):
                for name, item, own in zip(part.column("task").to_pylist(), part.column("item").to_pylist(), shingle_sets(part.column("body"), width, memo)):
                    if name != task:
                        out += done()
                        task, items, sets = name, [], []
                    items.append(item)
                    sets.append(own)
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out)], ["a", "b"])
        if out := done():
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out)], ["a", "b"])

    parts = int(tasks.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = tasks.join(texts.hint("merge"), "item").select("task", "item", "body")
    return pin(rows.repartition(parts, "task").sortWithinPartitions("task").mapInArrow(run, "a long, b long"))


def _of(text: str) -> Column:
    """The text's own hash, by which the text of a class is found."""
    return F.unhex(F.md5(F.col(text).cast("binary")))


def grouped(rows: DataFrame, docs: DataFrame, width: int, percent: int, text: str, same: str | None = None) -> DataFrame:
    """``mark`` and ``component`` (a number) of all sets of ``rows``; sets whose rows share a value of ``same`` belong together.

    A class is a set, numbered when the classes are written; texts are read once more, one for each hash, and only those
    of classes that are compared are kept.
    """
    classes = rows.where("mark IS NOT NULL").groupBy("mark").agg(F.min("of").alias("of"), F.first("signature").alias("signature"))
    classes = pin(classes.withColumn("item", F.monotonically_increasing_id()))
    tasks, regions = compared(classes)
    wanted = tasks.select("item").union(regions.select("item")).distinct().join(classes.select("item", "of"), "item")
    bodies = docs.where(F.col(text).isNotNull()).select(_of(text).alias("of"), F.col(text).alias("body")).groupBy("of").agg(F.first("body").alias("body"))
    texts = pin(bodies.join(pin(wanted).hint("merge"), "of").select("item", "body"))
    known = components(links(tasks, texts, width, percent))
    open_ = still_open(regions, known, classes)
    # What is known goes on as a star by component, not as all links that made it known.
    edges = known.select(F.col("node").alias("a"), F.col("component").alias("b")).union(links(open_, texts, width, percent))
    unpin(tasks, texts, open_)
    if same:
        held = rows.where("mark IS NOT NULL").select(F.col(same).alias("same"), "mark").distinct()
        held = held.join(classes.select("mark", "item"), "mark")
        shared = held.groupBy("same").agg(F.min("item").alias("a"), F.max("item").alias("b")).where("a < b").select("same", "a")
        edges = edges.union(held.join(shared, "same").select("a", F.col("item").alias("b")))
    found = components(edges)
    return pin(
        classes.select("mark", "item").join(found, F.col("item") == F.col("node"), "left").select("mark", F.coalesce("component", "item").alias("component"))
    )


def near_duplicates(
    docs: DataFrame, width: int = 5, percent: int = PERCENT, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """Per row: key, ``n_shingles``, ``component_id`` (smallest key reachable by links) and ``kept``."""
    rows = pin(signatures(docs.select(F.col(key).alias("item"), _of(text).alias("of"), F.col(text).alias("body")), width))
    named = rows.where("item IS NOT NULL")
    groups = grouped(named, docs.where(F.col(key).isNotNull()), width, percent, text, "item")
    least = named.where("mark IS NOT NULL").groupBy("mark").agg(F.min("item").alias("least")).join(groups, "mark")
    roots = least.groupBy("component").agg(F.min("least").alias("root"))
    roots = pin(least.join(roots, "component").select("mark", "root"))
    out = rows.select("item", "n_shingles", "mark").join(roots, "mark", "left")
    component = F.when(F.col("item").isNotNull(), F.coalesce("root", "item"))
    return out.select(
        F.col("item").alias(key), "n_shingles", component.alias("component_id"), F.col("item").eqNullSafe(component).alias("kept")
    )


def accept(docs: DataFrame, width: int = 5, percent: int = PERCENT, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row of each group of near duplicates, with the columns it came with: that of the smallest key, null last.

    Rows are told apart by their texts, so rows that share a key, or have none, are compared like all others; of rows of a
    group that share the smallest key, the one with the smallest other columns stays. Texts without words all stay. All but two
    steps work on hashes: one reads the texts to compare, one takes the chosen rows from the input.
    """
    word = F.coalesce(F.col(text).rlike(r"[^\x20\x09-\x0D]"), F.lit(False))
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    packed = docs.where(word).select(whole.alias("row"), _of(text).alias("of"), F.xxhash64(whole).alias("own"))
    rest = F.struct(F.lit(0).alias("_"), *[F.col(f"row.`{c}`").alias(f"c{i}") for i, c in enumerate(docs.columns) if c not in (key, text)])
    slim = packed.select(
        F.struct(F.col(f"row.`{key}`").alias("key"), rest.alias("rest"), "own").alias("item"), "of", F.col(f"row.`{text}`").alias("body")
    )
    rows = pin(signatures(slim, width))
    groups = grouped(rows, docs.where(word), width, percent, text)
    order = [F.col("item.key").isNull().alias("none"), *[F.col(f"item.{c}").alias(c) for c in ("key", "rest", "own")]]
    first = F.min(F.struct(*order, "of")).alias("least")
    chosen = pin(rows.select("item", "of", "mark").join(groups, "mark").groupBy("component").agg(first).select("least.of", "least.own"))
    # Equal rows meet before they are shuffled; what is left of them is joined where it lies.
    distinct = packed.groupBy("of", "own").agg(F.first("row").alias("row"))
    one = distinct.join(chosen.hint("merge"), ["of", "own"], "left_semi")
    return one.select("row.*").union(docs.where(~word))
