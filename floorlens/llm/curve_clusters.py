"""Centroid clustering over space-filling-curve zone maps, in exact integers.

Vectors are turned into integers and ordered along a Hilbert curve over their coordinates (``BITS`` bits each, scaled to
the range of the table). Runs of ``ROWS`` vectors become blocks, written once with their cells and the least and
largest value of each dimension. In each round the box of a block bounds the distance of all its vectors to each
centroid from below and above; only centroids whose lower bound does not exceed the least upper bound can be
nearest, and these alone are compared with the vectors. A centroid left out is farther than another for every
vector of the block, so results are exact, ties included.

Tasks send one row of sums per centroid and dimension; centroids, of fixed number and width, are the only thing the
driver holds. Ties in the order along the curve are cut by id and by the place of the row, so copies of a vector
spread over many blocks.

Defined cases: vectors that are null, of another width, or hold null or non-finite components are left out;
a component beyond ``LARGEST`` in size after scaling is an error, as squared distances would not fit; centroids start
with the vectors of the smallest hashes (null ids last; rows that share an id by their components), and there are
fewer of them if there are fewer vectors; a centroid without vectors stays; an empty table gives no rows. Repeated rows
are vectors of their own. Further columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from floorlens.session import pin

CLUSTERS, ROUNDS, DIMENSIONS, SCALE = 16, 3, 64, 64
ROWS, BITS = 256, 4
LARGEST = 1 << 27
AT_ONCE = 64


def integer_vectors(df: DataFrame, key: str, vector: str, dimensions: int, scale: int) -> DataFrame:
    """``item`` and ``cells``, the integers floor(scale * x), of the usable vectors."""
    x = F.col(vector).cast("array<double>")
    finite = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) != float("inf")))
    too_large = F.raise_error(F.lit(f"a component is beyond {LARGEST} after scaling")).cast("long")
    cell = lambda v: F.when(F.abs(v * scale) <= LARGEST, F.floor(v * scale)).otherwise(too_large)
    usable = df.where((F.size(x) == dimensions) & finite)
    return usable.select(F.col(key).alias("item"), F.transform(x, cell).alias("cells"))


def _matrix(cells: pa.Array, width: int) -> np.ndarray:
    return cells.flatten().to_numpy().reshape(len(cells), width)


def extent(vectors: DataFrame, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Least and largest value of each dimension: a row per task and dimension, then one per dimension."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        low = high = None
        for batch in batches:
            if batch.num_rows:
                x = _matrix(batch.column(0), width)
                low = x.min(axis=0) if low is None else np.minimum(low, x.min(axis=0))
                high = x.max(axis=0) if high is None else np.maximum(high, x.max(axis=0))
        if low is not None:
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(width, dtype=np.int32)), pa.array(low), pa.array(high)], ["d", "low", "high"])

    found = vectors.select("cells").mapInArrow(run, "d int, low long, high long")
    low, high = np.zeros(width, np.int64), np.zeros(width, np.int64)
    for d, a, b in found.groupBy("d").agg(F.min("low"), F.max("high")).collect():  # one row per dimension
        low[d], high[d] = a, b
    return low, high


def hilbert_keys(cells: np.ndarray, bits: int) -> np.ndarray:
    """Place of each row of coordinates below 2**bits along the Hilbert curve, as rows of big-endian bytes.

    The coordinates are turned plane by plane into the transposed index (Skilling 2004), whose bits are then
    read plane by plane.
    """
    x = cells.astype(np.int64).T.copy()
    top = 1 << (bits - 1)
    for plane in (1 << b for b in range(bits - 1, 0, -1)):
        rest = plane - 1
        for axis in x:
            turned = (axis & plane) != 0
            swap = np.where(turned, 0, (x[0] ^ axis) & rest)
            x[0] ^= np.where(turned, rest, swap)
            axis ^= swap
    x = np.bitwise_xor.accumulate(x, axis=0)
    flip = np.zeros(x.shape[1], np.int64)
    for plane in (1 << b for b in range(bits - 1, 0, -1)):
        flip ^= np.where(x[-1] & plane, plane - 1, 0)
    x ^= flip
    planes = [(x & (top >> b)) != 0 for b in range(bits)]
    return np.packbits(np.concatenate(planes).T, axis=1)


def blocks(vectors: DataFrame, width: int, rows: int = ROWS, bits: int = BITS) -> DataFrame:
    """One row per block: ``items``, ``cells`` (little-endian 32-bit), ``low`` and ``high`` of the box."""
    kind = vectors.schema["item"].dataType.simpleString()
    low, high = extent(vectors, width)
    spread = high - low + 1

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _matrix(batch.column(1), width)
            keys = hilbert_keys(((x - low) << bits) // spread, bits)
            yield pa.RecordBatch.from_arrays(
                [pa.array([k.tobytes() for k in keys], pa.binary()), batch.column(0), batch.column(2),
                 pa.array([r.tobytes() for r in x.astype("<i4")], pa.binary())], ["curve", "item", "place", "cells"])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items, cells = [], []

        def block(n: int) -> pa.RecordBatch:
            x = np.frombuffer(b"".join(cells[:n]), "<i4").reshape(n, width)
            out = [[items[:n]], [x.tobytes()], [x.min(axis=0).tobytes()], [x.max(axis=0).tobytes()]]
            del items[:n], cells[:n]
            return pa.RecordBatch.from_arrays(
                [pa.array(out[0], pa.list_(item_type)), *[pa.array(c, pa.binary()) for c in out[1:]]], ["items", "cells", "low", "high"])

        for batch in batches:
            item_type = batch.schema.field("item").type
            items += batch.column(0).to_pylist()
            cells += batch.column(1).to_pylist()
            while len(items) >= rows:
                yield block(rows)
        if items:
            yield block(len(items))

    parts = int(vectors.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = vectors.withColumn("place", F.monotonically_increasing_id()).mapInArrow(
        place, f"curve binary, item {kind}, place long, cells binary"
    )
    order = ["curve", "item", "place"]
    ordered = placed.repartitionByRange(parts, *order).sortWithinPartitions(*order).select("item", "cells")
    return pin(ordered.mapInArrow(cut, f"items array<{kind}>, cells binary, low binary, high binary"))


def candidates(low: np.ndarray, high: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Numbers of the centroids that can be nearest to a vector of the box."""
    outside = np.maximum(np.maximum(low - centroids, centroids - high), 0)
    farthest = np.maximum(centroids - low, high - centroids)
    return np.flatnonzero((outside**2).sum(axis=1) <= (farthest**2).sum(axis=1).min())


def nearest(x: np.ndarray, numbers: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nearest of the numbered centroids for each row, the smallest number on a tie, and the squared distance."""
    best, least = np.full(len(x), -1, np.int64), np.full(len(x), np.iinfo(np.int64).max)
    for at in range(0, len(numbers), AT_ONCE):
        own = numbers[at : at + AT_ONCE]
        distances = np.stack([((x - centroids[n]) ** 2).sum(axis=1) for n in own])
        first = distances.argmin(axis=0)
        found = distances[first, np.arange(len(x))]
        closer = found < least
        best[closer], least[closer] = own[first[closer]], found[closer]
    return best, least


def _compared(batch: pa.RecordBatch, centroids: np.ndarray) -> Iterator[tuple]:
    """Per block: items, cells, number of candidates, and cluster and distance of each vector."""
    width = centroids.shape[1]
    for items, cells, low, high in zip(*(c.to_pylist() for c in batch.columns)):
        x = np.frombuffer(cells, "<i4").reshape(-1, width).astype(np.int64)
        box = [np.frombuffer(b, "<i4").astype(np.int64) for b in (low, high)]
        numbers = candidates(*box, centroids)
        yield items, x, len(numbers), *nearest(x, numbers, centroids)


def moved(table: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """Each centroid replaced by the floor of the mean of its vectors; without vectors it stays."""
    k, width = centroids.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, counts = np.zeros((k, width), np.int64), np.zeros(k, np.int64)
        for batch in batches:
            for _, x, _, clusters, _ in _compared(batch, centroids):
                counts += np.bincount(clusters, minlength=k)
                for c in np.unique(clusters):
                    sums[c] += x[clusters == c].sum(axis=0)
        met = np.flatnonzero(counts)
        if len(met):
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.repeat(met, width).astype(np.int32)), pa.array(np.tile(np.arange(width, dtype=np.int32), len(met))),
                 pa.array(sums[met].ravel()), pa.array(np.repeat(counts[met], width))], ["cluster", "d", "total", "n"])

    found = table.mapInArrow(run, "cluster int, d int, total long, n long").groupBy("cluster", "d").agg(
        F.sum(F.col("total").cast("decimal(38,0)")).alias("total"), F.sum("n").alias("n")
    )
    out = centroids.copy()
    for cluster, d, total, n in found.collect():  # a row per centroid and dimension
        out[cluster, d] = int(total) // n
    return out


def first_centroids(vectors: DataFrame, clusters: int, mark: Column, width: int) -> np.ndarray:
    """The vectors with the smallest marks, in their order."""
    rows = vectors.select(mark.alias("mark"), "cells").orderBy(F.col("mark").asc_nulls_last(), "cells").limit(clusters).collect()
    return np.array([r["cells"] for r in rows], np.int64).reshape(len(rows), width)


def clustered(
    df: DataFrame, clusters: int = CLUSTERS, rounds: int = ROUNDS, key: str = "vec_id", vector: str = "embedding",
    dimensions: int = DIMENSIONS, scale: int = SCALE, seed: str = "1", rows: int = ROWS,
) -> tuple[DataFrame, np.ndarray]:
    """Per usable vector: key, ``cluster``, ``distance`` (squared) and ``candidates`` compared in its block; and the final centroids."""
    vectors = integer_vectors(df, key, vector, dimensions, scale)
    mark = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("item").cast("string")), 256)
    centroids = first_centroids(vectors, clusters, mark, dimensions)
    table = blocks(vectors, dimensions, rows)
    for _ in range(rounds):
        centroids = moved(table, centroids)
    kind = vectors.schema["item"].dataType.simpleString()
    final = centroids

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            item_type = batch.schema.field("items").type.value_type
            for items, x, many, cluster, distance in _compared(batch, final):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(items, item_type), pa.array(cluster.astype(np.int32)), pa.array(distance),
                     pa.array(np.full(len(x), many, np.int32))], [key, "cluster", "distance", "candidates"])

    return table.mapInArrow(run, f"`{key}` {kind}, cluster int, distance long, candidates int"), centroids


def with_inertia(assigned: DataFrame, centroids: np.ndarray) -> DataFrame:
    """``cluster_inertia``, ``inertia`` and ``centroid_sha256`` beside each vector; a row per cluster is summed on its way."""
    assigned = pin(assigned)
    sums = assigned.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).cast("long").alias("n")).collect()
    whole = sum(n for _, n in sums)
    rows = [(c, n, whole, hashlib.sha256(",".join(map(str, centroids[c].tolist())).encode()).hexdigest()) for c, n in sums]
    table = assigned.sparkSession.createDataFrame(rows, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return assigned.join(F.broadcast(table), "cluster")  # one row per cluster
