"""Passes over blocks of rows: partial sums of all blocks, combined as a tree."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
from pyspark.rdd import RDD
from pyspark.sql import DataFrame

#: Partitions whose sums are combined without a step between, and rows a task gets as far as there are as many.
FLAT = 64
TASK_ROWS = 1 << 14


def dealt(table: DataFrame, rows: int) -> RDD:
    """The rows of a table of blocks, kept by the executors, in no more partitions than ``rows`` are worth."""
    return table.coalesce(max(1, -(-rows // TASK_ROWS))).rdd.persist()


def combined(data: RDD, make: Callable[[object], list[np.ndarray]], joins: list[Callable]) -> list[np.ndarray]:
    """``make`` of every block, combined array by array with ``joins``."""
    joined = lambda a, b: [join(x, y) for join, x, y in zip(joins, a, b)]

    def partial(rows):
        out = None
        for row in rows:
            own = make(row)
            out = own if out is None else joined(out, own)
        return iter([] if out is None else [out])

    return data.mapPartitions(partial).treeReduce(joined, depth=1 if data.getNumPartitions() <= FLAT else 2)
