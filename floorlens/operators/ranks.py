"""Global rankings without a single-task window.

A window with no PARTITION BY sends every row to one task. Here rows are cut into ranges of the
sort order instead; each range is ranked on its own and shifted by what the ranges before it hold.

* The input is written once to the shared folder (``pin``), so all passes see the same rows.
* Ranges come from a range exchange over complete sort positions (key and tie-break), so even a key held by a third
  of all rows is spread over several ranges. Borders come from Spark's own sample; a poor sample costs balance,
  never correctness. The number of a row's range is written with it, so finding it costs the same for any number of ranges.
* Only border statistics reach the driver: one row per range of ``ROWS_PER_RANGE`` rows, and one for each range of a
  key that crosses from one to the next.
* Up to ``ROWS_PER_RANGE`` rows (checked by a count) there is just one range and no border.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from floorlens.session import pin

ROWS_PER_RANGE = 250_000


@dataclass(frozen=True)
class Ranking:
    """Rank columns over one sort key: output name -> kind.

    Kinds: ``row_number``, ``rank``, ``dense_rank``, ``percent_rank``, ``average_pct`` (mean rank of
    the tied rows over the number of rows) and ``ntile:<k>``. NULL keys count as lowest.
    """

    key: str
    outputs: dict[str, str]
    descending: bool = False


@dataclass
class _Borders:
    """What the ranges of one ordering hold, enough to shift local ranks."""

    ranges: list[tuple] = field(default_factory=list)  # range, rows before, distinct keys before
    runs: list[tuple] = field(default_factory=list)  # key, first position, dense position, tied rows


def with_global_ranks(
    df: DataFrame,
    rankings: list[Ranking],
    tie_break: list[str],
    rows_per_range: int | None = None,
) -> DataFrame:
    rows_per_range = rows_per_range or ROWS_PER_RANGE
    out = pin(df)
    total = out.count()
    cuts = math.ceil(total / rows_per_range)
    for i, ranking in enumerate(rankings):
        if cuts > 1:
            # The exchange reads its input twice, for borders and for rows.
            out = _in_ranges(pin(out) if i else out, ranking, tie_break, cuts)
        else:
            out = out.withColumn("_range", F.lit(0))
        out = _add_ranks(out, ranking, tie_break, cuts, total)
    return out


def _order(df: DataFrame, ranking: Ranking) -> Column:
    """The key in ranking order, NULL keys lowest."""
    if ranking.descending and not isinstance(df.schema[ranking.key].dataType, T.NumericType):
        raise ValueError("descending keys must be numbers")
    return F.col(ranking.key).desc() if ranking.descending else F.col(ranking.key).asc()


def _in_ranges(df: DataFrame, ranking: Ranking, tie_break: list[str], cuts: int) -> DataFrame:
    """The rows with the number of their range of the sort order, in ``_range``, written once."""
    return pin(df.repartitionByRange(cuts, _order(df, ranking), *tie_break).withColumn("_range", F.spark_partition_id()))


def _same(a: object, b: object) -> bool:
    """Whether two keys are one, as Spark compares them: NaN equals NaN."""
    return a == b or (a != a and b != b)


def _measure_borders(held: DataFrame, ranking: Ranking) -> _Borders:
    """Rows and distinct keys per range, and the tied runs that cross from one range to the next."""
    spark, key = held.sparkSession, F.col(ranking.key)
    kind = held.schema[ranking.key].dataType.simpleString()
    place = F.struct(key.isNotNull().alias("known"), key.alias("key"))
    low, high = F.min(place), F.max(place)
    measures = [F.count("*").alias("rows"), *(c.alias(n) for c, n in zip((high, low) if ranking.descending else (low, high), ("first", "last")))]
    if "dense_rank" in ranking.outputs.values():
        measures.append((F.countDistinct(key) + F.max(key.isNull().cast("int"))).alias("keys"))
    ranges = sorted(held.groupBy("_range").agg(*measures).collect(), key=lambda r: r["_range"])  # one row per range

    crossing = []
    for one, two in zip(ranges, ranges[1:]):
        shared = one["last"]["key"]
        if _same(shared, two["first"]["key"]) and not (crossing and _same(crossing[-1], shared)):
            crossing.append(shared)
    held_of: list[dict[int, int]] = [{} for _ in crossing]
    if crossing:
        keys = spark.createDataFrame(list(enumerate(crossing)), f"_border int, _border_key {kind}")
        counts = (
            held.select("_range", key.alias("_key"))
            .join(F.broadcast(keys), F.col("_key").eqNullSafe(F.col("_border_key")))  # one row per border at most
            .groupBy("_border", "_range").agg(F.count("*").alias("rows"))
        )
        for r in counts.collect():
            held_of[r["_border"]][r["_range"]] = r["rows"]

    borders = _Borders()
    before = keys_before = 0
    starts: dict[int, tuple[int, int, int, int]] = {}
    previous = None
    for r in ranges:
        keys = r["keys"] if "keys" in r else 0
        continues = previous is not None and _same(previous["last"]["key"], r["first"]["key"])
        starts[r["_range"]] = (before, keys_before - continues, r["rows"], keys)
        borders.ranges.append((r["_range"], before, keys_before - continues))
        before += r["rows"]
        keys_before += keys - continues
        previous = r
    for shared, by_range in zip(crossing, held_of):
        # A run that crosses closes the range it starts in.
        first = min(by_range)
        offset, dense_offset, rows, keys = starts[first]
        borders.runs.append((shared, offset + rows - by_range[first] + 1, dense_offset + keys, sum(by_range.values())))
    return borders


def _add_ranks(held: DataFrame, ranking: Ranking, tie_break: list[str], cuts: int, total: int) -> DataFrame:
    key, by_key = F.col(ranking.key), _order(held, ranking)
    within = Window.partitionBy("_range")
    ordered = within.orderBy(by_key, *[F.col(t).asc() for t in tie_break])
    kinds = set(ranking.outputs.values())
    wants_ties = "average_pct" in kinds

    out = held.withColumn("_row", F.row_number().over(ordered).cast("long"))
    if kinds & {"rank", "percent_rank", "average_pct"}:
        out = out.withColumn("_rank", F.rank().over(within.orderBy(by_key)).cast("long"))
    if "dense_rank" in kinds:
        out = out.withColumn("_dense", F.dense_rank().over(within.orderBy(by_key)).cast("long"))
    if wants_ties:
        out = out.withColumn("_ties", F.count("*").over(Window.partitionBy("_range", ranking.key)))

    if cuts > 1:
        borders = _measure_borders(held, ranking)
        spark = held.sparkSession
        # Both sides hold at most one row per range border: small, as a range holds many rows.
        offsets = spark.createDataFrame(borders.ranges, "_range int, _before long, _keys_before long")
        out = out.join(F.broadcast(offsets), "_range")
        out = out.withColumn("_row", F.col("_row") + F.col("_before"))
        crossing = {"_rank", "_dense", "_ties"} & set(out.columns)
        if crossing and not borders.runs:
            shifts = {"_rank": F.col("_before"), "_dense": F.col("_keys_before"), "_ties": F.lit(0)}
            out = out.withColumns({name: F.col(name) + shifts[name] for name in crossing})
        elif crossing:
            key_type = held.schema[ranking.key].dataType.simpleString()
            runs = spark.createDataFrame(
                borders.runs, f"_run_key {key_type}, _run_at long, _run_dense long, _run_ties long"
            ).withColumn("_in_run", F.lit(True))
            out = out.join(F.broadcast(runs), key.eqNullSafe(F.col("_run_key")), "left")
            whole = {
                "_rank": ("_run_at", F.col("_before")),
                "_dense": ("_run_dense", F.col("_keys_before")),
                "_ties": ("_run_ties", F.lit(0)),
            }
            for name in crossing:
                run, shift = whole[name]
                out = out.withColumn(
                    name, F.when(F.col("_in_run"), F.col(run)).otherwise(F.col(name) + shift)
                )

    for name, kind in ranking.outputs.items():
        out = out.withColumn(name, _final(kind, total))
    return out.select(*[c for c in held.columns if c != "_range"], *ranking.outputs)


def _final(kind: str, total: int) -> Column:
    row, rank = F.col("_row"), F.col("_rank")
    if kind == "row_number":
        return row
    if kind == "rank":
        return rank
    if kind == "dense_rank":
        return F.col("_dense")
    if kind == "percent_rank":
        return ((rank - 1) / F.lit(max(total - 1, 1))).cast("double")
    if kind == "average_pct":
        return (rank + (F.col("_ties") - 1) / 2) / F.lit(max(total, 1))
    if kind.startswith("ntile:"):
        return _ntile(row, total, int(kind.split(":")[1]))
    raise ValueError(f"unknown rank kind {kind!r}")


def _ntile(row: Column, total: int, buckets: int) -> Column:
    """Bucket of a global position; the first ``total mod buckets`` buckets hold one row more."""
    size, extra = divmod(total, buckets)
    large = extra * (size + 1)
    in_large = F.floor((row - 1) / F.lit(size + 1)) + 1
    if size == 0:
        return in_large.cast("int")
    in_small = F.floor((row - 1 - large) / F.lit(size)) + 1 + extra
    return F.when(row <= large, in_large).otherwise(in_small).cast("int")
