"""Shards that each hold the corpus' mixture of sources.

Rows are shuffled within their source by a seeded hash and get the fractional rank
``(rank - 1/2) / rows of the source``. Sorted by it, every stretch of the corpus holds each source in
proportion; cutting the order into equal stretches gives shards whose counts differ by one at most.

Both rankings are cut by their own key, which is spread evenly (a hash, a fraction): rows are ranked
within slices, and counts of the slices before are added. No task gathers a source or the corpus,
however large one source is.

Defined cases: rows without source are a source of their own; a null text has size 1; a null id is
hashed as an empty one; rows with equal keys are ordered by the checksum of their text, so equal
rows are interchangeable; an empty table gives no rows. Columns of the input are not carried along.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

SHARDS = 16
SEED = "interleave-1"
ROWS_PER_SLICE = 4000


def _before(counts: DataFrame, keys: list[str], slice_key: str) -> DataFrame:
    """Rows in the slices before each one, and all rows, within ``keys``."""
    own = Window.partitionBy(*keys)
    return counts.select(
        *keys, slice_key,
        (F.sum("n").over(own.orderBy(slice_key).rowsBetween(Window.unboundedPreceding, 0)) - F.col("n")).alias("before"),
        F.sum("n").over(own).alias("all"),
    )


def interleaved(
    docs: DataFrame, shards: int = SHARDS, seed: str = SEED, key: str = "doc_id", text: str = "text", stratum: str = "source"
) -> DataFrame:
    """Per row: key, ``size`` (bytes and one), ``text_crc32``, ``shard`` and ``slot`` within the shard.

    One row per slice goes through the windows over slices: a few thousandths of a row per row.
    """
    total = docs.count()
    slices = max(1, -(-total // ROWS_PER_SLICE))
    body = F.coalesce(F.col(text), F.lit(""))
    mark = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(key).cast("string"), F.lit(""))))
    rows = docs.select(
        F.col(key).alias("doc_id"),
        F.coalesce(F.concat(F.lit("s"), F.col(stratum)), F.lit("")).alias("stratum"),
        (F.octet_length(body) + 1).cast("long").alias("size"),
        F.crc32(body.cast("binary")).alias("text_crc32"),
        mark.alias("mark"),
    )
    rows = rows.withColumn("part", F.floor(F.conv(F.substring("mark", 1, 8), 16, 10).cast("long") * slices / 2**32))
    counts = rows.groupBy("stratum", "part").agg(F.count("*").alias("n"))
    before = _before(counts, ["stratum"], "part")
    order = ["mark", "doc_id", "text_crc32"]
    ranked = rows.withColumn("rank", F.row_number().over(Window.partitionBy("stratum", "part").orderBy(*order)))
    ranked = ranked.join(before, ["stratum", "part"]).withColumn(
        "place", (F.col("before") + F.col("rank") - F.lit(0.5)) / F.col("all")
    )
    ranked = ranked.drop("part", "before", "rank", "all").withColumn("part", F.floor(F.col("place") * slices))
    counts = ranked.groupBy("part").agg(F.count("*").alias("n"))
    before = _before(counts, [], "part").select("part", "before")
    within = Window.partitionBy("part").orderBy("place", "stratum", *order)
    placed = ranked.withColumn("rank", F.row_number().over(within)).join(before, "part")
    position = F.col("before") + F.col("rank") - 1
    return (
        placed.withColumn("position", position.cast("long"))
        .withColumn("shard", F.expr(f"CAST((position * {shards}) DIV {max(total, 1)} AS INT)"))
        .withColumn("slot", F.expr(f"position - ((CAST(shard AS LONG) * {total} + {shards - 1}) DIV {shards})"))
        .select("doc_id", "stratum", "size", "text_crc32", "shard", "slot")
    )
