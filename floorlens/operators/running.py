"""Running sums over a whole table without a single-task window.

Rows are dealt into ranges of the sort order by a range exchange and written once with the number of their range. Each
range sums on its own; a row of totals per range and group then tells what lies before it. Borders come from Spark's
own sample, so a poor sample costs balance, never correctness, and no range count, band or size is fixed here.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from floorlens.session import pin


def sums_before(df: DataFrame, order: list[str], sums: dict[str, str], by: list[str] | None = None, ranges: int | None = None) -> DataFrame:
    """Add, for each ``output: column`` of ``sums``, the sum of the column over all earlier rows of the group.

    ``by`` and ``order`` together must tell rows apart. Nulls sort first and count as 0 in a sum; a group's first row
    gets 0. Groups may be as large as the table. ``ranges`` overrides the number of ranges.
    """
    by = by or []
    sizes = [ranges] if ranges else []
    held = pin(df.repartitionByRange(*sizes, *by, *order).withColumn("_range", F.spark_partition_id()))
    before = lambda column, window: F.coalesce(F.sum(column).over(window), F.lit(0))
    # One row per range and group in it, so at most one per range and one per group.
    totals = held.groupBy(*by, "_range").agg(*[F.sum(column).alias(f"_of_{out}") for out, column in sums.items()])
    earlier = Window.partitionBy(*(by or [F.lit(0)])).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        *[F.col(c).alias(f"_by_{c}") for c in by], F.col("_range").alias("_range_of"),
        *[before(f"_of_{out}", earlier).alias(f"_before_{out}") for out in sums],
    )
    inside = Window.partitionBy("_range", *by).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    local = held.withColumns({out: before(column, inside) for out, column in sums.items()})
    same = F.col("_range") == F.col("_range_of")
    for c in by:
        same &= F.col(c).eqNullSafe(F.col(f"_by_{c}"))
    return local.join(offsets, same).select(
        *df.columns, *[(F.col(out) + F.col(f"_before_{out}")).alias(out) for out in sums]
    )
