"""CSV input, the Parquet warehouse, views by name, and exports."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from floorlens.functions.calendar import month_start
from floorlens.operators.reports import executive, health, player
from floorlens.plans.registry import FEATURES, VIEWS
from floorlens.sources.bind import Floor
from floorlens.sources.schemas import TABLES


def read_csv(spark: SparkSession, folder: str, table: str) -> DataFrame:
    """One of the six datasets, typed by its schema; columns are found by header name.

    Fields are read as text and cast, so columns may come in any order and a value that does not
    parse becomes NULL for the completeness check to count.
    """
    stem, schema, _, _ = TABLES[table]
    raw = spark.read.option("header", True).option("enforceSchema", False).csv(f"{folder}/{stem}.csv")
    missing = sorted(set(schema.names) - set(raw.columns))
    if missing:
        raise ValueError(f"{stem}.csv lacks columns: {', '.join(missing)}")
    return raw.select(*[_parse(f).alias(f.name) for f in schema])


def _parse(field: T.StructField):
    text = F.trim(F.col(field.name))
    if isinstance(field.dataType, T.IntegerType):
        flag = F.when(F.lower(text) == "true", 1).when(F.lower(text) == "false", 0)
        return F.coalesce(flag, text.try_cast("double").try_cast("int"))
    return text.try_cast(field.dataType)


def floor_from_csv(spark: SparkSession, folder: str) -> Floor:
    return Floor(**{table: read_csv(spark, folder, table) for table in TABLES})


# ---- warehouse ---------------------------------------------------------------------------------

def load_warehouse(floor: Floor, root: str) -> str:
    """Replace the whole warehouse in one step.

    All tables are written beside the current ones under a new version; the version becomes
    current only when its name is recorded after the last table. A failure before that leaves the
    previous version in use. Facts are laid out by month, rebalanced so that a heavy month is
    spread over several files and light ones share a task.
    """
    version = uuid.uuid4().hex
    for table, (_, _, _, day) in TABLES.items():
        df, target = getattr(floor, table), f"{root}/{version}/{table}"
        if day is None:
            df.write.parquet(target)
        else:
            monthly = df.withColumn("month", month_start(day)).hint("rebalance", "month")
            monthly.write.partitionBy("month").parquet(target)
    spark = floor.spark
    done = spark.range(1).select(F.lit(version).alias("version"), F.current_timestamp().alias("loaded_at"))
    done.coalesce(1).write.mode("append").parquet(f"{root}/_versions")
    return version


def current_version(spark: SparkSession, root: str) -> str:
    return spark.read.parquet(f"{root}/_versions").orderBy(F.desc("loaded_at")).first()["version"]


def floor_from_warehouse(
    spark: SparkSession, root: str, first_month: str | None = None, last_month: str | None = None
) -> Floor:
    """The current version; month bounds prune whole folders of the fact tables."""
    version = current_version(spark, root)
    tables = {}
    for table, (_, schema, _, day) in TABLES.items():
        df = spark.read.parquet(f"{root}/{version}/{table}")
        if day and first_month:
            df = df.where(F.col("month") >= F.lit(first_month).cast("date"))
        if day and last_month:
            df = df.where(F.col("month") <= F.lit(last_month).cast("date"))
        tables[table] = df.select(*schema.names)
    return Floor(**tables)


# ---- views and exports -------------------------------------------------------------------------

def _view_name(query: str) -> str:
    return query.split("_", 1)[1]


def register_views(floor: Floor) -> list[str]:
    """Make every base view and feature table queryable by name in Spark SQL."""
    names = []
    for query, build in {**VIEWS, **FEATURES}.items():
        prefix = "feature_" if query in FEATURES else ""
        name = f"{prefix}{_view_name(query)}"
        build(floor).createOrReplaceTempView(name)
        names.append(name)
    return names


def publish_views(floor: Floor, root: str) -> dict[str, str]:
    """Write the base views once, for report runs that read them many times."""
    paths = {}
    for query, build in VIEWS.items():
        paths[query] = f"{root}/{_view_name(query)}"
        build(floor).write.mode("overwrite").parquet(paths[query])
    return paths


def load_view(spark: SparkSession, name: str, *order: str) -> DataFrame:
    """A registered view as a frame, ordered by key where asked."""
    df = spark.table(name)
    return df.orderBy(*order) if order else df


def write_output(df: DataFrame, path: str, kind: str = "parquet") -> None:
    """Write a result in full; CSV carries a header and keeps NULL apart from empty text."""
    writer = df.write.mode("overwrite")
    if kind == "csv":
        writer.option("header", True).option("emptyValue", '""').csv(path)
    elif kind == "parquet":
        writer.parquet(path)
    else:
        raise ValueError(f"unknown output kind {kind!r}")


EXPORTS = {
    "player_segments": player.rfm_export,
    "machine_health": health.health_export,
    "dashboard_master": executive.master_dataset,
}


def write_exports(floor: Floor, root: str, kind: str = "parquet") -> dict[str, str]:
    """The three reporting datasets."""
    paths = {name: f"{root}/{name}" for name in EXPORTS}
    for name, build in EXPORTS.items():
        write_output(build(floor), paths[name], kind)
    return paths
