"""Training runs kept beside the data: a run is saved under a fingerprint of its rows and settings, and every later
query over the same rows reads it instead of fitting again.

* A run is written to a folder of its own and published last, by one row at its key. A driver lost half way leaves an
  unpublished folder, and the next one fits afresh. Of several drivers that publish one key all read the same run.
* The fingerprint is a count and sums of row hashes, so neither order nor partitioning of the rows matters. Nulls
  count as values, repeated rows count each time, an empty table has a fingerprint too. One row reaches the driver.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from floorlens.ml.training import Trained
from floorlens.session import pin, shared_folder, unpin

PUBLISHED = "name string, folder string, folds boolean"
HASHES = 2


def fingerprint(df: DataFrame, *settings: object) -> str:
    """SHA-256 over schema, settings, number of rows and two sums of 64-bit row hashes."""
    names = sorted(df.columns)
    # A hash skips nulls, so whether a value is missing is hashed as well.
    cells = [part for name in names for part in (F.col(f"`{name}`").isNull(), F.col(f"`{name}`"))]
    sums = [F.sum(F.xxhash64(F.lit(i), *cells).cast("decimal(28,0)")).cast("string") for i in range(HASHES)]
    held = df.agg(F.count("*"), *sums).first()
    types = [(name, df.schema[name].dataType.simpleString()) for name in names]
    return hashlib.sha256(repr((types, settings, tuple(held))).encode()).hexdigest()


def save(trained: Trained, key: str) -> None:
    """Write model and tables to a new folder below ``key``, then publish the folder."""
    spark = trained.metrics.sparkSession
    folder = f"{key}/run-{uuid.uuid4().hex}"
    trained.model.write().save(f"{folder}/model")
    trained.metrics.write.parquet(f"{folder}/metrics")
    trained.scored.write.parquet(f"{folder}/scored")
    if trained.folds is not None:
        trained.folds.write.parquet(f"{folder}/folds")
    row = spark.createDataFrame([(trained.name, folder, trained.folds is not None)], PUBLISHED)
    row.coalesce(1).write.mode("append").json(f"{key}/published")


def load(spark: SparkSession, key: str) -> Trained | None:
    """The run published at ``key``; of several the one whose folder comes first."""
    try:
        found = spark.read.schema(PUBLISHED).json(f"{key}/published").orderBy("folder").first()
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return None
    if found is None:
        return None
    table = lambda name: spark.read.parquet(f"{found['folder']}/{name}")
    model = PipelineModel.load(f"{found['folder']}/model")
    return Trained(found["name"], model, table("metrics"), table("scored"), table("folds") if found["folds"] else None)


def fitted_once(name: str, rows: DataFrame, train: Callable[..., Trained], *settings: object, root: str | None = None) -> Trained:
    """``train(rows, *settings)``, or what an earlier call with equal rows and settings has published.

    ``root`` is a folder all executors reach; runs go below the shared folder where it is not given. Rows that are
    pinned already are read as they are and stay.
    """
    spark = rows.sparkSession
    held = rows if hasattr(rows, "_pinned_at") else pin(rows)
    key = f"{root or shared_folder(spark) + '/models'}/{name}-{fingerprint(held, *settings)}"
    kept = load(spark, key)
    if kept is None:
        save(train(held, *settings), key)
        kept = load(spark, key)
    if held is not rows:
        unpin(held)
    return kept
