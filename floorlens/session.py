"""Session construction and the shared folder used to cut lineage."""

from __future__ import annotations

import math
import tempfile
import threading
import uuid
import zipfile
from collections.abc import Iterator
from contextlib import contextmanager
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

#: Rows that a new partition is opened for, and bytes up to which Spark merges small ones.
PARTITION_ROWS, PARTITION_MB = 200_000, 16
#: Bytes of rows that go to a Python worker as one Arrow batch.
BATCH_BYTES = 2 << 20
#: Spark's setting for that, writers inside it and what it was before.
CLEANUP, _LOCK, _BEFORE = "spark.sql.classic.shuffleDependency.fileCleanup.enabled", threading.Lock(), []


def build_session(app: str = "floorlens", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    defaults = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    }
    for key, value in {**defaults, **conf}.items():
        builder = builder.config(key, value)
    return ship(builder.getOrCreate())


def ship(spark: SparkSession) -> SparkSession:
    """Send the package to the Python workers, once a session, so that they import it wherever they start."""
    context = spark.sparkContext
    if not getattr(context, "_floorlens_shipped", False):
        package = Path(__file__).resolve().parent
        archive = Path(tempfile.mkdtemp(prefix="floorlens-code-")) / "floorlens.zip"
        with zipfile.ZipFile(archive, "w") as held:
            for source in sorted(package.rglob("*.py")):
                held.write(source, source.relative_to(package.parent))
        context.addPyFile(str(archive))
        context._floorlens_shipped = True
    return spark


def size_shuffles(spark: SparkSession, rows: int) -> None:
    """Let shuffles start with as many partitions as ``rows`` are worth and be merged to small ones, and files be read in
    small parts, so that what one task sorts and aggregates stays the same size for larger tables; their number grows instead."""
    least = int(spark.conf.get("spark.sql.shuffle.partitions"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.initialPartitionNum", str(max(least, math.ceil(rows / PARTITION_ROWS))))
    for name in ("spark.sql.adaptive.advisoryPartitionSizeInBytes", "spark.sql.files.maxPartitionBytes"):
        spark.conf.set(name, f"{PARTITION_MB}m")


def size_batches(spark: SparkSession) -> None:
    """Cut Arrow batches by bytes and not only by rows, so that long texts do not fill the JVM's buffers and the workers."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors reach, from ``spark.checkpoint.dir``; a local run that names none gets its own."""
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared is None:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder all executors can reach")
        shared = "file://" + tempfile.mkdtemp(prefix="floorlens-")
        spark.conf.set("spark.checkpoint.dir", shared)
    return shared


@contextmanager
def _shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Queries planned meanwhile delete their shuffle files when they end; threads may overlap."""
    with _LOCK:
        if not _BEFORE:
            _BEFORE[:] = [0, spark.conf.get(CLEANUP, None)]
            spark.conf.set(CLEANUP, "true")
        _BEFORE[0] += 1
    try:
        yield
    finally:
        with _LOCK:
            _BEFORE[0] -= 1
            if not _BEFORE[0]:
                spark.conf.unset(CLEANUP) if _BEFORE[1] is None else spark.conf.set(CLEANUP, _BEFORE[1])
                _BEFORE.clear()


def pin(df: DataFrame) -> DataFrame:
    """Write ``df`` once as Parquet to the shared folder, so that every later pass reads the same rows
    and only the columns it needs. What was shuffled for it is deleted then; else it would stay until the driver
    happens to collect its garbage."""
    path = f"{shared_folder(df.sparkSession)}/pin-{uuid.uuid4().hex}"
    with _shuffles_removed(df.sparkSession):
        df.write.parquet(path)
    pinned = df.sparkSession.read.schema(df.schema).parquet(path)
    pinned._pinned_at = path
    return pinned


def unpin(*frames: DataFrame) -> None:
    """Delete what ``pin`` wrote for frames that nothing reads any more."""
    for df in frames:
        context = df.sparkSession.sparkContext
        path = context._jvm.org.apache.hadoop.fs.Path(df._pinned_at)
        path.getFileSystem(context._jsc.hadoopConfiguration()).delete(path, True)
