from pyspark.sql import functions as F

from floorlens import session


def test_partitions_grow_with_the_rows(spark, monkeypatch, tmp_path):
    """What a task holds stays the same size for larger tables; before, the number of partitions was fixed."""
    names = ["spark.sql.adaptive.coalescePartitions.initialPartitionNum", "spark.sql.adaptive.advisoryPartitionSizeInBytes", "spark.sql.files.maxPartitionBytes"]
    held = {n: spark.conf.get(n, None) for n in names}
    monkeypatch.setattr(session, "PARTITION_ROWS", 1000)
    monkeypatch.setattr(session, "PARTITION_MB", 1)
    try:
        most = []
        for rows in (20_000, 80_000):
            session.size_shuffles(spark, rows)
            # Wide rows, so that partitions are not merged for being small.
            wide = F.concat_ws("", *[F.sha2(F.concat_ws("-", "id", F.lit(i)), 512) for i in range(24)])
            df = spark.range(rows).withColumn("wide", wide).repartition("id").groupBy(F.spark_partition_id()).agg(F.count("*").alias("n"), F.max("wide"))
            most.append(df.agg(F.max("n"), F.max("max(wide)")).first()[0])
        assert most[1] < 1.5 * most[0]
        session.size_shuffles(spark, 10)
        assert spark.conf.get(names[0]) == spark.conf.get("spark.sql.shuffle.partitions")
    finally:
        for n, value in held.items():
            spark.conf.unset(n) if value is None else spark.conf.set(n, value)


def test_pin_leaves_no_shuffle_files(spark):
    """Before, what was shuffled for a pinned frame stayed on disk until the driver collected its garbage."""
    manager = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def shuffled() -> set[str]:
        found = manager.getAllBlocks()
        return {name for i in range(found.size()) if (name := found.apply(i).name()).startswith("shuffle_")}

    before, setting = shuffled(), spark.conf.get(session.CLEANUP)
    pinned = session.pin(spark.range(1000).repartition(5, "id"))
    assert shuffled() <= before and spark.conf.get(session.CLEANUP) == setting
    assert pinned.count() == 1000
    with session._shuffles_removed(spark), session._shuffles_removed(spark):
        assert spark.conf.get(session.CLEANUP) == "true"
    assert spark.conf.get(session.CLEANUP) == setting
