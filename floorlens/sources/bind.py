"""Canonical tables: six DataFrames every operator reads, whatever store they come from."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from floorlens.session import size_shuffles

PRICE_FACTOR = "0.0067"
HOUSE_EDGE = "0.02"


@dataclass(frozen=True)
class Floor:
    location: DataFrame
    player: DataFrame
    machine: DataFrame
    session: DataFrame
    transaction: DataFrame
    event: DataFrame

    @property
    def spark(self) -> SparkSession:
        return self.location.sparkSession


def _pick(key: Column, names: list[str]) -> Column:
    """names[key modulo their number]"""
    return F.element_at(F.array(*[F.lit(n) for n in names]), (key % len(names)).cast("int") + 1)


def _id(prefix: str, key: Column) -> Column:
    return F.concat(F.lit(prefix), key.cast("string"))


def bind(spark: SparkSession, sf_dir: str) -> Floor:
    """Derive the canonical tables from the order-processing star schema in ``sf_dir``."""

    def read(name: str) -> DataFrame:
        return spark.read.parquet(f"{sf_dir}/{name}.parquet")

    size_shuffles(spark, read("lineitem").count() + read("events").count())  # from the files' footers
    nation, region = read("nation"), read("region")
    supplier, customer = read("supplier"), read("customer")
    venue = nation.join(region, nation.n_regionkey == region.r_regionkey)

    key = F.col("n_nationkey")
    location = venue.select(
        _id("L", key).alias("location_id"),
        F.col("n_name").alias("location_name"),
        F.concat("n_name", F.lit(" City")).alias("city"),
        _id("S", key % 10).alias("state"),
        F.col("r_name").alias("region"),
        _id("RM", key % 4).alias("route_manager"),
        _pick(key, ["Arcade", "Cruise Ship", "Hotel", "Lounge", "Racetrack"]).alias("location_type"),
        F.date_add(F.lit("1990-01-01").cast("date"), (key * 30).cast("int")).alias("opening_date"),
        F.when(key % 10 == 9, 0).otherwise(1).alias("active_flag"),
    )

    key = F.col("c_custkey")
    tier = (
        F.when(key % 20 < 1, "Platinum").when(key % 20 < 4, "Gold").when(key % 20 < 9, "Silver")
        .otherwise("Standard")
    )
    player = customer.join(venue, customer.c_nationkey == venue.n_nationkey).select(
        _id("P", key).alias("player_id"),
        F.date_add(F.lit("1991-01-01").cast("date"), (key % 1400).cast("int")).alias("enrollment_date"),
        tier.alias("loyalty_tier"),
        _pick(key, ["21-30", "31-40", "41-50", "51-64", "65+"]).alias("age_band"),
        F.col("r_name").alias("home_region"),
        F.when(key % 100 < 72, 1).otherwise(0).alias("marketing_opt_in"),
        F.when(key % 50 < 47, 1).otherwise(0).alias("active_flag"),
    )

    key = F.col("s_suppkey")
    machine = supplier.select(
        _id("M", key).alias("machine_id"),
        _id("L", F.col("s_nationkey")).alias("location_id"),
        _id("Maker ", key % 5).alias("manufacturer"),
        _id("Cabinet ", key % 4).alias("cabinet_type"),
        _id("Title ", key % 50).alias("game_title"),
        _id("Category ", key % 3).alias("game_category"),
        F.date_add(F.lit("1991-01-01").cast("date"), (key % 1000).cast("int")).alias("install_date"),
        _id("v", key % 4 + 1).alias("software_version"),
        F.when(key % 20 == 0, "Maintenance").otherwise("Active").alias("machine_status"),
        ((key % 40 + 50) / 1000).cast("decimal(8,4)").alias("theoretical_hold_pct"),
    )

    # A visit is one order at one supplier. Grouping by the order key first lets the aggregate
    # that builds sessions reuse the partitioning of the join with orders.
    wager = (F.col("l_extendedprice").cast("decimal(18,2)") * F.lit(PRICE_FACTOR).cast("decimal(6,4)")).cast(
        "decimal(18,2)"
    )
    net = (F.col("wager_amount") * (F.col("l_discount").cast("decimal(4,2)") - F.lit(HOUSE_EDGE).cast("decimal(4,2)"))).cast(
        "decimal(18,2)"
    )
    start = F.col("o_orderdate") + F.make_dt_interval(mins=(F.col("o_orderkey") % 1440).cast("int"))
    play = (
        read("lineitem")
        .join(read("orders"), F.col("l_orderkey") == F.col("o_orderkey"))
        .join(supplier, F.col("l_suppkey") == F.col("s_suppkey"))
        .withColumn("wager_amount", wager)
        .withColumn("net_gaming_revenue", net)
        .withColumn("started", start)
    )
    jackpot = (F.col("l_returnflag") == "R") & (F.col("l_linenumber") == 7)
    session_id = F.concat_ws("-", F.lit("S"), F.col("l_orderkey"), F.col("l_suppkey"))
    transaction = play.select(
        F.concat_ws("-", F.lit("T"), "l_orderkey", "l_linenumber", "l_suppkey", "l_partkey").alias("transaction_id"),
        session_id.alias("session_id"),
        _id("P", F.col("o_custkey")).alias("player_id"),
        _id("M", F.col("l_suppkey")).alias("machine_id"),
        _id("L", F.col("s_nationkey")).alias("location_id"),
        F.col("started").alias("transaction_timestamp"),
        "wager_amount",
        (F.col("wager_amount") - F.col("net_gaming_revenue")).cast("decimal(18,2)").alias("payout_amount"),
        F.when(jackpot, F.col("wager_amount")).otherwise(F.lit(0).cast("decimal(18,2)")).alias("jackpot_amount"),
        "net_gaming_revenue",
        F.when(jackpot, "Jackpot")
        .when(F.col("net_gaming_revenue") < 0, "Winning Round")
        .otherwise("Standard Round")
        .alias("transaction_type"),
    )

    visits = (
        play.groupBy("l_orderkey", "l_suppkey", "o_custkey", "s_nationkey", "started")
        .agg(
            F.sum(F.col("l_quantity").cast("long")).alias("rounds"),
            F.sum("wager_amount").alias("wager"),
            F.sum("net_gaming_revenue").alias("net"),
        )
        .withColumn("minutes", (F.col("rounds") % 115 + 5).cast("int"))
    )
    session = visits.select(
        session_id.alias("session_id"),
        _id("P", F.col("o_custkey")).alias("player_id"),
        _id("M", F.col("l_suppkey")).alias("machine_id"),
        _id("L", F.col("s_nationkey")).alias("location_id"),
        F.col("started").alias("session_start"),
        (F.col("started") + F.make_dt_interval(mins=F.col("minutes"))).alias("session_end"),
        F.col("minutes").alias("session_duration_minutes"),
        F.col("rounds").alias("total_rounds"),
        F.col("wager").cast("decimal(18,2)").alias("total_wager"),
        (F.col("wager") - F.col("net")).cast("decimal(18,2)").alias("total_payout"),
        F.col("net").cast("decimal(18,2)").alias("net_gaming_revenue"),
    )

    # The log's 30 days are spread over 80 earlier months so that it spans the order history.
    machines = supplier.agg(F.count("*").alias("machines"))
    shift = (F.col("event_id") % 80 * 30 + 8217).cast("int")
    logged = (
        read("events")
        .crossJoin(F.broadcast(machines))
        .withColumn("asset", F.col("user_id") % F.col("machines"))
        .join(supplier, F.col("asset") == F.col("s_suppkey"))
        .withColumn("at", F.col("ts") - F.make_dt_interval(days=shift))
    )
    severity = (
        F.when(F.col("value") >= 150, "Critical").when(F.col("value") >= 80, "High")
        .when(F.col("value") >= 30, "Medium").otherwise("Low")
    )
    event = logged.select(
        "event_id",
        _id("M", F.col("asset")).alias("machine_id"),
        _id("L", F.col("s_nationkey")).alias("location_id"),
        F.col("at").alias("event_timestamp"),
        "event_type",
        severity.alias("severity"),
        F.floor("value").cast("int").alias("downtime_minutes"),
        _id("v", F.col("asset") % 4 + 1).alias("software_version"),
        _id("E", F.col("event_id") % 100).alias("error_code"),
        F.to_date("at").alias("event_date"),
        F.when(F.col("value") >= 80, 1).otherwise(0).alias("requires_investigation"),
        F.when(F.col("event_type").isin("signup", "view"), 1).otherwise(0).alias("planned_event_flag"),
    )
    return Floor(location, player, machine, session, transaction, event)
