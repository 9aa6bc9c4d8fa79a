"""Data-quality checks: one row per rule with the number of violations, nothing raised."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from floorlens.functions.exact import count_if
from floorlens.sources.bind import Floor
from floorlens.sources.schemas import TABLES

# Tolerances and domains of the checks.
ROW_TOLERANCE = "0.02"
TOTAL_TOLERANCE = "5"
SEVERITIES = ["Low", "Medium", "High", "Critical"]
INVESTIGATED = ["High", "Critical"]


def _rules(df: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """Count several conditions in one pass; a NULL condition is not a violation."""
    counted = df.agg(*[F.coalesce(count_if(c), F.lit(0)).cast("long").alias(name) for name, c in rules.items()])
    return counted.unpivot([], list(rules), "rule", "violations")


def _all(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts).orderBy("rule")


def primary_keys(floor: Floor) -> DataFrame:
    """Null keys and keys held by more than one row, per table."""
    parts = []
    for table, (_, _, key, _) in TABLES.items():
        held = getattr(floor, table).groupBy(key).agg(F.count("*").alias("rows"))
        parts.append(
            held.agg(
                F.coalesce(F.sum(F.when(F.col(key).isNull(), F.col("rows"))), F.lit(0)).alias(f"{table} key null"),
                F.coalesce(count_if(F.col(key).isNotNull() & (F.col("rows") > 1)), F.lit(0)).alias(
                    f"{table} key repeated"
                ),
            ).unpivot([], [f"{table} key null", f"{table} key repeated"], "rule", "violations")
        )
    return _all(parts)


def orphans(floor: Floor) -> DataFrame:
    """Rows whose reference is NULL or unknown. References are counted before the join, so a
    reference held by a third of all rows is one row by then."""
    links = [
        ("machine", "location"), ("session", "location"), ("session", "machine"), ("session", "player"),
        ("transaction", "session"), ("transaction", "machine"), ("transaction", "player"), ("event", "machine"),
    ]
    parts = []
    for child, parent in links:
        key = f"{parent}_id"
        known = getattr(floor, parent).select(key)
        used = getattr(floor, child).groupBy(key).agg(F.count("*").alias("rows"))
        missing = used.join(known, key, "left_anti").agg(F.coalesce(F.sum("rows"), F.lit(0)).alias("violations"))
        parts.append(missing.select(F.lit(f"{child} without {parent}").alias("rule"), "violations"))
    return _all(parts)


def location_agreement(floor: Floor) -> DataFrame:
    """Sessions and events must be at their machine's location; an unknown machine disagrees too."""
    home = floor.machine.select("machine_id", F.col("location_id").alias("home"))
    parts = []
    for table in ("session", "event"):
        placed = getattr(floor, table).groupBy("machine_id", "location_id").agg(F.count("*").alias("rows"))
        off = placed.join(home, "machine_id", "left").where(~F.col("location_id").eqNullSafe(F.col("home")))
        total = off.agg(F.coalesce(F.sum("rows"), F.lit(0)).alias("violations"))
        parts.append(total.select(F.lit(f"{table} away from machine").alias("rule"), "violations"))
    return _all(parts)


def negative_amounts(floor: Floor) -> DataFrame:
    checks = {
        "session": ["total_wager", "total_payout"],
        "transaction": ["wager_amount", "payout_amount", "jackpot_amount"],
    }
    return _all(
        [
            _rules(getattr(floor, t), {f"{t} {c} negative": F.col(c) < 0 for c in columns})
            for t, columns in checks.items()
        ]
    )


def revenue_arithmetic(floor: Floor, tolerance: str = ROW_TOLERANCE) -> DataFrame:
    """Wager less payout must equal net revenue, row by row."""
    limit = F.lit(tolerance).cast("decimal(4,2)")

    def off(wager: str, payout: str) -> Column:
        return F.abs(F.col(wager) - F.col(payout) - F.col("net_gaming_revenue")) > limit

    return _all(
        [
            _rules(floor.session, {"session revenue off": off("total_wager", "total_payout")}),
            _rules(floor.transaction, {"transaction revenue off": off("wager_amount", "payout_amount")}),
        ]
    )


def revenue_reconciliation(floor: Floor, tolerance: str = TOTAL_TOLERANCE) -> DataFrame:
    sessions = floor.session.agg(F.sum("net_gaming_revenue").alias("session_revenue"))
    transactions = floor.transaction.agg(F.sum("net_gaming_revenue").alias("transaction_revenue"))
    difference = F.abs(F.col("session_revenue") - F.col("transaction_revenue"))
    return sessions.crossJoin(F.broadcast(transactions)).select(
        "session_revenue", "transaction_revenue", difference.alias("difference"),
        F.when(difference > F.lit(tolerance).cast("decimal(6,2)"), 1).otherwise(0).alias("violations"),
    )


def timestamps(floor: Floor) -> DataFrame:
    """Sessions must end after they start and contain their transactions.

    Transactions are reduced to first and last time per session and moment before the join.
    """
    times = floor.session.select("session_id", "session_start", "session_end")
    moments = floor.transaction.groupBy("session_id", "transaction_timestamp").agg(F.count("*").alias("rows"))
    outside = (F.col("transaction_timestamp") < F.col("session_start")) | (
        F.col("transaction_timestamp") > F.col("session_end")
    )
    stray = (
        moments.join(times, "session_id")
        .where(outside)
        .agg(F.coalesce(F.sum("rows"), F.lit(0)).alias("violations"))
        .select(F.lit("transaction outside session").alias("rule"), "violations")
    )
    return _all([_rules(times, {"session end not after start": F.col("session_end") <= F.col("session_start")}), stray])


def summary(floor: Floor) -> DataFrame:
    """Row counts and headline totals."""
    counts = [
        getattr(floor, t).agg(F.count("*").cast("double").alias("value")).select(F.lit(f"{t} rows").alias("measure"), "value")
        for t in TABLES
    ]
    totals = [
        floor.session.agg(F.sum("net_gaming_revenue").alias("session revenue")),
        floor.transaction.agg(F.sum("net_gaming_revenue").alias("transaction revenue")),
        floor.event.agg(
            F.sum("downtime_minutes").alias("downtime minutes"),
            count_if(F.col("severity") == "Critical").alias("critical events"),
            F.sum("requires_investigation").alias("events to investigate"),
        ),
    ]
    wide = [t.select([F.col(f"`{c}`").cast("double").alias(c) for c in t.columns]) for t in totals]
    long = [t.unpivot([], t.columns, "measure", "value") for t in wide]
    return reduce(DataFrame.unionByName, counts + long).orderBy("measure")


def relationship_agreement(floor: Floor) -> DataFrame:
    """A transaction's player, machine and location must be its session's."""
    columns = ["player_id", "machine_id", "location_id"]
    seen = floor.transaction.groupBy("session_id", *columns).agg(F.count("*").alias("rows"))
    expected = floor.session.select("session_id", *[F.col(c).alias(f"expected_{c}") for c in columns])
    joined = seen.join(expected, "session_id")
    names = {f"transaction {c} differs": ~F.col(c).eqNullSafe(F.col(f"expected_{c}")) for c in columns}
    sums = [F.coalesce(F.sum(F.when(c, F.col("rows"))), F.lit(0)).alias(n) for n, c in names.items()]
    return joined.agg(*sums).unpivot([], list(names), "rule", "violations").orderBy("rule")


def severity_domain(floor: Floor) -> DataFrame:
    flagged = F.col("severity").isin(INVESTIGATED).cast("int")
    return _all(
        [
            _rules(
                floor.event,
                {
                    "event severity unknown": ~F.coalesce(F.col("severity").isin(SEVERITIES), F.lit(False)),
                    "event investigation flag off": ~flagged.eqNullSafe(F.col("requires_investigation")),
                },
            )
        ]
    )


def completeness(floor: Floor, expected_rows: dict[str, int] | None = None) -> DataFrame:
    """NULLs per table, non-positive durations and rounds, and row counts where they are known."""
    parts = []
    for table in TABLES:
        df = getattr(floor, table)
        gap = reduce(lambda a, b: a | b, [F.col(c).isNull() for c in df.columns])
        rules = {f"{table} row with null": gap}
        if table == "session":
            rules["session duration not positive"] = F.col("session_duration_minutes") <= 0
            rules["session rounds not positive"] = F.col("total_rounds") <= 0
        parts.append(_rules(df, rules))
        if expected_rows and table in expected_rows:
            off = F.abs(F.count("*") - F.lit(expected_rows[table])).alias("violations")
            parts.append(df.agg(off).select(F.lit(f"{table} row count off").alias("rule"), "violations"))
    return _all(parts)


def declared_constraints(floor: Floor) -> DataFrame:
    flags = {
        "location": ["active_flag"], "player": ["marketing_opt_in", "active_flag"],
        "event": ["requires_investigation", "planned_event_flag"],
    }
    extra = {
        "machine": {"machine hold not between 0 and 1": ~F.col("theoretical_hold_pct").between(0, 1)},
        "event": {"event downtime negative": F.col("downtime_minutes") < 0},
    }
    parts = []
    for table in ("location", "player", "machine", "event"):
        rules = {f"{table} {c} not 0 or 1": ~F.col(c).isin(0, 1) for c in flags.get(table, [])}
        parts.append(_rules(getattr(floor, table), {**rules, **extra.get(table, {})}))
    return _all(parts)
