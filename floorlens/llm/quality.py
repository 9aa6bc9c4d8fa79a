"""Quality rules as a ledger of failure bits.

Every rule is evaluated once per document; the ledger keeps the measurements and one bit per failed
rule. A policy is a set of rules by version: applying or comparing policies only needs the bits.

Defined cases: a null, empty or blank text has no words, measurements of 0 and fails ``few_words``.
Rows are judged one by one, so repeated rows get equal rows; null ids stay null. Other columns,
whatever their names, are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from floorlens.session import pin

MEASURES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines"]

#: Condition of failure by rule; the place in this mapping is the rule's bit.
RULES = {
    "few_words": "n_words < 50",
    "repeated_windows": "100 * n_repeat_words > 50 * n_words",
    "symbols": "4 * n_symbols > 3 * n_words",
    "repeated_lines": "2 * n_dup_lines > n_lines",
    "word_length": "word_chars < 2 * n_words OR word_chars > 15 * n_words",
}

#: Rules that count, by policy version.
POLICIES = {
    "base": ["few_words", "repeated_windows"],
    "v1": ["few_words", "repeated_windows", "symbols", "repeated_lines"],
    "v2": list(RULES),
}
CURRENT = "v2"


def mask(rules: list[str]) -> int:
    return sum(1 << list(RULES).index(rule) for rule in rules)


def measured(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Key and measurements of each row.

    Three-word windows are told apart by 64-bit hashes within one text. Positions are only sorted in
    texts where some window is met twice.
    """
    rows = docs.select(F.col(key), F.coalesce(text, F.lit("")).alias("body"))
    rows = rows.select(
        key,
        F.expr(r"array_remove(split(body, '[ \\t-\\r]+'), '')").alias("words"),
        F.expr("length(regexp_replace(body, '[^#*$%&|<>]+', ''))").cast("long").alias("n_symbols"),
        F.expr(r"filter(split(body, '\\n'), line -> line rlike '[^ \\t-\\r]')").alias("lines"),
    )
    rows = rows.select(
        key, "n_symbols",
        F.size("words").cast("long").alias("n_words"),
        F.length(F.array_join("words", "")).cast("long").alias("word_chars"),
        F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.expr(
            "transform(slice(words, 1, greatest(size(words) - 2, 0)), (w, i) -> xxhash64(w, words[i + 1], words[i + 2]))"
        ).alias("windows"),
    )
    rows = rows.withColumn("repeats", F.size("windows") > F.size(F.array_distinct("windows")))
    rows = rows.withColumn(
        "places",
        F.expr("CASE WHEN repeats THEN array_sort(transform(windows, (h, i) -> struct(h, i))) END"),
    ).drop("windows")
    rows = rows.withColumn(
        "starts",
        F.expr(
            "sort_array(transform(filter(places, (p, k) -> p.h <=> get(places, k + 1).h OR p.h <=> get(places, k - 1).h), p -> p.i))"
        ),
    ).drop("places")
    # The last window covers three words, each earlier one as many as lie before the next.
    covered = F.expr(
        "aggregate(transform(starts, (p, k) -> coalesce(least(3, get(starts, k + 1) - p), 3)), 0L, (total, x) -> total + x)"
    )
    return rows.withColumn("n_repeat_words", F.coalesce(covered, F.lit(0)).cast("long")).select(key, *MEASURES)


def ledger(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Measurements and ``fails``: the bits of all rules the document fails."""
    bits = [F.when(F.expr(rule), 1 << bit).otherwise(0) for bit, rule in enumerate(RULES.values())]
    fails = bits[0]
    for bit in bits[1:]:
        fails = fails.bitwiseOR(bit)
    return measured(docs, key, text).withColumn("fails", fails.cast("long"))


def failed(policy: str) -> Column:
    """Whether a ledger row fails a rule of the policy."""
    return F.col("fails").bitwiseAND(F.lit(mask(POLICIES[policy]))) != 0


def judge(docs: DataFrame, policy: str = CURRENT, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The ledger with the verdicts of the base policy and of ``policy`` on top of it."""
    return (
        ledger(docs, key, text)
        .withColumn("base_failed", failed("base"))
        .withColumn("kept", ~(failed("base") | failed(policy)))
    )


def ablations(rows: DataFrame, policy: str = CURRENT) -> DataFrame:
    """For each rule of a policy: documents that fail it, that fail it alone, and that would be kept without it.

    The ledger is first reduced to at most 2^rules sets of bits.
    """
    used = mask(POLICIES[policy])
    sets = rows.groupBy(F.col("fails").bitwiseAND(F.lit(used)).alias("fails")).agg(F.count("*").alias("n"))
    rules = F.array(*[
        F.struct(F.lit(rule).alias("rule"), F.lit(mask([rule])).alias("bit")) for rule in POLICIES[policy]
    ])
    each = sets.select("fails", "n", F.explode(rules).alias("r")).select("fails", "n", "r.rule", "r.bit")
    count = lambda condition: F.sum(F.when(condition, F.col("n")).otherwise(0))
    return each.groupBy("rule").agg(
        count(F.col("fails").bitwiseAND(F.col("bit")) != 0).alias("failed"),
        count(F.col("fails") == F.col("bit")).alias("failed_alone"),
        count(F.col("fails").bitwiseAND(F.bitwise_not("bit")) == 0).alias("kept_without"),
    )


def accept(docs: DataFrame, policy: str = CURRENT, text: str = "text") -> DataFrame:
    """The rows that pass, with the columns they came with."""
    spot = "_row"
    while spot in docs.columns:
        spot += "_"
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias(spot), F.col(text).alias("_text"))
    # Written before it is filtered: pushed below the measurements, the verdict would repeat them many times over.
    return pin(judge(rows, policy, spot, "_text").select(spot, "kept")).where("kept").select(f"{spot}.*")
