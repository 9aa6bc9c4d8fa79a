"""Verdicts on URLs: a list of explicit rules first, mined association rules for the rest.

Explicit rules name a host and a path prefix and hold for the host and its subdomains; the longest
fitting one decides. For other URLs, FP-growth mines combinations of URL tokens that go with labels of
unwanted documents. A combination is a rule if at least ``MIN_PAGES`` unwanted labelled URLs hold it, however
many are labelled, its confidence reaches the threshold and no part of it is as confident. Tokens that fewer unwanted
URLs hold cannot be in a rule and are dropped before. Rules are matched by an inverted index from token to rule: a rule fits a
URL if as many of its tokens are met as it has. A URL that no rule fits is allowed.

Defined cases: a null URL or one without ``://`` has an empty host and path, no token and the verdict
``allow``; without labelled rows of both kinds there are no mined rules. Repeated rows get equal rows;
other columns are not read.
"""

from __future__ import annotations

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from floorlens.session import pin

#: Host and path prefix, verdict.
URL_RULES = [
    ("org/", "allow"),
    ("example.org/es/", "block"),
    ("example.org/en/1", "block"),
    ("com/fr/", "allow"),
    ("com/de/", "block"),
]
MIN_PAGES = 20
MIN_CONFIDENCE = 0.9
BAD = "verdict:block"
LOWER, UPPER = "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def parsed(pages: DataFrame, key: str = "page_id", url: str = "url") -> DataFrame:
    """Key, host (A-Z lower-cased), path and the distinct tokens of both."""
    rest = F.expr(f"CASE WHEN instr({url}, '://') > 0 THEN substring({url}, instr({url}, '://') + 3) ELSE '' END")
    rows = pages.select(F.col(key), rest.alias("rest"))
    rows = rows.select(
        key,
        F.translate(F.regexp_extract("rest", r"^([^/?#]*)", 1), UPPER, LOWER).alias("host"),
        F.regexp_extract("rest", r"^[^/?#]*([^?#]*)", 1).alias("path"),
    )
    hosts = F.expr("transform(filter(split(host, '[.]'), t -> t <> ''), t -> concat('host:', t))")
    paths = F.expr("transform(filter(split(path, '[/.]'), t -> t <> ''), t -> concat('path:', t))")
    return rows.withColumn("tokens", F.array_distinct(F.concat(hosts, paths)))


def explicit(rules: list[tuple[str, str]]) -> tuple[Column, Column]:
    """The longest fitting rule and its verdict, null where none fits."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for text, says in sorted(rules, key=lambda r: len(r[0])):
        host, _, path = text.partition("/")
        fits = ((F.col("host") == host) | F.endswith("host", F.lit(f".{host}"))) & F.startswith("path", F.lit(f"/{path}"))
        rule, verdict = F.when(fits, F.lit(text)).otherwise(rule), F.when(fits, F.lit(says)).otherwise(verdict)
    return rule, verdict


def mined(
    rows: DataFrame, labels: DataFrame, key: str = "page_id",
    min_pages: int = MIN_PAGES, min_confidence: float = MIN_CONFIDENCE,
) -> DataFrame:
    """Rules mined from all labelled URLs: ``rule`` (sorted tokens), ``confidence``, ``support``.

    ``labels``: doc_id, quality, toxic; a document is unwanted if it is toxic or of quality 0. Several
    labels of one id count as unwanted if one of them does.
    """
    bad = labels.where("doc_id IS NOT NULL").groupBy("doc_id").agg(
        F.max(F.when((F.col("toxic") == 1) | (F.col("quality") == 0), 1).otherwise(0)).alias("bad")
    )
    labelled = pin(
        rows.where(F.size("tokens") > 0).join(bad, F.col(key) == F.col("doc_id"))
        .select(F.monotonically_increasing_id().alias("basket"), "tokens", "bad")
    )
    total = labelled.count()
    held = labelled.select("basket", "bad", F.explode("tokens").alias("token"))
    frequent = pin(held.where("bad = 1").groupBy("token").agg(F.count("*").alias("n")).where(F.col("n") >= min_pages).select("token"))
    baskets = pin(
        held.join(frequent, "token").groupBy("basket", "bad").agg(F.collect_list("token").alias("tokens"))
        .select(F.when(F.col("bad") == 1, F.array_append("tokens", F.lit(BAD))).otherwise(F.col("tokens")).alias("items"))
    )
    # Half a page less, so that rounding does not ask for one more.
    n = baskets.count()
    support = (min_pages - 0.5) / max(n, 1)
    model = FPGrowth(
        itemsCol="items", minSupport=min(support, 1.0), minConfidence=min_confidence,
        numPartitions=max(1, baskets.rdd.getNumPartitions()),
    ).fit(baskets)
    found = model.associationRules.where((F.element_at("consequent", 1) == BAD) & (F.lit(support) <= 1)).select(
        F.sort_array("antecedent").alias("rule"), "confidence", (F.col("support") * n / max(total, 1)).alias("support")
    )
    found = pin(found)
    # A rule with a part that is as confident adds nothing: drop one token at a time and look the rest up.
    parts = found.select(
        "rule", "confidence", F.explode(F.expr("transform(rule, t -> array_remove(rule, t))")).alias("part")
    )
    better = found.select(F.col("rule").alias("part"), F.col("confidence").alias("other"))
    idle = parts.join(better, "part").where("other >= confidence").select("rule").distinct()
    return found.join(idle, "rule", "left_anti")


def matched(rows: DataFrame, rules: DataFrame) -> DataFrame:
    """``id`` and ``mark`` of the rows that a rule fits, with the highest confidence.

    The inverted index holds the tokens of rules only, so other tokens end at the join.
    """
    index = rules.select("rule", "confidence", F.size("rule").alias("needs"), F.explode("rule").alias("token"))
    met = rows.select("id", "mark", F.explode("tokens").alias("token")).join(index, "token")
    met = met.groupBy("id", "mark", "rule", "needs", "confidence").agg(F.size(F.collect_set("token")).alias("met"))
    return met.where("met = needs").groupBy("id", "mark").agg(F.max("confidence").alias("confidence"))


def judge(
    pages: DataFrame, labels: DataFrame, rules: list[tuple[str, str]] | None = None, key: str = "page_id", url: str = "url",
    min_pages: int = MIN_PAGES, min_confidence: float = MIN_CONFIDENCE,
) -> DataFrame:
    """Per row: key, host, path, ``rule`` (explicit, or null), ``verdict``, ``confidence`` of the mined rule."""
    rows = parsed(pages, key, url)
    rule, says = explicit(URL_RULES if rules is None else rules)
    rows = rows.withColumn("id", F.coalesce(F.col(key).cast("string"), F.lit(""))).withColumn("mark", F.xxhash64("host", "path"))
    found = matched(rows, mined(rows, labels, key, min_pages, min_confidence))
    return (
        rows.join(found, ["id", "mark"], "left")
        .withColumn("rule", rule)
        .withColumn("verdict", F.coalesce(says, F.when(F.col("confidence").isNotNull(), "block").otherwise("allow")))
        .select(key, "host", "path", "rule", "verdict", "confidence")
    )
