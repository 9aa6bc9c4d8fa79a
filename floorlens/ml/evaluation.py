"""Splits, folds and classification metrics as aggregates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from floorlens.functions.exact import count_if
from floorlens.operators.ranks import Ranking, with_global_ranks
from floorlens.operators.running import sums_before

SEED = 42
# Thresholds of the sweep.
THRESHOLDS = [0.20, 0.25, 0.30, 0.35, 0.40, 0.45, 0.50, 0.55, 0.60, 0.65, 0.70, 0.75, 0.80]


def _places_in_class(df: DataFrame, label: str, id_col: str, seed: int) -> DataFrame:
    """Position of each row among the rows of its class, in an order set by a hash of id and seed.

    The classes are ranked as one sequence (class, then hash) and the sizes of the classes before
    are taken off, so no class has to fit into one task.
    """
    shuffled = F.concat_ws("|", F.lpad(F.col(label).cast("string"), 12, " "), F.md5(F.concat_ws("|", id_col, F.lit(str(seed)))))
    placed = with_global_ranks(df.withColumn("_order", shuffled), [Ranking("_order", {"_place": "row_number"})], [id_col])
    sizes = placed.groupBy(F.col(label).alias("_class")).agg(
        F.count("*").alias("_size"), (F.min("_place") - 1).alias("_before")
    )
    # One row per class label: two for a binary target.
    return (
        placed.join(F.broadcast(sizes), placed[label] == sizes["_class"])
        .withColumn("_place", F.col("_place") - F.col("_before"))
        .drop("_order", "_class", "_before")
    )


def stratified_folds(df: DataFrame, label: str, id_col: str, k: int = 5, seed: int = SEED) -> DataFrame:
    """Add ``fold`` 0..k-1 with class shares equal in every fold up to one row."""
    placed = _places_in_class(df, label, id_col, seed)
    return placed.withColumn("fold", ((F.col("_place") - 1) % k).cast("int")).drop("_place", "_size")


def stratified_split(
    df: DataFrame, label: str, id_col: str, test_fraction: float = 0.20, seed: int = SEED
) -> DataFrame:
    """Add ``is_test``: the same share of every class, rounded to the nearest row."""
    placed = _places_in_class(df, label, id_col, seed)
    wanted = F.floor(F.col("_size") * F.lit(test_fraction) + 0.5)
    return placed.withColumn("is_test", (F.col("_place") <= wanted).cast("int")).drop("_place", "_size")


def _rate(top: Column, bottom: Column) -> Column:
    """0 where there is nothing to divide by."""
    return F.coalesce(top / F.nullif(bottom, F.lit(0)), F.lit(0.0))


def metrics_from_counts() -> list[Column]:
    """accuracy, precision, recall and F1 from columns tp, fp, tn, fn."""
    tp, fp, tn, fn = (F.col(c) for c in ("true_positive", "false_positive", "true_negative", "false_negative"))
    return [
        _rate(tp + tn, tp + fp + tn + fn).alias("accuracy"),
        _rate(tp, tp + fp).alias("precision"),
        _rate(tp, tp + fn).alias("recall"),
        _rate(2 * tp, 2 * tp + fp + fn).alias("f1_score"),
    ]


def _counts(label: str, predicted: Column) -> list[Column]:
    actual = F.col(label) == 1
    return [
        count_if(actual & predicted).alias("true_positive"),
        count_if(~actual & predicted).alias("false_positive"),
        count_if(~actual & ~predicted).alias("true_negative"),
        count_if(actual & ~predicted).alias("false_negative"),
    ]


CONFUSION = ["true_negative", "false_positive", "false_negative", "true_positive"]


def classification_metrics(df: DataFrame, label: str, prediction: str, by: list[str] | None = None) -> DataFrame:
    counts = df.groupBy(*(by or [])).agg(*_counts(label, F.col(prediction) == 1))
    return counts.select(*(by or []), *metrics_from_counts(), *CONFUSION)


def class_report(df: DataFrame, label: str, prediction: str) -> DataFrame:
    """Precision, recall, F1 and support of each class."""
    parts = []
    counts = df.agg(*_counts(label, F.col(prediction) == 1))
    tp, fp, tn, fn = (F.col(c) for c in ("true_positive", "false_positive", "true_negative", "false_negative"))
    for cls, hit, wrong, missed in ((0, tn, fn, fp), (1, tp, fp, fn)):
        parts.append(
            counts.select(
                F.lit(cls).alias("class"), _rate(hit, hit + wrong).alias("precision"),
                _rate(hit, hit + missed).alias("recall"), _rate(2 * hit, 2 * hit + wrong + missed).alias("f1_score"),
                (hit + missed).alias("support"),
            )
        )
    return parts[0].unionByName(parts[1]).orderBy("class")


def report_averages(report: DataFrame) -> DataFrame:
    """Accuracy and the plain and support-weighted means over the classes of ``class_report``."""
    measures, support = ["precision", "recall", "f1_score"], F.sum("support")
    plain = [F.avg(m).alias(m) for m in measures]
    weighted = [_rate(F.sum(F.col(m) * F.col("support")), support).alias(m) for m in measures]
    # Recall of a class times its support is what the class got right.
    accuracy = [_rate(F.sum(F.col("recall") * F.col("support")), support).alias(m) for m in measures]
    rows = [("accuracy", accuracy), ("macro avg", plain), ("weighted avg", weighted)]
    parts = [report.agg(*columns, support.alias("support")).select(F.lit(name).alias("average"), "*") for name, columns in rows]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def roc_auc(df: DataFrame, label: str, score: str, by: list[str] | None = None) -> DataFrame:
    """Exact area under the ROC curve.

    Scores are first reduced to one row per distinct score with its class counts; a running count
    over that histogram then gives the pairs each positive wins, ties counting half.
    """
    by = by or []
    total = _running_histogram(df, label, score, by)
    wins = F.sum(F.col("pos") * (F.col("neg_below") + F.col("neg") / 2))
    pairs = (F.sum("pos") * F.sum("neg")).cast("double")
    return total.groupBy(*by).agg((wins / F.nullif(pairs, F.lit(0.0))).alias("roc_auc"))


def _running_histogram(df: DataFrame, label: str, score: str, by: list[str]) -> DataFrame:
    """Class counts per distinct score with the number of rows of each class scoring lower."""
    histogram = df.groupBy(*by, F.col(score).alias("score")).agg(
        count_if(F.col(label) == 1).alias("pos"), count_if(F.col(label) == 0).alias("neg")
    )
    return sums_before(histogram, ["score"], {"pos_below": "pos", "neg_below": "neg"}, by)


def roc_points(df: DataFrame, label: str, score: str) -> DataFrame:
    """False and true positive rate when everything scoring at least the threshold is flagged.

    The curve starts where nothing is flagged, at (0, 0) without a threshold.
    """
    points = _curve(df, label, score).select(
        "threshold",
        _rate(F.col("fp"), F.col("negatives")).alias("false_positive_rate"),
        _rate(F.col("tp"), F.col("positives")).alias("true_positive_rate"),
    )
    return _with_end(points, 0.0, 0.0).orderBy(F.desc_nulls_first("threshold"))


def precision_recall_points(df: DataFrame, label: str, score: str) -> DataFrame:
    """Precision and recall per threshold; the curve ends at precision 1 and recall 0, without a threshold."""
    points = _curve(df, label, score).select(
        "threshold",
        _rate(F.col("tp"), F.col("tp") + F.col("fp")).alias("precision"),
        _rate(F.col("tp"), F.col("positives")).alias("recall"),
    )
    return _with_end(points, 1.0, 0.0).orderBy(F.desc_nulls_first("threshold"))


def _with_end(points: DataFrame, first: float, second: float) -> DataFrame:
    return points.unionByName(points.sparkSession.createDataFrame([(None, first, second)], points.schema))


def _curve(df: DataFrame, label: str, score: str) -> DataFrame:
    """Rows of each class at or above each distinct score, from one pass over the scored rows."""
    histogram = _running_histogram(df, label, score, [])
    # One row.
    sizes = histogram.agg(F.sum("pos").alias("positives"), F.sum("neg").alias("negatives"))
    return histogram.crossJoin(F.broadcast(sizes)).select(
        F.col("score").alias("threshold"), "positives", "negatives",
        (F.col("positives") - F.col("pos_below")).alias("tp"),
        (F.col("negatives") - F.col("neg_below")).alias("fp"),
    )


def probability_histogram(df: DataFrame, label: str, score: str, bins: int = 30) -> DataFrame:
    """Rows per class and bin; each class has equal-width bins between its own extremes, the last closed."""
    ends = df.groupBy(label).agg(F.min(score).alias("low"), F.max(score).alias("high"))
    # One row per class.
    placed = df.join(F.broadcast(ends), label)
    width = F.col("high") - F.col("low")
    place = F.when(width == 0, F.lit(bins // 2)).otherwise(F.floor((F.col(score) - F.col("low")) / F.nullif(width, F.lit(0.0)) * bins))
    return (
        placed.groupBy(label, F.least(place, F.lit(bins - 1)).alias("bin"))
        .agg(F.count("*").alias("row_count"), F.min(score).alias("lowest"), F.max(score).alias("highest"))
        .orderBy(label, "bin")
    )


def threshold_sweep(df: DataFrame, label: str, score: str, thresholds: list[float] | None = None) -> DataFrame:
    """Metrics at each threshold in one pass: counts for all thresholds in one aggregate."""
    cuts = thresholds or THRESHOLDS
    aggregates = []
    for i, cut in enumerate(cuts):
        for c, name in zip(_counts(label, F.col(score) >= cut), ("tp", "fp", "tn", "fn")):
            aggregates.append(c.alias(f"{name}_{i}"))
    wide = df.agg(*aggregates)
    rows = F.array(
        *[
            F.struct(
                F.lit(cut).alias("threshold"),
                F.col(f"tp_{i}").alias("true_positive"), F.col(f"fp_{i}").alias("false_positive"),
                F.col(f"tn_{i}").alias("true_negative"), F.col(f"fn_{i}").alias("false_negative"),
            )
            for i, cut in enumerate(cuts)
        ]
    )
    return (
        wide.select(F.explode(rows).alias("r")).select("r.*").select("threshold", *metrics_from_counts())
        .orderBy("threshold")
    )


def best_threshold(sweep: DataFrame) -> float:
    """Highest F1, then recall, then precision, then the lowest threshold."""
    order = [F.desc("f1_score"), F.desc("recall"), F.desc("precision"), F.asc("threshold")]
    return sweep.orderBy(*order).first()["threshold"]


FOLD_METRICS = [
    "train_accuracy", "validation_accuracy", "validation_precision", "validation_recall", "validation_f1",
    "validation_roc_auc",
]


def summarise_folds(folds: DataFrame, population: bool = False) -> DataFrame:
    """Mean, standard deviation, minimum and maximum of each metric over the folds."""
    present = [m for m in FOLD_METRICS if m in folds.columns]
    spread = F.stddev_pop if population else F.stddev_samp
    return (
        folds.unpivot(["fold"], present, "metric", "value")
        .groupBy("metric")
        .agg(
            F.avg("value").alias("mean"), spread("value").alias("standard_deviation"),
            F.min("value").alias("minimum"), F.max("value").alias("maximum"),
        )
        .orderBy("metric")
    )
