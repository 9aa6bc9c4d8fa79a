"""Preprocessing and models as MLlib pipelines."""

from __future__ import annotations

from dataclasses import dataclass
from multiprocessing.pool import ThreadPool

from pyspark.ml import Estimator, Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import Imputer, OneHotEncoder, SQLTransformer, StandardScaler, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import RandomForestRegressor
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from floorlens.ml.boosting import HuberBoosting
from floorlens.ml.datasets import numeric
from floorlens.ml.forest import GroupedForest
from floorlens.session import pin

SEED = 42


@dataclass(frozen=True)
class Forest:
    """Size of each published forest."""

    trees: int
    depth: int
    leaf: int


CHURN_FOREST = Forest(400, 12, 4)
FAILURE_FOREST = Forest(500, 8, 2)
DAILY_FOREST = Forest(500, 14, 3)
WEEKLY_FOREST = Forest(600, 12, 3)


@dataclass(frozen=True)
class Boosting:
    """Rounds, step, depth, smallest leaf and smallest split of each published boosting model."""

    rounds: int
    step: float
    depth: int
    leaf: int
    split: int


DAILY_BOOSTING = Boosting(300, 0.03, 3, 4, 8)
WEEKLY_BOOSTING = Boosting(300, 0.025, 2, 4, 8)


def most_frequent(df: DataFrame, columns: list[str]) -> dict[str, str]:
    """Mode per column, the smallest value on a tie. One row per column and value is counted on
    the cluster; one row per column reaches the driver."""
    pairs = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in columns])
    counts = (
        df.select(F.explode(pairs).alias("p")).select("p.*").where("value IS NOT NULL")
        .groupBy("column", "value").agg(F.count("*").alias("n"))
    )
    best = counts.groupBy("column").agg(F.min(F.struct((-F.col("n")).alias("n"), "value")).alias("best"))
    return {r["column"]: r["best"]["value"] for r in best.collect()}


def with_modes(df: DataFrame, modes: dict[str, str]) -> DataFrame:
    return df.fillna(modes)


def preprocessing(numeric_columns: list[str], categorical: list[str]) -> list:
    """Median impute and standardise numbers; one-hot categories, unseen ones all zero."""
    filled = [f"{c}_filled" for c in numeric_columns]
    stages = [
        Imputer(inputCols=numeric_columns, outputCols=filled, strategy="median", relativeError=0.0001),
        VectorAssembler(inputCols=filled, outputCol="numbers"),
        StandardScaler(inputCol="numbers", outputCol="scaled", withMean=True, withStd=True),
    ]
    inputs = ["scaled"]
    if categorical:
        indexed, hot = [f"{c}_index" for c in categorical], [f"{c}_hot" for c in categorical]
        stages += [
            StringIndexer(inputCols=categorical, outputCols=indexed, handleInvalid="keep", stringOrderType="alphabetAsc"),
            OneHotEncoder(inputCols=indexed, outputCols=hot, dropLast=True, handleInvalid="keep"),
        ]
        inputs += hot
    return [*stages, VectorAssembler(inputCols=inputs, outputCol="features")]


def balanced_weights(df: DataFrame, label: str) -> DataFrame:
    """Weight n / (2 * rows of the class); two rows reach the driver."""
    sizes = {r[label]: r["n"] for r in df.groupBy(label).agg(F.count("*").alias("n")).collect()}
    total = sum(sizes.values())
    weight = F.lit(0.0)
    for value, n in sizes.items():
        weight = F.when(F.col(label) == value, F.lit(total / (len(sizes) * n))).otherwise(weight)
    return df.withColumn("class_weight", weight)


def logistic(label: str, rows: int) -> LogisticRegression:
    """Unit inverse regularisation on the summed loss is 1 / rows on the mean loss."""
    return LogisticRegression(
        labelCol=label, featuresCol="features", weightCol="class_weight", maxIter=2000, regParam=1.0 / rows,
        elasticNetParam=0.0, standardization=False,
    )


def forest_classifier(label: str, size: Forest) -> GroupedForest:
    return GroupedForest(
        labelCol=label, featuresCol="features", weightCol="class_weight", trees=size.trees, depth=size.depth, leaf=size.leaf, seed=SEED,
    )


class ForestInParts(Estimator):
    """A forest fitted ``at_once`` trees at a time, some parts side by side.

    A level of all trees of a large, deep forest would go out with every task; a part's level stays small. The
    parts draw their rows by different seeds and count alike, so their mean is the forest's prediction.
    """

    def __init__(self, part: RandomForestRegressor, trees: int, at_once: int = 25, side_by_side: int = 4):
        super().__init__()
        self.part, self.side_by_side = part, side_by_side
        self.sizes = [min(at_once, trees - low) for low in range(0, trees, at_once)]

    def _fit(self, dataset: DataFrame) -> PipelineModel:
        rows = pin(dataset.select(self.part.getFeaturesCol(), self.part.getLabelCol()))
        names = [f"_part_{i}" for i in range(len(self.sizes))]
        parts = [
            self.part.copy({self.part.numTrees: n, self.part.seed: SEED + i, self.part.predictionCol: name})
            for i, (n, name) in enumerate(zip(self.sizes, names))
        ]
        with ThreadPool(self.side_by_side) as pool:
            models = pool.map(lambda estimator: estimator.fit(rows), parts, chunksize=1)
        mean = " + ".join(f"{name} * {n}" for name, n in zip(names, self.sizes))
        output = self.part.getPredictionCol()
        together = SQLTransformer(
            statement=f"SELECT * EXCEPT ({', '.join(names)}), ({mean}) / {sum(self.sizes)} AS {output} FROM __THIS__"
        )
        return PipelineModel([*models, together])


def forest_regressor(label: str, size: Forest) -> ForestInParts:
    part = RandomForestRegressor(
        labelCol=label, featuresCol="features", maxDepth=size.depth, minInstancesPerNode=size.leaf,
        featureSubsetStrategy="sqrt", maxMemoryInMB=512,
    )
    return ForestInParts(part, size.trees)


def boosting_regressor(label: str, size: Boosting) -> HuberBoosting:
    return HuberBoosting(
        labelCol=label, featuresCol="features", rounds=size.rounds, step=size.step, depth=size.depth, leaf=size.leaf, split=size.split,
    )


def prepare(df: DataFrame, numeric_columns: list[str], categorical: list[str], label: str | None = None) -> DataFrame:
    """Numbers as doubles, categories as text, the label as a double."""
    out = numeric(df, numeric_columns).withColumns({c: F.col(c).cast("string") for c in categorical})
    return out.withColumn(label, F.col(label).cast("double")) if label else out


def fit(df: DataFrame, numeric_columns: list[str], categorical: list[str], estimator) -> PipelineModel:
    return Pipeline(stages=[*preprocessing(numeric_columns, categorical), estimator]).fit(df)


def probability(model: PipelineModel, df: DataFrame, name: str) -> DataFrame:
    """Score rows with the probability of class 1, dropping the pipeline's working columns."""
    scored = model.transform(df).withColumn(name, vector_to_array("probability")[1])
    return scored.select(*df.columns, name)


def prediction(model: PipelineModel, df: DataFrame, name: str) -> DataFrame:
    return model.transform(df).withColumn(name, F.col("prediction")).select(*df.columns, name)


def feature_names(model: PipelineModel, df: DataFrame) -> list[str]:
    """Names in vector order, from the attributes the assembler records."""
    meta = model.transform(df.limit(0)).schema["features"].metadata["ml_attr"]["attrs"]
    found = {a["idx"]: a.get("name", "") for group in meta.values() for a in group}
    numbers = next(s for s in model.stages if isinstance(s, VectorAssembler)).getInputCols()
    scaled = [c.removesuffix("_filled") for c in numbers]
    return [scaled[i] if i < len(scaled) else found[i].replace("_hot_", "_", 1) for i in sorted(found)]


def importance(model: PipelineModel, df: DataFrame, higher: str = "Higher risk", lower: str = "Lower risk") -> DataFrame:
    """Coefficient or importance per feature with its size and direction, largest first."""
    last = model.stages[-1]
    values = list(last.coefficients) if hasattr(last, "coefficients") else list(last.featureImportances.toArray())
    kind = "coefficient" if hasattr(last, "coefficients") else "feature_importance"
    rows = [(n, float(v), abs(float(v))) for n, v in zip(feature_names(model, df), values)]
    table = df.sparkSession.createDataFrame(rows, "feature string, value double, absolute_importance double")
    direction = F.when(F.col("value") > 0, higher).when(F.col("value") < 0, lower).otherwise("Neutral")
    return (
        table.withColumn("importance_type", F.lit(kind))
        .withColumn("effect_direction", direction)
        .orderBy(F.desc("absolute_importance"), "feature")
    )
