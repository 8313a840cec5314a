"""Classifiers of ``pyspark.ml`` with the reference's settings, tuning, scoring."""

from __future__ import annotations

import random
from collections.abc import Mapping, Sequence
from datetime import date
from itertools import product

from pyspark.ml import Estimator, PipelineModel, Pipeline, Transformer
from pyspark.ml.classification import (
    GBTClassifier,
    LogisticRegression,
    RandomForestClassifier,
)
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.tuning import CrossValidator, CrossValidatorModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vintagemart.functions.dates import as_date
from vintagemart.operators.ranking import shuffled_row_number
from vintagemart.sources.scratch import materialize

VECTOR = "feature_vector"

# The searched grid, by its meaning in gradient-boosted trees.
SEARCH_GRID = {
    "maxIter": [25, 50],
    "maxDepth": [2, 3],
    "stepSize": [0.01, 0.1],
    "subsamplingRate": [0.6, 0.8],
    "featureSubsetStrategy": ["0.6", "0.8"],
    "minInfoGain": [0.0, 0.1],
    "minInstancesPerNode": [1, 3, 5],
}
SEARCH_DRAWS = 100
SEARCH_FOLDS = 3


def with_vector(df: DataFrame, array_col: str = "features") -> DataFrame:
    """The array column as an ML vector."""
    return df.withColumn(VECTOR, array_to_vector(F.col(array_col).cast("array<double>")))


def assembler(columns: Sequence[str]) -> VectorAssembler:
    return VectorAssembler(inputCols=list(columns), outputCol=VECTOR)


def logistic_regression(
    n_train: int, label: str = "label", weight: str | None = "weight", max_iter: int = 1000
) -> LogisticRegression:
    """Unit inverse strength on the sum of losses is ``1 / n`` on their mean."""
    lr = LogisticRegression(
        featuresCol=VECTOR,
        labelCol=label,
        maxIter=max_iter,
        regParam=1.0 / n_train,
        elasticNetParam=0.0,
        standardization=False,
    )
    return lr.setWeightCol(weight) if weight else lr


def random_forest(
    label: str = "label", weight: str | None = "weight", trees: int = 100, seed: int = 42
) -> RandomForestClassifier:
    """100 trees of depth 10 with at least 10 rows a leaf.

    A minimum of 20 rows to split is implied: a split leaves 10 on each side.
    """
    forest = RandomForestClassifier(
        featuresCol=VECTOR,
        labelCol=label,
        numTrees=trees,
        maxDepth=10,
        minInstancesPerNode=10,
        featureSubsetStrategy="sqrt",
        impurity="gini",
        maxMemoryInMB=1024,  # fewer passes over the rows per tree level
        seed=seed,
    )
    return forest.setWeightCol(weight) if weight else forest


def fit(estimator: Estimator, train: DataFrame, columns: Sequence[str] | None = None) -> PipelineModel:
    """Fit on named columns, or on a frame that already has the vector."""
    stages = [assembler(columns), estimator] if columns else [estimator]
    return Pipeline(stages=stages).fit(train)


def search_grid(
    draws: int = SEARCH_DRAWS, seed: int = 42, grid: Mapping[str, list] | None = None
) -> list[dict]:
    """Distinct random settings from the grid; all of them if it is smaller."""
    grid = grid or SEARCH_GRID
    settings = [dict(zip(grid, values)) for values in product(*grid.values())]
    return random.Random(seed).sample(settings, min(draws, len(settings)))


def stratified_folds(
    df: DataFrame, ids: Sequence[str], label: str, folds: int = SEARCH_FOLDS, seed: int = 42
) -> DataFrame:
    """Add ``fold``: each class is dealt out evenly."""
    dealt = shuffled_row_number(df, ids, f"fold:{seed}", [label], "fold")
    return dealt.withColumn("fold", (F.col("fold") % folds).cast("int"))


def tune_boosted_trees(
    train: DataFrame,
    ids: Sequence[str],
    label: str = "label",
    draws: int = SEARCH_DRAWS,
    folds: int = SEARCH_FOLDS,
    parallelism: int = 4,
    score_classes: bool = True,
    seed: int = 88,
    grid: Mapping[str, list] | None = None,
) -> tuple[CrossValidatorModel, list[dict]]:
    """Random search with cross-validation over gradient-boosted trees.

    ``score_classes`` ranks settings by the AUC of hard classes; otherwise by
    the AUC of the scores, which the evaluator bins: an approximation.
    """
    trees = GBTClassifier(featuresCol=VECTOR, labelCol=label, seed=seed)
    settings = search_grid(draws, grid=grid)
    maps = [{trees.getParam(name): value for name, value in s.items()} for s in settings]
    judge = BinaryClassificationEvaluator(
        rawPredictionCol="prediction" if score_classes else "rawPrediction",
        labelCol=label,
        metricName="areaUnderROC",
    )
    search = CrossValidator(
        estimator=trees,
        estimatorParamMaps=maps,
        evaluator=judge,
        numFolds=folds,
        foldCol="fold",
        parallelism=parallelism,
        seed=42,
    )
    dealt = materialize(
        stratified_folds(train.select(*ids, VECTOR, label), ids, label, folds), "folds"
    )
    return search.fit(dealt), settings


def predict(model: Transformer, df: DataFrame, keep: Sequence[str]) -> DataFrame:
    """Positive-class probability and class beside the kept columns."""
    scored = model.transform(df)
    return scored.select(
        *keep,
        vector_to_array("probability")[1].alias("prediction_probability"),
        F.col("prediction").cast("int").alias("prediction_binary"),
    )


def logistic_gradient(
    model: PipelineModel, train: DataFrame, label: str = "label", weight: str = "weight"
) -> DataFrame:
    """Slope of the penalised mean loss in each coefficient (``position``) at the
    fitted values; all are 0 at the optimum. One pass, summed per position."""
    fitted = model.stages[-1]
    strength = float(fitted.getOrDefault("regParam"))
    scored = model.transform(train).select(
        (F.col(weight) * (vector_to_array("probability")[1] - F.col(label))).alias("wrong"),
        F.posexplode(vector_to_array(VECTOR)).alias("position", "value"),
        F.col(weight).alias("__weight"),
    )
    slopes = scored.groupBy("position").agg(
        (F.sum(F.col("wrong") * F.col("value")) / F.sum("__weight")).alias("loss")
    )
    coefficients = F.lit([float(c) for c in fitted.coefficients.toArray()])
    penalty = F.lit(strength) * F.element_at(coefficients, F.col("position") + 1)
    return slopes.select("position", (F.col("loss") + penalty).alias("gradient"))


def stamp_predictions(
    predictions: DataFrame, model_name: str, model_version: str, prediction_date: date | str
) -> DataFrame:
    return predictions.withColumns(
        {
            "model_name": F.lit(model_name),
            "model_version": F.lit(str(model_version)),
            "prediction_date": F.lit(as_date(prediction_date)),
            "predicted_timestamp": F.current_timestamp(),
        }
    )
