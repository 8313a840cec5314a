"""Fitted models against what they are supposed to optimise."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from vintagemart.operators import evaluation, modelling, split
from vintagemart.operators.scaling import SCALED, StandardScaling


def sample(n=300, seed=4):
    r = np.random.default_rng(seed)
    x = r.normal(size=(n, 3))
    y = (x @ np.array([1.0, -2.0, 0.0]) + r.normal(size=n) > 1.0).astype(int)
    return x, y


@pytest.fixture(scope="module")
def rows(spark):
    x, y = sample()
    df = spark.createDataFrame(
        [(i, a.tolist(), int(b)) for i, (a, b) in enumerate(zip(x, y))],
        "id bigint, features array<double>, label int",
    )
    return modelling.with_vector(df).cache()


def penalised_optimum(x, y):
    """Newton steps on 1/2 |w|^2 + sum of balanced-weighted log losses."""
    n = len(y)
    weight = np.where(y == 1, n / (2 * y.sum()), n / (2 * (n - y.sum())))
    z = np.hstack([x, np.ones((n, 1))])
    penalty = np.diag([1.0] * x.shape[1] + [0.0])
    w = np.zeros(z.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-z @ w))
        gradient = z.T @ (weight * (p - y)) + penalty @ w
        hessian = (z * (weight * p * (1 - p))[:, None]).T @ z + penalty
        w -= np.linalg.solve(hessian, gradient)
    return w


def test_logistic_regression_finds_the_penalised_optimum(rows):
    x, y = sample()
    weighted = split.add_class_weights(rows)
    model = modelling.fit(modelling.logistic_regression(len(y)), weighted).stages[-1]
    got = [*model.coefficients.toArray(), model.intercept]
    assert got == pytest.approx(penalised_optimum(x, y).tolist(), abs=1e-3)


def test_forest_ranks_well(rows):
    model = modelling.fit(modelling.random_forest(trees=20), split.add_class_weights(rows))
    metrics = evaluation.model_metrics(modelling.predict(model, rows, ["label"])).first()
    assert metrics["auc"] > 0.9 and metrics["recall"] > 0.7
    assert metrics["tn"] + metrics["fp"] + metrics["fn"] + metrics["tp"] == 300


def test_search_settings_are_distinct_and_from_the_grid():
    settings = modelling.search_grid()
    assert len(settings) == modelling.SEARCH_DRAWS == len({str(s) for s in settings})
    assert all(s[k] in modelling.SEARCH_GRID[k] for s in settings for k in s)
    assert len(modelling.search_grid(500, grid={"maxDepth": [2, 3]})) == 2


def test_folds_are_stratified(rows):
    folds = modelling.stratified_folds(rows, ["id"], "label")
    sizes = folds.groupBy("label", "fold").count().collect()
    for label in (0, 1):
        per_fold = [r["count"] for r in sizes if r["label"] == label]
        assert len(per_fold) == 3 and max(per_fold) - min(per_fold) <= 1


def test_scaling_stage_equals_scaling(spark):
    df = spark.range(50).select(F.sqrt("id").alias("a b"), (F.col("id") * 1e-7).alias("x"))
    scaling = StandardScaling.fit(df, ["a b", "x"])
    staged = scaling.transformer().transform(df)
    plain = scaling.apply(df)
    for c in ("a b", "x"):
        assert [r[0] for r in staged.select(SCALED + c).collect()] == [
            r[0] for r in plain.select(c).collect()
        ]
