"""Correlations in tiles, held against numpy's and against odd columns."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from vintagemart.operators import columns, correlation


def matrix_of(df, names):
    place = {n: i for i, n in enumerate(names)}
    found = df.toPandas()
    out = np.full((len(names), len(names)), np.inf)
    out[found["earlier"].map(place), found["later"].map(place)] = found["corr"]
    return out, len(found)


@pytest.mark.parametrize("width", [2, 31, 32, 33, 70])
def test_same_as_numpy(spark, monkeypatch, width):
    monkeypatch.setattr(correlation, "VALUES", 100)
    dice = np.random.default_rng(width)
    x = dice.normal(size=(57, width)) * 10.0 ** dice.integers(-8, 9, width) + 1e6
    x[:, -1] = -3 * x[:, 0]
    names = [f"f{i}" for i in range(width)]
    df = spark.createDataFrame(pd.DataFrame(x, columns=names)).withColumn("i", F.lit("x")).repartition(5)
    got, n = matrix_of(correlation.tiled_correlations(df, names), names)
    upper = np.triu_indices(width, 1)
    assert n == len(upper[0])
    exact = np.corrcoef((x - x.mean(axis=0)).T)
    assert np.allclose(got[upper], exact[upper], atol=1e-6)
    assert correlation.tiled_correlated_features(df, names, 0.99) == columns.correlated_features(df, names, 0.99)
    assert correlation.tiled_correlated_features(df, names, 0.99)[-1] == names[-1]


def test_odd_columns(spark):
    df = spark.createDataFrame(
        [(1, 0.1, 1e300, None, 1.0), (2, 0.1, -1e300, 1.0, float("inf")), (3, 0.1, 0.0, 2.0, 2.0)],
        "a int, c double, big double, hole double, wide double",
    )
    pairs = {(r[0], r[1]): r[2] for r in correlation.tiled_correlations(df, ["a", "c", "big"]).collect()}
    assert pairs["a", "c"] is None and pairs["c", "big"] is None
    assert pairs["a", "big"] == pytest.approx(-0.5)
    for name in ("hole", "wide"):
        with pytest.raises(ValueError, match=name):
            correlation.tiled_correlations(df, ["a", name])
    assert correlation.tiled_correlations(df, ["a"]).count() == 0
    assert correlation.tiled_correlated_features(df, ["a"], 0.9) == []
    for empty in (df.limit(0), df.limit(1)):
        rows = correlation.tiled_correlations(empty, ["a", "c", "big"]).collect()
        assert sorted((r[0], r[1]) for r in rows) == [("a", "big"), ("a", "c"), ("c", "big")]
        assert all(r[2] is None for r in rows)
        assert correlation.tiled_correlated_features(empty, ["a", "c"], 0.9) == []


def test_five_thousand_columns(spark):
    """A chain of copies among 5,000 features; no matrix is collected."""
    width = 5_000
    dice = np.random.default_rng(5)
    x = dice.normal(size=(60, width))
    x[:, 1::1000] = 2 * x[:, 0::1000] + 1
    names = [f"f{i}" for i in range(width)]
    row = spark.createDataFrame([(r.tolist(),) for r in x], "v array<double>").coalesce(1)
    df = row.select(*[F.col("v")[i].alias(n) for i, n in enumerate(names)])
    assert correlation.tiled_correlated_features(df, names, 0.95) == names[1::1000]
