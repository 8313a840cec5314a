"""Boosting and node tables beside a plain trainer, edge rows and library models."""

import math
import random

import pytest
from pyspark.ml.classification import GBTClassifier
from pyspark.sql import functions as F

from vintagemart.operators import boosting, modelling, split, trees
from vintagemart.operators.boosting import LEAST_GAIN, UNIT, Settings
from vintagemart.sources.scratch import scratch_path


def some_rows(n=160, width=5, seed=2):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        x = [round(rng.gauss(0, 1), 2) if rng.random() > 0.1 else None for _ in range(width)]
        x[-1] = rng.choice([0.0, 1.0, float("nan")])
        y = int((x[0] or 0.8) + 0.5 * (x[1] or 0) + rng.gauss(0, 0.5) > 0.4)
        rows.append((i, x, y, 1.0 + (i % 3)))
    return rows


def frame(spark, rows):
    return spark.createDataFrame(rows, "id long, features array<double>, label int, weight double").repartition(3)


def missing(v):
    return v is None or math.isnan(v)


def shrunk(g, s):
    return math.copysign(max(abs(g) - s.l1, 0.0), g)


def strength(g, h, s):
    return shrunk(g, s) ** 2 / (h + s.l2)


def plain_tree(rows, sums, s, cuts, depth):
    """A tree as nested tuples, by trying every split on the rows themselves."""
    g, h = (sum(sums[i][k] for i, *_ in rows) / UNIT for k in (0, 1))
    leaf = ("leaf", -shrunk(g, s) / (h + s.l2) * s.step)
    best = None
    for f in range(len(cuts)) if depth else []:
        bins = [(None, True)] + [(c, side) for c in [*cuts[f], math.inf] for side in (False, True)]
        for c, side in bins:
            left = [r for r in rows if (side if missing(r[1][f]) else c is not None and r[1][f] <= c)]
            gl, hl = (sum(sums[i][k] for i, *_ in left) / UNIT for k in (0, 1))
            if 0 < len(left) < len(rows) and min(hl, h - hl) >= s.min_child:
                gain = strength(gl, hl, s) + strength(g - gl, h - hl, s) - strength(g, h, s)
                if gain > LEAST_GAIN and (best is None or gain > best[0]):
                    best = (gain, f, c, side, left)
    if best is None:
        return leaf
    gain, f, c, side, left = best
    ids = {r[0] for r in left}
    sides = [plain_tree([r for r in rows if (r[0] in ids) == k], sums, s, cuts, depth - 1) for k in (True, False)]
    if gain < s.gamma and all(x[0] == "leaf" for x in sides):
        return leaf
    return ("split", f, c, side, *sides)


def reached(tree, x):
    while tree[0] == "split":
        _, f, c, side, left, right = tree
        goes = side if missing(x[f]) else c is not None and x[f] <= c
        tree = left if goes else right
    return tree[1]


@pytest.mark.parametrize(
    "s",
    [
        Settings(trees=2, depth=3, step=0.5, l1=0.2, l2=2.0, gamma=0.6, min_child=3.0, bins=8),
        Settings(trees=6, depth=2, l2=0.5, min_child=0.5, bins=4),
    ],
)
def test_same_trees_as_a_plain_trainer(spark, s):
    rows = some_rows()
    df = frame(spark, rows)
    model = boosting.fit_boosted_trees(df, ["id"], s, weight="weight")
    margins = {i: 0.0 for i, *_ in rows}
    for _ in range(s.trees):
        sums = {}
        for i, _, y, w in rows:
            p = 1 / (1 + math.exp(-margins[i]))
            sums[i] = [math.floor(v * w * UNIT + 0.5) for v in (p - y, p * (1 - p))]
        tree = plain_tree(rows, sums, s, model.cuts, s.depth)
        margins = {i: margins[i] + reached(tree, x) for i, x, *_ in rows}
    found = trees.score_nodes(df, model.nodes(spark), ["id"]).collect()
    assert {r["id"]: pytest.approx(r["score"], abs=1e-9) for r in found} == margins


def test_cuts_are_the_values_at_the_ranks(spark):
    df = frame(spark, some_rows())
    cuts = boosting.quantile_cuts(df, 8)
    for f, found in enumerate(cuts):
        values = sorted(x[f] for _, x, *_ in some_rows() if not missing(x[f]))
        assert found == sorted({values[math.ceil(k / 8 * len(values)) - 1] for k in range(1, 8)})


def test_drawn_rows_and_columns_are_the_same_for_every_partitioning(spark):
    s = Settings(trees=3, depth=2, subsample=0.7, columns=0.5, bins=8)
    df = frame(spark, some_rows())
    one = boosting.fit_boosted_trees(df.repartition(7), ["id"], s).node_rows()
    assert one == boosting.fit_boosted_trees(df.coalesce(1), ["id"], s).node_rows()
    used = {t: {r[2] for r in one if r[0] == t and r[2] is not None} for t in range(3)}
    assert all(used[t] <= set(boosting.drawn_columns(s, t, 5)) for t in used)
    assert len(boosting.drawn_columns(s, 0, 5)) == 2


def test_edge_rows(spark):
    s = Settings(trees=1, depth=2, bins=4)
    df = frame(spark, some_rows(40))
    model = boosting.fit_boosted_trees(df.limit(0), ["id"], s)
    assert [r[-1] for r in model.node_rows()] == [0.0]
    same = boosting.fit_boosted_trees(df.withColumn("features", F.array(F.lit(1.0), F.lit(None))), ["id"], s)
    assert len(same.node_rows()) == 1
    # Rows without label, weight or features take no part, and are not scored.
    bad = spark.createDataFrame([(90, None, 1, 1.0), (91, [9.0] * 5, None, 1.0), (92, [9.0] * 5, 1, None)], df.schema)
    model = boosting.fit_boosted_trees(df, ["id"], s, weight="weight")
    assert boosting.fit_boosted_trees(df.union(bad), ["id"], s, weight="weight").node_rows() == model.node_rows()
    scored = trees.score_nodes(bad, model.nodes(spark), ["id"]).collect()
    assert [r["score"] is None for r in sorted(scored)] == [True, False, False]
    infinite = spark.createDataFrame([(1, [math.inf, -math.inf, None, 0.0, math.nan], 1, 1.0)], df.schema)
    both = boosting.fit_boosted_trees(df.union(infinite), ["id"], s)
    assert trees.score_nodes(infinite, both.nodes(spark), ["id"]).first()["score"] is not None


def test_search_finds_the_better_setting(spark):
    rows = [(i, x, y, w) for i, x, y, w in some_rows(300, seed=7)]
    dealt = modelling.stratified_folds(frame(spark, rows), ["id"], "label", 2)
    grid = {"trees": [3], "depth": [2], "step": [0.5], "bins": [8], "l2": [1.0, 1e9]}
    settings = boosting.search_settings(5, grid=grid)
    assert len(settings) == 2 and len(boosting.search_settings()) == 100
    best, scores = boosting.tune_regularised_trees(dealt, ["id"], settings, score_classes=False)
    assert best.settings.l2 == 1.0 and max(scores) > 0.8


@pytest.mark.parametrize("boosted", [False, True])
def test_saved_models_score_as_their_library(spark, boosted):
    rows = [(i, [v if v is not None and not math.isnan(v) else 0.5 for v in x], y, w) for i, x, y, w in some_rows()]
    df = modelling.with_vector(frame(spark, rows))
    if boosted:
        estimator = GBTClassifier(featuresCol=modelling.VECTOR, labelCol="label", maxIter=4, maxDepth=3, seed=1)
    else:
        estimator = modelling.random_forest(trees=7)
    model = modelling.fit(estimator, split.add_class_weights(df.drop("weight")))
    path = scratch_path(spark, "model")
    model.write().save(path)
    nodes = trees.saved_trees(spark, trees.forest_path(spark, path))
    assert nodes.columns == [f.split()[0] for f in trees.NODE_SCHEMA.split(", ")]
    own = modelling.predict(model, df, ["id", "features"])
    own = own.withColumnRenamed("prediction_probability", "p").drop("prediction_binary")
    scored = trees.score_nodes(own, nodes, ["id", "p"]).collect()
    for r in scored:
        # Margins of boosted trees are half the log odds.
        expected = 1 / (1 + math.exp(-2 * r["score"])) if boosted else r["score"]
        assert r["p"] == pytest.approx(expected, abs=1e-9)


def test_model_size_is_checked(spark, monkeypatch):
    monkeypatch.setattr(trees, "MAX_NODES", 1)
    s = Settings(trees=1, depth=1, bins=4)
    df = frame(spark, some_rows(60))
    with pytest.raises(ValueError):
        trees.ensemble_score(boosting.fit_boosted_trees(df, ["id"], s).nodes(spark))
