"""Tree ensembles as node tables: export, storage form and scoring.

One row per node: (tree, node, feature, threshold, missing_left, left, right, value).
A row goes left if its feature is at most the threshold. Leaves have no feature; a
score is the sum of the values of the leaves that a row reaches.

A model is bounded by its settings (trees times 2 ** depth), not by the data, so it
travels with the tasks as one constant: nested arrays that a native expression walks.
Nothing is joined, shuffled or handed to Python.
"""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

NODE_SCHEMA = (
    "tree int, node int, feature int, threshold double, missing_left boolean, "
    "left int, right int, value double"
)
# Nodes of one model that may become a constant of the plan.
MAX_NODES = 2_000_000

_TREE_SCHEMA = (
    "array<struct<depth: int, feature: array<int>, threshold: array<double>, "
    "missing_left: array<boolean>, left: array<int>, right: array<int>, value: array<double>>>"
)


def saved_trees(spark: SparkSession, stage_path: str) -> DataFrame:
    """The node table of a forest or boosted model of ``pyspark.ml`` that was saved at
    ``stage_path``, read from its stored nodes.

    A forest's values are the class-1 shares of its leaves over the number of trees, so
    scores are probabilities; boosted trees' values are predictions by tree weight, so
    scores are margins (half the log odds). Categorical splits are refused.
    """
    nodes = spark.read.parquet(f"{stage_path}/data").select("treeID", "nodeData.*")
    if not nodes.where("split.numCategories >= 0 and leftChild >= 0").isEmpty():
        raise ValueError("categorical splits have no threshold")
    # Stored by position: tree, its settings, its weight.
    meta = spark.read.parquet(f"{stage_path}/treesMetadata").toDF("treeID", "settings", "weights")
    # One row per tree.
    joined = nodes.join(F.broadcast(meta), "treeID")
    forest = not spark.read.text(f"{stage_path}/metadata").where(
        F.col("value").contains("RandomForestClassificationModel")
    ).isEmpty()
    stats = F.col("impurityStats")
    if forest:
        share = stats[1] / F.aggregate(stats, F.lit(0.0), lambda a, x: a + x)
        value = share / F.lit(meta.count())
    else:
        value = F.col("prediction") * F.col("weights")
    inner = F.col("leftChild") >= 0
    return joined.select(
        F.col("treeID").alias("tree"),
        F.col("id").alias("node"),
        F.when(inner, F.col("split.featureIndex")).alias("feature"),
        F.when(inner, F.col("split.leftCategoriesOrThreshold")[0]).alias("threshold"),
        F.when(inner, F.lit(False)).alias("missing_left"),
        F.when(inner, F.col("leftChild")).alias("left"),
        F.when(inner, F.col("rightChild")).alias("right"),
        F.when(~inner, value).alias("value"),
    )


def forest_path(spark: SparkSession, model_path: str) -> str:
    """The folder of the last stage of a saved pipeline."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    root = hadoop(f"{model_path}/stages")
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    found = [s.getPath() for s in root.getFileSystem(conf).listStatus(root)]
    last = max(found, key=lambda p: int(p.getName().split("_")[0]))
    return last.toString()


def _tree(rows: list) -> dict:
    """One tree with its nodes numbered from the root, 0, on."""
    by_node = {r["node"]: r for r in rows}
    children = {c for r in rows for c in (r["left"], r["right"]) if c is not None}
    (root,) = [n for n in by_node if n not in children]
    order, depth_of = [root], {root: 0}
    for n in order:
        for child in (by_node[n]["left"], by_node[n]["right"]):
            if child is not None:
                order.append(child)
                depth_of[child] = depth_of[n] + 1
    place = {n: i for i, n in enumerate(order)}
    inner = [by_node[n]["feature"] is not None for n in order]
    pick = lambda name, other: [by_node[n][name] if i else other for n, i in zip(order, inner)]
    return {
        "depth": max(depth_of.values()),
        "feature": pick("feature", -1),
        "threshold": pick("threshold", 0.0),
        "missing_left": pick("missing_left", False),
        "left": [place[by_node[n]["left"]] if i else -1 for n, i in zip(order, inner)],
        "right": [place[by_node[n]["right"]] if i else -1 for n, i in zip(order, inner)],
        "value": [0.0 if i else by_node[n]["value"] for n, i in zip(order, inner)],
    }


def ensemble_score(nodes: DataFrame, features: str | Column = "features") -> Column:
    """The sum of the leaf values that a row's feature array reaches, tree by tree.

    A feature that is null or NaN counts as missing and follows ``missing_left``. Without
    a threshold all known values go right. Without trees the score is 0.
    """
    rows = nodes.limit(MAX_NODES + 1).collect()
    if len(rows) > MAX_NODES:
        raise ValueError(f"more than {MAX_NODES} nodes")
    by_tree: dict[int, list] = {}
    for row in rows:
        by_tree.setdefault(row["tree"], []).append(row)
    model = json.dumps([_tree(by_tree[t]) for t in sorted(by_tree)])
    # A constant expression: evaluated once, when the plan is made.
    trees = F.from_json(F.lit(model), _TREE_SCHEMA)
    x = F.col(features) if isinstance(features, str) else features

    def step(tree: Column, node: Column) -> Column:
        value = F.get(x, F.get(tree["feature"], node))
        goes_left = F.when(
            value.isNull() | F.isnan(value), F.get(tree["missing_left"], node)
        ).otherwise(value <= F.get(tree["threshold"], node))
        below = F.when(goes_left, F.get(tree["left"], node)).otherwise(F.get(tree["right"], node))
        return F.when(F.get(tree["left"], node) < 0, node).otherwise(below)

    def leaf(tree: Column) -> Column:
        levels = F.array_repeat(F.lit(0), tree["depth"])
        node = F.aggregate(levels, F.lit(0), lambda at, _: step(tree, at))
        return F.get(tree["value"], node)

    return F.aggregate(trees, F.lit(0.0), lambda total, tree: total + leaf(tree))


def score_nodes(
    df: DataFrame, nodes: DataFrame, keep: Sequence[str], features: str = "features"
) -> DataFrame:
    """``keep`` and ``score`` of every row; rows without a feature array have no score."""
    score = F.when(F.col(features).isNotNull(), ensemble_score(nodes, features))
    return df.select(*keep, score.alias("score"))


def predict_nodes(
    df: DataFrame,
    nodes: DataFrame,
    keep: Sequence[str],
    margin: bool,
    features: str = "features",
) -> DataFrame:
    """Positive-class probability and class beside ``keep``, as ``modelling.predict``
    gives them; ``margin`` says that scores are log odds."""
    score = F.col("score")
    probability = 1.0 / (1.0 + F.exp(-score)) if margin else score
    scored = score_nodes(df, nodes, keep, features)
    return scored.select(
        *keep,
        probability.alias("prediction_probability"),
        (probability > 0.5).cast("int").alias("prediction_binary"),
    )
