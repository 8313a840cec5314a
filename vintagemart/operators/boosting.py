"""Second-order gradient boosting with L1, L2, gamma and columns drawn per tree.

Features are binned once, at quantiles. A level of a tree is one grouped aggregate over
the rows: gradient and hessian sums per (node, feature, bin), summed up in the tasks
first, so what is shuffled depends on the settings and not on the rows. Cumulative sums
over bins give the gain of every split; the best one per node, at most 2 ** depth rows,
goes to the driver and becomes part of the expression that places rows in the next
level. Gradients are whole numbers of 2 ** -24, so sums don't depend on the order of
rows and a recomputed task or another partitioning gives the same trees.
"""

from __future__ import annotations

import json
import math
import random
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, replace
from itertools import product

from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F

from vintagemart.operators import evaluation
from vintagemart.operators.ranking import shuffle_key, unit_interval
from vintagemart.operators.trees import NODE_SCHEMA, predict_nodes
from vintagemart.sources.scratch import materialize

# Gradients are kept as whole numbers of this; sums hold for 5e11 rows.
UNIT = 1 << 24
# A gain below this is rounding.
LEAST_GAIN = 1e-6
# Rows get their margin stored anew after so many trees.
STORED_EVERY = 5

# The searched grid of the regularised trainer.
REGULARISED_GRID = {
    "trees": [25, 50],
    "depth": [2, 3],
    "step": [0.01, 0.1],
    "subsample": [0.6, 0.8],
    "columns": [0.6, 0.8],
    "gamma": [0, 0.1],
    "min_child": [1, 3, 5],
    "l1": [0, 0.1, 1],
    "l2": [1, 1.5, 2],
}


@dataclass(frozen=True)
class Settings:
    """``subsample`` and ``columns`` are shares of rows and features drawn per tree;
    ``min_child`` is the least hessian sum of a child, ``gamma`` the least gain of a
    split whose children stay leaves."""

    trees: int = 50
    depth: int = 3
    step: float = 0.1
    subsample: float = 1.0
    columns: float = 1.0
    l1: float = 0.0
    l2: float = 1.0
    gamma: float = 0.0
    min_child: float = 1.0
    bins: int = 64
    seed: int = 88


@dataclass
class Node:
    """Sums of a node, and its split while it has one. Children are 2i and 2i + 1."""

    g: float
    h: float
    n: int
    feature: int | None = None
    bin: int | None = None
    missing_left: bool | None = None
    gain: float | None = None


def drawn_columns(settings: Settings, tree: int, width: int) -> list[int]:
    """The features that a tree may split on."""
    count = max(1, int(settings.columns * width))
    return sorted(random.Random(f"{settings.seed}:{tree}").sample(range(width), count))


def _missing(x: Column) -> Column:
    return x.isNull() | F.isnan(x)


def quantile_cuts(
    df: DataFrame, bins: int = 64, features: str = "features", accuracy: int = 10_000
) -> list[list[float]]:
    """Per feature the values at the ranks 1/bins, 2/bins ... of its known values, each
    once; exact up to ``accuracy`` rows, else to that share of the ranks."""
    values = df.select(F.posexplode(features).alias("feature", "x")).where(~_missing(F.col("x")))
    shares = F.array(*[F.lit(i / bins) for i in range(1, bins)])
    cuts = F.array_sort(F.array_distinct(F.percentile_approx("x", shares, accuracy)))
    found = {r["feature"]: r["cuts"] for r in values.groupBy("feature").agg(cuts.alias("cuts")).collect()}
    width = df.select(F.max(F.size(features))).first()[0] or 0
    return [found.get(i, []) for i in range(width)]


def binned(
    df: DataFrame, cuts: Sequence[Sequence[float]], keep: Sequence[str], features: str = "features"
) -> DataFrame:
    """``keep`` and ``bins``: 0 for a missing value, else 1 + the number of cuts below
    it, so a value is at most cut k if and only if its bin is at most k."""
    known = F.from_json(F.lit(json.dumps([list(c) for c in cuts])), "array<array<double>>")

    def place(x: Column, i: Column) -> Column:
        below = F.size(F.filter(F.get(known, i), lambda c: c < x))
        return F.when(_missing(x), 0).otherwise(below + 1)

    return df.select(*keep, F.transform(features, place).alias("bins"))


def _shrunk(g: Column, l1: float) -> Column:
    return F.signum(g) * F.greatest(F.abs(g) - F.lit(float(l1)), F.lit(0.0))


def _strength(g: Column, h: Column, settings: Settings) -> Column:
    top = _shrunk(g, settings.l1)
    return top * top / (h + F.lit(float(settings.l2)))


def split_candidates(rows: DataFrame, drawn: Sequence[int], settings: Settings) -> DataFrame:
    """Every split of every node: (node, feature, bin, missing_left, gain, n_left,
    g_left, h_left, g, h, n). ``rows`` has (node, g, h, bins), with ``g`` and ``h`` as
    whole numbers of 1 / UNIT. The gain is null where a child would be too light."""
    features = F.lit(list(drawn))
    entries = F.transform(features, lambda f: F.struct(f.alias("feature"), F.get("bins", f).alias("bin")))
    exploded = rows.select("node", "g", "h", F.inline(entries))
    sums = exploded.groupBy("node", "feature", "bin").agg(
        F.sum("g").alias("g"), F.sum("h").alias("h"), F.count("*").alias("n")
    )
    # As many rows as there are bins of a feature.
    per = Window.partitionBy("node", "feature")
    so_far = per.orderBy("bin").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    total = {f"{c}_all": F.sum(c).over(per) for c in "ghn"}
    left = {f"{c}_left": F.sum(c).over(so_far) for c in "ghn"}
    gone = {f"{c}_gone": F.coalesce(F.sum(F.when(F.col("bin") == 0, F.col(c))).over(per), F.lit(0)) for c in "ghn"}
    cumulated = sums.withColumns({**total, **left, **gone})
    # Bin 0 is summed up first: with it on the left, and once more without.
    sides = F.explode(F.array(F.lit(False), F.lit(True))).alias("missing_left")
    both = cumulated.select("*", sides).where("missing_left or bin > 0")
    real = lambda c: c / F.lit(float(UNIT))
    own = {c: F.col(f"{c}_left") - F.when(F.col("missing_left"), 0).otherwise(F.col(f"{c}_gone")) for c in "ghn"}
    both = both.select(
        "node",
        "feature",
        "bin",
        "missing_left",
        real(own["g"]).alias("g_left"),
        real(own["h"]).alias("h_left"),
        own["n"].alias("n_left"),
        real(F.col("g_all")).alias("g"),
        real(F.col("h_all")).alias("h"),
        F.col("n_all").alias("n"),
    )
    g_right, h_right = F.col("g") - F.col("g_left"), F.col("h") - F.col("h_left")
    gain = (
        _strength(F.col("g_left"), F.col("h_left"), settings)
        + _strength(g_right, h_right, settings)
        - _strength(F.col("g"), F.col("h"), settings)
    )
    heavy = (
        (F.col("n_left") > 0)
        & (F.col("n_left") < F.col("n"))
        & (F.col("h_left") >= float(settings.min_child))
        & (h_right >= float(settings.min_child))
    )
    return both.withColumn("gain", F.when(heavy, gain))


def best_splits(candidates: DataFrame) -> DataFrame:
    """One row per node: the split with the highest gain; ties go to the lower feature,
    the lower bin, and missing values on the right. Nodes without a split have their
    sums only."""
    order = F.struct(
        F.coalesce("gain", F.lit(-math.inf)),
        -F.col("feature"),
        -F.col("bin"),
        ~F.col("missing_left"),
    )
    best = F.max_by(F.struct(*[c for c in candidates.columns if c != "node"]), order)
    return candidates.groupBy("node").agg(best.alias("best")).select("node", "best.*")


def _place(nodes: Mapping[int, Node], of: Column, leaf) -> Column:
    """``leaf(node)`` of the node that ``bins`` lead to, from the root down."""

    def below(i: int) -> Column:
        node = nodes[i]
        if node.feature is None:
            return leaf(i)
        bin_ = F.get(of, F.lit(node.feature))
        left = bin_ <= node.bin if node.missing_left else (bin_ <= node.bin) & (bin_ > 0)
        return F.when(left, below(2 * i)).otherwise(below(2 * i + 1))

    return below(1)


def _grow(rows: DataFrame, drawn: Sequence[int], settings: Settings) -> dict[int, Node]:
    """``rows`` has (g, h, bins)."""
    nodes: dict[int, Node] = {1: Node(0.0, 0.0, 0)}
    open_nodes = [1]
    for level in range(settings.depth):
        at = _place(nodes, F.col("bins"), lambda i: F.lit(i))
        placed = rows.withColumn("node", at).where(F.col("node").isin(open_nodes))
        found = best_splits(split_candidates(placed, drawn, settings)).collect()
        if level == 0:
            if not found:
                return nodes
            nodes[1] = Node(found[0]["g"], found[0]["h"], found[0]["n"])
        open_nodes = []
        for best in sorted(found, key=lambda r: r["node"]):
            if best["gain"] is not None and best["gain"] > LEAST_GAIN:
                open_nodes += _split(nodes, best)
        if not open_nodes:
            break
    _prune(nodes, 1, settings.gamma)
    return nodes


def _split(nodes: dict[int, Node], best: Row) -> list[int]:
    i, node = best["node"], nodes[best["node"]]
    node.feature, node.bin, node.gain = best["feature"], best["bin"], best["gain"]
    node.missing_left = best["missing_left"]
    g, h, n = best["g_left"], best["h_left"], best["n_left"]
    nodes[2 * i] = Node(g, h, n)
    nodes[2 * i + 1] = Node(best["g"] - g, best["h"] - h, best["n"] - n)
    return [2 * i, 2 * i + 1]


def _prune(nodes: dict[int, Node], i: int, gamma: float) -> None:
    """From the leaves up, splits that gain too little and whose children are leaves go."""
    if nodes[i].feature is None:
        return
    children = (2 * i, 2 * i + 1)
    for child in children:
        _prune(nodes, child, gamma)
    if nodes[i].gain < gamma and all(nodes[c].feature is None for c in children):
        nodes[i].feature = nodes[i].bin = nodes[i].missing_left = nodes[i].gain = None
        for child in children:
            del nodes[child]


def leaf_value(node: Node, settings: Settings) -> float:
    top = math.copysign(max(abs(node.g) - settings.l1, 0.0), node.g)
    return -top / (node.h + settings.l2) * settings.step


class BoostedTrees:
    """Fitted trees: margins are log odds and begin at 0."""

    def __init__(self, settings: Settings, cuts: list[list[float]], trees: list[dict[int, Node]]) -> None:
        self.settings, self.cuts, self.trees = settings, cuts, trees

    def node_rows(self) -> list[tuple]:
        out = []
        for t, nodes in enumerate(self.trees):
            for i, node in sorted(nodes.items()):
                if node.feature is None:
                    out.append((t, i, None, None, None, None, None, leaf_value(node, self.settings)))
                else:
                    cut = self.cuts[node.feature]
                    # Beyond the last cut: all known values.
                    threshold = cut[node.bin - 1] if node.bin <= len(cut) else math.inf
                    threshold = None if node.bin == 0 else threshold
                    out.append((t, i, node.feature, threshold, node.missing_left, 2 * i, 2 * i + 1, None))
        return out

    def nodes(self, spark) -> DataFrame:
        """The node table that ``trees.score_nodes`` reads."""
        return spark.createDataFrame(self.node_rows(), NODE_SCHEMA)

    def split_table(self, spark) -> DataFrame:
        """(tree, node, feature, bin, missing_left, gain, g, h, n, value): gains of splits
        and values of leaves, with the sums they come from."""
        rows = []
        for t, nodes in enumerate(self.trees):
            for i, x in sorted(nodes.items()):
                value = leaf_value(x, self.settings) if x.feature is None else None
                rows.append((t, i, x.feature, x.bin, x.missing_left, x.gain, x.g, x.h, x.n, value))
        return spark.createDataFrame(
            rows,
            "tree int, node int, feature int, bin int, missing_left boolean, gain double, "
            "g double, h double, n long, value double",
        )


def gradients(margin: Column, label: Column, weight: Column) -> tuple[Column, Column]:
    """First and second derivative of the log loss, as whole numbers of 1 / UNIT."""
    p = 1.0 / (1.0 + F.exp(-margin))
    whole = lambda x: F.floor(x * F.lit(float(UNIT)) + 0.5).cast("long")
    return whole((p - label) * weight), whole(p * (1.0 - p) * weight)


def fit_boosted_trees(
    train: DataFrame,
    ids: Sequence[str],
    settings: Settings | None = None,
    label: str = "label",
    weight: str | None = None,
    features: str = "features",
    cuts: list[list[float]] | None = None,
) -> BoostedTrees:
    """Boosted trees on an array of features and a 0/1 label.

    Missing values (null or NaN) go to the side with the higher gain; a null label or
    weight leaves a row out. Rows are drawn per tree by a hash of ``ids``. Without rows
    every tree is one leaf of value 0.
    """
    settings = settings or Settings()
    known = train.where(F.col(label).isNotNull() & F.col(features).isNotNull())
    if weight:
        known = known.where(F.col(weight).isNotNull())
    if cuts is None:
        cuts = quantile_cuts(known, settings.bins, features)
    named = known.select(
        F.concat_ws(":", *[F.col(c).cast("string") for c in ids]).alias("id"),
        F.col(label).cast("double").alias("label"),
        (F.col(weight) if weight else F.lit(1.0)).cast("double").alias("weight"),
        F.col(features).alias("features"),
    )
    columns = ["id", "label", "weight"]
    state = binned(named, cuts, columns, "features").withColumn("margin", F.lit(0.0))
    state = materialize(state, "binned")
    trees: list[dict[int, Node]] = []
    margin = F.col("margin")
    for t in range(settings.trees):
        if t and t % STORED_EVERY == 0:
            state = materialize(state.select(*columns, "bins", margin.alias("margin")), "binned")
            margin = F.col("margin")
        g, h = gradients(margin, F.col("label"), F.col("weight"))
        rows = state
        if settings.subsample < 1.0:
            key = unit_interval(shuffle_key(["id"], f"boost:{settings.seed}:{t}"))
            rows = state.where(key < settings.subsample)
        drawn = drawn_columns(settings, t, len(cuts)) if cuts else []
        grown = {1: Node(0.0, 0.0, 0)}
        if drawn:
            grown = _grow(rows.select(g.alias("g"), h.alias("h"), "bins"), drawn, settings)
        trees.append(grown)
        margin = margin + _place(grown, F.col("bins"), lambda i, n=grown: F.lit(leaf_value(n[i], settings)))
    return BoostedTrees(settings, cuts, trees)


def search_settings(
    draws: int = 100, seed: int = 42, grid: Mapping[str, list] | None = None, base: Settings | None = None
) -> list[Settings]:
    """Distinct random settings from the grid; all of them if it is smaller."""
    grid = grid or REGULARISED_GRID
    every = [dict(zip(grid, values)) for values in product(*grid.values())]
    picked = random.Random(seed).sample(every, min(draws, len(every)))
    return [replace(base or Settings(), **setting) for setting in picked]


def tune_regularised_trees(
    dealt: DataFrame,
    ids: Sequence[str],
    settings: Sequence[Settings],
    label: str = "label",
    features: str = "features",
    score_classes: bool = True,
) -> tuple[BoostedTrees, list[float]]:
    """The model refitted with the best of ``settings``, and the mean held-out AUC of
    each. ``dealt`` has ``fold``; ties go to the earlier setting.

    ``score_classes`` ranks by the exact AUC of hard classes, else of probabilities.
    """
    dealt = materialize(dealt.select(*ids, label, features, "fold"), "dealt")
    folds = [r["fold"] for r in dealt.select("fold").distinct().orderBy("fold").collect()]
    cuts = {}
    spark = dealt.sparkSession
    held_out = []
    for k, chosen in enumerate(settings):
        for fold in folds:
            train = dealt.where(F.col("fold") != fold)
            if (fold, chosen.bins) not in cuts:
                cuts[fold, chosen.bins] = quantile_cuts(train, chosen.bins, features)
            model = fit_boosted_trees(train, ids, chosen, label, None, features, cuts[fold, chosen.bins])
            scored = predict_nodes(
                dealt.where(F.col("fold") == fold), model.nodes(spark), [label], True, features
            )
            held_out.append(scored.select(F.lit(k).alias("setting"), F.lit(fold).alias("fold"), "*"))
    # All settings and folds are judged in one pass.
    scores = held_out[0]
    for more in held_out[1:]:
        scores = scores.unionByName(more)
    judged = "prediction_binary" if score_classes else "prediction_probability"
    scores = scores.select("setting", "fold", label, F.col(judged).cast("double").alias("score"))
    auc = evaluation.roc_auc(scores, ["setting", "fold"], label, "score")
    means = {r["setting"]: r["auc"] for r in auc.groupBy("setting").agg(F.avg("auc").alias("auc")).collect()}
    order = [means.get(k, 0.0) or 0.0 for k in range(len(settings))]
    best = max(range(len(settings)), key=lambda k: order[k])
    return fit_boosted_trees(dealt, ids, settings[best], label, None, features), order
