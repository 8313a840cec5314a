"""Exact ROC-AUC and the metrics of hard classes, per group, in one pass.

The AUC needs, for every positive, the number of negatives scored below it.
A running count over a group's sorted scores would put a whole snapshot (which
may be a third of all rows) into one task. Instead each score is cut into
three digits whose order is the order of the scores, and pairs are counted at
the first digit in which they differ:

    equal scores -> same (top, mid), other score -> same top, other mid
    -> other top

Every step aggregates first and then runs over the children of one prefix,
of which there are at most a few million however many rows there are, and each
step shuffles only the aggregated counts of the step below.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

LOWEST_EXPONENT = -1000
TOP_BITS = 10
MID_BITS = 22

_CELLS = ("tn", "fp", "fn", "tp")
SCORE_COLUMNS = ("top", "mid", "score")


def _score_digits(score: Column) -> tuple[Column, Column]:
    """Two integers that never decrease as the score grows.

    ``top`` is the binary exponent and the first mantissa bits, ``mid`` the next
    bits. Scaling by powers of two is exact, so scores keep their order; scores
    that agree in both are compared themselves.
    """
    sign = F.signum(score).cast("bigint")
    size = F.abs(score)
    exponent = F.greatest(F.floor(F.log2(size)), F.lit(LOWEST_EXPONENT).cast("bigint"))
    mantissa = size * F.pow(F.lit(2.0), -exponent.cast("double")) / F.lit(4.0)
    scaled = mantissa * F.lit(float(2**TOP_BITS))
    first = F.floor(scaled)
    rest = F.floor((scaled - first.cast("double")) * F.lit(float(2**MID_BITS)))
    top = sign * ((exponent - LOWEST_EXPONENT + 1) * 2**TOP_BITS + first)
    zero = F.lit(0).cast("bigint")
    return F.coalesce(top, zero), F.coalesce(sign * rest, zero)


def _count_pairs(counts: DataFrame, prefix: Sequence[str], digit: str) -> DataFrame:
    """Add the pairs that differ first in ``digit`` and aggregate to the prefix."""
    lower = (
        Window.partitionBy(*prefix).orderBy(digit).rowsBetween(Window.unboundedPreceding, -1)
    )
    negatives = F.col("tn") + F.col("fp")
    positives = F.col("fn") + F.col("tp")
    below = F.coalesce(F.sum(negatives).over(lower), F.lit(0))
    paired = counts.withColumn(
        "wins", F.col("wins") + positives.cast("double") * below.cast("double")
    )
    return paired.groupBy(*prefix).agg(
        F.sum("wins").alias("wins"),
        F.sum("n_bad").alias("n_bad"),
        *[F.sum(c).alias(c) for c in _CELLS],
    )


def _cell(actual: Column, predicted: Column, a: int, p: int) -> Column:
    return F.count_if((actual == a) & (predicted == p))


def _rate(numerator: Column, denominator: Column) -> Column:
    return F.coalesce(
        F.try_divide(numerator.cast("double"), denominator.cast("double")), F.lit(0.0)
    )


def class_metric_columns(
    tn: Column, fp: Column, fn: Column, tp: Column
) -> dict[str, Column]:
    """Precision, recall and F1; a zero divisor gives 0."""
    return {
        "precision": _rate(tp, tp + fp),
        "recall": _rate(tp, tp + fn),
        "f1": _rate(2 * tp, 2 * tp + fp + fn),
    }


def score_counts(
    df: DataFrame,
    groups: Sequence[str],
    label: str,
    score: str,
    predicted: str | None,
) -> DataFrame:
    """Per group and score: the four confusion cells, how many rows lack a binary label,
    a finite score or a binary class, and all rows. Counts of several tables add up."""
    actual = F.col(label)
    value = F.col(score).cast("double")
    guess = F.col(predicted) if predicted else F.lit(1)
    finite = F.abs(value) < F.lit(float("inf"))
    usable = actual.isin(0, 1) & finite & guess.isin(0, 1)
    bad = F.coalesce(~usable, F.lit(True))
    keys = [f"__g{i}" for i in range(len(groups))] or ["__all"]
    named = [F.col(g).alias(k) for g, k in zip(groups, keys)] or [F.lit(0).alias("__all")]
    rows = df.select(
        *named, value.alias("score"), actual.alias("actual"), guess.alias("guess"), bad.alias("bad")
    )
    top, mid = _score_digits(F.when(F.col("bad"), F.lit(0.0)).otherwise(F.col("score")))
    counted = (
        rows.withColumn("top", top)
        .withColumn("mid", mid)
        .groupBy(*keys, "top", "mid", "score")
        .agg(
            _cell(F.col("actual"), F.col("guess"), 0, 0).alias("tn"),
            _cell(F.col("actual"), F.col("guess"), 0, 1).alias("fp"),
            _cell(F.col("actual"), F.col("guess"), 1, 0).alias("fn"),
            _cell(F.col("actual"), F.col("guess"), 1, 1).alias("tp"),
            F.count_if("bad").alias("n_bad"),
            F.count("*").alias("n_rows"),
        )
    )
    back = dict(zip(keys, groups))
    return counted.select(
        *[F.col(k).alias(g) for k, g in back.items()], *SCORE_COLUMNS, *_CELLS, "n_bad", "n_rows"
    )


def summed_counts(counts: DataFrame, groups: Sequence[str]) -> DataFrame:
    """Per group of rows of ``score_counts``: winning pairs, cells and unusable rows."""
    keys = [f"__g{i}" for i in range(len(groups))] or ["__all"]
    named = [F.col(g).alias(k) for g, k in zip(groups, keys)] or [F.lit(0).alias("__all")]
    base = (
        counts.select(*named, *SCORE_COLUMNS, *_CELLS, "n_bad")
        .groupBy(*keys, *SCORE_COLUMNS)
        .agg(*[F.sum(c).alias(c) for c in (*_CELLS, "n_bad")])
    )
    ties = (F.col("fn") + F.col("tp")).cast("double") * (F.col("tn") + F.col("fp")).cast("double")
    counts = base.withColumn("wins", F.lit(0.5) * ties)
    counts = _count_pairs(counts, [*keys, "top", "mid"], "score")
    counts = _count_pairs(counts, [*keys, "top"], "mid")
    counts = _count_pairs(counts, keys, "top")
    back = dict(zip(keys, groups))
    return counts.select(
        *[F.col(k).alias(g) for k, g in back.items()], "wins", "n_bad", *_CELLS
    )


def scored_counts(
    df: DataFrame,
    groups: Sequence[str],
    label: str,
    score: str,
    predicted: str | None,
) -> DataFrame:
    """Per group of rows: winning pairs, cells and unusable rows."""
    return summed_counts(score_counts(df, groups, label, score, predicted), groups)


def _auc_column(one_class: float | None) -> Column:
    positives = (F.col("fn") + F.col("tp")).cast("double")
    negatives = (F.col("tn") + F.col("fp")).cast("double")
    both = (positives > 0) & (negatives > 0)
    return F.when(
        F.col("n_bad") == 0,
        F.when(both, F.col("wins") / (positives * negatives)).otherwise(
            F.lit(one_class).cast("double")
        ),
    )


def roc_auc(
    df: DataFrame,
    groups: Sequence[str] = (),
    label: str = "actual_label",
    score: str = "prediction_probability",
    one_class: float | None = 0.5,
) -> DataFrame:
    """Tie-aware ROC-AUC per group; ``one_class`` where only one class occurs, null
    where a row has no binary label or no finite score."""
    counts = scored_counts(df, groups, label, score, None)
    return counts.select(
        *groups,
        (F.col("tn") + F.col("fp") + F.col("fn") + F.col("tp")).alias("n_rows"),
        _auc_column(one_class).alias("auc"),
    )


def gini(auc: Column) -> Column:
    return F.round(F.lit(2.0) * auc - F.lit(1.0), 3)


def confusion_cells(
    df: DataFrame,
    groups: Sequence[str] = (),
    label: str = "actual_label",
    predicted: str = "prediction_binary",
) -> DataFrame:
    actual, guess = F.col(label), F.col(predicted)
    return df.groupBy(*groups).agg(
        _cell(actual, guess, 0, 0).alias("tn"),
        _cell(actual, guess, 0, 1).alias("fp"),
        _cell(actual, guess, 1, 0).alias("fn"),
        _cell(actual, guess, 1, 1).alias("tp"),
    )


def confusion_matrix(cells: DataFrame) -> DataFrame:
    """``[[tn, fp], [fn, tp]]`` from the four cells."""
    matrix = F.array(F.array("tn", "fp"), F.array("fn", "tp"))
    return cells.withColumn("confusion_matrix", matrix).drop(*_CELLS)


def classification_metrics(
    df: DataFrame,
    groups: Sequence[str] = (),
    label: str = "actual_label",
    predicted: str = "prediction_binary",
) -> DataFrame:
    cells = confusion_cells(df, groups, label, predicted)
    metrics = class_metric_columns(*[F.col(c) for c in _CELLS])
    return cells.select(*groups, *[m.alias(n) for n, m in metrics.items()])


def model_metrics(
    df: DataFrame,
    groups: Sequence[str] = (),
    label: str = "label",
    score: str = "prediction_probability",
    predicted: str = "prediction_binary",
) -> DataFrame:
    """AUC (0.5 for a single class), precision, recall, F1 and the cells."""
    counts = scored_counts(df, groups, label, score, predicted)
    metrics = class_metric_columns(*[F.col(c) for c in _CELLS])
    return counts.select(
        *groups, _auc_column(0.5).alias("auc"), *[m.alias(n) for n, m in metrics.items()], *_CELLS
    )


def skip_reason() -> Column:
    """Why summed counts give no metrics; null if they do."""
    tn, fp, fn, tp = (F.col(c) for c in _CELLS)
    return F.when(F.col("n_bad") > 0, "rows without a label, score or class").when(
        (fn + tp == 0) | (tn + fp == 0), "only one class"
    )


def skipped_groups(
    df: DataFrame,
    groups: Sequence[str] = ("snapshot_date",),
    label: str = "actual_label",
    score: str = "prediction_probability",
    predicted: str = "prediction_binary",
) -> DataFrame:
    """The groups that ``performance_by_group`` has no row for, and why: rows,
    unusable rows among them, reason."""
    counts = scored_counts(df, groups, label, score, predicted)
    found = counts.withColumn("reason", skip_reason()).where("reason is not null")
    return with_rows(found, df.groupBy(*groups).agg(F.count("*").alias("n_rows")), groups)


def with_rows(found: DataFrame, rows: DataFrame, groups: Sequence[str]) -> DataFrame:
    """Skipped groups with the number of their rows; null groups are groups."""
    same = [found[g].eqNullSafe(rows[g]) for g in groups]
    joined = found.join(rows, same) if groups else found.join(rows)
    return joined.select(*[found[g] for g in groups], "n_rows", "n_bad", "reason")


def performance_by_group(
    df: DataFrame,
    groups: Sequence[str] = ("snapshot_date",),
    label: str = "actual_label",
    score: str = "prediction_probability",
    predicted: str = "prediction_binary",
) -> DataFrame:
    """Full metric row per group.

    Groups with one class only, or with a missing label, score or class, have
    no row; ``skipped_groups`` lists them.
    """
    return performance_of(scored_counts(df, groups, label, score, predicted), groups)


def performance_of(counts: DataFrame, groups: Sequence[str]) -> DataFrame:
    """The metric rows of ``performance_by_group`` from summed counts."""
    tn, fp, fn, tp = (F.col(c) for c in _CELLS)
    n = tn + fp + fn + tp
    metrics = class_metric_columns(tn, fp, fn, tp)
    usable = (F.col("n_bad") == 0) & (fn + tp > 0) & (tn + fp > 0)
    return counts.where(usable).select(
        *groups,
        n.alias("num_samples"),
        ((fn + tp) / n).alias("actual_default_rate"),
        ((fp + tp) / n).alias("predicted_default_rate"),
        _auc_column(None).alias("auc"),
        *[m.alias(name) for name, m in metrics.items()],
        *_CELLS,
    )
